"""Mixing sources to target weights by subset-sum budget fitting.

Each source has a target number of words. Whole repeats of the source fill as
much of it as they can; the remaining budget is fitted per source on the counts
of documents by exact length: a proportional share of each length first, then
documents by largest remainder, then a bounded-knapsack dynamic programme on
the last ``WINDOW`` words. Documents are chosen by length count in an order
seeded per document, so reruns agree and no length, source or group of copies
is gathered in one task.

Defined results: a null text has size 0 and is taken 0 times; a null source is a
source of its own and sorts last; rows with equal ids are separate documents; an
empty table gives an empty result. The driver holds one row per source, and one
task one row per (source, length).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACES, cut_lineage, group_ranks, text_or_empty

WINDOW = 1 << 15   # words left to the dynamic programme
MOST = 3           # a document is taken at most so many times
SLOTS = 4096       # parts of a (source, length) group that are ranked apart


def cycle_weights(sources: list[str | None]) -> dict[str | None, float]:
    """1, 2, 3, repeating, over the sources by code point, null last."""
    ordered = sorted([s for s in sources if s is not None]) + [None] * (None in sources)
    return {s: float(1 + i % 3) for i, s in enumerate(ordered)}


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], total: float | None = None,
            most: float = MOST) -> dict[str | None, float]:
    """Shares of ``total`` by weight; a target stops at ``most`` times its source's size, the excess is reshared."""
    left = float(sum(sizes.values()) if total is None else total)
    out, open_ = {}, set(sizes)
    while open_:
        weight = math.fsum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / weight > most * sizes[s]} if weight else set()
        if not over:
            out |= {s: left * weights[s] / weight if weight else 0.0 for s in open_}
            break
        out |= {s: float(most * sizes[s]) for s in over}
        left -= math.fsum(out[s] for s in over)
        open_ -= over
    return out


def knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """Documents of each length whose lengths add up to the largest sum within the budget.

    Reachable sums are the bits of one integer; each length's count is split into
    powers of two, and the sums before each part are kept to find the way back.
    """
    taken, mask, reach, steps = [0] * len(lengths), (1 << (budget + 1)) - 1, 1, []
    for i, (length, count) in enumerate(zip(lengths, counts)):
        left, part = min(count, budget // length), 1
        while left > 0 and not reach >> budget & 1:
            n = min(part, left)
            steps.append((i, n, reach))
            reach |= (reach << (n * length)) & mask
            left, part = left - n, 2 * part
    total = reach.bit_length() - 1
    for i, n, before in reversed(steps):
        if not before >> total & 1:
            taken[i] += n
            total -= n * lengths[i]
    return taken


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, most: int = 1, window: int = WINDOW
                ) -> np.ndarray:
    """How many documents of each length to take, adding up to about ``budget`` words.

    Each document is taken once at most, unless that leaves words of the budget
    over: then up to ``most`` times.
    """
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    share = counts * (budget / total) if total else counts * 0.0
    take = np.minimum(np.floor(share).astype(np.int64), counts)
    left = budget - int((take * lengths).sum())
    for i in np.lexsort((lengths, -(share - take))):  # largest remainder first
        if left <= window:
            break
        if take[i] < counts[i] and lengths[i] <= left:
            take[i] += 1
            left -= int(lengths[i])
    best, add = -1, np.zeros_like(take)
    for times in sorted({1, most}):
        room = np.where(lengths <= left, times * counts - take, 0)
        fit = np.flatnonzero(room > 0)
        more = np.zeros_like(take)
        more[fit] = knapsack(lengths[fit].tolist(), room[fit].tolist(), left)
        if (found := int((more * lengths).sum())) > best:
            best, add = found, more
        if best == left:
            break
    return take + add


def mix_sources(docs: DataFrame, weights: dict | None = None, seed: int = 42, id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken."""
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                        F.regexp_count(text_or_empty(text_col), F.lit(NOT_SPACES)).cast("bigint").alias("size"))
    sized = cut_lineage(sized, "mix_sizes")
    by_length = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["source"]: int(r["s"]) for r in by_length.groupBy("source").agg(F.sum(F.col("size") * F.col("n"))
                                                                                  .alias("s")).collect()}
    goal = targets(sizes, weights or cycle_weights(list(sizes)))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        source = pdf["source"].iloc[0]
        source = None if source is None or source is pd.NA or source != source else source
        pdf = pdf.sort_values("size", ignore_index=True)
        lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        total, target = sizes[source], goal[source]
        repeats = min(MOST, int(target // total)) if total else 0
        some = lengths > 0
        extra = np.zeros(len(pdf), dtype=np.int64)
        if total and repeats < MOST:
            extra[some] = fit_lengths(lengths[some], counts[some], min(total, round(target - repeats * total)),
                                      MOST - repeats)
        return pd.DataFrame({"source": [source] * len(pdf), "size": lengths, "source_size": total, "target": target,
                             "repeats": repeats, "extra": extra, "n": counts})

    plan = by_length.groupBy("source").applyInPandas(
        fit, "source string, size bigint, source_size bigint, target double, repeats bigint, extra bigint, "
             "n bigint")
    mixed = F.xxhash64(F.col("id"), F.lit(seed))
    ranked = group_ranks(sized.withColumn("_mixed", mixed), ["source", "size"], [F.col("_mixed"), F.col("id")],
                         F.shiftrightunsigned("_mixed", 52), SLOTS)
    on = F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.size") == F.col("p.size"))
    copies = F.when(F.col("r.size") == 0, F.lit(0)).otherwise(
        F.col("p.repeats") + F.expr("p.extra div p.n") + (F.col("r.rank") < F.expr("p.extra % p.n")).cast("bigint"))
    return (ranked.alias("r").join(plan.alias("p"), on)
            .select(F.col("r.id").alias(id_col), F.col("r.source").alias("source"), F.col("r.size").alias("size"),
                    "p.source_size", "p.target", copies.alias("copies"), (copies * F.col("r.size")).alias("taken")))


def draw_mix(docs: DataFrame, weights: dict | None = None, seed: int = 42, id_col: str = "doc_id",
             source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as the mix takes it.

    Documents of size 0 hold no words and are left out.
    """
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), whole.alias("whole")).alias("key"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    thin = keyed.select("key", F.col("row").getField(source_col).alias("source"),
                        F.col("row").getField(text_col).alias("text"))
    copies = mix_sources(thin, weights, seed, "key", "source", "text").groupBy("key").agg(F.sum("copies").alias("n"))
    # rows repeated in every column share a key: one of them carries the copies of all
    taken = (keyed.select("key.id", "key.whole", "row").alias("d")
             .join(copies.where("n > 0").select("key.id", "key.whole", "n").alias("c"),
                   F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.whole") == F.col("c.whole")))
             .select("d.id", "d.whole", "d.row", "c.n"))
    once = taken.groupBy("id", "whole").agg(F.first("row").alias("row"), F.first("n").alias("n"))
    return once.select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("row.*")
