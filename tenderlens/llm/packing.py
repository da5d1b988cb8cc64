"""Best-fit packing of token sequences by bin completion.

Documents are cut into pieces of at most ``capacity`` tokens. Which lengths go
together is decided on the counts of pieces by length - at most ``capacity``
rows, however many documents there are - so no piece passes through the driver.
Best-fit decreasing gives the first incumbent. Then branch-and-bound completes
one sequence after another around the largest length left: a first search tries a few
good fillings of its gap, by ascending waste, for as many sequences as the counts
allow; a second one tries all fillings that no further piece fits into, one by one,
for every number of sequences. A branch ends when
its waste could no longer save a sequence against the incumbent. The second
search is complete, whatever the depth: it ends at a proven minimum or when ``nodes``
completions are used up, whose number is the only bound.

Pieces then take their places by rank within their length. Defined results: a
null text is empty and has the end id only; rows with equal ids are packed
apart; an empty table gives an empty result.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, group_ranks, text_or_empty
from .encode import crc32, encoder

CAPACITY = 4096
NODES = 60_000
SLOTS = 4096
Patterns = list[tuple[tuple[int, ...], int]]  # lengths side by side, number of such sequences


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences needed at least: total length, and large pieces that exclude one another."""
    lengths = np.arange(len(counts))
    n, size = np.cumsum(counts), np.cumsum(counts * lengths)
    best, half = -(-int(size[-1]) // capacity), capacity // 2
    for small in range(1, half + 1):
        alone = n[-1] - n[capacity - small]
        paired = n[capacity - small] - n[half]
        rest = size[half] - size[small - 1]
        room = paired * capacity - (size[capacity - small] - size[half])
        best = max(best, int(alone + paired + max(0, -(-int(rest - room) // capacity))))
    return best


def _largest_up_to(counts: np.ndarray) -> np.ndarray:
    """For each length the largest available one that is not longer, 0 if none."""
    return np.maximum.accumulate(np.where(counts > 0, np.arange(len(counts)), 0))


def _fill_best(counts: np.ndarray, gap: int, below: np.ndarray, stop: int) -> tuple[list[int], int]:
    """Best fit while the gap is over ``stop``: always the largest length that fits (counts are lowered)."""
    taken: list[int] = []
    while gap > stop:
        x = int(below[gap])
        while x and counts[x] == 0:
            x = int(below[x - 1]) if counts[int(below[x])] == 0 else int(below[x])
            if x and counts[x] == 0:
                x -= 1
        if not x:
            break
        n = min(int(counts[x]), (gap - stop + x - 1) // x, gap // x)
        counts[x] -= n
        taken += [x] * n
        gap -= n * x
    return taken, gap


def _endings(counts: np.ndarray, gap: int, width: int) -> list[tuple[int, ...]]:
    """Undominated endings of a gap with up to three lengths, least waste first, then larger first lengths."""
    below = _largest_up_to(counts)
    one = int(below[gap])
    if not one or one == gap:
        return [(one,)] if one else [()]
    found: list[tuple[int, ...]] = [(one,)]
    firsts = np.flatnonzero(counts[: gap + 1])[::-1]
    firsts = firsts[firsts > 0]

    def pairs(first: np.ndarray, room: np.ndarray, own: int = 0) -> np.ndarray:
        second = below[np.minimum(room - first, first)]
        need = 1 + (second == first) + ((first == own).astype(int) + (second == own)) * (own > 0)
        return np.where(counts[second] >= np.where(second > 0, need, 0), second, 0)

    second = pairs(firsts, np.full(len(firsts), gap))
    total = firsts + second
    good = np.flatnonzero((second > 0) & (total > one))
    best, last = one, 0
    for i in good[np.argsort(-total[good], kind="stable")][: 4 * width]:
        found.append((int(firsts[i]), int(second[i])))
        best = max(best, int(total[i]))
    if best < gap:
        for x in firsts[:: max(1, len(firsts) // 48)]:
            x = int(x)
            inner = firsts[firsts <= min(x, gap - x)]
            if not len(inner):
                continue
            third = pairs(inner, np.full(len(inner), gap - x), x)
            sums = np.where((third > 0) & ((inner != x) | (counts[x] > 1)), x + inner + third, 0)
            i = int(np.argmax(sums))
            if sums[i] > best:
                best = int(sums[i])
                found.append((x, int(inner[i]), int(third[i])))
            if best == gap:
                break
    found = [f for f in found if all(counts[x] >= f.count(x) for x in f)]
    found.sort(key=lambda f: (gap - sum(f), tuple(-x for x in f)))
    return found[:width]


def _times(counts: np.ndarray, lengths: tuple[int, ...]) -> int:
    """Sequences of these lengths that the counts allow."""
    return min(int(counts[x]) // lengths.count(x) for x in set(lengths))


def best_fit(counts: np.ndarray, capacity: int) -> Patterns:
    """Best-fit decreasing on the counts."""
    counts, out = counts.copy(), []
    while len(left := np.flatnonzero(counts)):
        trial, first = counts.copy(), int(left[-1])
        trial[first] -= 1
        rest, _ = _fill_best(trial, capacity - first, _largest_up_to(trial), 0)
        lengths = (first, *rest)
        n = _times(counts, lengths)
        for x in lengths:
            counts[x] -= n
        out.append((lengths, n))
    return out


def completions(counts: np.ndarray, capacity: int, width: int) -> list[tuple[int, ...]]:
    """Fillings around the largest length left, least waste first."""
    trial, first = counts.copy(), int(np.flatnonzero(counts)[-1])
    trial[first] -= 1
    gap = capacity - first
    # small lengths: best fit until about three of the largest remain to be chosen
    rest, gap = _fill_best(trial, gap, _largest_up_to(trial), min(gap, 3 * first))
    out = [(first, *rest, *end) for end in _endings(trial, gap, width)]
    return [c for c in out if _times(counts, c) > 0]


def fillings(counts: np.ndarray, capacity: int) -> Iterator[tuple[int, ...]]:
    """Every filling around the largest length left that nothing left fits into, larger lengths first."""
    counts = counts.copy()
    lengths = np.flatnonzero(counts)[::-1].tolist()
    left = {x: int(counts[x]) for x in lengths}
    taken = [lengths[0]]
    left[lengths[0]] -= 1

    def rest(at: int, gap: int) -> Iterator[tuple[int, ...]]:
        fits = [i for i in range(len(lengths)) if lengths[i] <= gap and left[lengths[i]]]
        if not fits:
            yield tuple(taken)
        for i in fits:
            if i < at:
                continue  # lengths of a filling do not rise
            taken.append(lengths[i])
            left[lengths[i]] -= 1
            yield from rest(i, gap - lengths[i])
            left[lengths[i]] += 1
            taken.pop()

    yield from rest(0, capacity - lengths[0])


def _good(counts: np.ndarray, capacity: int, width: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """A node's good fillings, each for as many sequences as the counts allow."""
    yield from [(c, _times(counts, c)) for c in completions(counts, capacity, width)]


def _all(counts: np.ndarray, capacity: int, width: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Every (filling, sequences) of a node, the good ones first."""
    good = completions(counts, capacity, width)
    known = {tuple(sorted(c, reverse=True)) for c in good}
    for c in good:
        yield from ((c, n) for n in range(_times(counts, c), 0, -1))
    # when these are asked for, the search has come back to this node and the counts are as they were
    for c in fillings(counts, capacity):
        if c not in known:
            yield from ((c, n) for n in range(_times(counts, c), 0, -1))


def _search(counts: np.ndarray, capacity: int, best: Patterns, least: int, nodes: int, choices) -> Patterns:
    """Branch-and-bound below the incumbent ``best``; a filling looked at and cut off costs 1/32 of a node."""
    total, bins = int((counts * np.arange(len(counts))).sum()), sum(n for _, n in best)
    counts, path, waste, used, cost = counts.copy(), [], 0, 0, 0
    open_: list[Iterator] = []
    while bins > least and cost < 32 * nodes:
        if counts.any():
            allowed = (bins - 1) * capacity - total
            if len(open_) == len(path):
                open_.append(choices(counts))
            for lengths, n in open_[-1]:
                lost = n * (capacity - sum(lengths))
                # waste beyond what the incumbent leaves to save cannot lead to fewer sequences
                fits = waste + lost <= allowed
                cost += 32 if fits else 1
                if fits or cost >= 32 * nodes:
                    break
            else:
                fits = False
            if fits:
                for x in lengths:
                    counts[x] -= n
                path.append((lengths, n, lost))
                waste, used = waste + lost, used + n
                continue
        elif used < bins:
            best, bins = [(p, n) for p, n, _ in path], used
        if len(open_) > len(path):
            open_.pop()
        if not path:
            break
        lengths, n, lost = path.pop()
        for x in lengths:
            counts[x] += n
        waste, used = waste - lost, used - n
    return best


def pack_lengths(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES, width: int = 4) -> Patterns:
    """Patterns that hold every piece once, ``counts[i]`` pieces of length i; few sequences.

    Half the nodes may go into branches of good fillings, which soon lower the
    incumbent; the complete search has the rest.
    """
    best, least = best_fit(counts, capacity), lower_bound(counts, capacity)
    for choices in (_good, _all):
        best = _search(counts, capacity, best, least, nodes // 2, lambda c, f=choices: f(c, capacity, width))
    return best


def slots(patterns: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (length, first rank), first sequence, offset of each run of places."""
    keys, sequences, offsets, given, base = [], [], [], {}, 0
    for lengths, n in patterns:
        at = 0
        for x in lengths:
            keys.append((x << 40) + given.get(x, 0))
            given[x] = given.get(x, 0) + n
            sequences.append(base)
            offsets.append(at)
            at += x
        base += n
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    return tuple(np.array(v, dtype=np.int64)[order] for v in (keys, sequences, offsets))


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32 of every piece; the ids themselves are not moved."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = (f"id {rows.schema['id'].dataType.simpleString()}, piece int, start bigint, length bigint, "
              "ids_crc32 bigint")
    end, step = struct.pack("<I", end_id), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = enc.encode(text) + end
                for i, at in enumerate(range(0, len(raw), step)):
                    part = raw[at: at + step]
                    out.append((key, i, at // 4, len(part) // 4, crc32(part)))
            kinds = (batch.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                             names=["id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def pack(parts: DataFrame, capacity: int = CAPACITY, nodes: int = NODES, keys: tuple[str, ...] = ("doc_id", "piece")
         ) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` of 1 to ``capacity``."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    key, sequence, offset = slots(pack_lengths(counts, capacity, nodes))
    mixed = F.xxhash64(*keys)
    ranked = group_ranks(parts.withColumn("_mixed", mixed), ["length"], [F.col("_mixed"), *[F.col(k) for k in keys]],
                         F.shiftrightunsigned("_mixed", 52), SLOTS).drop("_mixed")
    at = ranked.columns
    schema = ranked.select("*").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(at.index("rank")).to_numpy(zero_copy_only=False).astype(np.int64)
            length = batch.column(at.index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            wanted = (length << 40) + rank
            i = np.searchsorted(key, wanted, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence[i] + wanted - key[i]),
                                              pa.array(offset[i])], names=[*at, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema).drop("rank")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, nodes: int = NODES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    cut = cut_lineage(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), "pack_pieces")
    return pack(cut, capacity, nodes, (id_col, "piece"))
