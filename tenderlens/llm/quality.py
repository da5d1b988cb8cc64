"""Quality classifier from weak labels.

Overlapping heuristics each vote low (-1), good (1) or nothing (0) on a text.
Votes of all documents are counted by pattern; expectation-maximisation on these
counts (at most 3^10 rows) estimates how often each heuristic votes low on good
and on low texts, and so the posterior of every pattern. A linear scorer on
hashed features (word shapes, repeated words, words) learns the posteriors from
a bounded sample, ``sample_rows`` documents of smallest seeded hash, and scores
every text.

Defined results: a null text is empty; a text without words is rejected, with
score 0 and no votes; rows with equal ids each get a result; an empty table gives
an empty result. A table without one low vote has every worded text kept.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, text_or_empty

HEURISTICS = ("symbols", "capitals", "distinct_words", "repeats", "bars", "sentences", "lines", "top_word", "mark_runs",
              "lone_marks")
# what a heuristic's low and good votes are taken for before any text is seen: P(low vote | class)
LOW_IF_GOOD, LOW_IF_LOW, STRENGTH = 0.01, 0.40, 0.05  # STRENGTH: weight of this belief, as a share of all texts
SAMPLE_ROWS = 8_000
BITS = 16
_SHAPES, _RATIOS = 1 << 12, 256  # slots for shapes, then for ratios, the rest for words
_RUNS = re.compile(r"(.)\1+")
_MARK_RUNS = re.compile(r"[!-/:-@\[-`{-~]{2,}")
_LONE_MARKS = re.compile(r"(?<!\S)[!-/:-@\[-`{-~]+(?!\S)")
_MEMO = 200_000


class _Words(dict):
    """word -> slot of its shape * 2^16 + slot of the word itself."""

    def __missing__(self, word: str) -> int:
        shape = "".join(["X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in word])
        shape = _RUNS.sub(r"\1", shape)
        first = _SHAPES + _RATIOS
        slots = (zlib.crc32(shape.encode("utf-8", "surrogatepass")) % _SHAPES) << BITS | (
            first + zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % ((1 << BITS) - first))
        if len(self) < _MEMO and len(word) <= 64:
            self[word] = slots
        return slots


def measures(text: str) -> tuple[list[str], dict[str, float]]:
    """The words and the ratios that the heuristics and the scorer look at."""
    words = text.split()
    n = max(1, len(words))
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    upper, lower = int(raw[65:91].sum()), int(raw[97:123].sum())
    digits = int(raw[48:58].sum())
    marks = int(raw[33:127].sum()) - upper - lower - digits
    lines = [x for x in text.split("\n") if x]
    counts = Counter(words)
    return words, {
        "n": float(len(words)),
        "symbols": marks / max(1, int(raw.sum())),
        "capitals": upper / max(1, upper + lower),
        "distinct_words": len(counts) / n,
        "repeats": sum(map(eq, words, words[1:])) / n,
        "bars": counts.get("|", 0) / n,
        "sentences": (text.count(". ") + text.count(".\n") + text.endswith(".")) / n,
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
        "top_word": max(counts.values(), default=0) / n,
        "mark_runs": sum(1 for _ in _MARK_RUNS.finditer(text)) / n,
        "lone_marks": sum(1 for _ in _LONE_MARKS.finditer(text)) / n,
    }


def votes(m: dict[str, float]) -> tuple[int, ...]:
    """One vote per heuristic: -1 low, 1 good, 0 none."""
    if not m["n"]:
        return (0,) * len(HEURISTICS)
    long = m["n"] >= 20

    def above(name: str, good: float, low: float, when: bool = True) -> int:
        return 0 if not when else -1 if m[name] > low else 1 if m[name] < good else 0

    def below(name: str, good: float, low: float, when: bool = True) -> int:
        return 0 if not when else -1 if m[name] < low else 1 if m[name] > good else 0

    return (above("symbols", 0.06, 0.14, m["n"] >= 10), above("capitals", 0.10, 0.45, long), below("distinct_words", 0.45, 0.35, long),
            above("repeats", 0.03, 0.20, long), above("bars", 0.02, 0.15), below("sentences", 0.05, 0.015, m["n"] >= 50),
            above("lines", 0.0, 0.5, long), above("top_word", 0.13, 0.22, long),
            above("mark_runs", 0.05, 0.2), above("lone_marks", 0.03, 0.15))


def pattern_code(v: tuple[int, ...]) -> int:
    code = 0
    for x in v:
        code = 3 * code + x + 1
    return code


def pattern_votes(code: int) -> list[int]:
    out = []
    for _ in HEURISTICS:
        code, x = divmod(code, 3)
        out.append(x - 1)
    return out[::-1]


def estimate(counts: dict[int, int], rounds: int = 200) -> tuple[dict[int, float], np.ndarray, float]:
    """EM over vote patterns: posterior of "good" by pattern, P(low vote | class, voted), share of good texts.

    A heuristic without a vote says nothing. The rates are most probable a
    posteriori under a weak belief in each heuristic, which tells the two classes
    apart and keeps a class without texts defined.
    """
    codes = sorted(counts)
    v = np.array([pattern_votes(c) for c in codes]).reshape(len(codes), len(HEURISTICS))
    n = np.array([counts[c] for c in codes], dtype=float)
    low, voted = (v == -1).astype(float), (v != 0).astype(float)
    belief = np.array([LOW_IF_GOOD, LOW_IF_LOW])
    rates = np.tile(belief[:, None], (1, len(HEURISTICS)))  # (class: good, low; heuristic)
    prior, good = 0.8, np.full(len(codes), -1.0)
    for _ in range(rounds):
        logs = low @ np.log(rates).T + (voted - low) @ np.log(1 - rates).T
        gap = logs[:, 0] - logs[:, 1] + math.log(prior) - math.log(1 - prior)
        new = 1 / (1 + np.exp(-np.clip(gap, -500, 500)))
        settled = np.abs(new - good).max(initial=0) < 1e-9
        good = new
        if settled:
            break
        extra = STRENGTH * n.sum() + 1
        for c, weight in enumerate((good * n, (1 - good) * n)):
            rates[c] = (weight @ low + extra * belief[c]) / (weight @ voted + extra)
        prior = float(good @ n + 0.8 * extra) / (n.sum() + extra)
    return dict(zip(codes, good.tolist())), rates, prior


def features(words: list[str], m: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features (slots, values): shares of shapes and words, ratios in steps."""
    packed = np.fromiter(map(held("word slots", _Words).__getitem__, words), np.int64, len(words))
    shape = np.bincount(packed >> BITS, minlength=_SHAPES)
    word = np.bincount(packed & ((1 << BITS) - 1), minlength=1 << BITS)
    word[:_SHAPES] = shape
    for i, name in enumerate(HEURISTICS):
        step = min(15, int(16 * min(1.0, m[name] * (1 if name in ("distinct_words", "lines", "capitals") else 3))))
        word[_SHAPES + 16 * i + step] = len(words)
    at = np.flatnonzero(word)
    return at, word[at] / max(1, len(words))


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 20, rate: float = 0.5,
          decay: float = 1e-4, seed: int = 42) -> np.ndarray:
    """Logistic regression on soft labels by AdaGrad; the last weight is the bias."""
    weights = np.zeros((1 << BITS) + 1)
    if not len(rows):
        weights[-1] = 1.0
        return weights
    past = np.full((1 << BITS) + 1, 1e-2)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for batch in np.array_split(order.permutation(len(rows)), max(1, len(rows) // 64)):
            at = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            z = np.bincount(row, weights[at] * value, minlength=len(batch)) + weights[-1]
            error = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - target[batch]
            slots, where = np.unique(at, return_inverse=True)
            slope = np.bincount(where, error[row] * value) / len(batch) + decay * weights[slots]
            past[slots] += slope ** 2
            weights[slots] -= rate * slope / np.sqrt(past[slots])
            past[-1] += error.mean() ** 2
            weights[-1] -= rate * error.mean() / math.sqrt(past[-1])
    return weights


class Model:
    """Posteriors by vote pattern and the weights of the scorer."""

    def __init__(self, posterior: dict[int, float], rates: np.ndarray, prior: float, weights: np.ndarray):
        self.posterior, self.rates, self.prior, self.weights = posterior, rates, prior, weights.astype(np.float32)

    def judge(self, text: str) -> tuple[str, float, float]:
        """(votes, posterior of the votes, score between 0 and 1)."""
        words, m = measures(text)
        v = votes(m)
        shown = "".join("-0+"[x + 1] for x in v)
        if not words:
            return shown, 0.0, 0.0
        at, value = features(words, m)
        z = float(self.weights[at] @ value + self.weights[-1])
        return shown, self.posterior.get(pattern_code(v), self.prior), 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Votes of all documents, EM, and the scorer's fit on at most about ``sample_rows`` of them."""
    rows = docs.select(F.xxhash64(F.col(id_col), F.lit(42)).alias("mixed"), text_or_empty(text_col).alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(pattern_code(votes(m)) for words, m in map(measures, batch.column(0).to_pylist()) if words)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())],
                                             names=["code", "n"])

    counted = rows.select("text").mapInArrow(vote, "code int, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    counts = {r["code"]: r["n"] for r in counted.collect()}  # at most 3^10 rows
    posterior, rates, prior = estimate(counts)
    if not any(-1 in pattern_votes(c) for c in counts):
        posterior = dict.fromkeys(posterior, 1.0)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                words, m = measures(text)
                if words:
                    at, value = features(words, m)
                    out.append((pattern_code(votes(m)), at.astype("<u4").tobytes(), value.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary()),
                 pa.array([r[2] for r in out], pa.binary())], names=["code", "at", "value"])

    total = sum(counts.values())
    share = min(1.0, sample_rows / max(1, total))
    some = rows.where(F.shiftrightunsigned("mixed", 33) < F.lit(int(share * (1 << 31)))).select("text")
    sample = some.mapInArrow(describe, "code int, at binary, value binary").collect()
    sample.sort(key=lambda r: (r["code"], bytes(r["at"]), bytes(r["value"])))  # the same order on a rerun
    found = [(np.frombuffer(r["at"], "<u4").astype(np.int64), np.frombuffer(r["value"], "<f4").astype(float))
             for r in sample]
    return Model(posterior, rates, prior, train(found, np.array([posterior[r["code"]] for r in sample])))


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
                    sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: id, votes (a sign per heuristic), weak_label, score, keep."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, sample_rows))  # fixed size
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [model.value.judge(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in out], pa.string()),
                 pa.array([r[1] for r in out], pa.float64()), pa.array([r[2] for r in out], pa.float64()),
                 pa.array([r[2] >= threshold for r in out], pa.bool_())],
                names=["id", "votes", "weak_label", "score", "keep"])

    schema = rows.select("id").schema
    for name, kind in (("votes", "string"), ("weak_label", "double"), ("score", "double"), ("keep", "boolean")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows whose text the classifier keeps, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, sample_rows))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.value.judge(t or "")[2] >= threshold
                                         for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
