"""Hard negatives by exact inner products of integer vectors, packed into wide integers.

Kronecker packing: the biased components that several candidates have in one
dimension lie side by side as fields of one wide integer. An anchor's biased
component multiplies that integer once, so all of them get their products; the sum
over the dimensions holds every score in a field of its own, wide enough that none
runs into the next. The biases' share is then subtracted, which leaves exact scores.
Where 26 bits hold the largest possible sum (components within about -1 to 1 in 64
dimensions do), two fields make a 53-bit integer, which a double holds exactly, so
a matrix product multiplies them; larger components use Python integers of
``WIDE_FIELDS`` fields, of whatever width they need.

Anchors are a stated query set (ids divisible by ``ANCHOR_STEP``) scored against all
rows in blocks: candidates are dealt by hash to groups of bounded size, anchors
travel to every group, and each group sends its best few per anchor, merged by a
window. A first pass finds the positives and multiplies only candidates of the
anchor's label; the second finds, for each positive's score, the best rows of other
labels within the margin. A label that holds a third of all rows is dealt over all
groups like the others.

Defined results: rows with a null id, label or vector, or with null or non-finite
components take no part; shorter vectors count as padded with zeros; rows that are
equal in id, label and integer vector are one row, rows that share only the id stay
apart (ties by a digest of label and vector); an anchor without other rows of its
label gives nothing; an empty table gives no rows. Scores must fit 64 bits, or the
run raises.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, parts

SCALE = 256
ANCHOR_STEP = 100
POSITIVES = NEGATIVES = 5
WORD_FIELD = 26  # bits of a field, two of which fit the 53 bits that a double holds exactly
WIDE_FIELDS = 128  # candidates in a Python integer where components need wider fields
_CELLS = 1 << 22  # scores held at once
GROUP_ROWS = 1 << 18


class PackedRows:
    """Candidates' rows, packed; ``scores`` multiplies every wide integer once per anchor component."""

    def __init__(self, rows: np.ndarray):
        far = int(np.abs(rows).max(initial=0)) >> 60 or rows.size and int(rows.min()) < -(1 << 60)
        rows = rows.astype(object) if far else rows
        self.bias = -min(0, int(rows.min(initial=0)))
        self.biased = rows + self.bias
        self.top, self.sums = int(self.biased.max(initial=0)), rows.sum(axis=1)
        self.words: np.ndarray | None = None
        self.wide: dict[tuple[int, int], list[int]] = {}

    def _word_sums(self, lifted: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Two fields in each 53-bit integer: doubles hold them exactly, so a matrix product does the multiplying."""
        if self.words is None:
            b = self.biased.astype(np.float64)
            b = np.vstack([b, np.zeros((len(b) % 2, b.shape[1]))])
            self.words = b[::2] + b[1::2] * float(1 << WORD_FIELD)
        first = lo // 2
        total = (lifted.astype(np.float64) @ self.words[first: -(-hi // 2)].T).astype(np.int64)
        out = np.empty((len(total), 2 * total.shape[1]), dtype=np.int64)
        out[:, ::2], out[:, 1::2] = total & ((1 << WORD_FIELD) - 1), total >> WORD_FIELD
        return out[:, lo - 2 * first: hi - 2 * first]

    def _wide_sums(self, lifted: np.ndarray, lo: int, hi: int, bits: int) -> np.ndarray:
        """``WIDE_FIELDS`` fields in each Python integer, as wide as the components ask for."""
        mask, made = (1 << bits) - 1, []
        for block in range(lo // WIDE_FIELDS, -(-hi // WIDE_FIELDS)):
            rows = self.biased[block * WIDE_FIELDS: (block + 1) * WIDE_FIELDS]
            if (block, bits) not in self.wide:
                self.wide[block, bits] = [sum(int(v) << (bits * j) for j, v in enumerate(c)) for c in rows.T]
            sums = [sum(map(mul, x, self.wide[block, bits])) for x in lifted.tolist()]
            made.append(np.array([[(t >> (bits * j)) & mask for j in range(len(rows))] for t in sums], dtype=object))
        start = lo // WIDE_FIELDS * WIDE_FIELDS
        return np.concatenate(made, axis=1)[:, lo - start: hi - start]

    def scores(self, anchors: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Inner products of anchors (rows) with candidates lo to hi."""
        if hi <= lo:
            return np.empty((len(anchors), 0), dtype=np.int64)
        d = self.biased.shape[1]
        bias = -min(0, int(anchors.min(initial=0)))
        lifted = anchors.astype(object) + bias
        bits = (d * int(lifted.max(initial=0)) * self.top).bit_length()
        if bits <= WORD_FIELD:
            fields = self._word_sums(lifted, lo, hi)
        else:
            fields = self._wide_sums(lifted, lo, hi, bits)
            anchors = anchors.astype(object)
        rest = self.bias * anchors.sum(axis=1) + d * bias * self.bias
        return (fields - bias * self.sums[lo:hi] - rest[:, None]).astype(np.int64)


class Group:
    """The candidates of one group, sorted by label, then id, then digest."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
        self.ids, self.keys, self.labels, rows = ids[new], keys[new], labels[new], rows[new]
        self.width, self.packed = rows.shape[1], PackedRows(rows)

    def _best(self, at: np.ndarray, scores: np.ndarray, n: int) -> list[tuple[int, str, int]]:
        if len(at) > n:  # all that reach the n-th score, then ties by id and digest
            reach = np.partition(scores, len(scores) - n)[len(scores) - n]
            at, scores = at[scores >= reach], scores[scores >= reach]
        order = sorted(range(len(at)), key=lambda i: (-scores[i], self.ids[at[i]], self.keys[at[i]]))[:n]
        return [(int(self.ids[at[i]]), self.keys[at[i]], int(scores[i])) for i in order]

    def same_label(self, ids: list[int], keys: list[str], label: int, anchors: np.ndarray, n: int) -> Iterator[tuple]:
        """(anchor id, digest, null, id, digest, score): the best n other rows of the anchors' label."""
        lo, hi = np.searchsorted(self.labels, [label, label + 1])
        at = np.arange(lo, hi)
        for key_id, key, scores in zip(ids, keys, self.packed.scores(anchors, lo, hi)):
            other = (self.ids[lo:hi] != key_id) | (self.keys[lo:hi] != key)
            for found in self._best(at[other], scores[other], n):
                yield (key_id, key, None, *found)

    def within_margins(self, ids: list[int], keys: list[str], label: int, anchors: np.ndarray, tops: list[list[int]],
                       low: int, n: int) -> Iterator[tuple]:
        """(anchor id, digest, positive score, id, digest, score): the best n of other labels under each score."""
        other = self.labels != label
        for key_id, key, asked, scores in zip(ids, keys, tops, self.packed.scores(anchors, 0, len(self.ids))):
            for top in asked:
                at = np.flatnonzero(other & (scores <= top) & (scores >= -(-low * top // 100)))
                for found in self._best(at, scores[at], n):
                    yield (key_id, key, top, *found)


def integer_rows(table: DataFrame, id_col: str, vec_col: str, label_col: str, label: Column) -> DataFrame:
    """id, label, x = floor(256 c), key (digest of label and x) of the rows that take part, written once."""
    good = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(
        vec_col, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf"))))
    x = F.transform(vec_col, lambda v: F.floor(v.cast("double") * SCALE).cast("bigint"))
    rows = table.where(good).select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), x.alias("x"))
    return cut_lineage(rows.withColumn("key", F.md5(F.concat_ws(",", F.col("label").cast("string"),
                                                               F.col("x").cast("array<string>")))), "negative_rows")


def _matrix(column: pa.Array) -> np.ndarray:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat, d = column.flatten().to_numpy(zero_copy_only=False), int(sizes.max(initial=0))
    if len(flat) == len(sizes) * d:
        return flat.reshape(len(sizes), d)
    out = np.zeros((len(sizes), d), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _stacked(blocks: list[np.ndarray]) -> np.ndarray:
    d = max(b.shape[1] for b in blocks)
    return np.vstack([np.pad(b, ((0, 0), (0, d - b.shape[1]))) for b in blocks])


_FOUND = "anchor_id bigint, anchor_key string, top bigint, id bigint, key string, score bigint"


def _search(rows: DataFrame, anchors: DataFrame, groups: int, positives: int, negatives: int, low: int) -> DataFrame:
    """Best rows of each group for each anchor: of its label where ``tops`` is null, else under each of ``tops``."""
    none = F.lit(None).cast("array<bigint>")
    dealt = (rows.select(F.pmod(F.xxhash64("id", "key"), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("kind"),
                         "label", "id", "key", "x", none.alias("tops"))
             .unionByName(anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"),
                                         F.lit(1).alias("kind"), "label", "id", "key", "x", "tops"))
             .repartitionById(groups, "g").sortWithinPartitions("g", "kind", "label", "id", "key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, group = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.asarray(batch.column(0)).astype(np.int64) * 2 + np.asarray(batch.column(1))
            cuts = np.flatnonzero(np.diff(part)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
                rows_in = batch.slice(lo, hi - lo)
                g, kind = divmod(int(part[lo]), 2)
                if g != at:
                    at, held, group = g, [], None
                labels, ids = np.asarray(rows_in.column(2)), np.asarray(rows_in.column(3))
                keys = np.array(rows_in.column(4).to_pylist(), dtype=object)
                if kind == 0:
                    held.append((ids, keys, labels, _matrix(rows_in.column(5))))
                    continue
                if not held:
                    continue
                if group is None:
                    group = Group(*[np.concatenate([h[i] for h in held]) for i in range(3)],
                                  _stacked([h[3] for h in held]))
                    held = [()]
                out: list[tuple] = []
                x = _stacked([_matrix(rows_in.column(5)), np.empty((0, group.width), dtype=np.int64)])[:, : group.width]
                tops, ids = rows_in.column(6).to_pylist(), ids.tolist()
                step = max(1, _CELLS // len(group.ids))
                runs = np.flatnonzero(np.diff(labels, prepend=labels[0] - 1)).tolist()  # anchors come by label
                for a, b in zip(runs, [*runs[1:], len(labels)]):
                    for i in range(a, b, step):
                        j, label = min(b, i + step), int(labels[i])
                        if tops[i] is None:
                            out += group.same_label(ids[i:j], keys[i:j], label, x[i:j], positives)
                        else:
                            out += group.within_margins(ids[i:j], keys[i:j], label, x[i:j], tops[i:j], low, negatives)
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)],
                                                 names=[f.split()[0] for f in _FOUND.split(", ")])

    return dealt.mapInArrow(run, _FOUND)


def mine(rows: DataFrame, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = 80, group_rows: int = GROUP_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``integer_rows``.

    Negatives have scores of at least ``low`` hundredths of the positive's and at most the positive's.
    """
    groups = max(parts(rows.sparkSession), -(-rows.count() // group_rows))
    anchors = rows.where(F.col("id") % anchor_step == 0).dropDuplicates(["id", "key"])
    none = F.lit(None).cast("array<bigint>")
    best = [F.desc("score"), "id", "key"]
    of_anchor = Window.partitionBy("anchor_id", "anchor_key").orderBy(*best)
    near = _search(rows, anchors.withColumn("tops", none), groups, positives, negatives, low)
    near = cut_lineage(near.withColumn("rank", F.row_number().over(of_anchor)).where(F.col("rank") <= positives)
                       .drop("rank"), "negative_positives")
    tops = near.groupBy("anchor_id", "anchor_key").agg(F.collect_set("score").alias("tops"))
    asked = anchors.join(tops.withColumnsRenamed({"anchor_id": "id", "anchor_key": "key"}), ["id", "key"])
    of_top = Window.partitionBy("anchor_id", "anchor_key", "top").orderBy(*best)
    hard = (_search(rows, asked, groups, positives, negatives, low)
            .withColumn("rank", F.row_number().over(of_top)).where(F.col("rank") <= negatives))
    pairs = near.select("anchor_id", "anchor_key", F.col("id").alias("positive_id"), F.col("score").alias("top"))
    return (pairs.join(hard, ["anchor_id", "anchor_key", "top"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    F.col("top").alias("positive_score"), F.col("score").alias("negative_score")))


def hard_negatives(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
                   ) -> DataFrame:
    """:func:`mine` on a table whose labels are moved on by one (mod 10) where the id is divisible by 7."""
    label = F.col(label_col).cast("bigint")
    moved = F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine(integer_rows(table, id_col, vec_col, label_col, moved))


NEGATIVE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
         CAST(list_dot_product(CAST(a.x AS DOUBLE[]), CAST(v.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
r AS (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM r WHERE rank <= 5
"""
