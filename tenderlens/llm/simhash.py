"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits (the last one
padded). The perfect binary Golay code [23, 12, 7] gives every 23-bit word one
codeword within 3 bits; the indices of all codewords within 4 bits (1 or 6 of
them) are its keys, and two words at most 2 bits apart share one. With at most
4 differing bits in all, one of these holds (pigeonhole on segment errors):

* a segment agrees, and one of the other two has at most 2 errors: key on the
  agreeing segment's bits and the other's indices;
* every segment differs: two of them have exactly 1 error. The nearest codeword of
  one fingerprint then lies within 4 bits of the other's segment, in both
  segments: key on two indices, one row per fingerprint on one side, all pairs
  of nearby indices on the other.

Only different fingerprints are keyed (copies are one row), rows of equal keys
are compared, and each task emits a spanning forest of the links it verified
(not all pairs of a group). A long run of one key is searched breadth first, so
a dense group costs a few passes over it and not its square. Components are
joined across tasks by alternating star contraction.

Defined results: a null text is empty; no words: fingerprint zero, linked like
any other; fewer words than a shingle: the whole sequence is one; rows with
equal ids each get a result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, held, parts, text_or_empty

SHINGLE, DISTANCE, SEED = 4, 4, 42
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, bits
GENERATOR = 0xC75                          # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_PAIRS = 1 << 20                           # pairs compared at once


def simhash(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set when it is set in over half of the shingles' XXH64 values."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and spaces only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return digest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: len(words) - size] + 1)).tolist()
    n = len(starts)
    values = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends[size - 1:].tolist())), np.uint64, n)
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(values[i: i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * votes > n).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(high-part syndromes, errors by syndrome with the nearest first, errors per syndrome)."""
    def remainder(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GENERATOR << (bit - 11)
        return x

    high = np.array([remainder(i << 11) for i in range(1 << 12)], dtype=np.int64)
    errors: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for places in combinations(range(23), weight):
            e = sum(1 << p for p in places)
            errors[int(high[e >> 11]) ^ (e & 0x7FF)].append(e)
    most = max(map(len, errors))
    table = np.array([e + [e[0]] * (most - len(e)) for e in errors], dtype=np.int64)
    return high, table, np.array([len(e) for e in errors])


def nearby(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n, 6) indices of the codewords within 4 bits, the nearest first, and how many of them count."""
    high, errors, n = _golay()
    syndrome = high[words >> 11] ^ (words & 0x7FF)
    return (words[:, None] ^ errors[syndrome]) >> 11, n[syndrome]


def keys(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, role, fingerprint) arrays. Roles: 0 one nearest key, 1 all nearby keys, 2 compared with one another."""
    bits = fps.view(np.uint64)
    segment = [(bits >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    near = [nearby(s) for s in segment]
    columns = np.arange(near[0][0].shape[1])
    live = [columns < n[:, None] for _, n in near]
    tag = 0
    for x in range(3):
        for y in range(3):
            if x != y:
                key = (tag << 40) | (segment[x][:, None] << 12) | near[y][0]
                yield key[live[y]], 2, np.broadcast_to(fps[:, None], key.shape)[live[y]]
                tag += 1
    for x, y in ((0, 1), (0, 2), (1, 2)):
        a, b = near[x][0], near[y][0]
        yield (tag << 40) | (a[:, 0] << 12) | b[:, 0], 0, fps
        key = (tag << 40) | (a[:, :, None] << 12) | b[:, None, :]
        on = live[x][:, :, None] & live[y][:, None, :]
        yield key[on], 1, np.broadcast_to(fps[:, None, None], key.shape)[on]
        tag += 1


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable) for every node that is not itself the smallest."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[: len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        if (label[a] == low).all() and (label[b] == low).all():
            break
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _long_run(left: np.ndarray, right: np.ndarray, most: int) -> tuple[list, list]:
    """Links that connect whatever links between the two sides connect, found breadth first."""
    left, right, a, b = np.unique(left), np.unique(right), [], []
    while len(left) and len(right):
        queue, left = [left[0]], left[1:]
        right = right[right != queue[0]]
        while queue:
            node = queue.pop()
            for side in (0, 1):
                others = (left, right)[side]
                hit = _apart(others, node) <= most
                if hit.any():
                    found = others[hit]
                    a.append(np.full(len(found), node))
                    b.append(found)
                    queue += found.tolist()
                    left, right = left[~np.isin(left, found)], right[~np.isin(right, found)]
    return a, b


def links(key: np.ndarray, role: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of rows sorted by (key, role); every key's rows must be complete."""
    starts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    ends = np.concatenate((starts[1:], [len(key)]))
    # a run's left side: nearest keys, or all of a role-2 run; its right side: the others, or the same rows
    ones = np.concatenate(([0], np.cumsum(role == 0)))
    both = role[starts] == 2
    n_left = np.where(both, ends - starts, ones[ends] - ones[starts])
    first_right = np.where(both, starts, starts + n_left)
    n_right = ends - first_right
    size = n_left * n_right * (ends - starts > 1)
    a, b = [], []
    for i in np.flatnonzero(size > _PAIRS):
        x, y = _long_run(fp[starts[i]: starts[i] + n_left[i]], fp[first_right[i]: ends[i]], most)
        a, b = a + x, b + y
    small = np.flatnonzero((size > 0) & (size <= _PAIRS))
    step = np.cumsum(size[small]) // _PAIRS
    for group in np.split(small, np.flatnonzero(step[1:] != step[:-1]) + 1) if len(small) else []:
        run = np.repeat(group, size[group])
        place = np.arange(len(run)) - np.repeat(np.cumsum(size[group]) - size[group], size[group])
        x, y = fp[starts[run] + place // n_right[run]], fp[first_right[run] + place % n_right[run]]
        hit = (x != y) & (_apart(x, y) <= most)
        a.append(x[hit])
        b.append(y[hit])
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(a), np.concatenate(b))


def star_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of an edge that is not its own root.

    Alternating large-star and small-star contraction; each round is a written table.
    Columns a and b, of one ordered type. Ends when nothing changes.
    """
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "star")
    for _ in range(rounds):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not state[0]:
            break
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = sides.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        edges = cut_lineage(small.unionByName(low.withColumnRenamed("low", "b")).distinct(), "star")
        if edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                 extra: dict | None = None) -> DataFrame:
    """id, the columns of ``extra``, and fp: the fingerprint as a signed 64-bit integer."""
    extra = extra or {}
    rows = docs.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in extra.items()],
                       text_or_empty(text_col).alias("text"))
    schema = rows.drop("text").schema.add("fp", "long")
    names = ["id", *extra, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("simhash", dict)  # lets other operators' caches go
        for batch in batches:
            fps = pa.array([_signed(simhash(t, size)) for t in batch.column(batch.num_columns - 1).to_pylist()],
                           pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], fps], names=names)

    return rows.mapInArrow(run, schema)


def fingerprint_components(fps: DataFrame, most: int = DISTANCE) -> DataFrame:
    """(node, root) of the linked fingerprints among the different values of ``fp``."""
    def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(values), 2_000):
                for key, role, fp in keys(np.ascontiguousarray(values[i: i + 2_000])):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(np.full(len(key), role, np.int8)), pa.array(fp)],
                        names=["key", "role", "fp"])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], []  # held: rows of the last key, which may go on in the next batch

        def compare(rows: list[np.ndarray]) -> None:
            x, y = links(*rows, most)
            if len(x):
                a.append(x)
                b.append(y)
            if sum(map(len, a)) > _PAIRS:
                x, y = forest(np.concatenate(a), np.concatenate(b))
                a[:], b[:] = [x], [y]

        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(rows[0]):
                continue
            if held and rows[0][-1] == held[0][0][0]:
                held.append(rows)
                continue
            rows = [np.concatenate([h[i] for h in (*held, rows)]) for i in range(3)]
            last = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
            if last:
                compare([r[:last] for r in rows])
            held = [[r[last:] for r in rows]]
        if held:
            compare([np.concatenate([h[i] for h in held]) for i in range(3)])
        if a:
            x, y = forest(np.concatenate(a), np.concatenate(b))
            for i in range(0, len(x), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i: i + 50_000]), pa.array(y[i: i + 50_000])],
                                                 names=["a", "b"])

    n = parts(fps.sparkSession)
    rows = fps.select("fp").distinct().mapInArrow(key_rows, "key bigint, role tinyint, fp bigint")
    edges = (rows.repartition(n, "key").sortWithinPartitions("key", "role").mapInArrow(sweep, "a bigint, b bigint"))
    return star_components(edges)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       most: int = DISTANCE) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, size), "simhash")
    return (with_components(fps, most)
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("first.id").alias("component_id")))


def with_components(fps: DataFrame, most: int = DISTANCE, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Adds ``first``: the columns of ``order`` of the component's first row (null ids last)."""
    least = F.min(F.struct(F.col("id").isNull().alias("none"), *order))
    groups = fps.groupBy("fp").agg(least.alias("least"))
    roots = fingerprint_components(fps, most)
    placed = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    firsts = placed.groupBy("root").agg(F.min("least").alias("first"))
    found = placed.select("fp", "root").join(firsts, "root").select("fp", "first")
    return fps.join(found, "fp")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                     most: int = DISTANCE) -> DataFrame:
    """One row of each component, with all its columns: the row of the smallest id."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    fps = cut_lineage(fingerprints(docs, id_col, text_col, size, {"whole": whole}), "simhash")
    firsts = with_components(fps, most, ("id", "whole")).select("first.id", "first.whole").distinct()
    rows = docs.select(F.col(id_col).alias("id"), whole.alias("whole"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("r.id").eqNullSafe(F.col("k.id")) & (F.col("r.whole") == F.col("k.whole"))
    kept = rows.alias("r").join(firsts.alias("k"), same, "left_semi")
    return kept.groupBy("id", "whole").agg(F.first("row").alias("row")).select("row.*")
