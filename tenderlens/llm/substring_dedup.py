"""Removal of repeated byte strings, by sorted suffixes and their common prefixes.

Every byte that is covered by a string of ``length`` bytes which also starts
anywhere else - in any document, overlaps included - is removed.

Not all suffixes are sorted. Each string of ``length`` bytes has an anchor: the
gram of ``gram`` bytes with the smallest hash within it, the leftmost of equal ones.
The anchor follows from the string's own bytes, so equal strings have their anchors
at the same offset, and neighbouring starts share one: about two in
``length - gram + 2`` positions are anchors. A run of starts with one anchor and the
bytes its strings cover is a segment. Only the suffix that starts at the anchor and
the reversed prefix that ends there are sorted (``suffix_sort``). Two segments hold
an equal string with the anchor at offset o exactly if their reversed prefixes share
o bytes and their suffixes share ``length - o`` bytes; both are read off the common
prefixes of neighbours.

1. Documents get a row number and are written once, bucketed by it; spans and
   segments travel to the documents later, the texts are not shuffled again.
2. Segments are counted by (anchor hash, digest of the whole segment). Equal
   segments are repeated in all their strings; their bytes are not needed.
3. Anchors with different segments send one copy of each. Groups of one anchor are
   sorted together, many small groups at a time.
4. An anchor with more than ``group_rows`` different segments (a passage with as many
   surroundings) is too much for a task: 128-bit digests of its strings are counted by
   shuffle instead, which finds the same strings.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing;
repeated rows count as documents of their own (so equal texts of ``length`` bytes or
more lose everything); null and equal ids keep all their rows; an empty table gives
none. Kept bytes may end inside a character, so they are binary.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint_dir, cut_lineage, parts
from .suffix_sort import sort_strings

LENGTH = 400
GRAM = 100
GROUP_ROWS = 2_000
_BATCH = 20_000  # segments sorted at once, of many anchors
_CHUNK = 1 << 21  # bytes hashed at once; longer texts are cut into chunks that overlap
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_powers_held: dict = {}


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of k bytes: rolling polynomial by prefix sums, then mixed."""
    n = len(data)
    if not _powers_held or len(_powers_held["up"]) < n:
        size = max(n, _CHUNK + 4 * LENGTH)
        _powers_held.update(up=_powers(_BASE, size), down=_powers(pow(_BASE, -1, 1 << 64), size))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[data] * _powers_held["up"][:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * _powers_held["down"][: n - k + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _smallest(keys: np.ndarray, w: int) -> np.ndarray:
    """Smallest key of each run of w, by running minima from both ends of blocks of w."""
    n = len(keys)
    blocks = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1: n])


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of concatenated texts that end at ``ends``: first start, number of starts, anchor's offset
    from the first start, anchor hash."""
    empty = tuple(np.empty(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.uint64))
    if len(data) < length:
        return empty
    h = gram_hashes(data, gram)
    place = np.arange(len(h), dtype=np.uint64)
    best = _smallest((h & ~np.uint64(0xFFFFFFFF)) | place, length - gram + 1)
    anchor = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    sizes = np.diff(ends, prepend=0)
    room = np.repeat(ends, sizes)[: len(anchor)] - np.arange(len(anchor))
    start = np.flatnonzero(room >= length)  # the string ends within its text
    if not len(start):
        return empty
    at = anchor[start]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    count = np.diff(np.append(new, len(start)))
    first, at = start[new], at[new]
    return first, count, at - first, h[at]


def _chunks(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """(row, from, to) pieces of texts, about ``_CHUNK`` bytes together; cut texts overlap by length - 1 bytes."""
    held, size = [], 0
    for row, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for at in range(lo, hi, _CHUNK):
            to = min(hi, at + _CHUNK + length - 1)
            if to - at < length:
                continue
            if held and size + to - at > _CHUNK + length:
                yield held
                held, size = [], 0
            held.append((row, at, to))
            size += to - at
    if held:
        yield held


_SEGMENTS = "uid bigint, start bigint, n int, o int, h bigint, d bigint"


def find_segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """uid, start, n (starts), o (anchor's offset from the first), h (anchor hash), d (digest of bytes and o)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uid, body = batch.column(0).to_numpy(), batch.column(1).cast(pa.large_binary())
            if not len(uid) or body.buffers()[2] is None:
                continue
            offsets = np.frombuffer(body.buffers()[1], np.int64)[body.offset: body.offset + len(uid) + 1]
            raw = np.frombuffer(body.buffers()[2], np.uint8)
            for pieces in _chunks(offsets, length):
                data = np.concatenate([raw[a:b] for _, a, b in pieces])
                ends = np.cumsum([b - a for _, a, b in pieces])
                first, count, o, h = segments(data, ends, length, gram)
                view, digest = memoryview(data), xxhash.xxh3_64_intdigest
                d = np.array([digest(view[a:b], s) for a, b, s in
                              zip(first.tolist(), (first + count + length - 1).tolist(), o.tolist())], dtype=np.uint64)
                piece = np.searchsorted(ends, first, side="right")
                row = np.array([p[0] for p in pieces])[piece]
                shift = (np.array([p[1] for p in pieces]) - np.concatenate(([0], ends[:-1])))[piece] - offsets[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[row]), pa.array(first + shift), pa.array(count.astype(np.int32)),
                     pa.array(o.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(d.view(np.int64))],
                    names=["uid", "start", "n", "o", "h", "d"])

    return docs.select("uid", "body").mapInArrow(run, _SEGMENTS)


def repeated_strings(bodies: list[bytes], offset: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Matrix (segment, start): is the string that starts there also in another of these segments?

    ``offset`` is the anchor's place in the segment, ``count`` the number of starts.
    """
    n, last = len(bodies), offset - count + 1  # anchor offsets of a segment's strings: last .. offset
    out = np.zeros((n, int(count.max(initial=0))), dtype=bool)
    right, right_common = sort_strings([b[o:] for b, o in zip(bodies, offset.tolist())])
    left, left_common = sort_strings([b[:o][::-1] for b, o in zip(bodies, offset.tolist())])
    right_class, left_class = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for o in range(int(last.min(initial=0)), int(offset.max(initial=-1)) + 1):
        have = np.flatnonzero((last <= o) & (o <= offset))
        if len(have) < 2:
            continue
        right_class[right] = np.cumsum(right_common < length - o)
        left_class[left] = np.cumsum(left_common < o)
        key = left_class[have] * (n + 1) + right_class[have]
        order = np.argsort(key, kind="stable")
        equal = np.diff(key[order]) == 0
        twice = have[order[np.concatenate((equal, [False])) | np.concatenate(([False], equal))]]
        out[twice, offset[twice] - o] = True
    return out


def _runs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of each run of true cells."""
    edge = np.diff(np.pad(matrix, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


_BODIES = "h bigint, d bigint, uid bigint, start bigint, n int, o int, single boolean, hot boolean, body binary"


def _bodies(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of wanted segments; documents stay where they are."""
    lists = wanted.groupBy("uid").agg(F.collect_list(F.struct("h", "d", "start", "n", "o", "single", "hot")).alias("w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _BODIES.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                uid, body = batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer()
                body = memoryview(body) if body is not None else b""
                w = batch.column(2)[i].values
                part = {f: w.field(f) for f in ("h", "d", "start", "n", "o", "single", "hot")}
                start, n = part["start"].to_numpy(), part["n"].to_numpy()
                bodies = [bytes(body[a:b]) for a, b in zip(start.tolist(), (start + n + length - 1).tolist())]
                made = part | {"uid": pa.array(np.full(len(start), uid)), "body": pa.array(bodies, pa.binary())}
                yield pa.RecordBatch.from_arrays([made[c] for c in names], names=names)

    return docs.select("uid", "body").join(lists, "uid").select("uid", "body", "w").mapInArrow(run, _BODIES)


def _sorted_groups(bodies: DataFrame, length: int) -> DataFrame:
    """uid, first, last: runs of repeated starts in the segments of anchors that fit a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            found = repeated_strings([r[6] for r in held], np.array([r[4] for r in held], dtype=np.int64),
                                     np.array([r[3] for r in held], dtype=np.int64), length)
            found[~np.array([r[5] for r in held])] = False  # equal segments are known already
            row, first, last = _runs(found)
            uid, start = (np.array([r[i] for r in held], dtype=np.int64)[row] for i in (1, 2))
            return pa.RecordBatch.from_arrays([pa.array(uid), pa.array(start + first), pa.array(start + last)],
                                              names=["uid", "first", "last"])

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if len(held) >= _BATCH and held[-1][0] != r[0]:
                    yield close()
                    held = []
                held.append(r)
        if held:
            yield close()

    n = parts(bodies.sparkSession)
    rows = bodies.select("h", "uid", "start", "n", "o", "single", "body").repartition(n, "h").sortWithinPartitions("h")
    return rows.mapInArrow(run, "uid bigint, first bigint, last bigint")


def _counted_strings(bodies: DataFrame, length: int) -> DataFrame:
    """As :func:`_sorted_groups` for anchors with too many segments: their strings are counted by digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for uid, start, n, single, body in zip(*[c.to_pylist() for c in batch.columns]):
                view = memoryview(body)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest(view[i: i + length]) for i in range(n)], pa.binary()),
                     pa.array(np.full(n, uid)), pa.array(start + np.arange(n)), pa.array(np.full(n, single))],
                    names=["g", "uid", "first", "single"])

    strings = cut_lineage(bodies.select("uid", "start", "n", "single", "body")
                          .mapInArrow(run, "g binary, uid bigint, first bigint, single boolean"), "repeat_strings")
    twice = strings.groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("g")
    return strings.where("single").join(twice, "g").select("uid", "first", F.col("first").alias("last"))


def _merged(spans: DataFrame, length: int) -> DataFrame:
    """uid, first, end: the maximal removed runs of bytes, from runs of repeated starts; sorted rows are streamed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None  # the run that the next rows may lengthen
        for batch in batches:
            out = []
            for uid, first, last in zip(*[c.to_pylist() for c in batch.columns]):
                if open_ and open_[0] == uid and first <= open_[2]:
                    open_[2] = max(open_[2], last + length)
                else:
                    if open_:
                        out.append(open_)
                    open_ = [uid, first, last + length]
            yield rows(out)
        if open_:
            yield rows([open_])

    def rows(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)],
                                          names=["uid", "first", "end"])

    dealt = spans.repartition(parts(spans.sparkSession), "uid").sortWithinPartitions("uid", "first")
    return dealt.mapInArrow(run, "uid bigint, first bigint, end bigint")


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """uid, id, body of every row, written once as a table bucketed by the row number."""
    spark = docs.sparkSession
    name = f"repeat_docs_{uuid.uuid4().hex}"
    n = parts(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    (rows.repartition(n, "uid").write.format("parquet").bucketBy(n, "uid").option("compression", "zstd")
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}").saveAsTable(name))
    return spark.table(name)


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """uid, first, last: runs of starts whose strings also start elsewhere. ``docs`` has uid and body."""
    if not 0 < gram <= length:
        raise ValueError("gram must be between 1 and length")
    found = cut_lineage(find_segments(docs, length, gram), "repeat_segments")
    counts = cut_lineage(found.groupBy("h", "d").agg(F.count(F.lit(1)).alias("c")), "repeat_counts")
    kinds = counts.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    known = (counts.join(kinds, "h", "left").where("c > 1 or m > 1")
             .select("h", "d", "c", F.coalesce("m", F.lit(1)).alias("m")))
    shared = cut_lineage(found.join(known, ["h", "d"]), "repeat_shared")
    single = shared.where("m > 1 and c = 1").select("h", "d", "m", "uid", "start", "n", "o", F.lit(True).alias("single"))
    one = (shared.where("m > 1 and c > 1").groupBy("h", "d")
           .agg(F.max("m").alias("m"), F.min(F.struct("uid", "start", "n", "o")).alias("r"))
           .select("h", "d", "m", "r.*", F.lit(False).alias("single")))
    wanted = single.unionByName(one).withColumn("hot", F.col("m") > group_rows)
    bodies = cut_lineage(_bodies(docs, wanted, length), "repeat_bodies")
    spans = (shared.where("c > 1").select("uid", F.col("start").alias("first"), (F.col("start") + F.col("n") - 1).alias("last"))
             .unionByName(_sorted_groups(bodies.where("not hot"), length)))
    if not bodies.where("hot").isEmpty():
        spans = spans.unionByName(_counted_strings(bodies.where("hot"), length))
    return spans


_SPANS = "array<struct<first:bigint,end:bigint>>"


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_rows: int = GROUP_ROWS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, spans array<struct<first,end>> (removed, maximal, in order), kept (binary)."""
    rows = _numbered(docs, id_col, text_col)
    spans = cut_lineage(_merged(repeated_spans(rows, length, gram, group_rows), length), "repeat_spans")
    lists = spans.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("s"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for body, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at = [0, *[x for s in spans for x in (s["first"], s["end"])], len(body)]
                kept.append(b"".join([body[a:b] for a, b in zip(at[::2], at[1::2])]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(batch.column(1)).cast(pa.int64()),
                                              batch.column(2), pa.array(kept, pa.binary())],
                                             names=["id", "n_bytes", "spans", "kept"])

    out = (rows.join(lists, "uid", "left").select("id", "body", F.coalesce("s", F.array().cast(_SPANS)).alias("s"))
           .mapInArrow(run, f"id {kind}, n_bytes bigint, spans {_SPANS}, kept binary"))
    return out.withColumnRenamed("id", id_col)


def removal_report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return remove_repeats(docs, length, gram, id_col=id_col, text_col=text_col).select(
        id_col, "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
