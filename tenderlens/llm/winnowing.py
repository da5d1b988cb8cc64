"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling polynomial hash (prefix sums modulo
2^64, so any gram's hash is one subtraction), mixed to spread the values. In
every window of w consecutive grams the smallest hash is chosen, the rightmost
on ties, and kept with its position. Two texts that share a passage of at least
``k + w - 1`` code points share a window and so a fingerprint entry.

Defined results: a null text is empty; an empty text has no entries (its
fingerprint string is empty); a text shorter than k is one gram; a text with
fewer than w grams is one window. Likeness is the Jaccard similarity of the
hash sets, 1.0 when both are empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from .common import bucket_of, parts, range_bounds, text_or_empty

GRAM, WINDOW = 8, 16               # short, so that short texts keep several grams
BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2^64
INVERSE = pow(BASE, -1, 1 << 64)
_SEGMENT = 1 << 23                 # windows handled at once; positions must fit the 24 tie bits
_FLUSH = 2_000_000                 # characters of texts whose results a task holds; entries take several times as much
_powers: dict[str, np.ndarray] = {}


def _power_table(kind: str, factor: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        steps = np.full(size, factor, dtype=np.uint64)
        steps[0] = 1
        _powers[kind] = have = np.multiply.accumulate(steps)
    return have[:n]


def gram_hashes(text: str, k: int) -> np.ndarray:
    """Mixed rolling hash of each k-gram, in order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = len(codes)
    if not n:
        return np.empty(0, dtype=np.uint64)
    k = min(k, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((codes + np.uint64(1)) * _power_table("up", BASE, n), out=sums[1:])
    h = (sums[k:] - sums[:-k]) * _power_table("down", INVERSE, n - k + 1)
    h ^= h >> np.uint64(31)        # a common 64-bit finaliser
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """Smallest key of each run of w: running minima from both sides of blocks of w."""
    n = len(keys)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    blocks = padded.reshape(-1, w)
    from_left = np.minimum.accumulate(blocks, axis=1).ravel()
    from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[: n - w + 1], from_left[w - 1: n])


def winnow(text: str | None, k: int = GRAM, w: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the chosen grams, by ascending position.

    Hashes are compared by their upper 40 bits; the lower 24 bits of the compared
    key hold the position, reversed, so that the rightmost of equal hashes wins.
    """
    h = gram_hashes(text or "", k)
    if not len(h):
        return h, np.empty(0, dtype=np.int64)
    w = min(w, len(h), 1 << 20)
    chosen = []
    for first in range(0, len(h) - w + 1, _SEGMENT):
        part = h[first: first + _SEGMENT + w - 1]
        place = np.arange(len(part), dtype=np.uint64)
        keys = (part & ~np.uint64(0xFFFFFF)) | (np.uint64(0xFFFFFF) - place)
        best = _window_minima(keys, w)
        best = best[np.concatenate(([True], best[1:] != best[:-1]))]
        chosen.append(first + 0xFFFFFF - (best & np.uint64(0xFFFFFF)).astype(np.int64))
    positions = np.unique(np.concatenate(chosen))
    return h[positions], positions


def as_string(hashes: np.ndarray, positions: np.ndarray) -> str:
    """``hash:position`` entries (16 hex digits, decimal) joined by spaces."""
    return " ".join(map("%016x:%d".__mod__, zip(hashes.tolist(), positions.tolist())))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes."""
    x, y = set(a.tolist()), set(b.tolist())
    both = len(x & y)
    return both / (len(x) + len(y) - both) if x or y else 1.0


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """One row per document: id, hashes array<long> (two's complement), positions array<long>."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = rows.select("id").schema.add("hashes", ArrayType(LongType())).add("positions", ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [winnow(t, k, w) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([m[0].view(np.int64) for m in marks], pa.list_(pa.int64())),
                 pa.array([m[1] for m in marks], pa.list_(pa.int64()))], names=["id", "hashes", "positions"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def in_descending_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by descending id in range partitions, each followed by the next partition's first row.

    Columns bucket, guest, id, text. Cut points come from a scan of the ids; a row
    that opens a bucket is sent to the bucket before it as a guest, so one pass
    over a sorted partition sees each row's successor. The last row's successor is
    the first row. Null ids come last, equal ids in ascending order of text.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    ids = rows.select("id")
    bounds = range_bounds(ids, "id", parts(docs.sparkSession))
    bucket = bucket_of(F.col("id"), bounds)
    tops = sorted((r["b"], r["top"]) for r in ids.groupBy(bucket.alias("b")).agg(F.max("id").alias("top")).collect())
    to = {tops[i - 1][1]: b for i, (b, _) in enumerate(tops)}  # the lowest bucket is followed by the highest
    own = rows.select(bucket.alias("bucket"), F.lit(False).alias("guest"), "id", "text")
    guest_in = F.lit(None).cast("int")
    for top, b in to.items():
        guest_in = F.when(F.col("id").eqNullSafe(F.lit(top)), F.lit(b)).otherwise(guest_in)
    opens = F.col("id").isin([t for t in to if t is not None])
    opens = opens | F.col("id").isNull() if None in to else opens
    guests = rows.where(opens).select(guest_in.alias("bucket"), F.lit(True).alias("guest"), "id", "text")
    n = max(1, len(bounds) + 1)
    return (own.unionAll(guests).repartitionById(n, "bucket")
            .sortWithinPartitions("bucket", "guest", F.col("id").desc_nulls_last(), "text"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text has the last third of the code points replaced by the first as
    many (or all) of the next document by descending id. Rows of equal id each get
    a result; a single row is its own successor.
    """
    rows = in_descending_order(docs, id_col, text_col)
    schema = (f"`id` {rows.schema['id'].dataType.simpleString()}, n_chars bigint, edited_sha256 string, "
              "fingerprint string, edited_fingerprint string, near_edited double, near_next double")

    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (bucket, id, text, hashes, positions) whose successor is still to come
        closed = None  # bucket whose guest has been seen
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            kinds = (batch.column(2).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)
            size = 0
            for bucket, guest, key, text in zip(*[c.to_pylist() for c in batch.columns]):
                if guest and closed == bucket:
                    continue  # a second guest: the first in order is the successor
                mark = winnow(text, k, w)
                if before is not None and before[0] == bucket:
                    third = len(before[2]) // 3
                    edited = before[2][: len(before[2]) - third] + text[:third]
                    edited_mark = winnow(edited, k, w)
                    for column, value in zip(out, (
                            before[1], len(before[2]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                            as_string(*before[3]), as_string(*edited_mark),
                            likeness(before[3][0], edited_mark[0]), likeness(before[3][0], mark[0]))):
                        column.append(value)
                    size += len(before[2])
                    if size > _FLUSH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)
                        out, size = [[] for _ in range(7)], 0
                closed = bucket if guest else closed
                before = None if guest else (bucket, key, text, mark)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
