"""Token ids in seekable files of independent zstandard frames.

One file per range of document ids, one frame per document (its ids as
little-endian unsigned 32-bit integers). Behind the frames come a skippable
frame with the document table and, at the end, the seek table of the public
zstandard seekable format: compressed size, size and checksum (lower 32 bits of
XXH64) of each frame. A reader of some documents reads the tail of a file and
decompresses only their frames; a wrong checksum raises.

Executors write each file under an attempt's own name and move it into place, so
a lost executor's task can run again. The folder lies under the shared
checkpoint folder unless one is given. Defined results: a null text is empty and
has the end id only; null ids come first; equal ids keep all their rows, ordered
by checksum; an empty table gives no file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bucket_of, checkpoint_dir, cut_lineage, parts, range_bounds, text_or_empty
from .encode import crc32, encoder

# fixed values of the zstandard seekable format
SKIPPABLE, SEEK_TABLE, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
LEVEL = 3
_DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("tokens", "<u8")])
_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a shared folder's address."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pa.fs.FileSystem.from_uri(uri)


def checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


def compress(raw: bytes, made: list = []) -> bytes:  # noqa: B006  one compressor per worker
    if not made:
        made.append(zstandard.ZstdCompressor(level=LEVEL))
    return made[0].compress(raw)


def tail(docs: list[tuple[int | None, int]], entries: list[tuple[int, int, int]]) -> bytes:
    """Document table and seek table for the frames already written."""
    table = np.array([(k or 0, k is None, n) for k, n in docs], dtype=_DOC).tobytes()
    index = struct.pack("<II", SKIPPABLE, len(table)) + table
    rows = np.array([*entries, (len(index), 0, 0)], dtype=_ENTRY).tobytes()
    body = rows + struct.pack("<IBI", len(entries) + 1, HAS_CHECKSUMS, SEEKABLE)
    return index + struct.pack("<II", SEEK_TABLE, len(body)) + body


class FrameFile:
    """A written file: ``ids()`` lists its documents, ``read(which)`` decompresses some or all."""

    def __init__(self, uri: str):
        self.fs, self.path = file_system(uri)
        with self.fs.open_input_file(self.path) as f:
            size = f.size()
            count, flags, magic = struct.unpack("<IBI", f.read_at(9, size - 9))
            if magic != SEEKABLE or not flags & HAS_CHECKSUMS:
                raise ValueError(f"{uri}: no seek table")
            entries = np.frombuffer(f.read_at(count * _ENTRY.itemsize, size - 9 - count * _ENTRY.itemsize), _ENTRY)
            starts = np.concatenate(([0], np.cumsum(entries["packed"], dtype=np.int64)))
            self.docs = np.frombuffer(f.read_at(int(entries["packed"][-1]) - 8, int(starts[-2]) + 8), _DOC)
        self.entries, self.starts = entries[:-1], starts[:-2]
        self.tokens_before = np.concatenate(([0], np.cumsum(self.docs["tokens"].astype(np.int64))))

    def ids(self) -> list[int | None]:
        return [None if n else k for k, n in zip(self.docs["id"].tolist(), self.docs["null"].tolist())]

    def _open(self, packed: bytes, i: int, unpack) -> bytes:
        raw = unpack.decompress(packed, max_output_size=max(1, int(self.entries["size"][i])))
        if checksum(raw) != self.entries["check"][i]:
            raise ValueError(f"{self.path}: frame {i} has another checksum")
        return raw

    def read(self, which: set | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(document id, its first token's place in the file, raw ids) in file order."""
        unpack = zstandard.ZstdDecompressor()
        keys = self.ids()
        if which is None:
            with self.fs.open_input_stream(self.path, compression=None, buffer_size=1 << 22) as f:
                for i, key in enumerate(keys):
                    yield key, int(self.tokens_before[i]), self._open(f.read(int(self.entries["packed"][i])), i, unpack)
            return
        with self.fs.open_input_file(self.path) as f:
            for i, key in enumerate(keys):
                if key in which:
                    packed = f.read_at(int(self.entries["packed"][i]), int(self.starts[i]))
                    yield key, int(self.tokens_before[i]), self._open(packed, i, unpack)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and writes all documents; the manifest: bucket, path, documents, tokens, base.

    Texts are encoded and compressed where they are read, so the one shuffle (by
    ranges of ids) moves compressed frames. ``base`` is the number of ids in all
    files before.
    """
    spark: SparkSession = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    bounds = range_bounds(rows.select("id"), "id", parts(spark))
    end = struct.pack("<I", end_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            raw = [enc.encode(t) + end for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(r) // 4 for r in raw], pa.int64()),
                 pa.array([checksum(r) for r in raw], pa.int64()), pa.array([compress(r) for r in raw], pa.binary())],
                names=["bucket", "id", "tokens", "check", "frame"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        out, at, name, docs_in, entries, made = None, None, None, [], [], []

        def close() -> None:
            out.write(tail(docs_in, entries))
            out.close()
            fs.move(f"{name}.{attempt}", name)
            made.append((at, f"{folder}/part-{at:06d}.zst", len(docs_in), sum(n for _, n in docs_in)))

        for batch in batches:
            for bucket, key, tokens, check, frame in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != at:
                    if out:
                        close()
                    at, name, docs_in, entries = bucket, f"{path}/part-{bucket:06d}.zst", [], []
                    out = fs.open_output_stream(f"{name}.{attempt}", compression=None, buffer_size=1 << 20)
                out.write(frame)
                docs_in.append((key, tokens))
                entries.append((len(frame), 4 * tokens, check))
        if out:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["bucket", "path", "documents", "tokens"])

    frames = (rows.select(bucket_of(F.col("id"), bounds).alias("bucket"), "id", "text")
              .mapInArrow(encode, "bucket int, id bigint, tokens bigint, check bigint, frame binary")
              .repartitionById(len(bounds) + 1, "bucket")
              .sortWithinPartitions("bucket", F.col("id").asc_nulls_first(), "check", "tokens"))
    manifest = cut_lineage(frames.mapInArrow(write, "bucket int, path string, documents bigint, tokens bigint"),
                           "token_manifest")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document from the files: id, start, n_tokens, ids_crc32 (unsigned). Files are read in parallel."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*[c.to_pylist() for c in batch.columns]):
                rows: list[tuple] = []
                for key, first, raw in FrameFile(path).read():
                    rows.append((key, base + first, len(raw) // 4, crc32(raw)))
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                                          names=["id", "start", "n_tokens", "ids_crc32"])

    n = parts(manifest.sparkSession)
    files = manifest.select("path", "base", "bucket").repartitionById(n, "bucket").select("path", "base")
    return (files.mapInArrow(read, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
            .withColumnRenamed("id", id_col))


def read_documents(path: str, which: set) -> dict:
    """Ids of some documents of one file; only their frames are decompressed."""
    return {key: np.frombuffer(raw, "<u4") for key, _, raw in FrameFile(path).read(which)}
