"""Keyed upsert as a Structured Streaming sink (``foreachBatch``): appended changes, folded now and then.

Each micro-batch writes only its own keys, the last row of each, as the folder
``v=<epoch>``: n changed keys cost n rows. The collection is a view: the newest
``base=<epoch>`` with the later changes merged field by field, so columns that a
change does not have keep their value. Every ``fold_every`` epochs the view is written
as the next base; readers list one folder and open a base and at most ``fold_every``
changes. A retried epoch rewrites only its own folders, and folders without
``_SUCCESS`` are not read, so the sink is idempotent per epoch.
"""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.sources.store import upsert_by_key

FOLD_EVERY = 32
_ORDER = "__epoch"


def _folders(spark: SparkSession, path: str) -> dict[str, dict[int, str]]:
    """Complete folders by kind (base, v) and epoch."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, dict[int, str]] = {"base": {}, "v": {}}
    for st in fs.listStatus(p) if fs.exists(p) else []:
        kind, _, number = st.getPath().getName().partition("=")
        if kind in out and number.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out[kind][int(number)] = st.getPath().toString()
    return out


def latest_snapshot(spark: SparkSession, path: str, keys: list[str], until: int | None = None) -> DataFrame | None:
    """The collection after all complete epochs (or those up to ``until``); None before the first."""
    found = _folders(spark, path)
    base = max((n for n in found["base"] if until is None or n <= until), default=None)
    current = spark.read.parquet(found["base"][base]) if base is not None else None
    later = [(n, spark.read.parquet(folder)) for n, folder in sorted(found["v"].items())
             if n > (base or 0) and (until is None or n <= until)]
    # epochs with the same columns merge in one aggregation
    for _, run in groupby(later, key=lambda x: tuple(x[1].columns)):
        changes = reduce(DataFrame.unionByName, [d.withColumn(_ORDER, F.lit(n)) for n, d in run])
        current = upsert_by_key(current, changes, keys, _ORDER)
    return current


def upsert_batch_writer(path: str, keys: list[str], order: str, fold_every: int = FOLD_EVERY):
    """A ``foreachBatch`` function appending each batch to ``path``; ``order`` says which row of a key is last."""
    if not order:
        raise ValueError("an upsert needs an order column: the last row of a key wins")

    def write(batch: DataFrame, epoch_id: int) -> None:
        version = epoch_id + 1
        upsert_by_key(None, batch, keys, order).write.mode("overwrite").parquet(f"{path}/v={version:09d}")
        if version % fold_every == 0:
            latest_snapshot(batch.sparkSession, path, keys, version).write.mode("overwrite").parquet(f"{path}/base={version:09d}")
    return write


def drop_folded(spark: SparkSession, path: str) -> None:
    """Deletes what no reader of the newest two bases needs."""
    jvm, found = spark.sparkContext._jvm, _folders(spark, path)
    kept = sorted(found["base"])[-2:]
    if len(kept) < 2:
        return
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in [f for n, f in found["base"].items() if n < kept[0]] + [f for n, f in found["v"].items() if n <= kept[0]]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(folder), True)


def start_upsert_stream(stream: DataFrame, path: str, keys: list[str], checkpoint: str, order: str,
                        available_now: bool = True, fold_every: int = FOLD_EVERY):
    w = stream.writeStream.foreachBatch(upsert_batch_writer(path, keys, order, fold_every)).option(
        "checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
