"""Helpers shared by the operators: tables, range buckets, whole-row handling."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.session import checkpoint_dir, cut_lineage

__all__ = ["table", "cut_lineage", "checkpoint_dir", "parts", "range_bounds", "bucket_of", "text_or_empty",
           "group_ranks"]

# ASCII white space, as the contracts write it: [\x20\x09-\x0D]
SPACES = r"[ \t-\r]+"
NOT_SPACES = r"[^ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _workers_find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _workers_find_package(spark: SparkSession) -> None:
    """Local Python workers look where this package was imported from; a cluster has it installed (or --py-files)."""
    sc, home = spark.sparkContext, str(Path(__file__).resolve().parents[2])
    have = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
    if sc.master.startswith("local") and home not in have:
        sc.environment["PYTHONPATH"] = os.pathsep.join([home, *filter(None, have)])


def parts(spark: SparkSession) -> int:
    """Shuffle width the cluster has chosen."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(name: str = "text") -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def range_bounds(df: DataFrame, key: str, n: int) -> list:
    """At most n - 1 ascending cut points of a numeric key (approximate quantiles, one scan of one column)."""
    if n < 2:
        return []
    row = df.agg(F.percentile_approx(F.col(key), [i / n for i in range(1, n)], 20_000).alias("b")).first()
    return sorted({x for x in (row["b"] or []) if x is not None})


def bucket_of(key: Column, bounds: list) -> Column:
    """Number of bounds <= key, as a balanced decision tree (log2 n comparisons a row); null: 0."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(key.isNull(), F.lit(0)).otherwise(tree(0, len(bounds)))


_held: dict = {}


def held(key, make):
    """What a Python worker keeps between tasks: one operator's caches, so that stages do not add up in memory."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def group_ranks(rows: DataFrame, group: list[str], order: list[Column], slot: Column, slots: int) -> DataFrame:
    """Adds ``rank`` (0, 1, ...) within each group without gathering a group in one task.

    ``slot`` spreads a group over ``slots`` consecutive integers and must be the
    leading part of the order. Slots are counted with partial aggregation, their
    counts are summed up by a window over at most ``slots`` rows a group, and rows
    are numbered only within one slot of one group.
    """
    from pyspark.sql import Window

    rows = rows.withColumn("_slot", slot)
    counts = rows.groupBy(*group, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = [F.col(f"r.{g}").eqNullSafe(F.col(f"s.{g}")) for g in (*group, "_slot")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = rows.alias("r").join(starts.alias("s"), on).select("r.*", "s._before")
    within = Window.partitionBy(*group, "_slot").orderBy(*order)
    return (joined.withColumn("rank", F.col("_before") + F.row_number().over(within) - F.lit(1))
            .drop("_slot", "_before"))
