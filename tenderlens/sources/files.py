"""File scans and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_csv_glob(spark: SparkSession, pattern: str, schema=None, dataset_col: str = "dataset") -> DataFrame:
    """A1: all CSV files of a glob as one DataFrame; ``dataset`` = 'DataSet_' + name up to the first dot.

    Unreadable files do not fail the job; :func:`rejected_files` names them.
    """
    r = spark.read.option("header", True).option("ignoreCorruptFiles", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(pattern)
    return df.withColumn(dataset_col, F.concat(F.lit("DataSet_"),
                                               F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]*)", 1)))


def rejected_files(spark: SparkSession, pattern: str, scanned: DataFrame) -> DataFrame:
    """A1: (path, length) of the glob's files that gave no row to the scan: unreadable or without rows.

    The listing reads no contents; files of no bytes are not listed.
    """
    listed = spark.read.format("binaryFile").load(pattern).select("path", "length")
    seen = scanned.select(F.col("_metadata.file_path").alias("path")).distinct()
    return listed.join(seen, "path", "left_anti")


def scan_json(spark: SparkSession, pattern: str, schema=None, multi_line: bool = False) -> DataFrame:
    """A2: JSON documents, one per line; ``multi_line`` for files that hold one document or an array."""
    r = spark.read.option("multiLine", multi_line)
    return (r.schema(schema) if schema is not None else r).json(pattern)


def first_existing(spark: SparkSession, paths: list[str]) -> str:
    """A3 helper: the first path that exists on the (Hadoop) file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            return p
    raise FileNotFoundError(f"none of {paths} exists")


def scan_csv_fallback(spark: SparkSession, paths: list[str], schema=None) -> DataFrame:
    """A3: one CSV from the first existing of a default and fallback paths."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(first_existing(spark, paths))


def write_datasets(df: DataFrame, path: str, dataset_col: str = "dataset", fmt: str = "parquet",
                   mode: str = "overwrite") -> None:
    """One folder per dataset; 'overwrite' replaces only the written partitions."""
    w = df.write.mode(mode).partitionBy(dataset_col).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_split(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet") -> None:
    """train/test rows written side by side, partitioned by the split column."""
    write_datasets(df, path, split_col, fmt)


def load_split_tables(spark: SparkSession, path: str, split_col: str = "split",
                      required=("train", "test")) -> dict[str, DataFrame]:
    """The saved splits; fails when one is missing."""
    df = spark.read.parquet(path)
    present = {r[0] for r in df.select(split_col).distinct().collect()}
    missing = [s for s in required if s not in present]
    if missing:
        raise FileNotFoundError(f"missing splits: {missing}")
    return {s: df.filter(F.col(split_col) == s) for s in required}
