"""Session helpers.

On a cluster the session is handed in by the caller; these helpers only fill
in settings that are unset, so cluster-wide choices (checkpoint folder,
shuffle partitions) always win.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # one statistics row per column set / dataset is broadcast explicitly;
    # automatic broadcast stays at Spark's size-checked default
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tenderlens") -> SparkSession:
    """Return the active session or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TENDERLENS_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir``. Only a local session (one machine, as in
    tests) may leave it unset and gets a fresh folder of its own; elsewhere a
    machine's own folder would be lost on the others, so that raises.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tenderlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def drop_tables(spark: SparkSession) -> None:
    """Deletes the tables that :func:`cut_lineage` has written for this application.

    For the end of a run: DataFrames that read them fail afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/tables")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df, name: str = "stage"):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job (compute + write); later reads get column pruning and filter
    pushdown, and a lost executor only re-reads files instead of recomputing
    the lineage. Never ``localCheckpoint`` (executor-local storage).
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
