"""Model-table preparation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def target_feature_split(df: DataFrame, prefix: str, key: str) -> tuple[list[str], list[str]]:
    """Target columns by prefix; features = the rest minus the key (names only, no job)."""
    targets = [c for c in df.columns if c.startswith(f"{prefix}_")]
    features = [c for c in df.columns if c not in targets and c != key]
    return targets, features


def drop_null_targets(df: DataFrame, targets: list[str]) -> DataFrame:
    """Drop rows where any target is NULL."""
    return df.dropna(how="any", subset=targets)


def join_features_targets(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """D3: rows aligned by key (never by position)."""
    return features.join(targets, key, "inner")


def common_schema(a: DataFrame, b: DataFrame) -> list[str]:
    """Sorted common column names."""
    return sorted(set(a.columns) & set(b.columns))


def align_types(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """B7 + B8: project both to the common columns; differently typed ones become strings in both."""
    cols = common_schema(a, b) if cols is None else cols
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    diff = {c for c in cols if ta[c] != tb[c]}

    def proj(d):
        return d.select(*[F.col(c).cast("string").alias(c) if c in diff else F.col(c) for c in cols])
    return proj(a), proj(b)


def run_summary(runs: DataFrame) -> DataFrame:
    """E5: successes, failures and models trained per model type and in total (rollup)."""
    return runs.rollup("model_type").agg(
        F.count_if(F.col("success")).alias("n_success"), F.count_if(~F.col("success")).alias("n_failed"),
        F.sum("models_trained").alias("models_trained"))


def blobs(values: np.ndarray) -> pa.Array:
    """A row of a matrix as bytes: one value of a column instead of a list of many."""
    values = np.ascontiguousarray(values)
    offsets = np.arange(len(values) + 1, dtype=np.int64) * values.shape[1] * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def from_blobs(column: pa.Array, kind: type) -> np.ndarray:
    """The matrix of :func:`blobs`."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.empty((0, 0), dtype=kind)
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    count = int(ends[-1] - ends[0]) // np.dtype(kind).itemsize
    return (np.frombuffer(column.buffers()[2], kind, count, int(ends[0])) if count else np.empty(0, dtype=kind)).reshape(len(column), -1)
