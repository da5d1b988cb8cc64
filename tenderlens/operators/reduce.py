"""Dimension reduction on vector columns.

Fits use Spark ML / MLlib distributed Gramian and covariance computations;
only d x k loadings and the d-dimensional mean reach the driver (bounded by
the vector width, not by the row count).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand_array(df: DataFrame, c: str, n: int | None = None, name: str | None = None) -> DataFrame:
    """``<name>_<i>`` columns from an array column (i from 0)."""
    name = name or c
    if n is None:
        n = df.select(F.max(F.size(c))).first()[0] or 0
    return df.select(*[x for x in df.columns if x != c], *[F.col(c)[i].alias(f"{name}_{i}") for i in range(n)])


def truncate_vector(df: DataFrame, c: str, n: int = 10) -> DataFrame:
    """Keep the first ``n`` dimensions."""
    return df.withColumn(c, F.slice(c, 1, n))


def _as_vector(df: DataFrame, c: str) -> DataFrame:
    dt = df.schema[c].dataType.typeName()
    if dt == "array":
        return df.withColumn(c, array_to_vector(F.transform(c, lambda x: x.cast("double"))))
    return df


def column_means(df: DataFrame, c: str) -> list[float]:
    v = _as_vector(df.select(c).na.drop(), c)
    m = v.select(Summarizer.mean(F.col(c)).alias("m")).first()["m"]
    return list(m.toArray()) if m is not None else []


def _signed(loadings: np.ndarray) -> np.ndarray:
    """Columns whose entry of largest size is positive."""
    out = np.array(loadings, copy=True)
    for j in range(out.shape[1]):
        if out[abs(out[:, j]).argmax(), j] < 0:
            out[:, j] = -out[:, j]
    return out


def pca_fit(df: DataFrame, c: str, k: int):
    """Centred PCA: returns (mean, loadings d x k with sign fixed, explained variance)."""
    v = _as_vector(df.select(c).na.drop(), c)
    mean = column_means(v, c)
    d = len(mean)
    k = min(k, d)
    centred = v.select(array_to_vector(F.zip_with(vector_to_array(c), F.array(*[F.lit(x) for x in mean]),
                                                  lambda a, m: a - m)).alias(c))
    model = PCA(k=k, inputCol=c, outputCol="__pca").fit(centred)
    pc = _signed(model.pc.toArray())  # d x k
    return mean, pc, list(model.explainedVariance.toArray())


def pca_reduce(df: DataFrame, key: str, c: str, k: int = 20, prefix: str = "PCA") -> DataFrame:
    """(key, ``<prefix>_1..k``) component scores of the centred vectors."""
    mean, pc, _ = pca_fit(df, c, k)
    arr = F.transform(c, lambda x: x.cast("double")) if df.schema[c].dataType.typeName() == "array" \
        else vector_to_array(c)
    cen = F.zip_with(arr, F.array(*[F.lit(x) for x in mean]), lambda a, m: a - m)
    d = df.select(key, cen.alias("__c"))
    outs = []
    for j in range(pc.shape[1]):
        w = F.array(*[F.lit(float(x)) for x in pc[:, j]])
        outs.append(F.aggregate(F.zip_with(F.col("__c"), w, lambda a, b: a * b), F.lit(0.0),
                                lambda acc, x: acc + x).alias(f"{prefix}_{j + 1}"))
    return d.select(key, *outs)


def explained_variance(df: DataFrame, c: str, k: int) -> list[float]:
    return pca_fit(df, c, k)[2]


def gramian(df: DataFrame, c: str) -> "np.ndarray":
    """X^T X of a vector column from JVM-side statistics (no Python rows).

    X^T X = (n - 1) * cov + n * mean mean^T, with cov from the correlation
    matrix and the sample variances (constant columns: correlation NaN -> 0).
    """
    from pyspark import StorageLevel
    from pyspark.ml.stat import Correlation
    v = _as_vector(df.select(c).na.drop(), c).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        st = v.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(c)).alias("s")).first()["s"]
        mean, var, n = np.array(st["mean"].toArray()), np.array(st["variance"].toArray()), float(st["count"])
        corr = np.nan_to_num(np.array(Correlation.corr(v, c).first()[0].toArray()), nan=0.0)
    finally:
        v.unpersist()
    sd = np.sqrt(np.maximum(var, 0.0))
    return (n - 1) * corr * np.outer(sd, sd) + n * np.outer(mean, mean)


def svd_reduce(df: DataFrame, key: str, c: str, k: int = 20, prefix: str = "SVD") -> DataFrame:
    """Truncated SVD without centring; scores = rows x V (k columns).

    V holds the top eigenvectors of the Gramian X^T X (d x d, bounded by the
    vector width), computed from distributed statistics.
    """
    g = gramian(df, c)
    vals, vecs = np.linalg.eigh(g)
    order = np.argsort(vals)[::-1][:min(k, g.shape[0])]
    V = np.array(vecs[:, order], copy=True)
    for j in range(V.shape[1]):
        if V[abs(V[:, j]).argmax(), j] < 0:
            V[:, j] = -V[:, j]
    arr = F.transform(c, lambda x: x.cast("double")) if df.schema[c].dataType.typeName() == "array" \
        else vector_to_array(c)
    outs = []
    for j in range(V.shape[1]):
        w = F.array(*[F.lit(float(x)) for x in V[:, j]])
        outs.append(F.aggregate(F.zip_with(arr, w, lambda a, b: a * b), F.lit(0.0),
                                lambda acc, x: acc + x).alias(f"{prefix}_{j + 1}"))
    return df.select(key, *outs)


def centred_products(df: DataFrame, cols: list[str], around: list[float]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sums, sums of products) of double columns less ``around``, in one pass without a vector per row.

    A task sends one row per pair of columns, whatever its number of rows.
    """
    shift, width = np.array(around, dtype=float), len(cols)
    a, b = np.triu_indices(width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) - shift
            n, sums, products = n + len(x), sums + x.sum(axis=0), products + x.T @ x
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(([-1], np.full(width, -1), a)), pa.int32()),
                 pa.array(np.concatenate(([-1], np.arange(width), b)), pa.int32()),
                 pa.array(np.concatenate(([float(n)], sums, products[a, b])), pa.float64())], names=["i", "j", "v"])

    rows = (df.select(*[F.col(f"`{c}`") for c in cols]).mapInArrow(add, "i int, j int, v double")
            .groupBy("i", "j").agg(F.sum("v").alias("v")).collect())
    n, sums, products = 0, np.zeros(width), np.zeros((width, width))
    for i, j, v in rows:
        if i < 0 and j < 0:
            n = int(v)
        elif i < 0:
            sums[j] = v
        else:
            products[i, j] = products[j, i] = v
    return n, sums, products


def add_pca_numeric(df: DataFrame, cols: list[str], k: int = 3,
                    exclude_prefixes=("TFIDF_", "dummy_", "BGE_", "PCA_"), prefix: str = "PCA") -> DataFrame:
    """``<prefix>_1..k`` of the numeric features (fill 0, min-max), k = min(3, n-1), beside a row's other columns.

    Least, largest and mean values come from one pass, the covariance from a second; a
    row's scores are sums over its own columns. Fewer than 5 columns add nothing.
    """
    cols = [c for c in cols if not c.startswith(tuple(exclude_prefixes))]
    if len(cols) < 5:
        return df
    x = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in cols]
    seen = df.agg(*[e for i, v in enumerate(x) for e in (F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.avg(v).alias(f"m{i}"))]).first()
    k = min(k, len(cols) - 1)
    if seen["lo0"] is None:  # no rows
        return df.withColumns({f"{prefix}_{j + 1}": F.lit(None).cast("double") for j in range(k)})
    low, span = [seen[f"lo{i}"] for i in range(len(cols))], [seen[f"hi{i}"] - seen[f"lo{i}"] for i in range(len(cols))]
    names = [f"__scaled_{i}" for i in range(len(cols))]
    scaled = {names[i]: F.lit(0.0) if span[i] == 0 else (v - F.lit(low[i])) / F.lit(span[i]) for i, v in enumerate(x)}
    around = [0.0 if s == 0 else (seen[f"m{i}"] - low[i]) / s for i, s in enumerate(span)]
    n, sums, products = centred_products(df.select(*[e.alias(c) for c, e in scaled.items()]), names, around)
    mean = [m + s / n for m, s in zip(around, sums.tolist())]
    values, vectors = np.linalg.eigh((products - np.outer(sums, sums) / n) / max(1, n - 1))
    pc = _signed(vectors[:, np.argsort(-values, kind="stable")[:k]])
    scores = {f"{prefix}_{j + 1}": reduce(lambda acc, e: acc + e, [(F.col(c) - F.lit(m)) * F.lit(w) for c, m, w in
                                                                  zip(names, mean, pc[:, j].tolist())]) for j in range(k)}
    return df.withColumns(scaled).withColumns(scores).drop(*names)


def pca_numeric(df: DataFrame, key: str, cols: list[str] | None = None, k: int = 3,
                exclude_prefixes=("TFIDF_", "dummy_", "BGE_", "PCA_")) -> DataFrame:
    """(key, ``PCA_1..k``) of the numeric features; see :func:`add_pca_numeric`."""
    from tenderlens.operators.clean import numeric_columns
    cols = numeric_columns(df, (key,)) if cols is None else cols
    d = add_pca_numeric(df.select(key, *[F.col(f"`{c}`").alias(f"__in_{c}") for c in cols]),
                        [f"__in_{c}" for c in cols if not c.startswith(tuple(exclude_prefixes))], k)
    return d.select(key, *[c for c in d.columns if c != key and not c.startswith("__in_")])
