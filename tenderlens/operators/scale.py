"""Scaling and log transforms.

Fit functions return a small statistics DataFrame (one row, or one row per
group); apply functions join it back by broadcast. Train statistics can be
persisted and applied to test data (G2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.operators.clean import fill_median, nan_to_null, numeric_columns

# Name fragments that keep a numeric column out of min-max scaling.
ID_KEYWORDS = ("id", "ID", "번호", "index")


def standard_stats(df: DataFrame, cols: list[str], group: str | None = None) -> DataFrame:
    """G1 fit: mean and population std per column (and per group)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"__m_{c}"), F.stddev_pop(x).alias(f"__s_{c}")]
    return (df.groupBy(group) if group else df.groupBy()).agg(*aggs)


def apply_standard(df: DataFrame, stats: DataFrame, cols: list[str], group: str | None = None,
                   out: dict[str, str] | None = None) -> DataFrame:
    """G1/G2 apply: (x - mean) / std with zero variance -> 0; NULL stays NULL."""
    out = out or {c: c for c in cols}
    j = df.join(stats, group, "left") if group else df.crossJoin(F.broadcast(stats))  # groups may be many
    exprs = {}
    for c in cols:
        s = F.col(f"__s_{c}")
        z = F.when(s.isNull() | (s == 0), F.lit(0.0)).otherwise((F.col(c).cast("double") - F.col(f"__m_{c}")) / s)
        exprs[out[c]] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(z)
    return j.withColumns(exprs).drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def standardize(df: DataFrame, cols: list[str], group: str | None = None,
                out: dict[str, str] | None = None) -> DataFrame:
    return apply_standard(df, standard_stats(df, cols, group), cols, group, out)


def scalable_columns(df: DataFrame, exclude_keywords=ID_KEYWORDS, exclude=()) -> list[str]:
    """Numeric columns whose names contain none of the keywords (Q10 kept literally)."""
    return [c for c in numeric_columns(df, exclude) if not any(k in c for k in exclude_keywords)]


def minmax_stats(df: DataFrame, cols: list[str], group: str | None = None) -> DataFrame:
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"__lo_{c}"), F.max(x).alias(f"__hi_{c}")]
    return (df.groupBy(group) if group else df.groupBy()).agg(*aggs)


def apply_minmax(df: DataFrame, stats: DataFrame, cols: list[str], group: str | None = None) -> DataFrame:
    """(x - min) / (max - min); a constant column gives 0 (not Spark ML's 0.5)."""
    j = df.join(stats, group, "left") if group else df.crossJoin(F.broadcast(stats))
    exprs = {}
    for c in cols:
        lo, hi = F.col(f"__lo_{c}"), F.col(f"__hi_{c}")
        rng = hi - lo
        exprs[c] = F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c).cast("double") - lo) / rng)
    return j.withColumns(exprs).drop(*[f"__lo_{c}" for c in cols], *[f"__hi_{c}" for c in cols])


def minmax_scale(df: DataFrame, cols: list[str] | None = None, group: str | None = None,
                 exclude_keywords=ID_KEYWORDS) -> DataFrame:
    """Median-fill NULLs, then min-max to 0..1 over the scalable columns."""
    cols = scalable_columns(df, exclude_keywords) if cols is None else cols
    if not cols:
        return df
    d = fill_median(df, cols)  # filling with a median moves no minimum or maximum
    return apply_minmax(d, minmax_stats(nan_to_null(df, cols), cols, group), cols, group)


def log1p_shifted(df: DataFrame, cols: list[str], prefix: str = "norm_log_") -> DataFrame:
    """``log1p(x + shift)``, shift = |min| + 1 when min <= 0, else 0."""
    d = nan_to_null(df, cols)
    stats = d.agg(*[F.min(F.col(c).cast("double")).alias(f"__min_{c}") for c in cols])
    exprs = {}
    for c in cols:
        mn = F.col(f"__min_{c}")
        shift = F.when(mn <= 0, F.abs(mn) + 1).otherwise(F.lit(0.0))
        exprs[f"{prefix}{c}"] = F.log1p(F.col(c).cast("double") + shift)
    j = d.crossJoin(F.broadcast(stats))
    return j.withColumns(exprs).drop(*[f"__min_{c}" for c in cols])
