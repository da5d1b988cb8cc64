"""Univariate feature selection.

One aggregation computes the correlation of every candidate with the target;
the F statistic of a simple regression is ``r^2 / (1 - r^2) * (n - 2)``. Only
the k best names reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Fewer candidate features or rows are not worth a selection.
MIN_FEATURES, MIN_ROWS = 5, 30


def f_scores(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(feature, n, r, f_score) for every candidate; constant columns score lowest."""
    d = df.fillna(0, subset=features)
    y = F.col(target).cast("double")
    aggs = [F.count(y).alias("__n")]
    # correlation by its definition: a constant column has none, and no division by zero
    spread = F.stddev_pop(y)
    aggs += [F.try_divide(F.covar_pop(F.col(c).cast("double"), y), F.stddev_pop(F.col(c).cast("double")) * spread)
             .alias(f"c{i}") for i, c in enumerate(features)]
    wide = d.filter(y.isNotNull()).agg(*aggs)
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(features))
    long = wide.selectExpr("__n AS n", f"stack({len(features)}, {pairs}) AS (feature, r)")
    f = F.when(F.col("r").isNull() | F.isnan("r"), F.lit(None).cast("double")).otherwise(
        F.try_divide(F.col("r") * F.col("r"), F.lit(1.0) - F.col("r") * F.col("r")) * (F.col("n") - 2))
    return long.select("feature", "n", "r", f.alias("f_score"))


def select_k_best(df: DataFrame, features: list[str], target: str, k: int = 10, prefix: str = "selected_") -> DataFrame:
    """Copy the k best features as ``selected_<c>`` (ties by name)."""
    scores = f_scores(df, features, target)
    best = [r["feature"] for r in scores.orderBy(F.col("f_score").desc_nulls_last(), "feature").limit(k).collect()]
    return df.withColumns({f"{prefix}{c}": F.coalesce(F.col(c), F.lit(0)) for c in best})
