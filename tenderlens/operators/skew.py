"""Skew handling for key joins whose large side may have hot keys.

A key is hot when it holds at least 1 / ``SHARES`` of all rows; there are at
most ``SHARES`` such keys whatever the table's size, so their list is bounded
without a cut. ``salted_join`` spreads a hot key's rows over as many salts as it
holds shares (a third of all rows: ``SHARES`` / 3 salts) and repeats only the hot
keys' rows of the small side. Cold keys join as usual (salt 0); the join stays
exact. Aggregations after the join should be partial (map-side) first, which
Spark does for built-in aggregates.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.session import cut_lineage

SALT = "__salt"


SHARES = 1024


def hot_keys(df: DataFrame, key: str, sample_fraction: float = 0.02, shares: int = SHARES, seed: int = 17) -> dict:
    """Hot key -> number of salts, from the key column of a Bernoulli sample (a pruned scan)."""
    counts = df.select(key).sample(fraction=sample_fraction, seed=seed).groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    least = max(2, math.ceil(total / shares))  # one sampled row says nothing
    rows = counts.filter(F.col("count") >= least).filter(F.col(key).isNotNull()).collect()
    return {r[0]: max(1, math.ceil(r[1] * shares / total)) for r in rows}


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner", salt_buckets: int = 16,
                hot: dict | list | None = None, **hot_kw) -> DataFrame:
    """Join ``big`` and ``small`` on ``key``, splitting hot keys over salts.

    ``hot`` may be given (key -> salts, or keys that get ``salt_buckets`` each);
    otherwise it is estimated with :func:`hot_keys`. With no hot key this is a
    plain join. Rows are dealt to salts by their place in their partition, so
    equal rows of a hot key part too; the dealt rows are written first, since a
    task that runs again may see its rows in another order.
    """
    if hot is None:
        hot = hot_keys(big, key, **hot_kw)
    if not isinstance(hot, dict):
        hot = dict.fromkeys(hot, salt_buckets)
    hot = {k: n for k, n in hot.items() if n > 1}
    if not hot:
        return big.join(small, key, how)
    salts = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    n = F.coalesce(salts[F.col(key)], F.lit(1))
    b = cut_lineage(big.withColumn(SALT, F.pmod(F.monotonically_increasing_id(), n).cast("int")), "salted")
    s = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), n - 1)))
    return b.join(s, [key, SALT], how).drop(SALT)
