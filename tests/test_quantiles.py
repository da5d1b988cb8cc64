"""Exact quantiles of columns by narrowing brackets, against numpy."""

import numpy as np
import pytest

from tenderlens.operators import ecdf as EC

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("accuracy,limit", [(None, None), (50, 20), (10, 1), (1000, 5)])
def test_columns_are_numpy(spark, accuracy, limit):
    """Coarse sketches and small limits force many rounds; ties, a heavy value, nulls, NaN, one value, none."""
    rng = np.random.default_rng(4)
    n = 4_000
    cols = {"normal": rng.normal(size=n) * 1e6, "ties": rng.integers(0, 5, n) / 4, "heavy": np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 20),
            "same": np.full(n, 3.25), "few": np.where(np.arange(n) < 3, np.arange(n), np.nan), "none": np.full(n, np.nan)}
    rows = [tuple(None if np.isnan(v) and i % 2 else float(v) for v in r) for i, r in enumerate(zip(*cols.values()))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(3)
    got = EC.column_quantiles(df, list(cols), PROBS, accuracy, limit)
    for c, v in cols.items():
        v = v[~np.isnan(v)]
        for p in PROBS:
            assert got[c][p] == (pytest.approx(np.quantile(v, p), rel=1e-12, abs=1e-12) if len(v) else None), (c, p)


def test_no_groups_is_the_same_table(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    assert {r["p"]: r["value"] for r in EC.exact_quantiles(df, "x", [0.5, 0.25, 0.5]).collect()} == {0.5: 2.0, 0.25: 1.5}
    assert EC.exact_quantiles(df.limit(0), "x", [0.5]).collect()[0]["value"] is None
