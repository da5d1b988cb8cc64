"""Numeric PCA beside a row's own columns, and rounding without decimals."""

import math

import numpy as np
import pytest

from tenderlens.operators import reduce as RD
from tenderlens.plans import preprocess as PP
from tenderlens.plans.catalog import round_doubles
from tenderlens.roles import ColumnRoles


def _rows():
    draw = np.random.default_rng(7)
    rows = [[float(v) for v in draw.normal(0, 1 + i % 3, 6)] for i in range(60)]
    for i, r in enumerate(rows):
        r[3], r[4] = r[0] * 2 + r[1], 5.0
        if i % 9 == 0:
            r[2] = None
    return rows


def test_pca_numeric_equals_numpy(spark):
    rows = _rows()
    df = spark.createDataFrame([(i % 50, *r) for i, r in enumerate(rows)], "k long, a double, b double, c double, d double, e double, f double")
    x = np.array([[0.0 if v is None else v for v in r] for r in rows])
    span = x.max(axis=0) - x.min(axis=0)
    x = np.where(span == 0, 0, (x - x.min(axis=0)) / np.where(span == 0, 1, span))
    x -= x.mean(axis=0)
    _, v = np.linalg.eigh(np.cov(x.T))
    v = v[:, ::-1][:, :3]
    v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(3)])
    got = RD.pca_numeric(df, "k", list("abcdef"), k=3)
    assert got.columns == ["k", "PCA_1", "PCA_2", "PCA_3"]
    got = sorted([r["PCA_1"], r["PCA_2"], r["PCA_3"]] for r in got.collect())
    assert np.allclose(got, sorted((x @ v).tolist()), atol=1e-9)


def test_advanced_plan_does_not_join_its_rows_with_their_scores(spark):
    df = spark.createDataFrame([(i % 50, *r) for i, r in enumerate(_rows())], "k long, a double, b double, c double, d double, e double, f double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a table that is rated large
    try:
        out = PP.run(df, "d", ColumnRoles(key="k", dedupe_key=None, essential=("k",), required=("k",), target=("a",)), advanced=True)
        assert {"PCA_1", "PCA_2", "PCA_3"} <= set(out.columns) and out.count() == 60
        assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rounding_halves_go_away_from_zero(spark):
    values = [0.5, 1.5, 2.5, -0.5, -2.5, 0.49999999999999994, -0.3, 4503599627370497.5, 1e300, float("inf"), float("-inf"), float("nan"), None,
              1e6 + 0.5, 123.4567895]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    want = {r["i"]: r["w"] for r in df.selectExpr("i", "round(v * 1.0D, 0) / 1.0D + 0.0D AS w").collect()}
    for r in round_doubles(df, 0).collect():
        w = want[r["i"]]
        assert r["v"] == w or (w is None and r["v"] is None) or (math.isnan(w) and math.isnan(r["v"]))
    assert [r["v"] for r in round_doubles(df, 0).where("i < 5").orderBy("i").collect()] == pytest.approx([1, 2, 3, -1, -3])
