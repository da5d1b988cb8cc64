"""The linear fit of plain columns is one pass of sums: no rows are assembled and kept for a second pass."""

import numpy as np
import pytest
from pyspark.sql import DataFrame

from tenderlens.operators import model as MD


def test_fit_keeps_no_rows(spark, monkeypatch):
    def kept(self, *a):
        raise AssertionError("rows were kept")

    monkeypatch.setattr(DataFrame, "persist", kept)
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(90, 3)) + 1e4, rng.normal(size=(90, 2))
    x[:, 2] = 5.0
    rows = [(*x[i].tolist(), *y[i].tolist()) for i in range(90)]
    rows[1] = (None, float("nan"), *rows[1][2:])
    x[1, :2] = 0
    rows += [(1.0, 1.0, 1.0, None, 1.0), (1.0, 1.0, 1.0, 1.0, float("nan"))]
    df = spark.createDataFrame(rows, "a double, b double, same double, t1 double, t2 double").repartition(3)
    m = MD.fit_linear_multi(df, ["a", "b", "same"], ["t1", "t2"], ridge=1e-6)
    xc, yc = x - x.mean(axis=0), y - y.mean(axis=0)
    coef = np.linalg.solve(xc.T @ xc / 90 + 1e-6 * np.eye(3), xc.T @ yc / 90)
    assert np.allclose(m["coef"], coef, rtol=1e-6, atol=1e-9)
    assert np.allclose(m["intercept"], y.mean(axis=0) - x.mean(axis=0) @ coef, rtol=1e-6, atol=1e-6)
    with pytest.raises(ValueError):
        MD.fit_linear_multi(df.limit(0), ["a"], ["t1"])
