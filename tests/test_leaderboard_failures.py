"""A candidate that fails ends a ranking query instead of leaving its rows out."""

import numpy as np
import pytest

from tenderlens.operators import model as MD
from tenderlens.operators import neighbors, trees
from tenderlens.plans import catalog_models as CM


@pytest.fixture()
def small(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, float(rng.normal()), float(rng.normal()), i % 5 == 0) for i in range(200)]
    rows = [(i, x, z, x - z, 2 * z, test) for i, x, z, test in rows]
    d = spark.createDataFrame(rows, f"`{CM.C.key}` long, x double, z double, `010_001` double, `010_002` double, is_test boolean")
    monkeypatch.setattr(CM, "TARGETS", ["010_001", "010_002"])
    monkeypatch.setattr(CM, "_model_data", lambda spark, sf: (d, ["x", "z"]))
    monkeypatch.setattr(CM, "_knn_data", lambda spark, sf: (d, ["x", "z"]))
    return d


def _failing(*args, **kwargs):
    raise ValueError("no memory for this fit")


@pytest.mark.parametrize("query", [CM.leaderboard_q, CM.metrics_fitted_q])
def test_ranking_raises_when_a_candidate_fails(spark, small, monkeypatch, query):
    boosted = trees.fit_boosted
    for fit in ("fit_boosted", "fit_forest"):  # short fits
        monkeypatch.setattr(trees, fit, lambda *a, **k: boosted(*a, rounds=1, depth=1, binning=k.get("binning")))
    found = query(spark, "").select("target", "model").distinct().count()
    assert found == 2 * (5 if query is CM.leaderboard_q else 2)
    monkeypatch.setattr(neighbors, "knn_predict", _failing)
    with pytest.raises(ValueError, match="no memory"):
        query(spark, "")


def test_strict_leaderboard_raises_for_a_fit_cut_short(spark, small):
    part = small.filter("not is_test"), small.filter("is_test"), CM.C.key, ["x", "z"], ["010_001"], ("GBT", "MEAN")
    met, failures = MD.leaderboard(*part, seconds_per_target=0.0)
    assert [r["model"] for r in failures.collect()] == ["GBT"] and met.count() == 2
    with pytest.raises(RuntimeError, match="GBT: stopped after"):
        MD.leaderboard(*part, seconds_per_target=0.0, strict=True)
