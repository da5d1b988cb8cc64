import random

from pyspark.sql import functions as F

from tenderlens.operators import ecdf as E
from tenderlens.operators import metrics as M
from tenderlens.operators.skew import salted_join


def nums(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


def test_prob_and_rank_fixture(spark):
    d = nums(spark, [1, 2, 2, 3, 5])
    assert E.prob_between(d, "x", 3, 2).first()[0] == 0.6
    assert E.percentile_rank_of(d, "x", 2).first()[0] == 20.0


def test_histogram_fixture(spark):
    h = E.histogram(nums(spark, [0, 1, 2, 3, 4, 4]), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 1, 1, 3]
    assert [r["lower"] for r in h] == [0.0, 1.0, 2.0, 3.0] and h[-1]["upper"] == 4.0


def test_ecdf_matches_brute_force(spark):
    rnd = random.Random(5)
    vals = [rnd.choice([0.5, 1.0, 1.5]) if rnd.random() < 0.3 else round(rnd.gauss(0, 1), 3) for _ in range(3000)]
    t = E.ecdf_table(nums(spark, vals), "x", bucket_rows=16).collect()
    for r in t:
        assert r["cum_le"] == sum(1 for v in vals if v <= r["value"])
        assert r["cum_lt"] == sum(1 for v in vals if v < r["value"])
    assert len(t) == len(set(vals))


def test_symmetric_bounds_reaches_p(spark):
    vals = list(range(-50, 51))
    r = E.symmetric_bounds(nums(spark, vals), "x", 0.5, 0.0).first()
    assert r["probability"] >= 0.5 and r["upper"] == -r["lower"]
    assert sum(1 for v in vals if abs(v) < r["upper"]) / len(vals) < 0.5


def test_compare_statistics_simple(spark):
    a, b = nums(spark, [1, 2, 3]), nums(spark, [4, 5, 6])
    r = E.compare_samples(a, b, "x")
    assert r["ks_d"] == 1.0 and r["mw_u"] == 0.0 and r["welch_t"] < 0


def test_regression_metrics_fixture(spark):
    d = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 2.0), (4.0, 6.0)], "y double, p double")
    r = M.regression_metrics(d).first()
    assert round(r["rmse"], 6) == 1.118034 and r["mae"] == 0.75 and r["r2"] == 0.0
    assert round(r["explained_variance"], 6) == 0.05 and r["median_ae"] == 0.5


def test_salted_join_equals_plain_join(spark):
    big = spark.createDataFrame([(1 if i % 3 else 2, i) for i in range(600)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, s string")
    plain = sorted(tuple(r) for r in big.join(small, "k").collect())
    salted = sorted(tuple(r) for r in salted_join(big, small, "k", hot=[1], salt_buckets=8).select("k", "v", "s").collect())
    assert plain == salted


def test_exact_quantiles_distributed_match_numpy(spark):
    import numpy as np
    rnd = random.Random(11)
    vals = [rnd.choice([2.0, 3.0]) if rnd.random() < 0.4 else round(rnd.gauss(0, 5), 2) for _ in range(2001)]
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
    got = {r["p"]: r["value"] for r in E.exact_quantiles(nums(spark, vals), "x", probs).collect()}
    for p in probs:
        assert abs(got[p] - float(np.quantile(vals, p))) < 1e-9, p
    grouped = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, x double")
    out = {r["g"]: r["value"] for r in E.value_at_percentile(grouped, "x", 50, ["g"]).collect()}
    for g in range(3):
        assert abs(out[g] - float(np.quantile([v for i, v in enumerate(vals) if i % 3 == g], 0.5))) < 1e-9
