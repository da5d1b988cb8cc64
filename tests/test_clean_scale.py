import math

from pyspark.sql import functions as F

from tenderlens.operators import clean as CL
from tenderlens.operators import encode as EN
from tenderlens.operators import scale as SC
from tenderlens.sources import store as ST


def nums(spark, values):
    return spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate(values)],
                                 "i int, x double")


def test_dedupe_keep_first(spark):
    d = spark.createDataFrame([("k1", 1, "x"), ("k1", 2, "y"), ("k2", 3, "z")], "k string, seq int, v string")
    got = sorted(tuple(r) for r in CL.dedupe_keep_first(d, ["k"], ["seq"]).collect())
    assert got == [("k1", 1, "x"), ("k2", 3, "z")]


def test_cap_outliers_iqr(spark):
    d = CL.cap_outliers_iqr(nums(spark, [1, 2, 3, 4, 100, None]), ["x"]).orderBy("i")
    assert [r["x"] for r in d.collect()] == [1, 2, 3, 4, 7, None]


def test_fill_median_and_mode(spark):
    d = CL.fill_median(nums(spark, [1, None, 3, 10]), ["x"]).orderBy("i")
    assert [r["x"] for r in d.collect()] == [1, 3, 3, 10]
    s = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",)], "c string")
    assert sorted(r[0] for r in CL.fill_mode(s, ["c"]).collect()) == ["a", "a", "a", "b", "b"]


def test_standardize_population(spark):
    got = [r["x"] for r in SC.standardize(nums(spark, [1, 2, 4]), ["x"]).orderBy("i").collect()]
    assert [round(v, 6) for v in got] == [-1.069045, -0.267261, 1.336306]


def test_minmax_constant_is_zero(spark):
    d = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    out = SC.minmax_scale(d, ["a", "b"]).collect()
    assert [round(r["a"], 6) for r in out] == [0.0, 0.333333, 1.0] and [r["b"] for r in out] == [0.0, 0.0, 0.0]


def test_log1p_shifted(spark):
    got = [r["norm_log_x"] for r in SC.log1p_shifted(nums(spark, [-1, 0, 3]), ["x"]).orderBy("i").collect()]
    assert [round(v, 6) for v in got] == [0.693147, 1.098612, 1.791759]


def test_multi_hot(spark):
    d = spark.createDataFrame([(1, "서울/경기"), (2, "경기"), (3, ""), (4, "부산//서울")], "k int, c string")
    out = EN.multi_hot(d, "c").orderBy("k").collect()
    assert [(r["c_경기"], r["c_부산"], r["c_서울"]) for r in out] == [(1, 0, 1), (1, 0, 0), (0, 0, 0), (0, 1, 1)]


def test_label_encode_shared_index(spark):
    tr = spark.createDataFrame([("b",), ("a",)], "c string")
    te = spark.createDataFrame([("a",), ("z",)], "c string")
    idx = EN.label_index(tr, "c")
    assert [r["c_code"] for r in EN.label_encode(te, "c", idx).orderBy("c").collect()] == [0, -1]


def test_upsert_fixture(spark):
    # FIXTURES 6: last row wins (NULL included), target-only columns kept, new keys inserted
    tgt = spark.createDataFrame([("k1", 1, 2)], "k string, a int, b int")
    src = spark.createDataFrame([("k1", 1, 9), ("k1", 2, None), ("k2", 3, 5)], "k string, seq int, a int")
    out = {r["k"]: (r["a"], r["b"]) for r in ST.upsert_by_key(tgt, src, ["k"], "seq").collect()}
    assert out == {"k1": (None, 2), "k2": (5, None)}
    again = {r["k"]: (r["a"], r["b"]) for r in
             ST.upsert_by_key(ST.upsert_by_key(tgt, src, ["k"], "seq"), src, ["k"], "seq").collect()}
    assert again == out  # idempotent


def test_null_profile(spark):
    d = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert {r[0]: r[1] for r in CL.null_profile(d).collect()} == {"a": 1, "b": 2}


def test_distributed_quantile_methods_equal_exact(spark):
    d = nums(spark, [1, 2, 3, 4, 100, None, 7, 7, 7])
    a = [r["x"] for r in CL.cap_outliers_iqr(d, ["x"]).orderBy("i").collect()]
    b = [r["x"] for r in CL.cap_outliers_iqr(d, ["x"]).orderBy("i").collect()]
    assert a == b
    m1 = [r["x"] for r in CL.fill_median(d, ["x"]).orderBy("i").collect()]
    m2 = [r["x"] for r in CL.fill_median(d, ["x"]).orderBy("i").collect()]
    assert m1 == m2
