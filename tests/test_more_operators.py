import json
import math

from pyspark.sql import functions as F

from tenderlens.operators import text as TX
from tenderlens.operators.combine import pairwise_ratio_diff
from tenderlens.operators.model import hash_split, kfold_assign
from tenderlens.plans import tender as TP
from tenderlens.plans.preprocess import roles_for
from tenderlens.roles import ColumnRoles
from tenderlens.sources import store as ST


def test_roles_for_glob_then_default():
    bid, notice, dflt = ColumnRoles(key="a"), ColumnRoles(key="b"), ColumnRoles(key="c")
    cfg = {"bid_data_*.csv": bid, "notice_data_*.csv": notice}
    assert roles_for("bid_data_2024.csv", cfg) is bid
    assert roles_for("notice_data_x.csv", cfg, dflt) is notice
    assert roles_for("other.csv", cfg, dflt) is dflt


def test_lookup_priority_first_hit(spark):
    a = spark.createDataFrame([(1, "a1"), (2, "a2")], "k int, v string")
    b = spark.createDataFrame([(2, "b2"), (3, "b3")], "k int, v string")
    ids = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    out = {r["k"]: (r["collection"], r["v"]) for r in ST.lookup_notice({"A": a, "B": b}, "k", ids, ["A", "B"]).collect()}
    assert out == {2: ("A", "a2"), 3: ("B", "b3")}


def test_pairwise_names_after_second_underscore(spark):
    d = spark.createDataFrame([(4.0, 2.0, 0.0)], "norm_log_x double, norm_log_y double, norm_log_z double")
    r = pairwise_ratio_diff(d).first().asDict()
    assert r["ratio_x_y"] == 2.0 and r["diff_x_y"] == 2.0 and r["ratio_y_z"] == 0.0


def test_group_to_list_keeps_order_and_drops_nulls(spark):
    d = spark.createDataFrame([("k", 3, 0.3), ("k", 1, 0.1), ("k", 2, None), (None, 0, 9.0)], "k string, s int, v double")
    out = TP.group_to_list(d, "k", "v", ["s"]).collect()
    assert [(r["k"], r["v"]) for r in out] == [("k", [0.1, 0.3])]


def test_hash_split_stable_and_sized(spark):
    d = spark.range(5000).withColumnRenamed("id", "k")
    a = {r["k"]: r["is_test"] for r in hash_split(d, "k").collect()}
    b = {r["k"]: r["is_test"] for r in hash_split(d.orderBy(F.desc("k")), "k").collect()}
    assert a == b and 0.17 < sum(a.values()) / len(a) < 0.23
    folds = {r["fold"] for r in kfold_assign(d, "k", 5).collect()}
    assert folds == {0, 1, 2, 3, 4}


def test_prediction_docs_shape(spark):
    p = spark.createDataFrame([(7, "010", "010_001", 0.25), (7, "010", "010_002", 0.75)],
                              "k long, prefix string, target string, prediction double")
    doc = json.loads(ST.prediction_docs(p, "k", "DataSet_3").first()["document"])
    assert doc["notice_id"] == "7" and doc["collection_name"] == "preprocessed_3"
    assert doc["predictions"] == {"010_001": 0.25, "010_002": 0.75} and doc["metadata"]["n_bins"] == "2"


def test_tfidf_matches_hand_computation(spark):
    texts = ["red apple red", "green apple", "red pear"] * 12  # 36 rows, > 100 characters
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    out = {(r["id"], r["term"]): r["tfidf"] for r in TX.tfidf_long(d, "id", "text", max_features=3).collect()}
    # vocabulary by corpus frequency: red (36), apple (24), then ties at 12 broken by term
    terms = sorted({t for _, t in out})
    assert terms == ["apple", "apple red", "red"]
    n = 36
    idf = {"red": math.log((1 + n) / (1 + 24)) + 1, "apple": math.log((1 + n) / (1 + 24)) + 1,
           "apple red": math.log((1 + n) / (1 + 12)) + 1}
    w = {"red": 2 * idf["red"], "apple": idf["apple"], "apple red": idf["apple red"]}
    norm = math.sqrt(sum(v * v for v in w.values()))
    for t in terms:
        assert abs(out[(0, t)] - w[t] / norm) < 1e-12
    assert out[(2, "apple")] == 0.0


def test_gramian_and_svd_scores(spark):
    import numpy as np
    from tenderlens.operators.reduce import gramian, svd_reduce
    rng = np.random.default_rng(3)
    X = rng.normal(size=(200, 5))
    X[:, 4] = 1.0  # a constant column
    d = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(X)], "id int, v array<double>")
    assert np.allclose(gramian(d, "v"), X.T @ X, atol=1e-8)
    s = {r["id"]: [r[f"SVD_{j}"] for j in (1, 2)] for r in svd_reduce(d, "id", "v", k=2).collect()}
    _, _, vt = np.linalg.svd(X, full_matrices=False)
    for j in range(2):
        ref = X @ vt[j]
        if vt[j][abs(vt[j]).argmax()] < 0:  # same sign rule as the operator
            ref = -ref
        got = np.array([s[i][j] for i in range(200)])
        assert np.allclose(got, ref, atol=1e-6)
