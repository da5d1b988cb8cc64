"""Cases that once went wrong: null and empty groups, ties, constant columns, repeated keys, orders, caps."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.operators import clean as CL
from tenderlens.operators import ecdf as E
from tenderlens.operators import encode as EN
from tenderlens.operators import model as MD
from tenderlens.operators.skew import hot_keys, salted_join
from tenderlens.plans import model as PM
from tenderlens.plans import preprocess as PP
from tenderlens.roles import ColumnRoles
from tenderlens.session import checkpoint_dir
from tenderlens.sources import files as FI
from tenderlens.sources import store as ST
from tenderlens.streaming.upsert import drop_folded, latest_snapshot, upsert_batch_writer


def grouped(spark):
    rows = [("a", float(i)) for i in range(7)] + [(None, 5.0), (None, 6.0), ("nulls", None), ("nan", float("nan")), ("one", 3.0)]
    return spark.createDataFrame(rows, "g string, x double")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1001])
def test_quantiles_are_exact(spark, n):
    values = np.random.default_rng(n).normal(0, 1, n).round(2)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = {r["p"]: r["value"] for r in E.exact_quantiles(df, "x", probs).collect()}
    assert all(math.isclose(got[p], np.quantile(values, p), abs_tol=1e-12) for p in probs)


def test_groups_without_values_and_the_null_group(spark):
    df = grouped(spark)
    got = {r["g"]: r["value"] for r in E.exact_quantiles(df, "x", [0.5], ["g"]).collect()}
    assert got == {"a": 3.0, None: 5.5, "nulls": None, "nan": None, "one": 3.0}
    stats = {r["g"]: (r["n"], r["median"]) for r in E.basic_stats(df, "x", ["g"]).collect()}
    assert stats[None] == (2, 5.5) and stats["nulls"] == (0, None)
    assert {r["g"]: r["probability"] for r in E.prob_between(df, "x", 0, 3, ["g"]).collect()}["nulls"] is None
    assert {r["g"]: r["percentile_rank"] for r in E.percentile_rank_of(df, "x", 3.0, ["g"]).collect()}["nulls"] is None
    table = E.ecdf_table(df, "x", ["g"], bucket_rows=2).collect()
    assert {(r["g"], r["value"]): (r["cum_le"], r["n"]) for r in table}[(None, 6.0)] == (2, 2)
    assert {r["value"]: r["cum_lt"] for r in table if r["g"] == "a"} == {float(i): i for i in range(7)}


def test_large_tie_and_no_variance(spark):
    tie = spark.range(3_000_000).select(F.lit(1.0).alias("x"))
    other = spark.createDataFrame([(0.0,), (1.0,), (2.0,)], "x double")
    r = E.compare_samples(tie, other, "x")
    assert r["tie_term"] > 2.6e19 and 0 <= r["mw_p"] <= 1
    flat = E.compare_samples(tie, spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x")
    assert flat["welch_p"] is None and flat["ks_d"] == 0.0


def test_density_of_constant_column_and_mass(spark):
    flat = E.density_grid(spark.createDataFrame([(2.0,)] * 5, "x double"), "x", grid=5).collect()
    assert len(flat) == 5 and all(r["density"] is None for r in flat)
    values = np.concatenate([np.random.default_rng(1).normal(0, 1, 400), [40.0]])
    rows = E.density_grid(spark.createDataFrame([(float(v),) for v in values], "x double"), "x").orderBy("point").collect()
    x, d = np.array([r["x"] for r in rows]), np.array([r["density"] for r in rows])
    bw = values.std(ddof=1) * len(values) ** -0.2
    want = np.exp(-0.5 * ((x[:, None] - values) / bw) ** 2).sum(axis=1) / (len(values) * bw * math.sqrt(2 * math.pi))
    assert np.allclose(d, want, atol=2e-4 * want.max())


def test_median_fill_keeps_integer_columns(spark):
    big = 2 ** 60 + 1
    df = spark.createDataFrame([(big, 1.0, 1), (2, None, None), (3, 3.0, 4)], "key long, x double, n int")
    out = CL.fill_median(df, ["key", "x", "n"])
    assert dict(out.dtypes)["key"] == "bigint"
    assert sorted(tuple(r) for r in out.collect()) == [(2, 2.0, 2.5), (3, 3.0, 4.0), (big, 1.0, 1.0)]


def test_keep_first_and_upsert_need_an_order(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        CL.dedupe_keep_first(df, ["k"], ["k"])
    with pytest.raises(ValueError):
        ST.upsert_by_key(df, df, ["k"], None)


def test_stream_appends_changes_and_folds(spark, tmp_path):
    write = upsert_batch_writer(str(tmp_path), ["k"], "seq", fold_every=3)
    write(spark.createDataFrame([(i, 0, i) for i in range(200)], "k int, seq int, v int"), 0)
    write(spark.createDataFrame([(7, 1, -7), (7, 2, -8), (500, 3, 500)], "k int, seq int, v int"), 1)
    got = {r["k"]: r["v"] for r in latest_snapshot(spark, str(tmp_path), ["k"]).collect()}
    assert got == {**{i: i for i in range(200)}, 7: -8, 500: 500}
    # a batch writes its own keys only; a retried epoch changes nothing
    assert spark.read.parquet(f"{tmp_path}/v=000000002").count() == 2
    write(spark.createDataFrame([(7, 1, -7), (7, 2, -8), (500, 3, 500)], "k int, seq int, v int"), 1)
    # an epoch with another column keeps the others' values, and the third one folds
    write(spark.createDataFrame([(7, 1, "x"), (None, 2, "y")], "k int, seq int, w string"), 2)
    write(spark.createDataFrame([(8, 1, None), (None, 1, 5)], "k int, seq int, v int"), 3)
    assert spark.read.parquet(f"{tmp_path}/base=000000003").count() == 202
    got = {r["k"]: (r["v"], r["w"]) for r in latest_snapshot(spark, str(tmp_path), ["k"]).collect()}
    assert got[7] == (-8, "x") and got[8] == (None, None) and got[None] == (5, "y") and got[9] == (9, None) and len(got) == 202
    assert {r["k"]: r["v"] for r in latest_snapshot(spark, str(tmp_path), ["k"], 1).collect()} == {i: i for i in range(200)}
    for epoch in range(4, 9):
        write(spark.createDataFrame([(epoch, 1, -epoch)], "k int, seq int, v int"), epoch)
    drop_folded(spark, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["base=000000006", "base=000000009", "v=000000007", "v=000000008", "v=000000009"]
    got = {r["k"]: r["v"] for r in latest_snapshot(spark, str(tmp_path), ["k"]).collect()}
    assert len(got) == 202 and got[8] == -8 and got[7] == -7 and got[500] == 500


def test_upsert_null_orders_and_keys(spark):
    target = spark.createDataFrame([(1, "old", "t"), (2, "old", "t"), (None, "old", "t")], "k int, a string, only string")
    source = spark.createDataFrame([(1, "new", None), (2, "none", None), (2, "first", 1), (3, "x", None), (None, "nk", 4), (None, "nk0", 3)],
                                   "k int, a string, seq int")
    got = sorted(map(str, (tuple(r) for r in ST.upsert_by_key(target, source, ["k"], "seq").collect())))
    assert got == sorted(map(str, [(1, "new", "t"), (2, "first", "t"), (3, "x", None), (None, "nk", "t")]))


def test_empty_string_is_a_class_and_many_classes_get_codes(spark):
    df = spark.createDataFrame([("b",), ("",), (None,), ("a",)], "c string")
    got = {r["c"]: r["c_code"] for r in EN.label_encode(df, "c").collect()}
    assert got == {"": 0, "a": 1, "b": 2, None: -1}
    many = spark.range(5000).select(F.format_string("%05d", "id").alias("c"))
    codes = EN.label_encode(many, "c").collect()
    assert all(int(r["c"]) == r["c_code"] for r in codes)


def test_hot_key_parts_and_joins_exactly(spark):
    big = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id").cast("int") + 10)
                                     .alias("k"), F.lit(7).alias("v"))
    hot = hot_keys(big, "k", sample_fraction=0.2, shares=64)
    assert set(hot) == {1} and 15 <= hot[1] <= 30
    small = spark.createDataFrame([(1, "hot"), (11, "cold")], "k int, s string")
    got = salted_join(big, small, "k", hot=hot).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in got} == {"hot": 10_000, "cold": 1}


def bids(spark):
    rows = [(n % 4, i, 100.0 + i * 7, 90.0 + i * 3, 95.0 + i, f"notice text number {i % 6} of several words", "ab"[i % 2])
            for i, n in enumerate(range(60))]
    return spark.createDataFrame(rows, "notice_no long, line int, `기초금액` double, `예정금액` double, `투찰가` double, title string, flag string")


def test_preprocess_keeps_one_row_per_row(spark):
    roles = ColumnRoles(key="notice_no", essential=("notice_no",), target=("투찰가",))
    for advanced in (False, True):
        out = PP.run(bids(spark), "bid_data_x", roles, advanced=advanced)
        assert out.count() == 60 and dict(out.dtypes)["notice_no"] == "bigint"
        assert not [c for c in out.columns if c.startswith("__")]
    assert {"PCA_1", "TFIDF_title_notice"} <= set(out.columns) or any(c.startswith("PCA") for c in out.columns)
    assert any(c.startswith("TFIDF_title") for c in out.columns) and any(c.startswith("selected_") for c in out.columns)
    r = out.orderBy("예정가비율").first()
    assert 0.4 < r["예정가비율"] < 0.95 and r["투찰가_예정금액비율"] == r["낙찰가격비율"]  # of unscaled amounts


def test_preprocess_roles(spark):
    roles = ColumnRoles(key="notice_no", essential=("notice_no",), scale=("line",), categorical=("flag",), text=("title",))
    out = PP.run(bids(spark), "bid_data_x", roles)
    assert out.agg(F.max("line")).first()[0] == 1.0 and out.agg(F.max("기초금액")).first()[0] > 100
    assert {"flag_a", "flag_b"} <= set(out.columns)
    assert PP.roles_for("notice_2024.csv", {"bid_*": roles}, by_type={"notice": roles}) is roles


def test_json_lines_and_rejected_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    assert FI.scan_json(spark, str(tmp_path / "*.json")).count() == 2
    (tmp_path / "good.csv").write_text("k\n1\n")
    (tmp_path / "empty.csv").write_text("k\n")
    scanned = FI.scan_csv_glob(spark, str(tmp_path / "*.csv"), "k int")
    left = [os.path.basename(r["path"]) for r in FI.rejected_files(spark, str(tmp_path / "*.csv"), scanned).collect()]
    assert left == ["empty.csv"] and scanned.count() == 1


def test_collections(spark, tmp_path):
    assert [ST.collection_alias(n) for n in ("DataSet_3", "dataset2", "etc", "own")] == [
        "preprocessed_3", "preprocessed_2", "preprocessed_etc", "own"]
    assert ST.collection_alias("3", split="test") == "preprocessed_dataset3_test"
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "k int, seq int, v int")
    paths = ST.save_datasets({"DataSet_3": df}, str(tmp_path), "k", "seq", 1)
    assert [(r["k"], r["v"]) for r in spark.read.parquet(paths["DataSet_3"]).collect()] == [(1, 6)]


def test_prediction_documents_null_for_nan(spark):
    import json
    p = spark.createDataFrame([(1, "010", "010_001", float("nan"), "DataSet_2"), (1, "010", "010_002", 0.5, "DataSet_2")],
                              "k int, prefix string, target string, prediction double, ds string")
    doc = json.loads(ST.prediction_docs(p, "k", F.col("ds")).first()["document"])
    assert doc["predictions"] == {"010_001": None, "010_002": 0.5} and doc["collection_name"] == "preprocessed_2"


def test_model_plan_falls_back_and_names_failures(spark):
    draw = np.random.default_rng(2)
    rows = [(i, "a" if i % 3 else "b", *map(float, x), float(2 * x[0] - x[1] + 1)) for i, x in enumerate(draw.normal(size=(90, 2)))]
    df = spark.createDataFrame(rows, "k int, dataset string, x double, z double, `010_001` double")
    models, predictions, metrics = PM.run(df, "k", ["x", "z"], ["010"], ["a", "b"], ())
    assert {(r["dataset"], round(r["rmse"], 4)) for r in metrics.collect()} == {("a", 0.0), ("b", 0.0)}
    assert PM.serving({"a": models["a"]}, ["a", "b"], ["b", "a"]) == {"a": "a", "b": "a"}
    ids = spark.createDataFrame([(0,), (1,), (500,)], "k int")
    found, failed = PM.predict_ids({"a": models["a"]}, df, ids, "k", ["a", "b"], ["a"])
    assert {r["k"] for r in found.collect()} == {0, 1}
    assert [(r["k"], r["reason"]) for r in failed.collect()] == [(500, "no such notice")]


def test_shared_folder_is_required_off_one_machine(spark):
    class Context:
        master = "spark://somewhere"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_cross_validation_scores_every_target(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(0, 1, 200)
    rows = [(i, float(v), float(2 * v + 1), float(-v), float(draw.normal())) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k long, x double, `010_001` double, `010_002` double, `100_001` double")
    targets = ["010_001", "010_002", "100_001"]
    got = {(r["fold"], r["target"]): r["rmse"] for r in MD.cv_scores(df, "k", ["x"], targets).collect()}
    folds = MD.kfold_assign(df, "k").toPandas()
    assert set(got) == {(f, t) for f in range(5) for t in targets}
    for (f, t), rmse in got.items():
        train, test = folds[folds.fold != f], folds[folds.fold == f]
        slope, base = np.polyfit(train.x, train[t], 1)
        assert math.isclose(rmse, np.sqrt(((test[t] - slope * test.x - base) ** 2).mean()), abs_tol=1e-4)


def test_cross_validation_query_has_every_target(spark):
    from tenderlens.plans.catalog_models import TARGETS
    import __spark_entry__ as entry
    rows = entry.queries()["cv_scores"](spark, "/root/testdata/sf0.001").toPandas()
    assert len(TARGETS) == 180 and set(rows.target) == set(TARGETS)
    assert (rows.groupby("target").fold.nunique() == rows.fold.nunique()).all() and len(rows) == 180 * rows.fold.nunique()


def test_batch_predict_trains_every_dataset(spark, monkeypatch):
    from tenderlens.plans import catalog_models as CM
    import __spark_entry__ as entry
    seen = {}

    def train(df, key, datasets, *more, kept=PM.train):
        seen["there"] = {r["dataset"] for r in df.select("dataset").distinct().collect()}
        seen["models"] = kept(df, key, datasets, *more)
        return seen["models"]

    monkeypatch.setattr(PM, "train", train)
    assert entry.queries()["batch_predict"](spark, "/root/testdata/sf0.001").limit(1).collect()
    assert "others" in seen["there"] and set(seen["models"]) == seen["there"] <= set(CM.DATASETS)


def test_dataset_without_training_rows_is_served_by_the_first_of_the_list(spark):
    rows = [(i, "a" if i % 2 else "b", float(i), float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows + [(99, "c", 7.0, 0.0)], "k long, dataset string, x double, `010_001` double")
    models = PM.train(df.filter("dataset <> 'c'"), "k", ["a", "b", "c"], ["x"], ["010_001"])
    found, failed = PM.predict_ids(models, df, df.select("k"), "k", ["a", "b", "c"], ["b", "a"])
    assert set(models) == {"a", "b"} and failed.count() == 0
    by_key = {r["k"]: r for r in found.collect()}
    assert by_key[99]["dataset"] == "c" and math.isclose(by_key[99]["p"], 0.0, abs_tol=1e-4)  # by b's model
    assert math.isclose(by_key[7]["p"], 1.0, abs_tol=1e-4)
