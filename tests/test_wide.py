"""Position columns (G4 at any width) and the linear models on them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlens.operators import encode as EN
from tenderlens.operators import model as MD
from tenderlens.operators import wide as W
from tenderlens.session import cut_lineage


def rows_of(n, agencies, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        marks = "/".join(f"m{m}" for m in rng.choice(7, rng.integers(0, 4), replace=False))
        a = i if i < agencies else int(rng.integers(agencies) if rng.random() > 0.3 else 0)
        x = float(rng.normal())
        y = x + (a % 5) + len(marks) + float(rng.normal()) * 0.1
        out.append((i, f"a{a:05d}", marks or None, None if i % 50 == 7 else x, y, None if i == 3 else 2 * x - a % 3))
    return out


def table(spark, n, agencies):
    df = spark.createDataFrame(rows_of(n, agencies), "k long, agency string, mark string, x double, y1 double, y2 double")
    for c in ("agency", "mark"):
        df = EN.multi_hot_positions(df, c)
    return cut_lineage(df.repartition(4), "wide_test"), ["x", "agency_hot", "mark_hot"]


def dense_of(rows, names):
    x = np.zeros((len(rows), len(names)))
    for r, row in enumerate(rows):
        for c, n in enumerate(names):
            x[r, c] = (row["x"] or 0.0) if n == "x" else float(int(n[:-1].split("[")[1]) in row[n.split("[")[0]])
    return x


def ridge_of(x, y, penalty=1e-6):
    mx, my = x.mean(axis=0), y.mean(axis=0)
    b = np.linalg.solve((x - mx).T @ (x - mx) / len(x) + penalty * np.eye(x.shape[1]), (x - mx).T @ (y - my) / len(x))
    return b, my - mx @ b


def test_positions_and_schema(spark):
    df = spark.createDataFrame([(1, "b/a"), (2, None), (3, ""), (4, "/c//c/"), (5, "b/a")], "k int, c string")
    out = EN.multi_hot_positions(df, "c")
    assert {r["k"]: r["c_hot"] for r in out.collect()} == {1: [0, 1], 2: [], 3: [], 4: [2], 5: [0, 1]}
    assert out.columns == ["k", "c", "c_hot"] and out.schema["c_hot"].metadata["categories"] == 3
    many = EN.multi_hot_positions(spark.range(5000).select("id", F.format_string("g%05d", "id").alias("c")), "c")
    assert many.select("c_hot").schema["c_hot"].dataType == out.schema["c_hot"].dataType
    assert many.where("size(c_hot) <> 1 OR c_hot[0] <> id").isEmpty()
    unseen = EN.multi_hot_positions(spark.createDataFrame([(1, "a/zz")], "k int, c string"), "c", index=EN.hot_index(df, "c"))
    assert unseen.first()["c_hot"] == [0] and unseen.schema["c_hot"].metadata["categories"] == 3
    empty = EN.multi_hot_positions(df.limit(0), "c")
    assert empty.count() == 0 and empty.schema["c_hot"].metadata["categories"] == 0


def test_too_many_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="multi_hot_positions"):
        EN.multi_hot(spark.range(1100).select(F.format_string("g%d", "id").alias("c")), "c")


def test_linear_fit_equals_dense_solution(spark):
    df, feats = table(spark, 400, 30)
    m = MD.fit_linear_multi(df, feats, ["y1", "y2"])
    rows = df.where("y1 IS NOT NULL AND y2 IS NOT NULL").collect()
    assert len(rows) == 399 and len(m["features"]) == 1 + 30 + 7
    x, y = dense_of(rows, m["features"]), np.array([(r["y1"], r["y2"]) for r in rows])
    b, first = ridge_of(x, y)
    got = {r["k"]: (r["y1"], r["y2"]) for r in MD.predict_linear(df.select("k", *feats), "k", m).collect()}
    assert len(got) == 400
    assert np.allclose([got[r["k"]] for r in rows], x @ b + first, atol=1e-7)
    # the penalty picks one of the many solutions: the coefficients agree too
    assert np.allclose(m["coef"], b, atol=1e-4)


def test_gradients_and_direct_solution_agree(spark):
    df, feats = table(spark, 400, 30)
    _, parts = W.products(df, feats, ["y1", "y2"])
    a, b = W.ridge(parts[0], 1e-3), W.ridge(parts[0], 1e-3, direct=0)
    assert np.allclose(a, b, atol=1e-6)


def test_cross_validation_equals_refits(spark):
    df, feats = table(spark, 400, 30)
    got = {(r["fold"], r["target"]): r["rmse"] for r in MD.cv_scores(df, "k", feats, ["y1", "y2"], k=3, ridge=1e-3).collect()}
    rows = MD.kfold_assign(df, "k", 3).where("y2 IS NOT NULL").collect()
    names = W.layout_of(df, feats).names
    x, y, fold = dense_of(rows, names), np.array([(r["y1"], r["y2"]) for r in rows]), np.array([r["fold"] for r in rows])
    assert len(got) == 6
    for f in range(3):
        b, first = ridge_of(x[fold != f], y[fold != f], 1e-3)
        rmse = np.sqrt(((y[fold == f] - x[fold == f] @ b - first) ** 2).mean(axis=0))
        assert np.allclose([got[f, "y1"], got[f, "y2"]], rmse, atol=1e-6)


def test_saved_wide_model_scores_alike(spark, tmp_path):
    df, feats = table(spark, 200, 20)
    m = MD.fit_linear_multi(df, feats, ["y1", "y2"])
    MD.save_linear(spark, m, str(tmp_path / "m"), "d", "y")
    again = MD.load_linear(spark, str(tmp_path / "m"))
    a, b = (sorted(map(tuple, MD.predict_linear(df, "k", x).collect())) for x in (m, again))
    assert np.allclose(a, b)


def test_five_thousand_agencies(spark):
    df, feats = table(spark, 6000, 5000)
    m = MD.fit_linear_multi(df, feats, ["y1", "y2"])
    assert m["coef"].shape == (5008, 2)
    assert MD.predict_linear(df, "k", m).count() == 6000
    rows = df.where("y2 IS NOT NULL").collect()
    got = {r["k"]: (r["y1"], r["y2"]) for r in MD.predict_linear(df, "k", m).collect()}
    left = np.array([(r["y1"] - got[r["k"]][0], r["y2"] - got[r["k"]][1]) for r in rows])
    x = dense_of(rows, ["x"])
    sums = {"x": (x - x.mean()).T @ left / len(rows)}
    for row, e in zip(rows, left / len(rows)):
        for n in [f"{c}[{i}]" for c in feats[1:] for i in row[c]]:
            sums[n] = sums.get(n, 0) + e
    # the equations of the fit: residuals add up to zero, and along each feature to the penalty's share
    assert np.allclose(left.mean(axis=0), 0, atol=1e-8)
    assert np.allclose([np.ravel(sums.get(n, (0, 0))) for n in m["features"]], 1e-6 * m["coef"], atol=1e-8)


def test_transform_at_any_width(spark):
    from tenderlens.plans import tender as TP
    from tenderlens.roles import TenderColumns
    from tenderlens.sources import views as V
    C = TenderColumns()
    n, b = V.notices(spark, "/root/testdata/sf0.001"), V.bids(spark, "/root/testdata/sf0.001")
    named = n.withColumn(C.agency, F.concat(F.lit("g"), F.col(C.key).cast("string")))
    few, many = (TP.transform(x, b, form="positions") for x in (n, named))
    assert few.dtypes == many.dtypes
    widths = {c: many.schema[c].metadata["categories"] for c in many.columns if c.endswith("_hot")}
    assert widths[f"{C.agency}_hot"] == many.count() > 1000
    columns = TP.transform(n, b)
    marks = EN.categories_of(n, C.mark)
    want = {r[0]: [i for i, v in enumerate(marks) if r[f"{C.mark}_{v}"]] for r in columns.select(C.key, *[f"{C.mark}_{v}" for v in marks]).collect()}
    assert {r[0]: r[1] for r in few.select(C.key, f"{C.mark}_hot").collect()} == want
