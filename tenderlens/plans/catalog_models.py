"""Queries of the model-table operators.

The model data are the tender plan's per-notice targets (and features), split
80/20 by key hash. Two SQL-expressible candidates (training mean per target,
uniform prior 1/n) and the neighbour regressor feed the oracle-checked metric
queries; linear and tree fits of all targets are checked on rows and by tests.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlens.functions.expr import all_target_names
from tenderlens.operators import metrics as M
from tenderlens.operators import model as MD
from tenderlens.plans import tender as TP
from tenderlens.plans.catalog import q, query, r, round_doubles
from tenderlens.plans.catalog_tender import (BINNED_SQL, KEY, NB_SQL, NORMS, NT_SQL, ORACLE_CATEGORIES, PB_SQL,
                                             TRANSFORM_SQL, _ctx, targets_sql)
from tenderlens.roles import TenderColumns
from tenderlens.sources import views as V

C = TenderColumns()
TARGETS = all_target_names()
SPLIT = "CAST(('0x' || substr(md5(CAST({k} AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 100 < 20"

BASE_SQL = f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
{targets_sql(False).strip()},
yl AS (SELECT {KEY}, target, y, {SPLIT.format(k=KEY)} AS is_test
       FROM (UNPIVOT targets ON COLUMNS(* EXCLUDE ({KEY})) INTO NAME target VALUE y)),
mean_m AS (SELECT target, avg(y) AS p FROM yl WHERE NOT is_test GROUP BY target),
preds AS (SELECT 'MEAN' AS model, yl.target, yl.{KEY}, yl.y, mean_m.p FROM yl JOIN mean_m USING (target) WHERE is_test
          UNION ALL
          SELECT 'PRIOR', target, {KEY}, y, 1.0 / CAST(split_part(target, '_', 1) AS INTEGER) FROM yl WHERE is_test),
met AS (SELECT model, target, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, avg((y - p) * (y - p)) AS mse,
               avg(abs(y - p)) AS mae,
               CASE WHEN var_pop(y) = 0 THEN NULL ELSE 1 - avg((y - p) * (y - p)) / var_pop(y) END AS r2,
               CASE WHEN var_pop(y) = 0 THEN NULL ELSE 1 - var_pop(y - p) / var_pop(y) END AS explained_variance,
               quantile_cont(abs(y - p), 0.5) AS median_ae
        FROM preds GROUP BY model, target)"""

MET_COLS = ["rmse", "mse", "mae", "r2", "explained_variance", "median_ae"]


def _targets(spark, sf):
    n, b = _ctx(spark, sf)
    return TP.calculate_target(TP.clean_notices(n), TP.parsed_bids(b))


def _split_targets(spark, sf):
    """The split target table (written once, several branches read it) and the training means (one row)."""
    from tenderlens.session import cut_lineage
    t = cut_lineage(MD.hash_split(_targets(spark, sf), C.key), "split_targets")
    return t, t.filter(~F.col("is_test")).agg(*[F.avg(F.col(f"`{x}`")).alias(x) for x in TARGETS]).first()


def _constant(test, values):
    """Predictions that are the same for every row."""
    return test.select(C.key, *[F.lit(values[x]).cast("double").alias(x) for x in TARGETS])


def _wide_preds(spark, sf):
    """Test rows, and wide predictions of the MEAN and PRIOR candidates."""
    t, means = _split_targets(spark, sf)
    test = t.filter("is_test")
    return test, {"MEAN": _constant(test, means), "PRIOR": _constant(test, {x: 1.0 / int(x.split("_")[0]) for x in TARGETS})}


def _preds(spark, sf):
    """Long predictions (model, target, key, y, p) of the MEAN candidate."""
    t, means = _split_targets(spark, sf)
    return _long_means(t.filter("is_test"), means)


def _long_means(test, means):
    """A row per test row and target; the means stand beside their targets, so none is looked up by name."""
    pairs = F.array(*[F.struct(F.lit(x).alias("target"), F.col(f"`{x}`").cast("double").alias("y"), F.lit(means[x]).cast("double").alias("p"))
                      for x in TARGETS])
    return test.select(C.key, F.inline(pairs)).select(F.lit("MEAN").alias("model"), "target", C.key, "y", "p")


def _metrics(spark, sf):
    test, predictions = _wide_preds(spark, sf)
    return M.wide_metrics(M.paired(test, predictions, C.key, TARGETS), TARGETS)


def _met_sql(prefix: str = "") -> str:
    return ", ".join(f"{r(prefix + c)} AS {c}" for c in MET_COLS)


@query("hash_split", f"SELECT o_orderkey, {SPLIT.format(k='o_orderkey')} AS is_test FROM orders")
def hash_split_q(spark, sf):
    return MD.hash_split(V.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("kfold_assign", "SELECT o_orderkey, CAST(CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8))"
       " AS BIGINT) % 5 AS INTEGER) AS fold FROM orders")
def kfold_assign_q(spark, sf):
    return MD.kfold_assign(V.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 5)


@query("regression_metrics", BASE_SQL + f"""
SELECT count(*) AS n, {r('sqrt(avg((y - p) * (y - p)))')} AS rmse, {r('avg((y - p) * (y - p))')} AS mse,
       {r('avg(abs(y - p))')} AS mae, {r('1 - avg((y - p) * (y - p)) / var_pop(y)')} AS r2,
       {r('1 - var_pop(y - p) / var_pop(y)')} AS explained_variance, {r('quantile_cont(abs(y - p), 0.5)')} AS median_ae
FROM preds WHERE model = 'MEAN'""")
def regression_metrics_q(spark, sf):
    return round_doubles(M.regression_metrics(_preds(spark, sf)))


@query("metrics_by_model_target", BASE_SQL + f"\nSELECT model, target, n, {_met_sql()} FROM met")
def metrics_by_model_target_q(spark, sf):
    return round_doubles(_metrics(spark, sf))


@query("model_mean_metrics", BASE_SQL + "\nSELECT model, " + ", ".join(
    f"{r(f'avg({c})')} AS mean_{c}" for c in MET_COLS) + ", count(*) AS n_targets FROM met GROUP BY model")
def model_mean_metrics_q(spark, sf):
    return round_doubles(M.model_mean_metrics(_metrics(spark, sf)))


@query("best_model", BASE_SQL + f"""
SELECT target, arg_min(model, (rmse, model)) AS best_model, {r('min(rmse)')} AS best_score FROM met GROUP BY target""")
def best_model_q(spark, sf):
    return round_doubles(M.best_model(_metrics(spark, sf)))


ORD_SQL = ("(CASE split_part(target, '_', 1) WHEN '010' THEN 0 WHEN '020' THEN 10 WHEN '050' THEN 30 ELSE 80 END"
           " + CAST(split_part(target, '_', 2) AS INTEGER))")


@query("metrics_by_target", BASE_SQL + f"""
SELECT target, CAST({ORD_SQL} AS INTEGER) AS target_ordinal, {_met_sql()} FROM met WHERE model = 'MEAN'""")
def metrics_by_target_q(spark, sf):
    m = _metrics(spark, sf).filter(F.col("model") == "MEAN")
    return round_doubles(m.select("target", M.target_ordinal("target").cast("int"), *MET_COLS)
                         .orderBy("target_ordinal"))


@query("target_ordinal", BASE_SQL + f"\nSELECT DISTINCT target, CAST({ORD_SQL} AS INTEGER) AS target_ordinal FROM met")
def target_ordinal_q(spark, sf):
    return _metrics(spark, sf).select("target", M.target_ordinal("target").cast("int")).distinct()


@query("first_n_targets", BASE_SQL + f"""
SELECT split_part(target, '_', 1) AS prefix, target, {r('rmse')} AS rmse FROM met WHERE model = 'MEAN'
QUALIFY row_number() OVER (PARTITION BY split_part(target, '_', 1) ORDER BY {ORD_SQL}) <= 5""")
def first_n_targets_q(spark, sf):
    m = _metrics(spark, sf).filter(F.col("model") == "MEAN").select(
        F.split("target", "_").getItem(0).alias("prefix"), "target", "rmse", M.target_ordinal("target"))
    return round_doubles(M.first_n_per_group(m, "prefix", ["target_ordinal"], 5).drop("target_ordinal"))


@query("predicted_vs_actual", BASE_SQL + f"""
SELECT preds.{KEY}, split_part(target, '_', 1) AS prefix, CAST(split_part(target, '_', 2) AS INTEGER) AS bin,
       {r("nb.lo + CAST(CAST(split_part(target, '_', 2) AS INTEGER) - 1 AS DOUBLE) * ((nb.hi - nb.lo) / CAST(CAST(split_part(target, '_', 1) AS INTEGER) - 1 AS DOUBLE))")} AS x,
       {r('y')} AS y, {r('p')} AS p FROM preds JOIN nb ON preds.{KEY} = nb.{KEY} WHERE model = 'MEAN'""")
def predicted_vs_actual_q(spark, sf):
    """Shares by rate, on the axis of each notice's own price range."""
    nb = TP.notice_bounds(TP.clean_notices(V.notices(spark, sf)))
    p = _preds(spark, sf).join(nb, C.key)
    parts = F.split("target", "_")
    n, i = parts.getItem(0).cast("int"), parts.getItem(1).cast("int")
    return round_doubles(p.select(C.key, parts.getItem(0).alias("prefix"), i.alias("bin"),
                                  M.bin_position(n, i, F.col("__lower"), F.col("__upper")).alias("x"), "y", "p"))


def _residuals_sql() -> str:
    from tenderlens.plans.catalog_dist import hist_ctes, hist_select
    return (BASE_SQL + ",\nres AS (SELECT y - p AS residual FROM preds WHERE model = 'MEAN'),\n"
            + hist_ctes("residual", "res") + "\n" + hist_select())


@query("residuals", _residuals_sql())
def residuals_q(spark, sf):
    from tenderlens.operators.ecdf import histogram
    p = M.residuals(_preds(spark, sf))
    return round_doubles(histogram(p, "residual", 100))


@query("target_feature_split", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
{targets_sql(True).strip()}
SELECT {KEY}, {", ".join(q(t) for t in TARGETS)} FROM targets""")
def target_feature_split_q(spark, sf):
    """B5 for every prefix: the target columns found, side by side."""
    from tenderlens.operators.modeldata import target_feature_split
    t = round_doubles(_targets(spark, sf))
    return t.select(C.key, *[c for p in ("010", "020", "050", "100") for c in target_feature_split(t, p, C.key)[0]])


@query("join_features_targets", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
{targets_sql(True).strip()}
SELECT nt."기초금액" IS NOT NULL AS has_base, nt."예가범위", targets.*
FROM nt JOIN targets ON nt.{KEY} = targets.{KEY}""")
def join_features_targets_q(spark, sf):
    from tenderlens.operators.modeldata import join_features_targets
    n, _ = _ctx(spark, sf)
    feats = TP.clean_notices(n).select(C.key, F.col(C.base).isNotNull().alias("has_base"), C.range_text)
    return round_doubles(join_features_targets(feats, _targets(spark, sf), C.key))


@query("drop_null_targets", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
{targets_sql(True).strip()}
SELECT nt.{KEY}, targets.* EXCLUDE ({KEY}) FROM nt LEFT JOIN targets ON nt.{KEY} = targets.{KEY}
WHERE {" AND ".join(f"targets.{q(t)} IS NOT NULL" for t in TARGETS)}""")
def drop_null_targets_q(spark, sf):
    """B6 on notices with and without bids: those without have NULL targets."""
    from tenderlens.operators.modeldata import drop_null_targets
    from tenderlens.operators.bins import read_shares
    n, b = _ctx(spark, sf)
    from tenderlens.session import cut_lineage
    nt = TP.clean_notices(n)
    j = nt.select(C.key).join(TP.calculate_target(nt, TP.parsed_bids(b), maps=True), C.key, "left")
    # the wide table is written: 180 conditions on columns still to be computed would repeat their expressions
    j = cut_lineage(read_shares(j, [C.key]), "with_null_targets")
    return round_doubles(drop_null_targets(j, TARGETS).select(C.key, *TARGETS))


# ------------------------------------------------------------ Spark ML fits (rows-only checks)
def _model_data(spark, sf, form="columns", indexes=None):
    """The model table (features + 180 targets + split), written once to the
    checkpoint folder: several fits read it. The targets are written as one array
    and read into columns by every pass: tables of over 100 columns are read and
    written value by value. The linear models take the multi-hot cells as
    ``form`` "positions", for any number of categories."""
    d = _split_table(spark, sf, form, indexes)
    return d, [c for c in d.columns if c not in TARGETS and c not in (C.key, C.range_text, "dataset", "is_test")]


def _split_table(spark, sf, form="columns", indexes=None):
    from tenderlens.session import cut_lineage
    n, b = _ctx(spark, sf)
    t = TP.transform(n, b, form=form, indexes=indexes, packed=True)
    return TP.read_targets(cut_lineage(MD.hash_split(t, C.key)))


@query("fit_linear_multi", None)
def fit_linear_multi_q(spark, sf):
    """One pass for all 180 targets -> (target, feature, coef) with the intercept as a feature row."""
    from tenderlens.operators.encode import hot_index
    from tenderlens.session import cut_lineage
    n, b = _ctx(spark, sf)
    known = TP.clean_notices(n).join(b.select(C.key).distinct(), C.key, "left_semi")
    indexes = {c: cut_lineage(hot_index(known, c), "categories") for c in (C.agency, C.region, C.mark)}
    d, feats = _model_data(spark, sf, "positions", indexes)
    m = MD.fit_linear_multi(d.filter(~F.col("is_test")), feats, TARGETS)
    rows = [(t, f, float(m["coef"][i, j])) for j, t in enumerate(TARGETS) for i, f in enumerate(m["features"])]
    rows += [(t, "(intercept)", float(m["intercept"][j])) for j, t in enumerate(TARGETS)]
    coefs = spark.createDataFrame(rows, "target string, feature string, coef double")
    names = reduce(DataFrame.unionByName, [i.select(F.format_string("%s_hot[%d]", F.lit(c), "code").alias("feature"),
                                                    F.concat(F.lit(f"{c}_"), "value").alias("named")) for c, i in indexes.items()])
    return round_doubles(coefs.join(names, "feature", "left").select("target", F.coalesce("named", "feature").alias("feature"), "coef"))


def _fitted_trees(spark, sf, fit, **params):
    d, feats = _model_data(spark, sf)
    return d.filter(F.col("is_test")), fit(d.filter(~F.col("is_test")), C.key, feats, TARGETS, **params)


def _tree_metrics(test, model):
    """Test metrics of every target beside the rounds kept and the validation error."""
    from tenderlens.operators import trees as TR
    met = M.wide_metrics(M.paired(test, {model.name: TR.predict(test, C.key, model)}, C.key, TARGETS), TARGETS)
    kept = test.sparkSession.createDataFrame([(t, n, model.validation.get(t)) for t, n in model.rounds.items()],
                                             "target string, rounds int, validation_rmse double")
    return round_doubles(met.join(kept, "target"))


@query("fit_gbt", None)
def fit_gbt_q(spark, sf):
    """Boosted trees of all 180 targets."""
    from tenderlens.operators.trees import fit_boosted
    return _tree_metrics(*_fitted_trees(spark, sf, fit_boosted))


@query("fit_random_forest", None)
def fit_random_forest_q(spark, sf):
    """A forest of 100 trees for each of the 180 targets."""
    from tenderlens.operators.trees import fit_forest
    return _tree_metrics(*_fitted_trees(spark, sf, fit_forest))


@query("feature_importance", None)
def feature_importance_q(spark, sf):
    """Gain and number of splits per target and feature over the boosted trees of all targets."""
    from tenderlens.operators.trees import fit_boosted, importance
    _, model = _fitted_trees(spark, sf, fit_boosted)
    return round_doubles(spark.createDataFrame(importance(model), "target string, feature string, gain double, splits int"))


FEATURES = [*NORMS.values(), *[f"{c}_{v}" for c, vals in ORACLE_CATEGORIES.items() for v in vals]]  # of the driver tables
KNN_SQL = f"""WITH t AS ({TRANSFORM_SQL}),
s AS (SELECT *, {SPLIT.format(k=KEY)} AS is_test FROM t),
st AS (SELECT {", ".join(f"avg({q(f)}) AS m{i}, stddev_pop({q(f)}) AS s{i}" for i, f in enumerate(FEATURES))} FROM s WHERE NOT is_test),
v AS (SELECT {KEY}, is_test, [{", ".join(f"CASE WHEN s{i} > 0 THEN ({q(f)} - m{i}) / s{i} ELSE 0 END" for i, f in enumerate(FEATURES))}] AS x FROM s, st),
near AS (SELECT {KEY}, unnest(b) AS nb FROM (
         SELECT a.{KEY}, min({{'d': round(list_distance(a.x, b.x) * 1e9) / 1e9, 'k': b.{KEY}}}, 5) AS b
         FROM v AS a JOIN v AS b ON a.is_test AND NOT b.is_test GROUP BY a.{KEY})),
w AS (SELECT {KEY}, nb.k AS n, CASE WHEN min(nb.d) OVER (PARTITION BY {KEY}) = 0 THEN CAST(nb.d = 0 AS DOUBLE) ELSE 1 / nb.d END AS w
      FROM near),
knn AS (SELECT w.{KEY}, {", ".join(f"sum(w * t.{q(x)}) / sum(w) AS {q(x)}" for x in TARGETS)}
        FROM w JOIN t ON t.{KEY} = w.n GROUP BY w.{KEY})"""


def _knn_data(spark, sf):
    """The model table with values of six decimals, so that equal distances are equal in any engine."""
    d = round_doubles(_split_table(spark, sf))
    return d, [c for c in d.columns if c not in TARGETS and c not in (C.key, C.range_text, "dataset", "is_test")]


@query("knn_regressor", KNN_SQL + f"\nSELECT {KEY}, {', '.join(f'{r(q(x))} AS {q(x)}' for x in TARGETS)} FROM knn")
def knn_regressor_q(spark, sf):
    """All 180 targets of the test notices from their 5 nearest training notices on standardised features."""
    from tenderlens.operators.neighbors import knn_predict
    d, feats = _knn_data(spark, sf)
    return round_doubles(knn_predict(d.filter(~F.col("is_test")), d.filter(F.col("is_test")), C.key, feats, TARGETS))


@query("metrics_fitted", KNN_SQL + f""",
yl AS (SELECT {KEY}, target, y, is_test FROM (UNPIVOT (SELECT {KEY}, is_test, {", ".join(q(x) for x in TARGETS)} FROM s)
       ON COLUMNS(* EXCLUDE ({KEY}, is_test)) INTO NAME target VALUE y)),
pl AS (SELECT 'KNN' AS model, {KEY}, target, p FROM (UNPIVOT knn ON COLUMNS(* EXCLUDE ({KEY})) INTO NAME target VALUE p)
       UNION ALL SELECT 'MEAN', {KEY}, target, m FROM yl JOIN (SELECT target, avg(y) AS m FROM yl WHERE NOT is_test GROUP BY target)
       USING (target) WHERE is_test),
preds AS (SELECT model, target, y, p FROM pl JOIN yl USING ({KEY}, target)),
met AS (SELECT model, target, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
               CASE WHEN var_pop(y) = 0 THEN NULL ELSE 1 - avg((y - p) * (y - p)) / var_pop(y) END AS r2,
               CASE WHEN var_pop(y) = 0 THEN NULL ELSE 1 - var_pop(y - p) / var_pop(y) END AS explained_variance,
               quantile_cont(abs(y - p), 0.5) AS median_ae FROM preds GROUP BY model, target)
SELECT model, target, n, {_met_sql()}, arg_min(model, (rmse, model)) OVER (PARTITION BY target) AS best_model FROM met""")
def metrics_fitted_q(spark, sf):
    """J10 + W6 on fitted predictions of all targets (nearest neighbours) beside the training means."""
    d, feats = _knn_data(spark, sf)
    met, _ = MD.leaderboard(d.filter(~F.col("is_test")), d.filter(F.col("is_test")), C.key, feats, TARGETS, ("KNN", "MEAN"), strict=True)
    best = M.best_model(met).select("target", "best_model")
    return round_doubles(met.join(best, "target"))


@query("leaderboard", None)
def leaderboard_q(spark, sf):
    """Linear, neighbours, boosted trees, forest and mean ranked for each of the 180 targets."""
    d, feats = _model_data(spark, sf)
    met, _ = MD.leaderboard(d.filter(~F.col("is_test")), d.filter(F.col("is_test")), C.key, feats, TARGETS, strict=True)
    place = F.row_number().over(Window.partitionBy("target").orderBy("rmse", "model"))
    return round_doubles(met.withColumn("place", place).join(M.best_model(met), "target"))


@query("cv_scores", None)
def cv_scores_q(spark, sf):
    """RMSE per fold and target beside the target's mean and population standard deviation over the folds."""
    d, feats = _model_data(spark, sf, "positions")
    per = MD.cv_scores(d.filter(~F.col("is_test")), C.key, feats, TARGETS, k=5)
    folds = Window.partitionBy("target")
    return round_doubles(per.select("fold", "target", "rmse", F.avg("rmse").over(folds).alias("mean_rmse"),
                                    F.stddev_pop("rmse").over(folds).alias("std_rmse")))


DATASETS = ["range3", "range2", "others"]


@query("predict_bins", None)
def predict_bins_q(spark, sf):
    """All bins of all granularities for the test notices, one column per bin."""
    d, feats = _model_data(spark, sf, "positions")
    m = MD.fit_linear_multi(d.filter(~F.col("is_test")), feats, TARGETS)
    return round_doubles(MD.predict_linear(d.filter(F.col("is_test")), C.key, m))


@query("batch_predict", None)
def batch_predict_q(spark, sf):
    """J12 + J13 + A14: one JSON document per notice of the bids and granularity, by the models of the notice's own
    dataset; one without training rows is served by the first dataset of the priority list."""
    from tenderlens.plans import model as PM
    from tenderlens.sources.store import prediction_docs_wide
    d, feats = _model_data(spark, sf, "positions")
    models = PM.train(d.filter(~F.col("is_test")), C.key, DATASETS, feats, TARGETS)
    ids = V.bids(spark, sf).select(C.key).distinct()
    wide, _ = PM.predict_ids(models, d, ids, C.key, DATASETS, ["range3", "range2"], wide=True)
    names = F.create_map(*[F.lit(x) for pair in TP.DATASET_NAMES.items() for x in pair])
    return prediction_docs_wide(wide, C.key, names[F.col("dataset")], TARGETS)


@query("batch_predict_failures", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}
SELECT DISTINCT b.{KEY}, 'no such notice' AS reason FROM ({V.BIDS_SQL}) b
WHERE b.{KEY} IS NOT NULL AND b.{KEY} NOT IN (SELECT nt.{KEY} FROM nt JOIN pb ON nt.{KEY} = pb.{KEY})""")
def batch_predict_failures_q(spark, sf):
    """The notices of the bids that the batch run of all models gives no prediction, with the reason."""
    from tenderlens.plans import model as PM
    d, feats = _model_data(spark, sf, "positions")
    models = PM.train(d.filter(~F.col("is_test")), C.key, DATASETS, feats, TARGETS)
    ids = V.bids(spark, sf).select(C.key).dropna().distinct()
    return PM.predict_ids(models, d, ids, C.key, DATASETS, ["range3", "range2"])[1]


@query("train_evaluate", None)
def train_evaluate_q(spark, sf):
    """P3 + A15: linear model and boosted trees of all 180 targets per dataset, metrics written as CSV and read back
    (forests: ``fit_random_forest``, ``leaderboard``)."""
    from tenderlens.plans import model as PM
    from tenderlens.session import checkpoint_dir
    d, feats = _model_data(spark, sf)
    _, _, metrics = PM.run(d.drop("is_test"), C.key, feats, ["010", "020", "050", "100"], DATASETS, ("GBT",))
    path = f"{checkpoint_dir(spark).rstrip('/')}/evaluation-{uuid.uuid4().hex[:12]}"
    PM.write_evaluation(metrics, path)
    return round_doubles(spark.read.option("header", True).schema(metrics.schema).csv(f"{path}/metrics"))


def _save_models(spark, sf):
    """One fit per dataset for all targets, saved per (dataset, prefix)."""
    from tenderlens.session import checkpoint_dir
    d, feats = _model_data(spark, sf, "positions")
    root = f"{checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex[:12]}"
    paths = {}
    for ds in DATASETS:
        part = d.filter((F.col("dataset") == ds) & ~F.col("is_test"))
        if part.isEmpty():
            continue
        m = MD.fit_linear_multi(part, feats, TARGETS)
        for prefix in ("010", "020", "050", "100"):
            at = [i for i, t in enumerate(TARGETS) if t.startswith(f"{prefix}_")]
            paths[ds, prefix] = f"{root}/{ds}/{prefix}"
            MD.save_linear(spark, {"features": m["features"], "targets": [TARGETS[i] for i in at], "coef": m["coef"][:, at],
                                   "intercept": m["intercept"][at]}, paths[ds, prefix], ds, prefix)
    return d, feats, paths


@query("model_store", None)
def model_store_q(spark, sf):
    """Linear models saved per dataset and prefix, loaded back and applied to the test rows."""
    d, feats, paths = _save_models(spark, sf)
    out = []
    for (ds, prefix), path in paths.items():
        m = MD.load_linear(spark, path, prefix)
        test = d.filter((F.col("dataset") == ds) & F.col("is_test"))
        out.append(MD.predict_linear_long(test, C.key, m).withColumn("dataset", F.lit(ds)))
    p = out[0]
    for x in out[1:]:
        p = p.unionByName(x)
    return round_doubles(p.groupBy("dataset", "target").agg(F.count(F.lit(1)).alias("n_predictions"),
                                                            F.avg("p").alias("mean_prediction")))


@query("model_registry", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()},
d AS (SELECT DISTINCT CASE WHEN nt."예가범위" = '+2%~-2%' THEN 'range2' WHEN nt."예가범위" = '+3%~-3%' THEN 'range3'
             ELSE 'others' END AS dataset FROM nt JOIN pb ON nt.{KEY} = pb.{KEY}
      WHERE NOT ({SPLIT.format(k='nt.' + KEY)}))
SELECT dataset, printf('%03d', n) AS prefix, range(1, n + 1) AS bins, n AS n_models
FROM d, (SELECT unnest([10, 20, 50, 100]) AS n)""")
def model_registry_q(spark, sf):
    """Bins with a saved model per dataset and prefix."""
    _, _, paths = _save_models(spark, sf)
    reg = spark.read.parquet(*paths.values())
    return reg.groupBy("dataset", "prefix").agg(
        F.array_sort(F.collect_set(F.split("target", "_").getItem(1).cast("int"))).alias("bins"),
        F.count(F.lit(1)).alias("n_models"))
