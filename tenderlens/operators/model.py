"""Model tables.

* Splits are hash based (stable, reproducible in any engine).
* ``fit_linear_multi`` fits one ridge regression for ALL targets from a
  distributed pass after the means (sums of products of [1 | X] with [1 | X | Y],
  a matrix product per Arrow batch); only p * (p+t) numbers reach the driver. With
  position columns (any number of categories) the products are sparse: ``operators/wide.py``.
* Trees of all targets: ``operators/trees.py``; ``fit_tree`` wraps Spark ML for one target.
* ``leaderboard`` ranks five candidates for every target.
* Scoring is one plan for all rows and targets.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens.operators import wide as W


def hash_bucket(key, seed: int = 42, buckets: int = 100) -> F.Column:
    """Stable bucket: first 8 hex digits of md5('<key>:<seed>') modulo ``buckets``."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10)
    return (h.cast("long") % F.lit(buckets)).cast("int")


def hash_split(df: DataFrame, key: str, test_pct: int = 20, seed: int = 42, out: str = "is_test") -> DataFrame:
    """80/20 split by key hash; X and Y stay aligned because they share the key."""
    return df.withColumn(out, hash_bucket(key, seed) < F.lit(test_pct))


def kfold_assign(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 by key hash."""
    return df.withColumn(out, hash_bucket(key, seed, k))


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    va = VectorAssembler(inputCols=features, outputCol=out, handleInvalid="keep")
    return va.transform(df.fillna(0, subset=features))


def fit_linear_multi(df: DataFrame, features: list[str], targets: list[str], ridge: float = 1e-6) -> dict:
    """Ridge regression of every target on the same features, one data pass after the means.

    Returns {"features", "targets", "coef" (p x t), "intercept" (t)}. Position columns
    count as one feature per category, ``<col>[<position>]``.
    """
    if W.hot_columns(df, features):
        return _fit_wide(df, features, targets, ridge)
    means, parts = fold_products(df.fillna(0, subset=features).withColumn("__fold", F.lit(0)), "__fold", features, targets)
    if 0 not in parts:
        raise ValueError("no rows with all targets")
    p, n, zz = len(features), parts[0]["zz"][0, 0], parts[0]["zz"]
    off = zz[0, 1:] / n  # the means of values less the means: what rounding left
    cov = zz[1:, 1:] / n - np.outer(off[:p], off)
    coef = np.linalg.solve(cov[:, :p] + ridge * np.eye(p), cov[:, p:])
    mean = means + off
    return {"features": features, "targets": targets, "coef": coef, "intercept": mean[p:] - mean[:p] @ coef}


def _fit_wide(df: DataFrame, features: list[str], targets: list[str], ridge: float) -> dict:
    means, parts = W.products(df, features, targets)
    if 0 not in parts:
        raise ValueError("no rows with all targets")
    layout = parts[0].layout
    b, nd = W.ridge(parts[0], ridge), len(layout.numbers)
    return {"features": layout.names, "targets": targets, "coef": b[1:],
            "intercept": means[nd:] + b[0] - means[:nd] @ b[1: 1 + nd]}


def predict_linear(df: DataFrame, key: str, model: dict, keep: list[str] = ()) -> DataFrame:
    """J11 for the linear model: key, ``keep`` and one prediction column per target.

    The coefficients travel once per task with the function; every Arrow batch is one
    matrix product. Missing features count as 0.
    """
    feats, targets = model["features"], model["targets"]
    coef, intercept = np.asarray(model["coef"]), np.asarray(model["intercept"])
    carried = [key, *keep]
    layout = W.layout_named(feats, df)
    rows = df.select(*carried, *W.feature_columns(layout))
    schema = T.StructType([*rows.select(*carried).schema.fields, *[T.StructField(t, T.DoubleType()) for t in targets]])
    n = len(carried)

    def run(batches):
        for batch in batches:
            p = W.scores(batch.columns[n:], layout, coef, batch.num_rows) + intercept
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *[pa.array(p[:, j]) for j in range(p.shape[1])]],
                                             names=[*carried, *targets])

    return rows.mapInArrow(run, schema)


def predict_linear_long(df: DataFrame, key: str, model: dict, model_name: str = "LR") -> DataFrame:
    """J11 for the linear model: (model, target, key, p) for all rows and targets."""
    wide = predict_linear(df, key, model)
    return wide.unpivot([key], model["targets"], "target", "p").select(
        F.lit(model_name).alias("model"), "target", key, "p")


def targets_long(df: DataFrame, key: str, targets: list[str]) -> DataFrame:
    """Actual target values as (target, key, y)."""
    return df.select(key, *targets).unpivot(key, targets, "target", "y")


def fit_tree(df: DataFrame, features: list[str], target: str, kind: str = "gbt", seed: int = 42, **params):
    """Spark ML gradient-boosted trees or random forest for one target.

    The assembled rows are persisted for the iterations and released after. Boosting
    stops early on a validation share of rows chosen by their hash.
    """
    from pyspark import StorageLevel
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    d = assemble(df.dropna(subset=[target]).select(*features, target), features).select(
        "features", target, (F.pmod(F.xxhash64(*features), F.lit(100)) < params.get("validation_pct", 10)).alias("__held"))
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    if kind == "gbt":
        est = GBTRegressor(featuresCol="features", labelCol=target, seed=seed, validationIndicatorCol="__held",
                           maxIter=params.get("maxIter", 20), maxDepth=params.get("maxDepth", 4))
    else:
        est = RandomForestRegressor(featuresCol="features", labelCol=target, seed=seed,
                                    numTrees=params.get("numTrees", 100), maxDepth=params.get("maxDepth", 5))
    try:
        return est.fit(d)
    finally:
        d.unpersist()


def predict_tree_long(df: DataFrame, key: str, features: list[str], model, target: str, name: str) -> DataFrame:
    d = assemble(df, features)
    return model.transform(d).select(F.lit(name).alias("model"), F.lit(target).alias("target"), key,
                                     F.col("prediction").alias("p"))


def feature_importance(model, features: list[str], spark) -> DataFrame:
    """(feature, importance) rows of a tree model."""
    imp = model.featureImportances.toArray()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")


def mean_baseline_long(train: DataFrame, test: DataFrame, key: str, targets: list[str], name: str = "MEAN") -> DataFrame:
    """A constant candidate: the training mean of each target."""
    # one row of means (bounded by the target count) becomes a literal array per row
    row = train.agg(*[F.avg(F.col(f"`{t}`")).alias(t) for t in targets]).first()
    entries = F.array(*[F.struct(F.lit(t).alias("target"), F.lit(row[t]).cast("double").alias("p"))
                        for t in targets])
    return test.select(key, F.inline(entries)).select(F.lit(name).alias("model"), "target", key, "p")


CANDIDATES = ("LR", "KNN", "GBT", "RF", "MEAN")


def candidate(name: str, train: DataFrame, test: DataFrame, key: str, features: list[str], targets: list[str], binning=None,
              seconds: float | None = None) -> tuple[DataFrame, str | None]:
    """Wide test predictions of one candidate for all targets, and what its time bound cut off, if anything."""
    from tenderlens.operators import trees as TR
    from tenderlens.operators.neighbors import knn_predict
    if name == "LR":
        return predict_linear(test, key, fit_linear_multi(train, features, targets)), None
    if name == "KNN":
        return knn_predict(train, test, key, features, targets), None
    if name == "MEAN":
        row = train.agg(*[F.avg(F.col(f"`{t}`")).alias(t) for t in targets]).first()
        return test.select(key, *[F.lit(row[t]).cast("double").alias(t) for t in targets]), None
    fit = {"GBT": TR.fit_boosted, "RF": TR.fit_forest}[name]
    model = fit(train, key, features, targets, seconds=seconds, binning=binning)
    return TR.predict(test, key, model), model.stopped


def leaderboard(train: DataFrame, test: DataFrame, key: str, features: list[str], targets: list[str],
                candidates: tuple[str, ...] = CANDIDATES, seconds_per_target: float | None = None,
                strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(metrics of every candidate for every target, failures as (model, reason)).

    The tree candidates share one binning. ``seconds_per_target`` times the number of
    targets bounds each tree fit, which covers all targets together; what a fit did not
    get to is a failure row, as is a candidate that raised. ``strict`` raises instead: for
    callers that return the metrics alone, where a missing candidate would not be seen.
    """
    from tenderlens.operators import trees as TR
    from tenderlens.operators.metrics import paired, wide_metrics
    binning = TR.fit_bins(train, features) if {"GBT", "RF"} & set(candidates) else None
    budget = None if seconds_per_target is None else seconds_per_target * len(targets)
    predictions, failures = {}, []
    for name in candidates:
        try:
            predictions[name], cut = candidate(name, train, test, key, features, targets, binning, budget)
        except Exception as e:  # noqa: BLE001  one candidate's failure leaves the others to compete
            if strict:
                raise
            cut = f"{type(e).__name__}: {str(e)[:200]}"
        if cut and strict:
            raise RuntimeError(f"{name}: {cut}")
        if cut:
            failures.append((name, cut))
    metrics = wide_metrics(paired(test, predictions, key, targets), targets)
    return metrics, train.sparkSession.createDataFrame(failures, "model string, reason string")


def fold_products(df: DataFrame, fold: str, features: list[str], targets: list[str]) -> tuple[np.ndarray, dict[int, dict]]:
    """Sums of products of [1, X, Y] per fold, from one scan after the means: (means, {fold: {"zz", "yy"}}).

    ``zz`` is [1, X]' [1, X, Y], ``yy`` the targets' sums of squares, both of values less
    the means. Rows with a NULL target take no part, missing features count as 0.
    """
    p, t = len(features), len(targets)
    rows = df.dropna(subset=targets).select(
        F.col(fold).cast("int").alias("__f"), *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"__x{i}") for i, c in enumerate(features)],
        *[F.col(f"`{c}`").cast("double").alias(f"__y{j}") for j, c in enumerate(targets)])
    r = rows.agg(*[F.avg(c).alias(c) for c in rows.columns[1:]]).first()
    means = np.array([r[c] if r[c] is not None else 0.0 for c in rows.columns[1:]])
    size = (p + 1) * (p + 1 + t) + t

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            v = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]) - means
            for f in np.unique(folds).tolist():
                part = v[folds == f]
                z = np.column_stack([np.ones(len(part)), part])
                made = np.concatenate([(z[:, : p + 1].T @ z).ravel(), (part[:, p:] ** 2).sum(axis=0)])
                sums[f] = sums[f] + made if f in sums else made
        for f, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, f, dtype=np.int32)), pa.array(np.arange(size, dtype=np.int32)),
                                              pa.array(total)], names=["f", "at", "v"])

    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(run, "f int, at int, v double").groupBy("f", "at").agg(F.sum("v").alias("v")).collect():
        out.setdefault(r["f"], np.zeros(size))[r["at"]] = r["v"]  # folds x (features x targets) numbers
    return means, {f: {"zz": v[: size - t].reshape(p + 1, p + 1 + t), "yy": v[size - t:]} for f, v in out.items()}


def cv_scores(df: DataFrame, key: str, features: list[str], targets: list[str], k: int = 5, ridge: float = 1e-6) -> DataFrame:
    """K-fold RMSE of the linear candidate, one row per fold and target.

    One scan adds up the products per fold; a fold's model comes from the total less the
    fold's own part, its squared errors from that part.
    """
    if W.hot_columns(df, features):
        return _cv_wide(df, key, features, targets, k, ridge)
    p = len(features)
    _, parts = fold_products(kfold_assign(df, key, k), "fold", features, targets)
    total, out = sum(v["zz"] for v in parts.values()) if parts else None, []
    for f, own in sorted(parts.items()):
        rest = total - own["zz"]
        n = rest[0, 0]
        if n == 0:
            continue  # all rows lie in one fold: nothing to fit on
        mean = rest[0, 1:] / n
        cov = rest[1:, 1:] / n - np.outer(mean[:p], mean)
        coef = np.linalg.solve(cov[:, :p] + ridge * np.eye(p), cov[:, p:])
        b = np.vstack([mean[p:] - mean[:p] @ coef, coef])  # on values less the means, as the products are
        zz, zy = own["zz"][:, : p + 1], own["zz"][:, p + 1:]
        sse = own["yy"] - 2 * (b * zy).sum(axis=0) + (b * (zz @ b)).sum(axis=0)
        rmse = np.sqrt(np.maximum(sse, 0) / zz[0, 0])
        out += [(f, t, float(rmse[j])) for j, t in enumerate(targets)]
    return df.sparkSession.createDataFrame(out, "fold int, target string, rmse double")


def _cv_wide(df: DataFrame, key: str, features: list[str], targets: list[str], k: int, ridge: float) -> DataFrame:
    _, parts = W.products(kfold_assign(df, key, k), features, targets, "fold")
    out = []
    if len(parts) > 1:
        whole = reduce(W.Products.plus, parts.values())
        for f, own in parts.items():
            rmse = np.sqrt(np.maximum(W.errors(own, W.ridge(whole.plus(own, -1), ridge)), 0) / own.n)
            out += [(f, t, float(rmse[j])) for j, t in enumerate(targets)]
    return df.sparkSession.createDataFrame(out, "fold int, target string, rmse double")


def save_model(model, path: str) -> None:
    """Spark ML models are saved with ``write().overwrite().save``."""
    model.write().overwrite().save(path)


def load_tree(path: str, kind: str):
    """A saved tree model."""
    from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
    return (GBTRegressionModel if kind == "gbt" else RandomForestRegressionModel).load(path)


def save_linear(spark, model: dict, path: str, dataset: str, prefix: str) -> None:
    """J16 for the linear model: a coefficient table (target, intercept, coef array, features)."""
    rows = [(dataset, prefix, t, float(model["intercept"][j]), [float(v) for v in model["coef"][:, j]],
             model["features"]) for j, t in enumerate(model["targets"])]
    spark.createDataFrame(rows, "dataset string, prefix string, target string, intercept double, "
                                "coef array<double>, features array<string>").write.mode("overwrite").parquet(path)


def load_linear(spark, path: str, prefix: str | None = None) -> dict:
    df = spark.read.parquet(path)
    if prefix:
        df = df.filter(F.col("prefix") == prefix)
    rows = df.orderBy("target").collect()  # one row per target: bounded by the target count
    return {"features": list(rows[0]["features"]), "targets": [r["target"] for r in rows],
            "coef": np.array([r["coef"] for r in rows]).T, "intercept": np.array([r["intercept"] for r in rows])}
