"""Plans and outputs that must not depend on few keys, one file or a table's estimated size."""

import json
import json
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tenderlens.operators import bins as B
from tenderlens.operators import encode as E
from tenderlens.operators import metrics as M
from tenderlens.operators import text as TX
from tenderlens.plans import catalog_store as CS
from tenderlens.plans import tender as TP
from tenderlens.sources import store as ST


def _plan(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


def test_dataset_statistics_are_broadcast_whatever_spark_rates_them(spark):
    """A join by dataset would put all rows into a task for each dataset."""
    c = TP.TenderColumns()
    rows = [(i, "t", "a", "r", 100.0 + i, 90.0 + i, "+2%~-2%", 5.0, 85.0, 3, "m", "range2" if i % 3 else "range3") for i in range(30)]
    df = spark.createDataFrame(rows, [c.key, c.title, c.agency, c.region, c.base, c.estimate, c.range_text, c.a_value, c.bid_rate,
                                      c.n_bidders, c.mark, "dataset"])
    cats = {c.agency: ["a"], c.region: ["r"], c.mark: ["m"]}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a table that is rated large
    try:
        out = TP.process_notices(df, None, categories=cats)
        assert "SortMergeJoin" not in _plan(out) and "BroadcastHashJoin" in _plan(out)
        got = {r[c.key]: r[f"norm_log_{c.base}"] for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for ds in (0, 1):
        x = {i: math.log1p(100.0 + i) for i in range(30) if (i % 3 > 0) == ds}
        m = sum(x.values()) / len(x)
        s = (sum((v - m) ** 2 for v in x.values()) / len(x)) ** 0.5
        assert all(got[i] == pytest.approx((v - m) / s) for i, v in x.items())


def test_few_cells_go_to_the_rows(spark):
    df = spark.range(3_000_000).select("id", F.concat(F.lit("a/b"), (F.col("id") % 3).cast("string")).alias("c"))
    out = E.multi_hot_positions(df, "c")
    assert "SortMergeJoin" not in _plan(out)
    assert [tuple(r["c_hot"]) for r in out.filter("id < 3").orderBy("id").collect()] == [(0, 1), (0, 2), (0, 3)]


def test_paired_arrays_are_not_broadcast(spark, monkeypatch, tmp_path):
    seen = []
    monkeypatch.setattr(M, "cut_lineage", lambda d, name: seen.append(d) or d)
    spark.createDataFrame([(i, float(i), 1.0) for i in range(5)], "k long, a double, b double").write.parquet(f"{tmp_path}/y")
    y = spark.read.parquet(f"{tmp_path}/y")  # a file of few bytes, as a table of equal shares is
    p = y.select("k", F.lit(2.0).alias("a"), F.lit(3.0).alias("b"))
    got = M.paired(y, {"M": p, "N": p}, "k", ["a", "b"])
    assert "Broadcast" not in _plan(seen[0])
    assert sorted((r["model"], tuple(r["y"]), tuple(r["p"])) for r in got.collect()) == sorted(
        (m, (float(i), 1.0), (2.0, 3.0)) for m in "MN" for i in range(5))


def test_documents_come_from_wide_rows_without_a_shuffle(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, "DataSet_3", 0.5, nan, 0.25), (2, "DataSet_2", inf, None, 1.0), (None, "DataSet_etc", -inf, 2.0, 0.0)]
    wide = spark.createDataFrame(rows, "k long, ds string, 010_002 double, 010_001 double, 020_001 double")
    targets = ["010_002", "010_001", "020_001"]
    docs = ST.prediction_docs_wide(wide, "k", F.col("ds"), targets)
    assert "Exchange" not in docs._jdf.queryExecution().executedPlan().toString()
    long = wide.unpivot(["k", "ds"], targets, "target", "prediction").withColumn("prefix", F.split("target", "_")[0])
    assert docs.columns == ["k", "prefix", "document"]
    assert Counter(docs.collect()) == Counter(ST.prediction_docs(long, "k", F.col("ds")).collect())
    assert json.loads(docs.where("k = 1 and prefix = '010'").first()["document"])["predictions"] == {"010_001": None, "010_002": 0.5}


def test_stream_loads_are_not_written_by_one_task(spark, tmp_path, monkeypatch):
    rows = [(i % 40, i % 7 + 1, i, 1, float(i), "F" if i % 2 else "O", "ANR"[i % 3]) for i in range(400)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
                                     "l_linestatus string, l_returnflag string")
    li.repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(CS, "_scratch", lambda s, tag: f"{tmp_path}/{tag}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r["k"]: (r["status"], r["flag"], r["line"]) for r in CS.upsert_stream_q(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(list((tmp_path / "stream/in").glob("*.parquet"))) > 4
    assert sorted(p.name for p in (tmp_path / "stream/out").glob("v=*")) == [f"v={i:09d}" for i in (1, 2, 3, 4)]
    last = {}
    for k, line, part, supp, price, status, flag in rows:  # lower line halves arrive later
        place = (-(line // 2), line, part, supp, price)
        if k not in last or place > last[k][0]:
            last[k] = (place, (status, flag, line))
    assert got == {k: v for k, (_, v) in last.items()}


@pytest.mark.parametrize("min_df", [1, 2, 4])
def test_only_frequent_terms_are_counted_per_document(spark, monkeypatch, min_df):
    texts = [(i % 37 if i % 9 else None, " ".join([f"w{j}" for j in range(i % 11)] + [f"only{i}"] * (20 if i == 5 else 1) + ["rare", "rare"] * (i in (3, 40, 5))))
             for i in range(60)]
    written = []
    keep = TX.cut_lineage
    monkeypatch.setattr(TX, "cut_lineage", lambda d, name: written.append((name, keep(d, name))) or written[-1][1])
    got = {(r["k"], r["term"]): r["tfidf"] for r in TX.tfidf_long(spark.createDataFrame(texts, "k long, t string"), "k", "t", 5, min_df).collect()}
    tf = {}
    for k, t in texts:
        w = t.split()
        tf.setdefault(k, Counter()).update(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    tot, df = Counter(), Counter()
    for c in tf.values():
        tot.update(c)
        df.update(c.keys())
    vocab = sorted((t for t in tot if df[t] >= min_df), key=lambda t: (-tot[t], t))[:5]
    assert {t for _, t in got} == set(vocab)
    idf = {t: math.log(61 / (1 + df[t])) + 1 for t in vocab}
    for k, c in tf.items():
        if k is None:
            continue  # a null key finds no row of its own in the join
        norm = math.sqrt(sum((c[t] * idf[t]) ** 2 for t in vocab))
        assert all(got[k, t] == pytest.approx(c[t] * idf[t] / norm if norm else 0.0) for t in vocab)
    counted = sum(d.count() for name, d in written if name == "terms")
    assert counted < sum(len(c) for c in tf.values()) / 2


def test_shares_are_read_after_the_join(spark, monkeypatch):
    """A sort of rows with 180 columns is what the join's tasks held most memory for."""
    c = TP.TenderColumns()
    rows = [(i, "t", "a", "r", 100.0, 90.0, "+2%~-2%", 5.0, 85.0, 3, "m") for i in range(4)]
    nt = spark.createDataFrame(rows, [c.key, c.title, c.agency, c.region, c.base, c.estimate, c.range_text, c.a_value, c.bid_rate,
                                      c.n_bidders, c.mark])
    bids = spark.createDataFrame([(i, f"{r}.5") for i in range(3) for r in (-1, 0, 0, 1)], [c.key, c.rate_text])
    seen = []
    monkeypatch.setattr("tenderlens.session.cut_lineage", lambda d, name="stage": seen.append(d) or d)
    out = TP.transform(nt, bids)
    lines = [x for x in _plan(seen[0]).splitlines() if "Join" in x]
    assert "010_001" in seen[0].columns and lines
    optimized = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "010_001" not in optimized[optimized.index("Join "):]
    got = {r[c.key]: [r[f"010_{i:03d}"] for i in range(1, 11)] for r in out.collect()}
    assert set(got) == {0, 1, 2} and all(sum(v) == pytest.approx(1) and max(v) == 0.5 for v in got.values())
    left = B.read_shares(nt.select(c.key).join(TP.calculate_target(nt, TP.parsed_bids(bids), maps=True), c.key, "left"), [c.key])
    assert left.where(f"`{c.key}` = 3").first()["100_050"] is None


def test_means_stand_beside_their_targets(spark):
    """A lookup by name in 180 means for each of 180 targets of a row is 16,000 comparisons a row."""
    from tenderlens.plans import catalog_models as CM
    key, names = CM.C.key, CM.TARGETS
    means = {x: (None if i == 5 else float(i)) for i, x in enumerate(names)}
    rows = [(k, *[None if (i + (k or 0)) % 7 == 0 else i / 180 for i in range(len(names))]) for k in (1, 2, 2, None)]
    test = spark.createDataFrame(rows, ", ".join([f"`{key}` bigint", *[f"`{x}` double" for x in names]]))
    out = CM._long_means(test, means)
    assert "element_at" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.columns == ["model", "target", key, "y", "p"] and dict(out.dtypes)["p"] == "double"
    want = Counter(("MEAN", x, r[0], r[1 + i], means[x]) for r in rows for i, x in enumerate(names))
    assert Counter(tuple(r) for r in out.collect()) == want
