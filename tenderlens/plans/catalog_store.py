"""Queries of the store, file and bookkeeping operators.

File round trips write into a fresh folder under the session's checkpoint
folder (the shared folder on a cluster) and read it back.
"""

from __future__ import annotations

import time
import uuid

import numpy as np
from pyspark.sql import functions as F

from tenderlens.plans import catalog_tender as CT
from tenderlens.plans import tender as TP
from tenderlens.plans.catalog import q, query, r, round_doubles
from tenderlens.roles import TenderColumns
from tenderlens.session import checkpoint_dir
from tenderlens.sources import files as FI
from tenderlens.sources import store as ST
from tenderlens.sources import views as V

C = TenderColumns()
NT_SQL, TRANSFORM_SQL = CT.NT_SQL, CT.TRANSFORM_SQL
LAST_FIRST = "l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC"


def _scratch(spark, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"


def _upd(spark, sf):
    li = V.table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("k"), F.struct(*V.BID_ORDER).alias("seq"),
                     F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("flag"))


@query("upsert_by_key", f"""WITH t AS (SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS priority
           FROM orders WHERE o_orderstatus = 'F'),
s AS (SELECT l_orderkey AS k, l_linestatus AS status, l_returnflag AS flag FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {LAST_FIRST}) = 1)
SELECT coalesce(t.k, s.k) AS k, CASE WHEN s.k IS NOT NULL THEN s.status ELSE t.status END AS status,
       t.priority, s.flag FROM t FULL OUTER JOIN s ON t.k = s.k""")
def upsert_by_key_q(spark, sf):
    o = V.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    target = o.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"),
                      F.col("o_orderpriority").alias("priority"))
    return ST.upsert_by_key(target, _upd(spark, sf), ["k"], order="seq")


@query("upsert_single", f"""SELECT l_orderkey AS k, l_returnflag AS dataset_type, l_linestatus AS status,
       {r('l_extendedprice')} AS price FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY {LAST_FIRST}) = 1""")
def upsert_single_q(spark, sf):
    li = V.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.struct(*V.BID_ORDER).alias("seq"), "l_returnflag",
        F.col("l_linestatus").alias("status"), F.col("l_extendedprice").alias("price"))
    flags = ["A", "N", "R"]  # fixed domain of the return flag
    parts = {f: li.filter(F.col("l_returnflag") == f).drop("l_returnflag") for f in flags}
    return round_doubles(ST.upsert_single(None, parts, "k", order="seq").select("k", "dataset_type", "status", "price"))


@query("upsert_stream", f"""SELECT l_orderkey AS k, l_linestatus AS status, l_returnflag AS flag, CAST(l_linenumber AS INTEGER) AS line
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber // 2, {LAST_FIRST}) = 1""")
def upsert_stream_q(spark, sf):
    """A10 as a stream: the bid lines arrive in four loads of many files, each load is an epoch, later epochs win;
    every second one folds."""
    from tenderlens.streaming.upsert import latest_snapshot, start_upsert_stream
    path = _scratch(spark, "stream")
    li = _upd(spark, sf).withColumn("line", F.col("seq.l_linenumber").cast("int"))
    part = F.floor(F.col("line") / 2).cast("int")
    for i in (3, 2, 1, 0):  # line numbers end at seven; lower ones arrive later
        li.filter(part == i).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(li.schema).parquet(f"{path}/in")  # all files since the last run are one epoch
        start_upsert_stream(stream, f"{path}/out", ["k"], f"{path}/checkpoint", "seq", fold_every=2).awaitTermination()
    return latest_snapshot(spark, f"{path}/out", ["k"])


@query("storable_names", """SELECT o_orderkey AS "order_key", o_totalprice AS "order_total_price" FROM orders""")
def storable_names_q(spark, sf):
    o = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("order.key"),
                                            F.col("o_totalprice").alias("order.total.price"))
    return ST.storable_names(o)


@query("scan_collection", f"SELECT * FROM ({V.NOTICES_SQL})")
def scan_collection_q(spark, sf):
    """A4: a collection written with the store's ``_id`` and read back without it."""
    path = _scratch(spark, "collection")
    n = V.notices(spark, sf).select(F.monotonically_increasing_id().alias("_id"), "*")
    ST.save_snapshot(n, path, "preprocessed_3", 1)
    return ST.scan_collection(spark, f"{path}/preprocessed_3/v=000001")


@query("lookup_notice", f"""WITH {NT_SQL.strip()},
ids AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R')
SELECT nt."공고번호", CASE WHEN nt."예가범위" = '+2%~-2%' THEN 'range2' WHEN nt."예가범위" = '+3%~-3%' THEN 'range3'
       ELSE 'others' END AS collection, {r('nt."기초금액"')} AS "기초금액"
FROM nt JOIN ids ON nt."공고번호" = ids.k""")
def lookup_notice_q(spark, sf):
    """Ids looked up across the three range collections, first hit by priority."""
    nt = TP.separate(TP.clean_notices(V.notices(spark, sf)))
    cols = {ds: nt.filter(F.col("dataset") == ds).select(C.key, C.base) for ds in ("range3", "range2", "others")}
    ids = V.table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias(C.key))
    return round_doubles(ST.lookup_notice(cols, C.key, ids, ["range2", "range3", "others"]).select(
        C.key, "collection", C.base))


CSV_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus"]


@query("scan_csv_glob", "SELECT " + ", ".join(
    r(c) + f" AS {c}" if c == "l_quantity" else c for c in CSV_COLS) + ", 'DataSet_bids_' || l_returnflag AS dataset FROM lineitem")
def scan_csv_glob_q(spark, sf):
    """A1: bid CSV files named after their return flag (``bids_A.00000.csv``), read back by one glob with dataset names."""
    path = _scratch(spark, "csv")
    li = V.table(spark, sf, "lineitem").select(*CSV_COLS)
    li.withColumn("folder", F.col("l_returnflag")).write.partitionBy("folder").option("header", True).csv(path)
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/folder=*")):
        flag = folder.getPath().getName().partition("=")[2]
        for i, part in enumerate(fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder.getPath(), "part-*.csv"))):
            fs.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/bids_{flag}.{i:05d}.csv"))
    return round_doubles(FI.scan_csv_glob(spark, f"{path}/*.csv", li.schema))


@query("scan_json", "SELECT doc_id, lang, source, n_chars, text FROM documents")
def scan_json_q(spark, sf):
    """A2: documents written as JSON lines and read back, every row."""
    path = _scratch(spark, "json")
    docs = V.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    docs.write.json(path)
    return FI.scan_json(spark, path, docs.schema)


@query("scan_csv_fallback", f"SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice FROM orders")
def scan_csv_fallback_q(spark, sf):
    """A3: the default path is missing, the fallback path is read."""
    path = _scratch(spark, "fallback")
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    o.write.option("header", True).csv(path)
    return round_doubles(FI.scan_csv_fallback(spark, [f"{path}-missing", path], o.schema))


@query("write_datasets", TRANSFORM_SQL)
def write_datasets_q(spark, sf):
    """The tender datasets with all targets written one folder per dataset, read back."""
    path = _scratch(spark, "datasets")
    t = TP.transform(V.notices(spark, sf), V.bids(spark, sf))
    FI.write_datasets(t, path)
    return round_doubles(spark.read.parquet(path).select(*t.columns))


_ORDER_SPLIT = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 100 < 20"
_SPLIT_ROWS = f"""SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice,
       CASE WHEN {_ORDER_SPLIT} THEN 'test' ELSE 'train' END AS split FROM orders"""


def _written_splits(spark, sf):
    from tenderlens.operators.model import hash_split
    path = _scratch(spark, "split")
    o = hash_split(V.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    FI.write_split(o.withColumn("split", F.when(F.col("is_test"), "test").otherwise("train")).drop("is_test"), path)
    return path


@query("write_split", _SPLIT_ROWS)
def write_split_q(spark, sf):
    """Train and test rows written side by side, read back."""
    return round_doubles(spark.read.parquet(_written_splits(spark, sf)).select("o_orderkey", "o_totalprice", "split"))


@query("stage_metrics", None)
def stage_metrics_q(spark, sf):
    """Rows, columns and duration per stage of the tender plan (observed metrics)."""
    from pyspark.sql import Observation
    n, b = V.notices(spark, sf), V.bids(spark, sf)
    stages = [("load", lambda: n), ("clean", lambda: TP.clean_notices(n)),
              ("transform", lambda: TP.transform(n, b))]
    rows = []
    for name, build in stages:
        obs = Observation(name)
        t0 = time.time()
        df = build().observe(obs, F.count(F.lit(1)).alias("rows"))
        df.write.format("noop").mode("overwrite").save()
        rows.append((name, int(obs.get["rows"]), len(df.columns), round(time.time() - t0, 3)))
    return spark.createDataFrame(rows, "stage string, n_rows long, n_columns int, seconds double")


@query("run_summary", None)
def run_summary_q(spark, sf):
    """E5: one linear fit per (dataset, prefix), successes and models trained rolled up by model type."""
    from tenderlens.functions.expr import GRANULARITIES, all_target_names
    from tenderlens.operators.model import fit_linear_multi
    from tenderlens.operators.modeldata import run_summary
    from tenderlens.session import cut_lineage
    n, b = V.notices(spark, sf), V.bids(spark, sf)
    t = cut_lineage(TP.transform(n, b))
    targets = all_target_names()
    feats = [c for c in t.columns if c not in targets and c not in (C.key, C.range_text, "dataset")]
    runs = []
    for ds in ("range3", "range2", "others"):
        for g in GRANULARITIES:
            tg = [x for x in targets if x.startswith(f"{g:03d}_")]
            try:
                fit_linear_multi(t.filter(F.col("dataset") == ds), feats, tg)
                runs.append(("LR", ds, f"{g:03d}", True, len(tg)))
            except np.linalg.LinAlgError:  # a singular system is a failed fit, counted as such
                runs.append(("LR", ds, f"{g:03d}", False, 0))
    rt = spark.createDataFrame(runs, "model_type string, dataset string, prefix string, success boolean, "
                                     "models_trained long")
    return run_summary(rt)


def _bid_table(spark, sf):
    """lineitem with the amount, date and price names of the roles."""
    li = V.table(spark, sf, "lineitem")
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return li.select(F.col("l_orderkey").alias("notice_no"), *V.BID_ORDER[:3],
                     F.col("l_extendedprice").alias("기초금액"), net.alias("예정금액"),
                     (net * (F.lit(1.0) + F.col("l_tax"))).alias("투찰가"), F.col("l_quantity").alias("qty"),
                     F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
                     F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"))


def _bid_roles(**more):
    from tenderlens.roles import ColumnRoles
    return ColumnRoles(key="notice_no", dedupe_key=None, essential=("notice_no",),
                       required=("notice_no", "기초금액"), **more)


_SCALED = [*V.BID_ORDER[:3], "기초금액", "예정금액", "투찰가", "qty", "norm_log_기초금액", "norm_log_예정금액"]
_PREPROCESS_CTE = """WITH b AS (SELECT l_orderkey AS notice_no, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS b0,
    l_extendedprice * (1.0::DOUBLE - l_discount) AS e0, l_quantity AS qty, l_returnflag AS flag, l_linestatus AS status,
    l_extendedprice * (1.0::DOUBLE - l_discount) * (1.0::DOUBLE + l_tax) AS p, l_shipdate AS d
  FROM lineitem WHERE l_orderkey IS NOT NULL),
k AS (SELECT quantile_cont(b0, 0.25) AS b1, quantile_cont(b0, 0.75) AS b3, quantile_cont(e0, 0.25) AS e1,
             quantile_cont(e0, 0.75) AS e3 FROM b),
c AS (SELECT b.*, least(greatest(b0, b1 - 1.5 * (b3 - b1)), b3 + 1.5 * (b3 - b1)) AS "기초금액",
             least(greatest(e0, e1 - 1.5 * (e3 - e1)), e3 + 1.5 * (e3 - e1)) AS "예정금액", p AS "투찰가" FROM b, k),
u AS (SELECT *, ln(1 + "기초금액") AS "norm_log_기초금액", ln(1 + "예정금액") AS "norm_log_예정금액" FROM c),
m AS (SELECT """ + ", ".join(f'min({q(x)}) AS "lo_{x}", max({q(x)}) AS "hi_{x}"' for x in _SCALED) + """ FROM u),
z AS (SELECT notice_no, flag, status, date_trunc('day', d) AS ship_date, """ + ", ".join(
    f'({q(x)} - "lo_{x}") / ("hi_{x}" - "lo_{x}")::DOUBLE AS {q(x)}' for x in _SCALED) + """,
    u."기초금액" AS ub, u."예정금액" AS ue, u."투찰가" AS up, u."norm_log_기초금액" AS lb, u."norm_log_예정금액" AS le
  FROM u, m)
"""


def _guarded(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE {a} / {b} END"


@query("preprocess", _PREPROCESS_CTE + "SELECT notice_no, flag, status, ship_date, " + ", ".join(
    f"{r(q(x))} AS {q(x)}" for x in _SCALED) + ", " + ", ".join(
    f"CAST({c} = '{v}' AS INTEGER) AS {c}_{v}" for c, v in
    (("flag", "A"), ("flag", "N"), ("flag", "R"), ("status", "F"), ("status", "O"))) + f""",
    year(ship_date) AS ship_date_year, month(ship_date) AS ship_date_month, day(ship_date) AS ship_date_day,
    isodow(ship_date) - 1 AS ship_date_weekday, quarter(ship_date) AS ship_date_quarter,
    {r(_guarded('"norm_log_기초금액"', '"norm_log_예정금액"'))} AS "ratio_기초금액_예정금액",
    {r('"norm_log_기초금액" - "norm_log_예정금액"')} AS "diff_기초금액_예정금액",
    {r('up / nullif(ue, 0)')} AS "낙찰가격비율", {r(_guarded('ue', 'ub'))} AS "예정가비율",
    {r(_guarded('le', 'lb'))} AS "log_예정가비율", {r(_guarded('up', 'ub'))} AS "투찰가_기초금액비율",
    {r(_guarded('up', 'ue'))} AS "투찰가_예정금액비율" FROM z""")
def preprocess_q(spark, sf):
    """P2 on the bid-like lineitem table (no dedupe key: bids keep every row, Q21)."""
    from tenderlens.plans import preprocess as PP
    return round_doubles(PP.run(_bid_table(spark, sf), "bid_data_lineitem", _bid_roles()))


@query("preprocess_advanced", None)
def preprocess_advanced_q(spark, sf):
    """P2 with its optional blocks: k-best selection for a target and the numeric PCA, one row per input row."""
    from tenderlens.plans import preprocess as PP
    return round_doubles(PP.run(_bid_table(spark, sf), "bid_data_lineitem", _bid_roles(target=("투찰가",)),
                                advanced=True))


@query("custom_hook", _PREPROCESS_CTE + f"""SELECT notice_no, {r('l_linenumber')} AS l_linenumber,
    'bid_data_lineitem' AS hook_dataset, {r('"기초금액" / nullif(qty, 0)')} AS amount_per_qty FROM z""")
def custom_hook_q(spark, sf):
    """A user hook ``(df, name, roles) -> df`` runs after the feature stage."""
    from tenderlens.plans import preprocess as PP

    def hook(df, name, roles):
        return df.withColumn("hook_dataset", F.lit(name)).withColumn(
            "amount_per_qty", F.try_divide(F.col("기초금액"), F.col("qty")))

    out = PP.run(_bid_table(spark, sf), "bid_data_lineitem", _bid_roles(), hook=hook)
    return round_doubles(out.select("notice_no", "l_linenumber", "hook_dataset", "amount_per_qty"))


REQUIRED_OUT = ["공고번호", "공고제목", "발주처(수요기관)", "지역제한", "기초금액", "예정가격", "예가범위", "A값",
                "투찰률(%)", "참여업체수", "공고구분표시"]


@query("project_required", "SELECT " + ", ".join(
    (f'{r(chr(34) + c + chr(34))} AS "{c}"' if c in ("기초금액", "예정가격", "A값", "투찰률(%)") else f'"{c}"')
    for c in REQUIRED_OUT) + f" FROM ({V.NOTICES_SQL})")
def project_required_q(spark, sf):
    """B1 + B2: required-column check at plan time, then the projection to them."""
    from tenderlens.roles import require_columns
    n = V.notices(spark, sf)
    require_columns(n, C.notice_required, "notices")
    return round_doubles(n.select(*C.notice_required))


_SPLIT = "CAST(('0x' || substr(md5(CAST(\"공고번호\" AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 100 < 20"


@query("align_types", f"""WITH n AS ({V.NOTICES_SQL})
SELECT 'train' AS split, "공고번호", CAST("참여업체수" AS VARCHAR) AS "참여업체수", {r('"기초금액"')} AS "기초금액"
FROM n WHERE NOT ({_SPLIT})
UNION ALL
SELECT 'test', "공고번호", CAST(CAST("참여업체수" AS DOUBLE) AS VARCHAR), {r('"기초금액"')} FROM n WHERE {_SPLIT}""")
def align_types_q(spark, sf):
    """B7 + B8: train and test projected to their common columns; a column typed
    differently in the two (bidder count: long vs double) becomes a string in both."""
    from tenderlens.operators.model import hash_split
    from tenderlens.operators.modeldata import align_types
    n = hash_split(V.notices(spark, sf).select(C.key, C.n_bidders, C.base, "입찰일자"), C.key)
    train = n.filter(~F.col("is_test")).drop("is_test", "입찰일자")
    test = n.filter(F.col("is_test")).drop("is_test").withColumn(C.n_bidders, F.col(C.n_bidders).cast("double"))
    a, b = align_types(train, test)
    return round_doubles(a.withColumn("split", F.lit("train")).unionByName(b.withColumn("split", F.lit("test"))))


@query("common_schema", f"""SELECT 'notices' AS origin, "공고번호" FROM ({V.NOTICES_SQL})
UNION ALL SELECT 'bids', "공고번호" FROM ({V.BIDS_SQL})""")
def common_schema_q(spark, sf):
    """Notices and bids projected to their common columns."""
    from tenderlens.operators.modeldata import common_schema
    n, b = V.notices(spark, sf), V.bids(spark, sf)
    cols = common_schema(n, b)
    return (n.select(F.lit("notices").alias("origin"), *cols)
            .unionByName(b.select(F.lit("bids").alias("origin"), *cols)))


@query("load_split_tables", _SPLIT_ROWS)
def load_split_tables_q(spark, sf):
    """Both saved splits loaded (a missing one raises)."""
    parts = FI.load_split_tables(spark, _written_splits(spark, sf))
    return round_doubles(parts["train"].unionByName(parts["test"]).select("o_orderkey", "o_totalprice", "split"))


@query("overwrite_collections", f"""WITH {NT_SQL.strip()}
SELECT "공고번호", CASE WHEN "예가범위" = '+2%~-2%' THEN 'range2' WHEN "예가범위" = '+3%~-3%' THEN 'range3'
       ELSE 'others' END AS dataset, CASE WHEN "예가범위" = '+3%~-3%' THEN 0.0 ELSE {r('"기초금액"')} END AS "기초금액"
FROM nt""")
def overwrite_collections_q(spark, sf):
    """One dataset of a collection replaced in place (dynamic partition overwrite), all rows read back."""
    path = _scratch(spark, "collections")
    nt = TP.separate(TP.clean_notices(V.notices(spark, sf))).select(C.key, "dataset", C.base)
    FI.write_datasets(nt, path)
    FI.write_datasets(nt.filter(F.col("dataset") == "range3").withColumn(C.base, F.lit(0.0)), path)
    return round_doubles(spark.read.parquet(path).select(C.key, "dataset", C.base))


@query("first_collection", f"SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice FROM orders WHERE NOT ({_ORDER_SPLIT})")
def first_collection_q(spark, sf):
    """A5 + A16: the first name and the test split do not exist, so the train split of the second is read."""
    from tenderlens.operators.model import hash_split
    root = _scratch(spark, "collections")
    o = hash_split(V.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    o.where(~F.col("is_test")).drop("is_test").write.parquet(f"{root}/{ST.collection_alias('DataSet_3')}_train")
    return round_doubles(ST.first_collection(spark, root, ["DataSet_2", "dataset3"], ("test", "train")))


@query("prediction_docs", None)
def prediction_docs_q(spark, sf):
    """One JSON document per (notice, prefix) from the training-mean candidate."""
    from tenderlens.plans.catalog_models import TARGETS, _split_targets
    names = F.create_map(*[F.lit(x) for pair in TP.DATASET_NAMES.items() for x in pair])
    ds = TP.separate(TP.clean_notices(V.notices(spark, sf))).select(C.key, "dataset")
    t, means = _split_targets(spark, sf)
    p = t.filter("is_test").select(C.key).join(ds, C.key)
    p = p.select(C.key, "dataset", *[F.lit(means[x]).cast("double").alias(x) for x in TARGETS])
    return ST.prediction_docs_wide(p, C.key, names[F.col("dataset")], TARGETS)
