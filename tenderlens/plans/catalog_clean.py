"""Queries of the cleaning and profiling operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlens.operators import clean as CL
from tenderlens.operators.encode import cardinality_profile
from tenderlens.plans.catalog import q, query, r, round_doubles
from tenderlens.sources import views as V

LI_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
LI_KEY_LIST = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _li(spark, sf):
    return V.table(spark, sf, "lineitem")


def _li_nulls(spark, sf):
    """lineitem with NULLs placed by line number (the source has none)."""
    li = _li(spark, sf)
    return li.select(*LI_KEY_LIST,
                     F.when(F.col("l_linenumber") == 2, F.lit(None)).otherwise(F.col("l_quantity")).alias("qty"),
                     F.when(F.col("l_linenumber") == 3, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("price"),
                     F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_returnflag")).alias("flag"),
                     F.when(F.col("l_linenumber") == 4, F.lit(None)).otherwise(F.col("l_linestatus")).alias("status"))


LI_NULLS_SQL = f"""SELECT {LI_KEYS},
  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS qty,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS flag,
  CASE WHEN l_linenumber = 4 THEN NULL ELSE l_linestatus END AS status
FROM lineitem"""


@query("fill_median", f"""WITH t AS ({LI_NULLS_SQL}),
s AS (SELECT quantile_cont(qty, 0.5) AS mq, quantile_cont(price, 0.5) AS mp FROM t)
SELECT {LI_KEYS}, {r('coalesce(qty, mq)')} AS qty, {r('coalesce(price, mp)')} AS price FROM t, s""")
def fill_median_q(spark, sf):
    d = _li_nulls(spark, sf).drop("flag", "status")
    return round_doubles(CL.fill_median(d, ["qty", "price"]))


@query("fill_mean", f"""WITH t AS ({LI_NULLS_SQL}),
s AS (SELECT avg(qty) AS mq, avg(price) AS mp FROM t)
SELECT {LI_KEYS}, {r('coalesce(qty, mq)')} AS qty, {r('coalesce(price, mp)')} AS price FROM t, s""")
def fill_mean_q(spark, sf):
    d = _li_nulls(spark, sf).drop("flag", "status")
    return round_doubles(CL.fill_mean(d, ["qty", "price"]))


@query("fill_constant", f"""WITH t AS ({LI_NULLS_SQL})
SELECT {LI_KEYS}, coalesce(flag, 'Unknown') AS flag, coalesce(status, 'Unknown') AS status FROM t""")
def fill_constant_q(spark, sf):
    d = _li_nulls(spark, sf).drop("qty", "price")
    return CL.fill_constant(d, ["flag", "status"], "Unknown")


@query("fill_empty", f"""WITH t AS ({LI_NULLS_SQL})
SELECT {LI_KEYS}, coalesce(flag, '') AS flag FROM t""")
def fill_empty_q(spark, sf):
    d = _li_nulls(spark, sf).select(*LI_KEY_LIST, "flag")
    return CL.fill_empty(d, ["flag"])


@query("fill_mode", f"""WITH t AS ({LI_NULLS_SQL}),
cf AS (SELECT flag AS v, count(*) AS c FROM t WHERE flag IS NOT NULL GROUP BY flag),
cs AS (SELECT status AS v, count(*) AS c FROM t WHERE status IS NOT NULL GROUP BY status),
mf AS (SELECT v FROM cf ORDER BY c DESC, v LIMIT 1),
ms AS (SELECT v FROM cs ORDER BY c DESC, v LIMIT 1)
SELECT {LI_KEYS}, coalesce(flag, (SELECT v FROM mf), 'UNKNOWN') AS flag,
       coalesce(status, (SELECT v FROM ms), 'UNKNOWN') AS status FROM t""")
def fill_mode_q(spark, sf):
    d = _li_nulls(spark, sf).drop("qty", "price")
    return CL.fill_mode(d, ["flag", "status"])


@query("drop_essential_nulls", f"""WITH t AS ({LI_NULLS_SQL})
SELECT count(*) AS n_rows, (SELECT count(*) FROM t) - count(*) AS n_dropped FROM t
WHERE qty IS NOT NULL AND flag IS NOT NULL""")
def drop_essential_nulls_q(spark, sf):
    d = _li_nulls(spark, sf)
    kept = CL.drop_null_keys(d, ["qty", "flag"])
    n = d.agg(F.count(F.lit(1)).alias("__all"))
    return kept.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(n).select(
        "n_rows", (F.col("__all") - F.col("n_rows")).alias("n_dropped"))


@query("dedupe_keep_first", f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r('l_extendedprice')} AS l_extendedprice,
       l_returnflag, l_shipdate
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
     ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""")
def dedupe_keep_first_q(spark, sf):
    li = _li(spark, sf).select(*LI_KEY_LIST, "l_extendedprice", "l_returnflag", "l_shipdate")
    d = CL.dedupe_keep_first(li, ["l_orderkey"], list(V.BID_ORDER))
    return round_doubles(d)


@query("distinct_rows", """SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_quantity AS DOUBLE) AS l_quantity
FROM lineitem""")
def distinct_rows_q(spark, sf):
    return CL.distinct_rows(_li(spark, sf).select("l_returnflag", "l_linestatus", "l_quantity"))


@query("duplicate_count", """SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates
FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicate_count_q(spark, sf):
    return CL.duplicate_count(_li(spark, sf), ["l_orderkey", "l_linenumber"])


@query("cap_outliers_iqr", f"""WITH s AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
                         quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT {LI_KEYS}, {r('least(greatest(l_extendedprice, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1))')} AS l_extendedprice
FROM lineitem, s""")
def cap_outliers_iqr_q(spark, sf):
    d = _li(spark, sf).select(*LI_KEY_LIST, "l_extendedprice")
    return round_doubles(CL.cap_outliers_iqr(d, ["l_extendedprice"]))


@query("coerce_dates", """SELECT o_orderkey,
  strftime(try_strptime(CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'not a date'
                         ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d'), '%Y-%m-%d %H:%M:%S') AS order_ts
FROM orders""")
def coerce_dates_q(spark, sf):
    o = V.table(spark, sf, "orders")
    txt = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), F.lit("not a date")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    d = CL.coerce_dates(o.select("o_orderkey", txt.alias("order_ts")), ["order_ts"], "yyyy-MM-dd")
    return d.select("o_orderkey", F.date_format("order_ts", "yyyy-MM-dd HH:mm:ss").alias("order_ts"))


NOTICE_COLS = ["공고번호", "공고제목", "발주처(수요기관)", "지역제한", "기초금액", "예정가격", "예가범위", "A값",
               "투찰률(%)", "참여업체수", "공고구분표시", "입찰일자"]


@query("null_profile", "WITH n AS (" + V.NOTICES_SQL + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({q(c)}) AS BIGINT) AS n_null FROM n" for c in NOTICE_COLS))
def null_profile_q(spark, sf):
    return CL.null_profile(V.notices(spark, sf))


@query("rows_with_nulls", "SELECT " + ", ".join(q(c) for c in ["공고번호", "예가범위", "투찰률(%)", "공고구분표시"]) +
       " FROM (" + V.NOTICES_SQL + ") WHERE " + " OR ".join(f"{q(c)} IS NULL" for c in NOTICE_COLS))
def rows_with_nulls_q(spark, sf):
    return CL.rows_with_nulls(V.notices(spark, sf)).select("공고번호", "예가범위", "투찰률(%)", "공고구분표시")


@query("cleaning_stats", """WITH l AS (SELECT *, CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE l_quantity END AS q FROM lineitem),
f AS (SELECT * FROM l WHERE q IS NOT NULL),
d AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_extendedprice) = 1),
a AS (SELECT l_returnflag, count(*) AS n FROM l GROUP BY 1), b AS (SELECT l_returnflag, count(*) AS n FROM f GROUP BY 1),
c AS (SELECT l_returnflag, count(*) AS n FROM d GROUP BY 1)
SELECT a.l_returnflag, a.n AS rows_before, coalesce(c.n, 0) AS rows_after, 12 AS cols_before, 12 AS cols_after,
       a.n - coalesce(b.n, 0) AS nulls_removed, coalesce(b.n, 0) - coalesce(c.n, 0) AS duplicates_removed
FROM a LEFT JOIN b USING (l_returnflag) LEFT JOIN c USING (l_returnflag)""")
def cleaning_stats_q(spark, sf):
    """C14 on lines whose quantity is missing in every seventh line number, then one line per order."""
    li = _li(spark, sf).withColumn("q", F.when(F.col("l_linenumber") % 7 != 0, F.col("l_quantity")))
    full = CL.drop_null_keys(li, ["q"])
    return CL.cleaning_stats(li, full, CL.dedupe_keep_first(full, ["l_orderkey"], list(V.BID_ORDER)), "l_returnflag")


STRING_NOTICE_COLS = ["공고제목", "발주처(수요기관)", "지역제한", "예가범위", "공고구분표시"]


@query("cardinality_profile", "WITH n AS (" + V.NOTICES_SQL + ")\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {q(c)}) AS BIGINT) AS n_distinct FROM n"
    for c in STRING_NOTICE_COLS))
def cardinality_profile_q(spark, sf):
    return cardinality_profile(V.notices(spark, sf), STRING_NOTICE_COLS)


@query("distinct_notices", "SELECT DISTINCT l_orderkey AS \"공고번호\" FROM lineitem")
def distinct_notices_q(spark, sf):
    return V.bids(spark, sf).select("공고번호").distinct()


FIRST_FIELDS = "공고번호,기초대비 사정률(%),l_linenumber,l_partkey,l_suppkey"


@query("collection_profile", f"""SELECT 'bids' AS collection, count(*) AS n_documents, 6 AS n_fields, '{FIRST_FIELDS}' AS first_fields,
       count(DISTINCT l_orderkey) AS n_notices, count(*) = 0 AS is_empty FROM lineitem""")
def collection_profile_q(spark, sf):
    from tenderlens.sources.store import collection_profile
    return collection_profile(V.bids(spark, sf), "bids", key="공고번호")
