"""Driver tables seen as tender notices and bids.

The test tables hold no tenders, so notices are built from ``orders`` and
bids from ``lineitem`` with deterministic expressions. The same definitions
are kept as DuckDB SQL (``NOTICES_SQL``, ``BIDS_SQL``) for the oracle; both
sides use only integer arithmetic before the final double operations so the
two engines print and round alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlens.roles import TenderColumns

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def notices(spark: SparkSession, sf_dir: str, cols: TenderColumns = TenderColumns()) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # nation is a fixed 25-row dimension: broadcast is size-bounded by definition
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, F.col("c_nationkey") == n.n_nationkey, "left")
    k = F.col("o_orderkey")
    rng = (F.when(k % 101 == 0, F.lit(None).cast("string"))
           .when(F.col("o_orderstatus") == "F", F.lit(" +3% ~ -3%"))
           .when(F.col("o_orderstatus") == "O", F.lit("+2%~-2% "))
           .otherwise(F.lit("+0% ~ -6%")))
    return j.select(
        k.alias(cols.key),
        F.concat_ws(" ", "c_mktsegment", "n_name", "o_orderpriority").alias(cols.title),
        F.col("o_orderpriority").alias(cols.agency),
        F.col("n_name").alias(cols.region),
        F.col("o_totalprice").alias(cols.base),
        (F.col("o_totalprice") * (F.lit(97) + k % 7).cast("double") / 100).alias(cols.estimate),
        rng.alias(cols.range_text),
        (F.col("o_totalprice") * 5 / 100).alias(cols.a_value),
        F.when(k % 11 == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(170) + k % 13).cast("double") / 2).alias(cols.bid_rate),
        (F.col("o_custkey") % 50 + 2).cast("long").alias(cols.n_bidders),
        F.when(k % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat("c_mktsegment", F.lit("/"), "o_orderstatus")).alias(cols.mark),
        F.col("o_orderdate").alias("입찰일자"),
    )


# bids keep their input order through these columns (unique with the key)
BID_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def bids(spark: SparkSession, sf_dir: str, cols: TenderColumns = TenderColumns()) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    v = F.col("l_partkey") % 601 - 300          # hundredths of a percent
    av = F.abs(v)
    txt = F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")),
                   F.floor(av / 100).cast("long").cast("string"), F.lit("."),
                   F.lpad((av % 100).cast("string"), 2, "0"),
                   F.lit(" ("), F.col("l_linenumber").cast("string"), F.lit(")"))
    rate_text = F.when(F.col("l_linenumber") == 7, v.cast("string")).otherwise(txt)
    return li.select(F.col("l_orderkey").alias(cols.key), rate_text.alias(cols.rate_text), *BID_ORDER)


NOTICES_SQL = """
SELECT o.o_orderkey AS "공고번호",
       concat_ws(' ', c.c_mktsegment, n.n_name, o.o_orderpriority) AS "공고제목",
       o.o_orderpriority AS "발주처(수요기관)",
       n.n_name AS "지역제한",
       o.o_totalprice AS "기초금액",
       o.o_totalprice * CAST(97 + o.o_orderkey % 7 AS DOUBLE) / 100 AS "예정가격",
       CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
            WHEN o.o_orderstatus = 'F' THEN ' +3% ~ -3%'
            WHEN o.o_orderstatus = 'O' THEN '+2%~-2% '
            ELSE '+0% ~ -6%' END AS "예가범위",
       o.o_totalprice * 5 / 100 AS "A값",
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
            ELSE CAST(170 + o.o_orderkey % 13 AS DOUBLE) / 2 END AS "투찰률(%)",
       CAST(o.o_custkey % 50 + 2 AS BIGINT) AS "참여업체수",
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL
            ELSE concat(c.c_mktsegment, '/', o.o_orderstatus) END AS "공고구분표시",
       o.o_orderdate AS "입찰일자"
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

BIDS_SQL = """
SELECT l_orderkey AS "공고번호",
       CASE WHEN l_linenumber = 7 THEN CAST(l_partkey % 601 - 300 AS VARCHAR)
            ELSE concat(CASE WHEN l_partkey % 601 - 300 < 0 THEN '-' ELSE '' END,
                        CAST(abs(l_partkey % 601 - 300) // 100 AS VARCHAR), '.',
                        lpad(CAST(abs(l_partkey % 601 - 300) % 100 AS VARCHAR), 2, '0'),
                        ' (', CAST(l_linenumber AS VARCHAR), ')') END AS "기초대비 사정률(%)",
       l_linenumber, l_partkey, l_suppkey, l_extendedprice
FROM lineitem
"""
