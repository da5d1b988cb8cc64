"""Queries of the scalar and feature operators."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import functions as F

from tenderlens.functions import expr as X
from tenderlens.operators import encode as EN
from tenderlens.operators import reduce as RD
from tenderlens.operators import scale as SC
from tenderlens.operators import select as SEL
from tenderlens.operators import text as TX
from tenderlens.plans import tender as TP
from tenderlens.plans.catalog import q, query, r, round_doubles
from tenderlens.roles import TenderColumns
from tenderlens.sources import views as V

C = TenderColumns()
LI_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
LI_KEY_LIST = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
DOC_NORM_SQL = "lower(regexp_replace(coalesce(text, ''), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'))"
TOKENS_SQL = f"regexp_extract_all({DOC_NORM_SQL}, '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def _li(spark, sf):
    return V.table(spark, sf, "lineitem")


@query("log1p_strict", f"SELECT {LI_KEYS}, {r('ln(1 + l_extendedprice)')} AS log_price FROM lineitem")
def log1p_strict_q(spark, sf):
    li = _li(spark, sf)
    return round_doubles(li.select(*LI_KEY_LIST, X.log1p_strict("l_extendedprice").alias("log_price")))


@query("log1p_shifted", f"""WITH s AS (SELECT min(value - 50) AS mn FROM events)
SELECT event_id, {r('ln(1 + (value - 50) + CASE WHEN mn <= 0 THEN abs(mn) + 1 ELSE 0 END)')}
       AS norm_log_centred FROM events, s""")
def log1p_shifted_q(spark, sf):
    e = V.table(spark, sf, "events").select("event_id", (F.col("value") - 50).alias("centred"))
    return round_doubles(SC.log1p_shifted(e, ["centred"]).select("event_id", "norm_log_centred"))


@query("price_ratios", f"""SELECT {LI_KEYS},
  {r('coalesce(l_extendedprice / nullif(l_discount, 0), 0)')} AS price_per_discount,
  {r('coalesce(l_tax / nullif(l_discount, 0), 0)')} AS tax_per_discount,
  {r('coalesce(l_extendedprice / nullif(l_quantity, 0), 0)')} AS unit_price
FROM lineitem""")
def price_ratios_q(spark, sf):
    li = _li(spark, sf)
    return round_doubles(li.select(*LI_KEY_LIST,
                                   X.safe_ratio("l_extendedprice", "l_discount").alias("price_per_discount"),
                                   X.safe_ratio("l_tax", "l_discount").alias("tax_per_discount"),
                                   X.safe_ratio("l_extendedprice", "l_quantity").alias("unit_price")))


@query("win_price_ratio", f"""SELECT {LI_KEYS}, {r('l_tax / nullif(l_discount, 0)')} AS win_price_ratio FROM lineitem""")
def win_price_ratio_q(spark, sf):
    li = _li(spark, sf)
    return round_doubles(li.select(*LI_KEY_LIST, X.safe_ratio("l_tax", "l_discount", False).alias("win_price_ratio")))


PAIR_COLS = ["norm_log_l_quantity", "norm_log_l_extendedprice", "norm_log_l_tax"]


def _pair_name(a: str) -> str:
    return a.split("_", 2)[2]


@query("pairwise_ratio_diff", "WITH t AS (SELECT " + LI_KEYS + ", " + ", ".join(
    f"ln(1 + {c[len('norm_log_'):]}) AS {c}" for c in PAIR_COLS) + " FROM lineitem)\nSELECT " + LI_KEYS + ", " + ", ".join(
    f"{r(f'coalesce({a} / nullif({b}, 0), 0)')} AS {q('ratio_' + _pair_name(a) + '_' + _pair_name(b))}, "
    f"{r(f'{a} - {b}')} AS {q('diff_' + _pair_name(a) + '_' + _pair_name(b))}"
    for a, b in permutations(PAIR_COLS, 2) if PAIR_COLS.index(a) < PAIR_COLS.index(b)) + " FROM t")
def pairwise_ratio_diff_q(spark, sf):
    from tenderlens.operators.combine import pairwise_ratio_diff
    li = _li(spark, sf)
    d = li.select(*LI_KEY_LIST, *[F.log1p(c[len("norm_log_"):]).alias(c) for c in PAIR_COLS])
    return round_doubles(pairwise_ratio_diff(d, PAIR_COLS).drop(*PAIR_COLS))


@query("days_between", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  CAST(floor((epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate)) / 86400000000) AS BIGINT) AS days_ship_order
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def days_between_q(spark, sf):
    from tenderlens.operators.skew import salted_join
    li = _li(spark, sf).select(*LI_KEY_LIST, "l_shipdate")
    o = V.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    # an order with a third of all lines is split over salts instead of one task
    j = salted_join(li, o, "l_orderkey")
    return j.select(*LI_KEY_LIST, X.days_between("l_shipdate", "o_orderdate").alias("days_ship_order"))


@query("date_parts", """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
  CAST(month(o_orderdate) AS INTEGER) AS o_orderdate_month, CAST(day(o_orderdate) AS INTEGER) AS o_orderdate_day,
  CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_weekday, CAST(quarter(o_orderdate) AS INTEGER) AS o_orderdate_quarter
FROM orders""")
def date_parts_q(spark, sf):
    o = V.table(spark, sf, "orders")
    return o.select("o_orderkey", *X.date_parts("o_orderdate", "o_orderdate"))


@query("text_length", "SELECT doc_id, CAST(length(coalesce(text, '')) AS INTEGER) AS text_length FROM documents")
def text_length_q(spark, sf):
    d = V.table(spark, sf, "documents")
    return d.select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("text_length"))


@query("normalize_text", f"SELECT doc_id, md5({DOC_NORM_SQL}) AS norm_md5, length({DOC_NORM_SQL}) AS norm_length FROM documents")
def normalize_text_q(spark, sf):
    d = V.table(spark, sf, "documents")
    n = X.normalize_text("text")
    return d.select("doc_id", F.md5(n).alias("norm_md5"), F.length(n).cast("long").alias("norm_length"))


@query("a_value_ratio", f"""SELECT "공고번호", {r('"A값" / (1 + ln(1 + "기초금액"))')} AS a_value_ratio
FROM ({V.NOTICES_SQL})""")
def a_value_ratio_q(spark, sf):
    n = V.notices(spark, sf)
    return round_doubles(n.select(C.key, X.a_value_ratio(C.a_value, F.log1p(C.base)).alias("a_value_ratio")))


@query("parse_target_name", """SELECT DISTINCT label, split_part(label, '_', 1) AS prefix,
  CAST(split_part(label, '_', 2) AS INTEGER) AS bin
FROM (SELECT printf('%03d_%03d', n, i) AS label
      FROM (SELECT unnest([10, 20, 50, 100]) AS n), LATERAL (SELECT unnest(range(1, n + 1)) AS i))""")
def parse_target_name_q(spark, sf):
    """F15 on the rows of the long target table (180 different labels)."""
    from tenderlens.plans.catalog_tender import _ctx
    n, b = _ctx(spark, sf)
    t = TP.calculate_target(TP.clean_notices(n), TP.parsed_bids(b))
    labels = t.unpivot([C.key], [c for c in t.columns if c != C.key], "label", "share")
    return labels.select("label", *X.parse_target_name("label")).distinct()


STD_COLS = ["l_quantity", "l_extendedprice", "l_tax"]


@query("standardize", "WITH s AS (SELECT l_returnflag, " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in STD_COLS) + " FROM lineitem GROUP BY l_returnflag)\n"
    "SELECT " + LI_KEYS + ", " + ", ".join(
        r(f"CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 0 ELSE ({c} - m_{c}) / s_{c} END") + f" AS {c}" for c in STD_COLS)
    + " FROM lineitem JOIN s USING (l_returnflag)")
def standardize_q(spark, sf):
    li = _li(spark, sf).select(*LI_KEY_LIST, "l_returnflag", *STD_COLS)
    return round_doubles(SC.standardize(li, STD_COLS, group="l_returnflag").drop("l_returnflag"))


SPLIT_SQL = "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 100 < 20"


@query("standardize_apply", f"""WITH o AS (SELECT o_orderkey, o_totalprice, {SPLIT_SQL} AS is_test FROM orders),
s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS sd FROM o WHERE NOT is_test)
SELECT o_orderkey, {r('CASE WHEN sd = 0 THEN 0 ELSE (o_totalprice - m) / sd END')} AS o_totalprice FROM o, s WHERE is_test""")
def standardize_apply_q(spark, sf):
    from tenderlens.operators.model import hash_split
    o = hash_split(V.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    train, test = o.filter(~F.col("is_test")), o.filter(F.col("is_test"))
    stats = SC.standard_stats(train, ["o_totalprice"])
    return round_doubles(SC.apply_standard(test, stats, ["o_totalprice"]).drop("is_test"))


MM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("minmax_scale", "WITH s AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in MM_COLS)
       + " FROM lineitem)\nSELECT " + LI_KEYS + ", " + ", ".join(
           r(f"CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE ({c} - lo_{c}) / (hi_{c} - lo_{c}) END") + f" AS {c}"
           for c in MM_COLS) + " FROM lineitem, s")
def minmax_scale_q(spark, sf):
    li = _li(spark, sf).select(*LI_KEY_LIST, *MM_COLS)
    return round_doubles(SC.minmax_scale(li, MM_COLS))


@query("multi_hot", f"""WITH n AS ({V.NOTICES_SQL})
SELECT "공고번호", """ + ", ".join(
    f"CAST(coalesce(list_contains(string_split(\"공고구분표시\", '/'), '{v}'), false) AS INTEGER) AS {q('공고구분표시_' + v)}"
    for v in ["AUTOMOBILE", "BUILDING", "F", "FURNITURE", "HOUSEHOLD", "MACHINERY", "O", "P"]) + " FROM n")
def multi_hot_q(spark, sf):
    n = V.notices(spark, sf).select(C.key, C.mark)
    return EN.multi_hot(n, C.mark).drop(C.mark)


def _positions_sql(c):
    return f"""(SELECT cell, string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) AS at FROM
  (SELECT DISTINCT {q(c)} AS cell, unnest(string_split({q(c)}, '/')) AS v FROM n) JOIN
  (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
    (SELECT DISTINCT unnest(string_split({q(c)}, '/')) AS v FROM n) WHERE v <> '') USING (v) GROUP BY cell)"""


@query("multi_hot_positions", f"""WITH n AS ({V.NOTICES_SQL})
SELECT n."공고번호", coalesce(a.at, '') AS agency_at, coalesce(m.at, '') AS mark_at FROM n
LEFT JOIN {_positions_sql(C.agency)} a ON n.{q(C.agency)} = a.cell
LEFT JOIN {_positions_sql(C.mark)} m ON n.{q(C.mark)} = m.cell""")
def multi_hot_positions_q(spark, sf):
    """G4 at any width: the positions of each notice's ones, joined by commas."""
    n = V.notices(spark, sf).select(C.key, C.agency, C.mark)
    d = EN.multi_hot_positions(EN.multi_hot_positions(n, C.agency), C.mark)
    return d.select(C.key, *[F.concat_ws(",", F.col(f"`{c}_hot`").cast("array<string>")).alias(name)
                             for c, name in ((C.agency, "agency_at"), (C.mark, "mark_at"))])


@query("one_hot_low_card", f"""SELECT {LI_KEYS}, l_returnflag, l_linestatus,
  CAST(l_returnflag = 'A' AS INTEGER) AS l_returnflag_A, CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N,
  CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R, CAST(l_linestatus = 'F' AS INTEGER) AS l_linestatus_F,
  CAST(l_linestatus = 'O' AS INTEGER) AS l_linestatus_O FROM lineitem""")
def one_hot_low_card_q(spark, sf):
    li = _li(spark, sf).select(*LI_KEY_LIST, "l_returnflag", "l_linestatus")
    return EN.one_hot_low_card(li)


@query("label_encode", """SELECT o_orderkey, o_orderpriority,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority_code FROM orders""")
def label_encode_q(spark, sf):
    o = V.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return EN.label_encode(o, "o_orderpriority")


@query("tfidf_top_terms", f"""WITH tok AS (SELECT doc_id, {TOKENS_SQL} AS w FROM documents),
terms AS (SELECT doc_id, unnest(w) AS term FROM tok
          UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM tok),
tf AS (SELECT doc_id, term, count(*) AS c FROM terms GROUP BY doc_id, term),
dfc AS (SELECT term, count(*) AS df, sum(c) AS tot FROM tf GROUP BY term),
n AS (SELECT count(*) AS n, sum(length(coalesce(text, ''))) AS chars FROM documents),
vocab AS (SELECT term, df FROM dfc, n WHERE df >= 2 AND n.n >= 30 AND n.chars > 100 ORDER BY tot DESC, term LIMIT 10),
w AS (SELECT tf.doc_id, tf.term, tf.c * (ln((1 + n.n) / (1 + v.df)) + 1) AS x FROM tf JOIN vocab v ON tf.term = v.term, n),
nr AS (SELECT doc_id, sqrt(sum(x * x)) AS nn FROM w GROUP BY doc_id)
SELECT d.doc_id, v.term, {r('coalesce(w.x / nr.nn, 0)')} AS tfidf
FROM documents d CROSS JOIN vocab v LEFT JOIN w ON w.doc_id = d.doc_id AND w.term = v.term
LEFT JOIN nr ON nr.doc_id = d.doc_id""")
def tfidf_top_terms_q(spark, sf):
    d = V.table(spark, sf, "documents")
    return round_doubles(TX.tfidf_long(d, "doc_id", "text"))


@query("embed_text", f"""WITH tok AS (SELECT doc_id, unnest({TOKENS_SQL}) AS t FROM documents),
c AS (SELECT doc_id, CAST(CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % 64 AS INTEGER) AS dim, count(*) AS c
      FROM tok GROUP BY ALL),
nr AS (SELECT doc_id, sqrt(sum(c * c)) AS nn FROM c GROUP BY doc_id)
SELECT c.doc_id, c.dim, {r('c.c / nr.nn')} AS value FROM c JOIN nr ON c.doc_id = nr.doc_id""")
def embed_text_q(spark, sf):
    d = V.table(spark, sf, "documents")
    return round_doubles(TX.embed_text_long(d, "doc_id", "text", 64))


def _counting_encoder():
    """A stand-in for a model: code points, words of Latin letters and capitals of each text."""
    import re

    def encode(texts):
        return [[len(t), len(re.findall("[A-Za-z]+", t)), len(re.findall("[A-Z]", t))] for t in texts]
    return encode


@query("embed_plugin", """WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, CAST(length(text) AS DOUBLE) AS embedding_0, CAST(len(regexp_extract_all(text, '[A-Za-z]+')) AS DOUBLE) AS embedding_1,
       CAST(len(regexp_extract_all(text, '[A-Z]')) AS DOUBLE) AS embedding_2 FROM t""")
def embed_plugin_q(spark, sf):
    """A user's encoder over the whole texts, in batches of 32, its vectors as columns."""
    d = TX.embed_with(V.table(spark, sf, "documents"), "doc_id", "text", _counting_encoder, 3)
    return RD.expand_array(d, "embedding", 3)


@query("expand_array", "SELECT vec_id, " + ", ".join(f"{r(f'embedding[{i + 1}]')} AS embedding_{i}" for i in range(64))
       + " FROM embeddings")
def expand_array_q(spark, sf):
    e = V.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return round_doubles(RD.expand_array(e, "embedding", 64))


@query("truncate_vector", "SELECT vec_id, " + ", ".join(f"{r(f'embedding[{i + 1}]')} AS embedding_{i}" for i in range(10))
       + " FROM embeddings")
def truncate_vector_q(spark, sf):
    e = V.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return round_doubles(RD.expand_array(RD.truncate_vector(e, "embedding", 10), "embedding", 10))


SEL_FEATS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]


@query("select_k_best", "WITH s AS (SELECT count(l_extendedprice) AS n, " + ", ".join(
    f"corr({c}, l_extendedprice) AS c_{c}" for c in SEL_FEATS) + " FROM lineitem)\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, n, {r(f'c_{c}')} AS r, {r(f'c_{c} * c_{c} / (1 - c_{c} * c_{c}) * (n - 2)')} AS f_score FROM s"
    for c in SEL_FEATS))
def select_k_best_q(spark, sf):
    """G11 scores; ``select_k_best`` then copies the k best as ``selected_<c>``."""
    li = _li(spark, sf)
    return round_doubles(SEL.f_scores(li, SEL_FEATS, "l_extendedprice"))


@query("pca_reduce", None)
def pca_reduce_q(spark, sf):
    e = V.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return round_doubles(RD.pca_reduce(e, "vec_id", "embedding", k=10, prefix="PCA_embedding"))


@query("pca_numeric", None)
def pca_numeric_q(spark, sf):
    li = _li(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    li = li.withColumn("row_key", F.concat_ws(":", "l_orderkey", "l_linenumber")).drop("l_orderkey")
    return round_doubles(RD.pca_numeric(li, "row_key", ["l_linenumber", "l_quantity", "l_extendedprice",
                                                       "l_discount", "l_tax"], k=3))


@query("svd_reduce", None)
def svd_reduce_q(spark, sf):
    e = V.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return round_doubles(RD.svd_reduce(e, "vec_id", "embedding", k=10, prefix="SVD_embedding"))


@query("reduced_text_features", None)
def reduced_text_features_q(spark, sf):
    d = V.table(spark, sf, "documents")
    return round_doubles(TX.reduced_text_features(d, "doc_id", "text", k=20, dim=64))


@query("knn_graph", f"""WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS neighbor_id, round(list_distance(a.v, b.v) * 1e9) / 1e9 AS distance
      FROM e AS a JOIN e AS b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank,
       neighbor_id, {r('distance')} AS distance FROM d
QUALIFY rank <= 15""")
def knn_graph_q(spark, sf):
    """The 15 nearest other vectors of every vector whose id is divisible by 20, against all vectors."""
    from tenderlens.operators.neighbors import knn_join
    e = V.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return round_doubles(knn_join(e.where("vec_id % 20 = 0"), e, 15, "vec_id", "vec_id", "embedding", other=True))
