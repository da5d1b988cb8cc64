"""Queries of the tender plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlens.functions.expr import GRANULARITIES, parse_rate, range_bounds, range_level, target_name
from tenderlens.operators import bins as B
from tenderlens.plans import tender as TP
from tenderlens.plans.catalog import q, query, r, round_doubles, strip_sql
from tenderlens.roles import TenderColumns
from tenderlens.sources import views as V

C = TenderColumns()
KEY = q(C.key)
ORDER = ", ".join(V.BID_ORDER)

# ---------------------------------------------------------------- SQL pieces
NT_SQL = f"""
nt0 AS (SELECT * FROM ({V.NOTICES_SQL}) WHERE {KEY} IS NOT NULL AND {q(C.range_text)} IS NOT NULL),
ntm AS (SELECT avg({q(C.bid_rate)}) AS m FROM nt0),
nt AS (SELECT {KEY}, {q(C.title)}, {strip_sql(q(C.agency))} AS {q(C.agency)},
              {strip_sql(q(C.region))} AS {q(C.region)}, {q(C.base)}, {q(C.estimate)},
              {strip_sql(q(C.range_text))} AS {q(C.range_text)}, {q(C.a_value)},
              coalesce({q(C.bid_rate)}, ntm.m) AS {q(C.bid_rate)}, {q(C.n_bidders)},
              {strip_sql(f"coalesce({q(C.mark)}, '')")} AS {q(C.mark)}
       FROM nt0, ntm
       QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY {KEY}) = 1)"""

PB_SQL = f"""
pb0 AS (SELECT {KEY},
               try_cast(nullif(regexp_extract({q(C.rate_text)}, '(-?[0-9]+\\.[0-9]+)', 1), '') AS DOUBLE) AS {q(C.rate)},
               {ORDER}
        FROM ({V.BIDS_SQL})),
pb AS (SELECT * FROM pb0 WHERE {KEY} IS NOT NULL AND {q(C.rate)} IS NOT NULL)"""

NB_SQL = """
nb0 AS (SELECT {key},
               CASE WHEN trim({rng}) = '+3%~-3%' THEN 3 WHEN trim({rng}) = '+2%~-2%' THEN 2 ELSE 0 END AS lvl,
               list_transform(regexp_extract_all({rng}, '([-+]?[0-9]+(?:\\.[0-9]+)?)%', 1),
                              lambda s: CAST(s AS DOUBLE)) AS pc
        FROM nt),
nb AS (SELECT {key}, lvl, CASE WHEN len(pc) = 2 THEN list_min(pc) END AS lo,
              CASE WHEN len(pc) = 2 THEN list_max(pc) END AS hi
       FROM nb0)""".format(key=KEY, rng=q(C.range_text))


def bin_sql(x: str, n: int) -> str:
    fixed = (f"1 + len(list_filter(range(1, {n}), lambda i: ((CAST(i AS DOUBLE) * ((CAST(lvl AS DOUBLE) "
             f"- CAST(-lvl AS DOUBLE)) / CAST({n} AS DOUBLE)) + CAST(-lvl AS DOUBLE)) / 100) * 100 <= {x}))")
    equal = (f"1 + len(list_filter(range(1, {n}), lambda i: CAST(i AS DOUBLE) * ((hi - lo) / CAST({n} AS DOUBLE))"
             f" + lo <= {x}))")
    return f"CAST(CASE WHEN lvl IN (2, 3) THEN {fixed} ELSE {equal} END AS INTEGER)"


BINNED_SQL = f"""
binned AS (SELECT pb.{KEY}, {ORDER}, nb.lvl, pb.{q(C.rate)},
                  {", ".join(f"{bin_sql(f'pb.{q(C.rate)}', n)} AS b{n}" for n in GRANULARITIES)}
           FROM pb JOIN nb ON pb.{KEY} = nb.{KEY}
           WHERE nb.lvl > 0 OR (nb.lo IS NOT NULL AND nb.lo < nb.hi))"""

def targets_sql(rounded: bool = True) -> str:
    rr = r if rounded else (lambda e: e)
    return f"""
targets AS (SELECT {KEY}, {", ".join(f"{rr(f'count_if(b{n} = {i}) / count(*)')} AS {q(target_name(n, i))}"
                                     for n in GRANULARITIES for i in range(1, n + 1))}
            FROM binned GROUP BY {KEY})"""


TARGETS_SQL = targets_sql(True)


def _ctx(spark, sf):
    return V.notices(spark, sf), V.bids(spark, sf)


# ---------------------------------------------------------------- queries
@query("parse_rate", f"""WITH {PB_SQL.strip().rstrip(',')}
SELECT {KEY}, {ORDER}, {r(q(C.rate))} AS {q(C.rate)} FROM pb0""")
def parse_rate_q(spark, sf):
    b = V.bids(spark, sf)
    return round_doubles(b.select(C.key, *V.BID_ORDER, parse_rate(C.rate_text).alias(C.rate)))


@query("strip_whitespace", f"""SELECT {KEY}, {strip_sql(q(C.range_text))} AS range_clean,
       {strip_sql(q(C.region))} AS region_clean, {strip_sql(q(C.mark))} AS mark_clean
FROM ({V.NOTICES_SQL})""")
def strip_whitespace_q(spark, sf):
    from tenderlens.functions.expr import strip_whitespace
    n = V.notices(spark, sf)
    return n.select(C.key, strip_whitespace(C.range_text).alias("range_clean"),
                    strip_whitespace(C.region).alias("region_clean"), strip_whitespace(C.mark).alias("mark_clean"))


@query("range_level", f"""WITH {NT_SQL.strip()}, {NB_SQL.strip()}
SELECT {KEY}, lvl AS range_level FROM nb""")
def range_level_q(spark, sf):
    nt = TP.clean_notices(V.notices(spark, sf))
    return nt.select(C.key, range_level(C.range_text).alias("range_level"))


@query("range_bounds", f"""WITH {NT_SQL.strip()}, {NB_SQL.strip()}
SELECT {KEY}, {r('lo')} AS lower_bound, {r('hi')} AS upper_bound, lo IS NOT NULL AS valid FROM nb""")
def range_bounds_q(spark, sf):
    nt = TP.clean_notices(V.notices(spark, sf))
    b = range_bounds(C.range_text)
    return round_doubles(nt.select(C.key, b["lower"].alias("lower_bound"), b["upper"].alias("upper_bound"),
                                   b["valid"].alias("valid")))


@query("drop_null_keys", f"""SELECT {KEY}, {q(C.range_text)}, {q(C.n_bidders)}
FROM ({V.NOTICES_SQL}) WHERE {KEY} IS NOT NULL AND {q(C.range_text)} IS NOT NULL""")
def drop_null_keys_q(spark, sf):
    from tenderlens.operators.clean import drop_null_keys
    return drop_null_keys(V.notices(spark, sf), [C.key, C.range_text]).select(C.key, C.range_text, C.n_bidders)


NOTICE_OUT = [C.key, C.agency, C.region, C.base, C.estimate, C.range_text, C.a_value, C.bid_rate,
              C.n_bidders, C.mark]


def _notice_out_sql(prefix: str = "") -> str:
    cols = []
    for c in NOTICE_OUT:
        if c in (C.base, C.estimate, C.a_value, C.bid_rate):
            cols.append(f"{r(prefix + q(c))} AS {q(c)}")
        else:
            cols.append(prefix + q(c))
    return ", ".join(cols)


@query("restructure", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()},
cnt AS (SELECT {KEY}, count(*) AS n_rates FROM pb GROUP BY {KEY})
SELECT {_notice_out_sql('nt.')}, cnt.n_rates FROM nt JOIN cnt ON nt.{KEY} = cnt.{KEY}""")
def restructure_q(spark, sf):
    n, b = _ctx(spark, sf)
    return round_doubles(TP.restructure(n, b).select(*NOTICE_OUT, "n_rates"))


@query("split_by_range", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()},
cnt AS (SELECT {KEY}, count(*) AS n_rates FROM pb GROUP BY {KEY}),
m AS (SELECT CASE WHEN {q(C.range_text)} = '+3%~-3%' THEN 'range3' WHEN {q(C.range_text)} = '+2%~-2%' THEN 'range2'
             ELSE 'others' END AS dataset, n_rates
      FROM nt JOIN cnt ON nt.{KEY} = cnt.{KEY})
SELECT dataset, count(*) AS n_notices, CAST(sum(n_rates) AS BIGINT) AS n_rates FROM m GROUP BY dataset""")
def split_by_range_q(spark, sf):
    n, b = _ctx(spark, sf)
    m = TP.separate(TP.restructure(n, b))
    return m.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_notices"), F.sum("n_rates").alias("n_rates"))


@query("group_to_list", f"""WITH {PB_SQL.strip()}
SELECT {KEY}, list({q(C.rate)} ORDER BY {ORDER}) AS {q(C.rate)} FROM pb GROUP BY {KEY}""")
def group_to_list_q(spark, sf):
    pb = TP.parsed_bids(V.bids(spark, sf), keep=V.BID_ORDER)
    return TP.group_to_list(pb, C.key, C.rate, list(V.BID_ORDER))


@query("equal_width_edges", f"""WITH {NT_SQL.strip()}, {NB_SQL.strip()},
bounds AS (SELECT DISTINCT lo, hi FROM nb WHERE lvl = 0 AND lo IS NOT NULL AND lo < hi),
g AS (SELECT unnest([10, 20, 50, 100]) AS n)
SELECT {r('lo')} AS lower_bound, {r('hi')} AS upper_bound, CAST(n AS INTEGER) AS n, CAST(i AS INTEGER) AS idx,
       {r('CAST(i AS DOUBLE) * ((hi - lo) / CAST(n AS DOUBLE)) + lo')} AS edge
FROM bounds, g, LATERAL (SELECT unnest(range(1, n)) AS i)""")
def equal_width_edges_q(spark, sf):
    nt = TP.clean_notices(V.notices(spark, sf))
    nb = TP.notice_bounds(nt).filter((F.col("__level") == 0) & F.col("__valid"))
    bounds = nb.select(F.col("__lower").alias("lower_bound"), F.col("__upper").alias("upper_bound")).distinct()
    rows = []
    for n in GRANULARITIES:
        rows.append(bounds.select("lower_bound", "upper_bound", F.lit(n).alias("n"),
                                  F.posexplode(B.equal_width_edges("lower_bound", "upper_bound", n)).alias("p", "edge")))
    u = rows[0]
    for x in rows[1:]:
        u = u.unionByName(x)
    return round_doubles(u.select("lower_bound", "upper_bound", "n", (F.col("p") + 1).cast("int").alias("idx"), "edge"))


def _binned(spark, sf):
    n, b = _ctx(spark, sf)
    nt = TP.clean_notices(n)
    pb = TP.parsed_bids(b, keep=V.BID_ORDER)
    nb = TP.notice_bounds(nt).filter((F.col("__level") > 0) | F.col("__valid"))
    j = pb.join(nb, C.key, "inner")
    return B.add_bin_columns(j, C.rate, "__level", "__lower", "__upper", TP.default_edges(spark))


@query("bin_index", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()}
SELECT {KEY}, {ORDER}, CAST(lvl AS INTEGER) AS range_level, {r(q(C.rate))} AS {q(C.rate)},
       b10, b20, b50, b100 FROM binned""")
def bin_index_q(spark, sf):
    d = _binned(spark, sf)
    return round_doubles(d.select(C.key, *V.BID_ORDER, F.col("__level").cast("int").alias("range_level"), C.rate,
                                  *[F.col(f"__b{n}").alias(f"b{n}") for n in GRANULARITIES]))


@query("calculate_target", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
{TARGETS_SQL.strip()}
SELECT * FROM targets""")
def calculate_target_q(spark, sf):
    n, b = _ctx(spark, sf)
    nt = TP.clean_notices(n)
    return round_doubles(TP.calculate_target(nt, TP.parsed_bids(b)))


@query("bin_shares_long", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
spine AS (SELECT {KEY}, count(*) AS total FROM binned GROUP BY {KEY}),
bins AS (SELECT unnest(range(1, 101)) AS bin),
cnt AS (SELECT {KEY}, b100 AS bin, count(*) AS c FROM binned GROUP BY {KEY}, b100)
SELECT s.{KEY}, 100 AS n, CAST(bins.bin AS INTEGER) AS bin, {r('coalesce(cnt.c, 0) / s.total')} AS share
FROM spine s CROSS JOIN bins LEFT JOIN cnt ON cnt.{KEY} = s.{KEY} AND cnt.bin = bins.bin""")
def bin_shares_long_q(spark, sf):
    d = _binned(spark, sf)
    wide = B.bin_shares_wide(d, [C.key], (100,))
    return round_doubles(B.wide_to_long(wide, [C.key], (100,)))


def _target_list_sql() -> str:
    return ", ".join(q(target_name(n, i)) for n in GRANULARITIES for i in range(1, n + 1))


@query("target_mass_check", f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
{TARGETS_SQL.strip()},
s AS (SELECT round({" + ".join(q(target_name(n, i)) for n in GRANULARITIES for i in range(1, n + 1))}, 6) AS total_share
      FROM targets)
SELECT total_share, count(*) AS n_notices FROM s GROUP BY total_share""")
def target_mass_check_q(spark, sf):
    """Row sum of the 180 shares (expected 4.0), then value counts."""
    n, b = _ctx(spark, sf)
    t = round_doubles(TP.calculate_target(TP.clean_notices(n), TP.parsed_bids(b)))
    from functools import reduce
    s = reduce(lambda a, c: a + c, [F.col(target_name(g, i)) for g in GRANULARITIES for i in range(1, g + 1)])
    return t.select(F.round(s, 6).alias("total_share")).groupBy("total_share").agg(
        F.count(F.lit(1)).alias("n_notices"))


# Fixed values for the oracle only: the category domains of the driver tables
# (order priorities without spaces, nation names, market segments and order
# statuses). The Spark side finds its categories from the data.
ORACLE_CATEGORIES = {
    C.agency: ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOTSPECIFIED", "5-LOW"],
    C.region: [f"NATION_{i}" for i in range(25)],
    C.mark: ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "F", "O", "P"],
}
NORMS = {C.base: "norm_log_기초금액", C.estimate: "norm_log_예정가격", C.bid_rate: "norm_log_투찰률(%)",
         C.a_value: "norm_A값/기초금액"}


def _transform_sql() -> str:
    lg = (f"SELECT m.*, ln(1 + {q(C.base)}) AS l0, ln(1 + {q(C.estimate)}) AS l1, ln(1 + {q(C.bid_rate)}) AS l2, "
          f"{q(C.a_value)} / (1 + ln(1 + {q(C.base)})) AS l3 FROM m")
    st = ", ".join(f"avg(l{i}) AS m{i}, stddev_pop(l{i}) AS s{i}" for i in range(4))
    norm = ", ".join(f"{r(f'CASE WHEN s{i} IS NULL OR s{i} = 0 THEN 0 ELSE (l{i} - m{i}) / s{i} END')} AS {q(name)}"
                     for i, name in enumerate(NORMS.values()))
    hots = ", ".join(f"CAST(list_contains(string_split({q(c)}, '/'), '{v}') AS INTEGER) AS {q(f'{c}_{v}')}"
                     for c, vals in ORACLE_CATEGORIES.items() for v in vals)
    return f"""WITH {NT_SQL.strip()}, {PB_SQL.strip()}, {NB_SQL.strip()}, {BINNED_SQL.strip()},
{TARGETS_SQL.strip()},
cnt AS (SELECT {KEY}, count(*) AS n_rates FROM pb GROUP BY {KEY}),
m AS (SELECT nt.*, CASE WHEN {q(C.range_text)} = '+3%~-3%' THEN 'range3'
                        WHEN {q(C.range_text)} = '+2%~-2%' THEN 'range2' ELSE 'others' END AS dataset
      FROM nt JOIN cnt ON nt.{KEY} = cnt.{KEY}),
lg AS ({lg}),
st AS (SELECT dataset, {st} FROM lg GROUP BY dataset)
SELECT lg.{KEY}, lg.{q(C.range_text)}, lg.dataset, {norm}, {hots}, targets.* EXCLUDE ({KEY})
FROM lg JOIN st ON lg.dataset = st.dataset JOIN targets ON targets.{KEY} = lg.{KEY}"""


TRANSFORM_SQL = _transform_sql()


@query("transform", TRANSFORM_SQL)
def transform_q(spark, sf):
    """H8 flagship: cleaned notices x parsed bids -> features + 180 targets per notice."""
    n, b = _ctx(spark, sf)
    return round_doubles(TP.transform(n, b))


@query("range_rejects", f"""WITH {NT_SQL.strip()}, {NB_SQL.strip()}
SELECT {KEY} FROM nb WHERE lvl = 0 AND NOT coalesce(lo < hi, false)""")
def range_rejects_q(spark, sf):
    """the notices that ``transform`` gives no targets, their range text having no pair of bounds."""
    return TP.range_rejects(TP.clean_notices(V.notices(spark, sf)))


@query("load_bin_edges", """WITH e AS (
  SELECT l_linenumber AS level, 11 AS n, l_discount AS upper,
         row_number() OVER (PARTITION BY l_linenumber ORDER BY l_discount DESC) AS seq
  FROM (SELECT DISTINCT l_linenumber, l_discount FROM lineitem)),
k AS (SELECT e.* FROM e JOIN (SELECT level, max(seq) AS last_seq FROM e GROUP BY level) m
      ON e.level = m.level AND e.seq < m.last_seq)
SELECT level, n, CAST(row_number() OVER (PARTITION BY level ORDER BY upper) AS INTEGER) AS idx, """ + r("upper * 100") + """ AS edge
FROM k""")
def load_bin_edges_q(spark, sf):
    """Edge rows as a file would hold them (here the discounts per line number, not sorted), last row dropped."""
    from pyspark.sql import Window

    from tenderlens.operators.bins import load_bin_edges
    d = V.table(spark, sf, "lineitem").select("l_linenumber", "l_discount").distinct()
    w = Window.partitionBy("l_linenumber").orderBy(F.col("l_discount").desc())
    table = d.select(F.col("l_linenumber").alias("level"), F.lit(11).alias("n"), F.col("l_discount").alias("upper"),
                     F.row_number().over(w).alias("seq"))
    return round_doubles(load_bin_edges(table))


@query("process_notices", TRANSFORM_SQL)
def process_notices_q(spark, sf):
    """H7 on the cleaned notices that have targets, the targets joined by key."""
    n, b = _ctx(spark, sf)
    nt = TP.clean_notices(n)
    targets = TP.calculate_target(nt, TP.parsed_bids(b))
    base = TP.separate(nt.join(targets.select(C.key), C.key, "left_semi"))
    return round_doubles(TP.process_notices(base, targets))


@query("transform_with_text", None)
def transform_with_text_q(spark, sf):
    """H8 with the title text features (hashed embedding -> PCA, 20 columns)."""
    n, b = _ctx(spark, sf)
    return round_doubles(TP.transform(n, b, text_features=20))
