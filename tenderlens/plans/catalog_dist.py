"""Queries of the empirical-distribution operators (I1-I10) on ``events.value``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlens.operators import ecdf as E
from tenderlens.plans.catalog import query, r, round_doubles
from tenderlens.sources import views as V


def _ev(spark, sf):
    return V.table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")


@query("prob_between", f"""SELECT event_type, {r('count_if(value BETWEEN 20 AND 80) / count(value)')} AS probability
FROM events GROUP BY event_type""")
def prob_between_q(spark, sf):
    return round_doubles(E.prob_between(_ev(spark, sf), "value", 80, 20, ["event_type"]))


@query("value_at_percentile", f"""SELECT event_type, {r('quantile_cont(value, 0.9)')} AS value
FROM events GROUP BY event_type""")
def value_at_percentile_q(spark, sf):
    return round_doubles(E.value_at_percentile(_ev(spark, sf), "value", 90, ["event_type"]))


@query("ecdf_table", f"""WITH vc AS (SELECT value, count(*) AS c FROM events WHERE value IS NOT NULL GROUP BY value)
SELECT {r('value')} AS value, c, CAST(sum(c) OVER (ORDER BY value) - c AS BIGINT) AS cum_lt,
       CAST(sum(c) OVER (ORDER BY value) AS BIGINT) AS cum_le, CAST(sum(c) OVER () AS BIGINT) AS n FROM vc""")
def ecdf_table_q(spark, sf):
    t = E.ecdf_table(_ev(spark, sf), "value")
    return round_doubles(t.select("value", "c", F.col("cum_lt").cast("long"), F.col("cum_le").cast("long"),
                                  F.col("n").cast("long")))


@query("ecdf_by_group", f"""WITH vc AS (SELECT event_type, value, count(*) AS c FROM events GROUP BY event_type, value)
SELECT event_type, {r('value')} AS value, c,
       CAST(sum(c) OVER (PARTITION BY event_type ORDER BY value) - c AS BIGINT) AS cum_lt,
       CAST(sum(c) OVER (PARTITION BY event_type ORDER BY value) AS BIGINT) AS cum_le,
       CAST(sum(c) OVER (PARTITION BY event_type) AS BIGINT) AS n FROM vc""")
def ecdf_by_group_q(spark, sf):
    t = E.ecdf_table(_ev(spark, sf), "value", ["event_type"])
    return round_doubles(t.select("event_type", "value", "c", F.col("cum_lt").cast("long"),
                                  F.col("cum_le").cast("long"), F.col("n").cast("long")))


@query("percentile_rank_of", f"""SELECT event_type, {r('count_if(value < 50) / count(value) * 100')} AS percentile_rank
FROM events GROUP BY event_type""")
def percentile_rank_of_q(spark, sf):
    return round_doubles(E.percentile_rank_of(_ev(spark, sf), "value", 50.0, ["event_type"]))


@query("percentile_ranks", f"""WITH p AS (SELECT DISTINCT round(avg(value), 2) AS probe FROM events GROUP BY user_id),
n AS (SELECT count(value) AS n FROM events)
SELECT {r('probe')} AS probe, {r('(SELECT count(*) FROM events e WHERE e.value < p.probe) / n.n * 100')} AS percentile_rank
FROM p, n""")
def percentile_ranks_q(spark, sf):
    """I4 for many probe values at once: every user's mean value ranked in the whole sample."""
    ev = _ev(spark, sf)
    probes = ev.groupBy("user_id").agg(F.round(F.avg("value"), 2).alias("probe")).select("probe")
    return round_doubles(E.percentile_ranks(ev, "value", probes, "probe"))


@query("symmetric_bounds", f"""WITH d AS (SELECT abs(value - 50) AS d, count(*) AS c FROM events GROUP BY 1),
cum AS (SELECT d, sum(c) OVER (ORDER BY d) AS cl, sum(c) OVER () AS n FROM d),
h AS (SELECT d, cl, n FROM cum WHERE cl >= 0.5 * n ORDER BY d LIMIT 1)
SELECT {r('50 - d')} AS lower, {r('50 + d')} AS upper, {r('cl / n')} AS probability FROM h""")
def symmetric_bounds_q(spark, sf):
    return round_doubles(E.symmetric_bounds(_ev(spark, sf), "value", 0.5, 50.0))


@query("basic_stats", f"""SELECT event_type, count(value) AS n, {r('avg(value)')} AS mean,
  {r('quantile_cont(value, 0.5)')} AS median, {r('stddev_pop(value)')} AS std, {r('min(value)')} AS min,
  {r('max(value)')} AS max, {r('quantile_cont(value, 0.25)')} AS q1, {r('quantile_cont(value, 0.75)')} AS q3
FROM events GROUP BY event_type""")
def basic_stats_q(spark, sf):
    return round_doubles(E.basic_stats(_ev(spark, sf), "value", ["event_type"]))


def _summary_sql() -> str:
    pct = ", ".join(f"quantile_cont(z, {p / 100}) AS p{p}" for p in E.SUMMARY_PERCENTILES)
    ints = ", ".join(f"count_if(z BETWEEN {a} AND {b}) / count(z) AS i{k}" for k, (a, b) in enumerate(E.SUMMARY_INTERVALS))
    rows = ["('n', n)", "('mean', mean)", "('median', median)", "('std', std)", "('min', mn)", "('max', mx)",
            "('q1', q1)", "('q3', q3)", "('iqr', q3 - q1)", "('skewness', sk)", "('kurtosis', ku)",
            "('jarque_bera', n / 6 * (sk * sk + ku * ku / 4))"]
    rows += [f"('percentile_{p}', p{p})" for p in E.SUMMARY_PERCENTILES]
    rows += [f"('interval_{a}~{b}', i{k})" for k, (a, b) in enumerate(E.SUMMARY_INTERVALS)]
    return f"""WITH s0 AS (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events),
z AS (SELECT (value - m) / sd AS z FROM events, s0),
mo AS (SELECT avg(z) AS mz FROM z),
s AS (SELECT CAST(count(z) AS DOUBLE) AS n, avg(z) AS mean, quantile_cont(z, 0.5) AS median, stddev_pop(z) AS std,
             min(z) AS mn, max(z) AS mx, quantile_cont(z, 0.25) AS q1, quantile_cont(z, 0.75) AS q3,
             avg(power(z - mz, 3)) / power(avg(power(z - mz, 2)), 1.5) AS sk,
             avg(power(z - mz, 4)) / power(avg(power(z - mz, 2)), 2) - 3 AS ku, {pct}, {ints}
      FROM z, mo)
SELECT v.stat, {r('v.value')} AS value FROM s, LATERAL (VALUES {", ".join(rows)}) AS v(stat, value)"""


@query("summary_stats", _summary_sql())
def summary_stats_q(spark, sf):
    """I7 on the standardised value (the fixed intervals are in standard units)."""
    from tenderlens.operators.scale import standardize
    ev = standardize(_ev(spark, sf), ["value"], out={"value": "z"})
    return round_doubles(E.summary_stats(ev, "z"))


@query("compare_samples", f"""WITH a AS (SELECT value FROM events WHERE event_type = 'click'),
b AS (SELECT value FROM events WHERE event_type = 'view'),
vc AS (SELECT value, sum(ca) AS ca, sum(cb) AS cb FROM (SELECT value, 1 AS ca, 0 AS cb FROM a
       UNION ALL SELECT value, 0, 1 FROM b) GROUP BY value),
cum AS (SELECT value, ca, cb, sum(ca) OVER (ORDER BY value) AS xa, sum(cb) OVER (ORDER BY value) AS xb,
               sum(ca) OVER () AS na, sum(cb) OVER () AS nb FROM vc),
st AS (SELECT max(abs(xa / na - xb / nb)) AS d,
              sum(ca * ((xa + xb) - (ca + cb) + (ca + cb + 1) / 2.0)) - max(na) * (max(na) + 1) / 2 AS u
       FROM cum),
m AS (SELECT (SELECT avg(value) FROM a) AS ma, (SELECT var_samp(value) FROM a) AS va, (SELECT count(*) FROM a) AS na,
             (SELECT avg(value) FROM b) AS mb, (SELECT var_samp(value) FROM b) AS vb, (SELECT count(*) FROM b) AS nb)
SELECT {r('d')} AS ks_d, {r('u')} AS mw_u, {r('(ma - mb) / sqrt(va / na + vb / nb)')} AS welch_t FROM st, m""")
def compare_samples_q(spark, sf):
    """I8 statistics on the full samples (p-values: ``ecdf.compare_samples``)."""
    ev = _ev(spark, sf)
    s = E.compare_statistics(ev.filter(F.col("event_type") == "click"), ev.filter(F.col("event_type") == "view"), "value")
    return round_doubles(s.select("ks_d", "mw_u", "welch_t"))


def hist_ctes(value_sql: str, src: str, bins: int = 100, p: str = "h") -> str:
    """CTEs of the equal-width histogram oracle (no WITH keyword, names prefixed)."""
    step = f"((hi - lo) / CAST({bins} AS DOUBLE))"
    idx = (f"CASE WHEN hi = lo THEN 1 ELSE 1 + len(list_filter(range(1, {bins}), "
           f"lambda i: CAST(i AS DOUBLE) * {step} + lo <= x)) END")
    return f"""{p}_d AS (SELECT {value_sql} AS x FROM {src}),
{p}_s AS (SELECT min(x) AS lo, max(x) AS hi FROM {p}_d),
{p}_c AS (SELECT {idx} AS bin, count(*) AS cnt FROM {p}_d, {p}_s WHERE x IS NOT NULL GROUP BY 1),
{p}_g AS (SELECT unnest(range(1, {bins + 1})) AS bin)"""


def hist_select(bins: int = 100, p: str = "h") -> str:
    step = f"((hi - lo) / CAST({bins} AS DOUBLE))"
    return f"""SELECT CAST(g.bin AS INTEGER) AS bin, {r(f'CAST(g.bin - 1 AS DOUBLE) * {step} + lo')} AS lower,
       {r(f'CASE WHEN g.bin = {bins} THEN hi ELSE CAST(g.bin AS DOUBLE) * {step} + lo END')} AS upper,
       coalesce(c.cnt, 0) AS count
FROM {p}_g g CROSS JOIN {p}_s LEFT JOIN {p}_c c ON c.bin = g.bin"""


def _hist_sql(value_sql: str, src: str, bins: int = 100) -> str:
    return f"WITH {hist_ctes(value_sql, src, bins)}\n{hist_select(bins)}"


@query("histogram", _hist_sql("value", "events"))
def histogram_q(spark, sf):
    return round_doubles(E.histogram(_ev(spark, sf), "value", 100))


@query("compare_pvalues", None)
def compare_pvalues_q(spark, sf):
    """I8: the p-values of the three tests on the full samples, one row per test."""
    ev = _ev(spark, sf)
    r_ = E.compare_samples(ev.filter(F.col("event_type") == "click"), ev.filter(F.col("event_type") == "view"), "value")
    rows = [("kolmogorov_smirnov", r_["ks_d"], r_["ks_p"]), ("mann_whitney", r_["mw_u"], r_["mw_p"]),
            ("welch", r_["welch_t"], r_["welch_p"])]
    return round_doubles(spark.createDataFrame(rows, "test string, statistic double, p_value double"))


@query("density_grid", f"""WITH st AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n,
  CASE WHEN stddev_samp(value) > 0 THEN stddev_samp(value) * pow(CAST(count(value) AS DOUBLE), -0.2) END AS bw FROM events),
cells AS (SELECT floor((value - lo) / (bw / 32.0)) AS k, count(*) AS wk, avg(value) AS cx FROM events, st
          WHERE value IS NOT NULL AND bw IS NOT NULL GROUP BY 1),
points AS (SELECT CAST(i AS INTEGER) AS point, lo - 3.0 * bw + i * ((hi - lo + 6.0 * bw) / 199.0) AS x, bw, n
           FROM st, range(200) t(i)),
masses AS (SELECT point, sum(wk * exp(-0.5 * pow((x - cx) / bw, 2))) AS mass FROM points, cells
           WHERE abs(x - cx) <= 8.0 * bw GROUP BY point)
SELECT points.point, {r('x')} AS x, {r('CASE WHEN bw IS NOT NULL THEN coalesce(mass, 0.0) / (n * bw * sqrt(2.0 * pi())) END')} AS density
FROM points LEFT JOIN masses ON points.point = masses.point""")
def density_grid_q(spark, sf):
    return round_doubles(E.density_grid(_ev(spark, sf), "value"))


def _wide_sql() -> str:
    from tenderlens.functions.expr import GRANULARITIES, target_name
    from tenderlens.plans.catalog import q
    bins = ", ".join(
        f"1 + len(list_filter(range(1, {n}), lambda i: CAST(i AS DOUBLE) * ((hi - lo) / CAST({n} AS DOUBLE)) + lo"
        f" <= value)) AS b{n}" for n in GRANULARITIES)
    shares = ", ".join(f"{r(f'count_if(b{n} = {i}) / count(*)')} AS {q(target_name(n, i))}"
                       for n in GRANULARITIES for i in range(1, n + 1))
    return f"""WITH e AS (SELECT user_id, value, CAST(0 AS DOUBLE) AS lo, CAST(500 AS DOUBLE) AS hi FROM events
                WHERE value IS NOT NULL),
b AS (SELECT user_id, {bins} FROM e)
SELECT user_id, {shares} FROM b GROUP BY user_id"""


@query("bin_shares_wide", _wide_sql())
def bin_shares_wide_q(spark, sf):
    """H5: per user, shares of values in equal-width bins of [0, 500] at all four granularities."""
    from tenderlens.operators import bins as B
    ev = _ev(spark, sf).filter(F.col("value").isNotNull()).select(
        "user_id", "value", F.lit(0).alias("lvl"), F.lit(0.0).alias("lo"), F.lit(500.0).alias("hi"))
    return round_doubles(B.bin_shares_wide(B.add_bin_columns(ev, "value", "lvl", "lo", "hi", {}), ["user_id"]))
