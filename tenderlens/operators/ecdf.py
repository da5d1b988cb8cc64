"""Empirical-distribution operators (I1-I10) on any numeric column.

Order statistics come without a sorted copy of the column in one task. The
distributed ECDF table (I3) counts rows per distinct value, cuts the values of
each group into buckets of about ``BUCKET_ROWS`` (their number follows the data)
and sums counts inside buckets; a value held by a third of all rows is one row.
Exact quantiles need less: a sketch brackets each wanted rank, one pass counts
what lies outside the bracket, and only the values inside it are counted and
ordered. Null groups are groups; a group without values keeps its row, with
null statistics.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The summary's percentiles and closed intervals.
SUMMARY_PERCENTILES = (1, 5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 99)
SUMMARY_INTERVALS = ((-3, -2), (-2, -1), (-1, 0), (0, 1), (1, 2), (2, 3), (-0.5, 0.5), (-1, 1))


BUCKET_ROWS = 200_000   # distinct values that one window orders
SKETCH = 10_000         # a quantile's bracket holds about 4 / SKETCH of the rows
INSIDE = 20_000         # rows of a bracket that are counted value by value


def _same(group: list[str], left: str, right: str) -> Column:
    """Null-safe equality of the group columns of two aliased tables."""
    on = F.lit(True)
    for g in group:
        on = on & F.col(f"{left}.`{g}`").eqNullSafe(F.col(f"{right}.`{g}`"))
    return on


def with_groups(rows: DataFrame, groups: DataFrame, group: list[str], how: str = "inner") -> DataFrame:
    """Rows with the other columns of their group's row (without groups: one row, so broadcast)."""
    if not group:
        return rows.crossJoin(F.broadcast(groups))
    others = [c for c in groups.columns if c not in group]
    return (rows.alias("l").join(groups.alias("r"), _same(group, "l", "r"), how)
            .select("l.*", *[F.col(f"r.`{c}`") for c in others]))


def _x(value: str) -> F.Column:
    x = F.col(value).cast("double")
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def value_counts(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    group = group or []
    return (df.select(*group, _x(value).alias("value")).filter(F.col("value").isNotNull())
            .groupBy(*group, "value").agg(F.count(F.lit(1)).alias("c")))


def ecdf_table(df: DataFrame, value: str, group: list[str] | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(group..., value, c, cum_lt, cum_le, n) -- distributed prefix counts."""
    group = group or []
    vc = value_counts(df, value, group)
    return prefix_counts(vc, "value", ["c"], group, bucket_rows).withColumnRenamed(
        "cum_c", "cum_le").withColumn("cum_lt", F.col("cum_le") - F.col("c")).withColumnRenamed("tot_c", "n")


def prefix_counts(vc: DataFrame, value: str, counts: list[str], group: list[str] | None = None,
                  bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` of count columns in ``value`` order (per group).

    Adds ``tot_<c>`` (group totals). ``vc`` holds one row per distinct value. The
    largest group's number of values sets the number of buckets; each group is
    cut at its own quantiles, so a narrow group is spread like a wide one.
    """
    group = group or []
    most = vc.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = max(1, math.ceil(most / bucket_rows))
    if buckets > 1:
        cuts = vc.groupBy(*group).agg(F.percentile_approx(value, [i / buckets for i in range(1, buckets)],
                                                          max(SKETCH, 4 * buckets)).alias("__q"))
        b = with_groups(vc, cuts, group)
        b = b.withColumn("__bk", F.size(F.filter("__q", lambda q: q < F.col(value)))).drop("__q")
    else:
        b = vc.withColumn("__bk", F.lit(0))
    totals = b.groupBy(*group, "__bk").agg(*[F.sum(c).alias(f"__t_{c}") for c in counts])
    # offsets over (group x bucket) rows, windows per group
    wg = Window.partitionBy(*group).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*group)
    offs = totals.select(*group, "__bk",
                         *[F.coalesce(F.sum(f"__t_{c}").over(wg), F.lit(0)).alias(f"__o_{c}") for c in counts],
                         *[F.sum(f"__t_{c}").over(wt).alias(f"tot_{c}") for c in counts])
    wb = Window.partitionBy(*group, "__bk").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    inner = b.select("*", *[F.sum(c).over(wb).alias(f"__w_{c}") for c in counts])
    j = with_groups(inner, offs, [*group, "__bk"])
    return j.select(*group, value, *counts, *[(F.col(f"__o_{c}") + F.col(f"__w_{c}")).alias(f"cum_{c}")
                                              for c in counts], *[f"tot_{c}" for c in counts])


def prob_between(df: DataFrame, value: str, a: float, b: float, group: list[str] | None = None) -> DataFrame:
    """Share of values in the closed interval [min(a,b), max(a,b)]."""
    lo, hi = min(a, b), max(a, b)
    x = _x(value)
    g = df.groupBy(*(group or []))
    return g.agg(F.try_divide(F.count_if(x.between(lo, hi)), F.count(x)).alias("probability"))


def exact_quantiles(df: DataFrame, value: str, probs: list[float], group: list[str] | None = None,
                    accuracy: int = SKETCH) -> DataFrame:
    """Exact quantiles (linear interpolation, as pandas/numpy): (group..., p, value).

    A sketch of ``accuracy`` brackets each rank with room for its error. One
    aggregation counts the rows below each bracket and finds the values next to
    it; the values inside, a few rows in ``accuracy``, are counted and ordered.
    """
    group, probs = group or [], [float(p) for p in probs]
    if not group:
        found = column_quantiles(df, [value], probs, accuracy)[value]
        return df.sparkSession.createDataFrame([(p, found[p]) for p in dict.fromkeys(probs)], "p double, value double")
    rows = df.select(*group, _x(value).alias("__x"))
    around = [min(1.0, max(0.0, p + d / accuracy)) for p in probs for d in (-2, 2)]
    sketch = rows.groupBy(*group).agg(F.count("__x").alias("__n"),
                                      F.percentile_approx("__x", around, accuracy).alias("__q"))
    j = with_groups(rows, sketch, group)
    lo, hi = [F.col("__q")[2 * i] for i in range(len(probs))], [F.col("__q")[2 * i + 1] for i in range(len(probs))]
    x = F.col("__x")
    outside = j.groupBy(*group).agg(F.first("__n").alias("__n"), *[
        e for i in range(len(probs)) for e in (
            F.count_if(x < lo[i]).alias(f"__below{i}"), F.count_if(x.between(lo[i], hi[i])).alias(f"__in{i}"),
            F.max(F.when(x < lo[i], x)).alias(f"__under{i}"), F.min(F.when(x > hi[i], x)).alias(f"__above{i}"))])
    targets = outside.select(*group, "__n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("__i"), F.lit(p).alias("__p"), F.col(f"__below{i}").alias("__below"),
                 F.col(f"__in{i}").alias("__in"), F.col(f"__under{i}").alias("__under"),
                 F.col(f"__above{i}").alias("__above")) for i, p in enumerate(probs)])).alias("__t"))
    targets = targets.select(*group, "__n", "__t.*").withColumn("__h", F.col("__p") * F.greatest(F.col("__n") - 1, F.lit(0)))
    held = F.array(*[F.when(x.between(lo[i], hi[i]), F.struct(F.lit(i).alias("__i"), x.alias("__v")))
                     for i in range(len(probs))])
    inside = (j.select(*group, F.explode(F.filter(held, lambda e: e.isNotNull())).alias("__e")).select(*group, "__e.*")
              .groupBy(*group, "__i", "__v").agg(F.count(F.lit(1)).alias("__c")))
    upto = Window.partitionBy(*group, "__i").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("__cum", F.sum("__c").over(upto))
    ranks = {"lo": F.floor("__h"), "hi": F.ceil("__h")}
    met = with_groups(inside, targets.select(*group, "__i", "__below", "__h"), [*group, "__i"])
    last = F.col("__below") + F.col("__cum")
    here = {k: (last - F.col("__c") <= r) & (r < last) for k, r in ranks.items()}
    found = met.where(here["lo"] | here["hi"]).groupBy(*group, "__i").agg(
        *[F.max(F.when(here[k], F.col("__v"))).alias(f"__x_{k}") for k in ranks])
    t = with_groups(targets, found, [*group, "__i"], "left")
    at = {k: F.when(r < F.col("__below"), F.col("__under"))
          .when(r >= F.col("__below") + F.col("__in"), F.col("__above"))
          .otherwise(F.col(f"__x_{k}")) for k, r in ranks.items()}
    quantile = at["lo"] + (F.col("__h") - F.floor("__h")) * (at["hi"] - at["lo"])
    return t.select(*group, F.col("__p").alias("p"), F.when(F.col("__n") > 0, quantile).alias("value"))


def quantile_columns(df: DataFrame, value: str, named: dict[str, float], group: list[str] | None = None) -> DataFrame:
    """One row per group with a column per named probability."""
    group = group or []
    q = exact_quantiles(df, value, list(dict.fromkeys(named.values())), group)
    return q.groupBy(*group).agg(*[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(k)
                                   for k, p in named.items()])


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], accuracy: int | None = None,
                     limit: int | None = None) -> dict[str, dict[float, float | None]]:
    """Exact quantiles of several columns as numbers on the driver (columns x probabilities of them).

    A sketch of all columns brackets every wanted rank; a second scan counts what lies
    below and inside the brackets. A bracket with more than ``limit`` rows is sketched
    again within itself, so that whatever the number of rows, at most ``limit`` different
    values per bracket are counted one by one in the last scan.
    """
    probs, accuracy, limit = [float(p) for p in dict.fromkeys(probs)], accuracy or SKETCH, limit or INSIDE
    out: dict[str, dict[float, float | None]] = {c: dict.fromkeys(probs) for c in cols}
    if not cols or not probs:
        return out
    rows = df.select(*[_x(c).alias(f"x{i}") for i, c in enumerate(cols)])
    x = [F.col(f"x{i}") for i in range(len(cols))]
    around = [min(1.0, max(0.0, p + d / accuracy)) for p in probs for d in (-2, 2)]
    first = rows.agg(*[e for i, v in enumerate(x) for e in (F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                                                           F.percentile_approx(v, around, accuracy).alias(f"q{i}"))]).first()
    wanted: dict[tuple[int, int], dict] = {}
    for i in range(len(cols)):
        for j, p in enumerate(probs):
            n = first[f"n{i}"]
            if n:
                h = p * (n - 1)
                wanted[i, j] = {"h": h, "ranks": (math.floor(h), math.ceil(h)), "lo": first[f"q{i}"][2 * j], "hi": first[f"q{i}"][2 * j + 1],
                                "least": first[f"lo{i}"], "most": first[f"hi{i}"]}
    open_ = dict(wanted)
    while open_:
        seen = rows.agg(*[e for k, ((i, _), w) in enumerate(open_.items()) for e in (
            F.count_if(x[i] < w["lo"]).alias(f"below{k}"), F.count_if(x[i].between(w["lo"], w["hi"])).alias(f"in{k}"))]).first()
        again = {}
        for k, (at, w) in enumerate(open_.items()):
            w["below"], w["in"] = seen[f"below{k}"], seen[f"in{k}"]
            if w["ranks"][0] < w["below"]:  # the sketch was off: the bracket opens on that side
                again[at] = w | {"lo": w["least"]}
            elif w["ranks"][1] >= w["below"] + w["in"]:
                again[at] = w | {"hi": w["most"]}
            elif w["in"] > limit and w["lo"] < w["hi"]:
                again[at] = w
            wanted[at] = again.get(at, w)
        wide = {at: w for at, w in again.items() if w["in"] > limit and w["lo"] < w["hi"]}
        if wide:
            def share(w: dict, d: int) -> float:
                return min(1.0, max(0.0, (w["ranks"][d > 0] - w["below"]) / max(1, w["in"] - 1) + d / accuracy))

            inner = rows.agg(*[F.percentile_approx(F.when(x[at[0]].between(w["lo"], w["hi"]), x[at[0]]), [share(w, -2), share(w, 2)], accuracy)
                               .alias(f"q{k}") for k, (at, w) in enumerate(wide.items())]).first()
            for k, (at, w) in enumerate(wide.items()):
                lo, hi = inner[f"q{k}"]
                if (lo, hi) == (w["lo"], w["hi"]):  # no narrower: equal values at both ends fill it
                    w["done"] = True
                w["lo"], w["hi"] = lo, hi
        open_ = {at: w for at, w in again.items() if not w.pop("done", False)}
    held = F.array(*[F.when(x[i].between(w["lo"], w["hi"]), F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), x[i].alias("v")))
                     for (i, j), w in wanted.items()]) if wanted else None
    values: dict[tuple[int, int], list] = {}
    if wanted:
        for r in (rows.select(F.explode(F.filter(held, lambda e: e.isNotNull())).alias("e")).groupBy("e.i", "e.j", "e.v")
                  .agg(F.count(F.lit(1)).alias("c")).collect()):  # at most `limit` values per bracket
            values.setdefault((r["i"], r["j"]), []).append((r["v"], r["c"]))
    for (i, j), w in wanted.items():
        upto, found = w["below"], {}
        for v, c in sorted(values[i, j]):
            for rank in w["ranks"]:
                if upto <= rank < upto + c:
                    found[rank] = v
            upto += c
        lo, hi = (found[rank] for rank in w["ranks"])
        out[cols[i]][probs[j]] = lo + (w["h"] - w["ranks"][0]) * (hi - lo)
    return out


def value_at_percentile(df: DataFrame, value: str, p: float, group: list[str] | None = None,
                        accuracy: int | None = None) -> DataFrame:
    """Value at percentile ``p`` (0..100), exact; ``accuracy`` asks for ``percentile_approx`` instead."""
    if accuracy:
        return df.groupBy(*(group or [])).agg(F.percentile_approx(_x(value), p / 100.0, accuracy).alias("value"))
    return exact_quantiles(df, value, [p / 100.0], group).drop("p")


def percentile_rank_of(df: DataFrame, value: str, v: float, group: list[str] | None = None) -> DataFrame:
    """I4: share strictly below ``v``, times 100."""
    x = _x(value)
    return df.groupBy(*(group or [])).agg((F.try_divide(F.count_if(x < v), F.count(x)) * 100).alias("percentile_rank"))


def percentile_ranks(df: DataFrame, value: str, probes: DataFrame, probe_col: str) -> DataFrame:
    """I4 for a table of probe values: probes join the value counts with weight 0,
    so one distributed prefix count answers all of them (no per-probe scan)."""
    vc = value_counts(df, value).withColumn("__probe", F.lit(False))
    pr = probes.select(F.col(probe_col).cast("double").alias("value")).distinct().select(
        "value", F.lit(0).cast("long").alias("c"), F.lit(True).alias("__probe"))
    u = vc.unionByName(pr).groupBy("value").agg(F.sum("c").alias("c"), F.max("__probe").alias("__probe"))
    pc = prefix_counts(u.withColumn("__p", F.col("__probe").cast("int")), "value", ["c"])
    below = F.col("cum_c") - F.col("c")
    return pc.join(u.select("value", "__probe"), "value").filter("__probe").select(
        F.col("value").alias(probe_col), (below / F.col("tot_c") * 100).alias("percentile_rank"))


def symmetric_bounds(df: DataFrame, value: str, p: float, center: float = 0.0) -> DataFrame:
    """Narrowest symmetric [c - h, c + h] holding at least share ``p``.

    h is the discrete quantile of |x - c|: the smallest deviation d with
    share(|x - c| <= d) >= p, found on the distributed ECDF of deviations.
    """
    dev = df.select(F.abs(_x(value) - F.lit(float(center))).alias("d"))
    e = ecdf_table(dev, "d")
    hit = e.filter(F.col("cum_le") >= F.lit(p) * F.col("n")).agg(
        F.min_by(F.struct("value", "cum_le", "n"), "value").alias("h"))
    return hit.select((F.lit(float(center)) - F.col("h.value")).alias("lower"),
                      (F.lit(float(center)) + F.col("h.value")).alias("upper"),
                      (F.col("h.cum_le") / F.col("h.n")).alias("probability"))


def basic_stats(df: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """N, mean, median, population std, min, max, Q1, Q3."""
    x, group = _x(value), group or []
    moments = df.groupBy(*group).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"),
                                     F.min(x).alias("min"), F.max(x).alias("max"))
    found = with_groups(moments, quantile_columns(df, value, {"median": 0.5, "q1": 0.25, "q3": 0.75}, group), group)
    return found.select(*group, "n", "mean", "median", "std", "min", "max", "q1", "q3")


def summary_stats(df: DataFrame, value: str, intervals=SUMMARY_INTERVALS,
                  percentiles=SUMMARY_PERCENTILES) -> DataFrame:
    """Long (stat, value) summary: one aggregation of moments, all quantiles in one call, then ``stack``.

    Skewness and excess kurtosis are the population moment forms; the sampled
    Shapiro-Wilk p-value is replaced by Jarque-Bera from the same moments.
    """
    x = _x(value)
    aggs = [F.count(x).cast("double").alias("n"), F.avg(x).alias("mean"),
            F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
            F.skewness(x).alias("skewness"), (F.kurtosis(x)).alias("kurtosis")]
    aggs += [F.try_divide(F.count_if(x.between(a, b)), F.count(x)).alias(f"i{k}") for k, (a, b) in enumerate(intervals)]
    named = {"median": 0.5, "q1": 0.25, "q3": 0.75, **{f"p{p}": p / 100.0 for p in percentiles}}
    w = with_groups(df.agg(*aggs), quantile_columns(df, value, named), [])
    w = w.withColumn("iqr", F.col("q3") - F.col("q1")).withColumn(
        "jarque_bera", F.col("n") / 6 * (F.col("skewness") * F.col("skewness")
                                         + F.col("kurtosis") * F.col("kurtosis") / 4))
    names = ["n", "mean", "median", "std", "min", "max", "q1", "q3", "iqr", "skewness", "kurtosis", "jarque_bera"]
    pairs = [(nm, nm) for nm in names] + [(f"p{p}", f"percentile_{p}") for p in percentiles] + \
        [(f"i{k}", f"interval_{a}~{b}") for k, (a, b) in enumerate(intervals)]
    stack = ", ".join(f"'{label}', CAST({col} AS DOUBLE)" for col, label in pairs)
    return w.selectExpr(f"stack({len(pairs)}, {stack}) AS (stat, value)")


def jarque_bera_pvalue(jb: float) -> float:
    return math.exp(-jb / 2.0)  # chi-square with 2 degrees of freedom


def compare_statistics(a: DataFrame, b: DataFrame, value: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """I8 statistics on full data: KS D, Mann-Whitney U (average ranks), Welch t.

    One combined value-count table with a count per sample, distributed
    prefix sums of both, then single aggregations.
    """
    va = value_counts(a, value).withColumnRenamed("c", "ca").withColumn("cb", F.lit(0))
    vb = value_counts(b, value).withColumnRenamed("c", "cb").withColumn("ca", F.lit(0))
    vc = va.unionByName(vb).groupBy("value").agg(F.sum("ca").alias("ca"), F.sum("cb").alias("cb"))
    pc = prefix_counts(vc, "value", ["ca", "cb"], bucket_rows=bucket_rows)
    na, nb = F.col("tot_ca").cast("double"), F.col("tot_cb").cast("double")
    # average rank of the tied block at this value over both samples
    cum_all = F.col("cum_ca") + F.col("cum_cb")
    blk = F.col("ca") + F.col("cb")
    avg_rank = cum_all - blk + (blk + 1) / 2.0
    t = pc.agg(F.max(F.abs(F.try_divide(F.col("cum_ca"), na) - F.try_divide(F.col("cum_cb"), nb))).alias("ks_d"),
               F.sum(F.col("ca") * avg_rank).alias("rank_sum_a"),
               F.first(na).alias("na"), F.first(nb).alias("nb"),
               F.sum(F.pow(blk.cast("double"), F.lit(3.0)) - blk).alias("tie_term"))
    xa, xb = _x(value), _x(value)
    ma = a.agg(F.avg(xa).alias("mean_a"), F.var_samp(xa).alias("var_a"))
    mb = b.agg(F.avg(xb).alias("mean_b"), F.var_samp(xb).alias("var_b"))
    s = t.crossJoin(ma).crossJoin(mb)
    u = F.col("rank_sum_a") - F.col("na") * (F.col("na") + 1) / 2
    se = F.sqrt(F.try_divide(F.col("var_a"), F.col("na")) + F.try_divide(F.col("var_b"), F.col("nb")))
    return s.select("ks_d", u.alias("mw_u"), F.try_divide(F.col("mean_a") - F.col("mean_b"), se).alias("welch_t"),
                    "na", "nb", "mean_a", "mean_b", "var_a", "var_b", "tie_term")


def _norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _ks_pvalue(d: float, na: float, nb: float) -> float:
    en = math.sqrt(na * nb / (na + nb))
    lam = (en + 0.12 + 0.11 / en) * d
    s = sum((-1) ** (k - 1) * math.exp(-2 * (k * lam) ** 2) for k in range(1, 101))
    return max(0.0, min(1.0, 2 * s))


def _betacf(a, b, x):
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = 1 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, 300):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = 1 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1 + aa / c if abs(1 + aa / c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = 1 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1 + aa / c if abs(1 + aa / c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1) < 3e-14:
            break
    return h


def _betainc(a, b, x):
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def _t_sf2(t: float, df: float) -> float:
    return _betainc(df / 2, 0.5, df / (df + t * t))


def compare_samples(a: DataFrame, b: DataFrame, value: str) -> dict:
    """I8 with p-values: statistics from Spark, p-values finished on the driver (scalars).

    A test without a defined statistic (an empty sample, no variance) has a null p-value.
    """
    r = compare_statistics(a, b, value).first().asDict()
    na, nb = r["na"] or 0.0, r["nb"] or 0.0
    n, u = na + nb, r["mw_u"]
    r.update(ks_p=None, mw_p=None, welch_p=None, welch_df=None)
    if na and nb:
        r["ks_p"] = _ks_pvalue(r["ks_d"], na, nb)
        spread = na * nb / 12 * ((n + 1) - r["tie_term"] / (n * (n - 1)))
        z = (abs(u - na * nb / 2) - 0.5) / math.sqrt(spread) if spread > 0 else 0.0
        r["mw_p"] = min(1.0, 2 * _norm_sf(z))
    if na > 1 and nb > 1 and r["welch_t"] is not None:
        va, vb = r["var_a"] / na, r["var_b"] / nb
        r["welch_df"] = (va + vb) ** 2 / (va * va / (na - 1) + vb * vb / (nb - 1))
        r["welch_p"] = _t_sf2(r["welch_t"], r["welch_df"])
    return r


def histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """Equal-width bins between min and max (last bin closed), zeros kept.

    (bin, lower, upper, count); edges as ``numpy.linspace`` builds them.
    """
    from tenderlens.operators.bins import bin_index_equal_width_sql
    x = _x(value)
    stats = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    d = df.select(x.alias("__x")).filter(F.col("__x").isNotNull()).crossJoin(F.broadcast(stats))
    idx = bin_index_equal_width_sql("__x", "__lo", "__hi", bins)
    counts = d.selectExpr(f"CASE WHEN __hi = __lo THEN 1 ELSE {idx} END AS bin").groupBy("bin").agg(
        F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")).crossJoin(
        F.broadcast(stats))
    step = (F.col("__hi") - F.col("__lo")) / F.lit(float(bins))
    lower = (F.col("bin") - 1).cast("double") * step + F.col("__lo")
    upper = F.when(F.col("bin") == bins, F.col("__hi")).otherwise(F.col("bin").cast("double") * step + F.col("__lo"))
    return spine.join(F.broadcast(counts), "bin", "left").select(
        "bin", lower.alias("lower"), upper.alias("upper"), F.coalesce("count", F.lit(0)).alias("count"))


def density_grid(df: DataFrame, value: str, grid: int = 200, cut: float = 3.0, steps: int = 32) -> DataFrame:
    """Gaussian KDE on a grid (Scott bandwidth): (point, x, density).

    Values are first counted in cells of ``1 / steps`` of the bandwidth, each
    standing at its mean, so the rounding does not show against the kernel. A cell adds to the grid points within
    8 bandwidths of it only. A column without spread, or with one value, has no
    density: its points have a null density.
    """
    x = _x(value)
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.stddev_samp(x).alias("sd"), F.count(x).alias("n"))
    st = st.select("lo", "hi", "n", F.when(F.col("sd") > 0, F.col("sd") * F.pow(
        F.col("n").cast("double"), F.lit(-0.2))).alias("bw"))
    width = (F.col("hi") - F.col("lo") + F.lit(2 * cut) * F.col("bw")) / F.lit(float(max(1, grid - 1)))
    st = st.withColumn("first", F.col("lo") - F.lit(cut) * F.col("bw")).withColumn("width", width)
    cell = F.col("bw") / F.lit(float(steps))
    cells = (df.select(x.alias("x")).where(F.col("x").isNotNull()).crossJoin(F.broadcast(st)).where("bw IS NOT NULL")
             .groupBy(F.floor((F.col("x") - F.col("lo")) / cell).alias("k"))
             .agg(F.count(F.lit(1)).alias("wk"), F.avg("x").alias("cx")))
    near = cells.crossJoin(F.broadcast(st))
    reach = F.lit(8.0) * F.col("bw")
    from_ = F.greatest(F.lit(0), F.ceil((F.col("cx") - reach - F.col("first")) / F.col("width")).cast("int"))
    to = F.least(F.lit(grid - 1), F.floor((F.col("cx") + reach - F.col("first")) / F.col("width")).cast("int"))
    near = near.where(from_ <= to).select("*", F.explode(F.sequence(from_, to)).alias("g"))
    z = (F.col("first") + F.col("g") * F.col("width") - F.col("cx")) / F.col("bw")
    dens = near.groupBy("g").agg(F.sum(F.col("wk") * F.exp(-0.5 * z * z)).alias("mass"))
    points = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("g")).crossJoin(F.broadcast(st))
    scale = F.col("n") * F.col("bw") * F.lit(math.sqrt(2 * math.pi))
    return points.join(dens, "g", "left").select(
        F.col("g").alias("point"), F.coalesce(F.col("first") + F.col("g") * F.col("width"), F.col("lo")).alias("x"),
        F.when(F.col("bw").isNotNull(), F.coalesce(F.col("mass"), F.lit(0.0)) / scale).alias("density"))
