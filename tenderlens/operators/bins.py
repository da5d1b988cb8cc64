"""Bin edges, bin indices and per-notice bin shares.

A bid's assessment rate falls into bin ``i`` of granularity ``n`` when
``edge[i-1] <= x < edge[i]`` (left-closed), with open outer bins, so values
outside the range land in bin 1 or bin n and shares always sum to 1.

Scale notes:
* Bin indices are column expressions: fixed edges go through ML
  ``Bucketizer`` (binary search), equal-width edges are a floor that is corrected
  against the two neighbouring edges, so no per-row edge arrays.
* The edge table is tiny and bounded (levels x 4 granularities x <100 edges);
  it is read once on the driver behind a check of its size.
* Shares are counted per notice and its bins of all granularities, with weights:
  rows that are equal were counted before, so a notice with very many bids sends one
  row per different rate, and are read into columns from a map of at most 180 cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderlens.functions.expr import GRANULARITIES, target_name

MAX_EDGE_ROWS = 10_000   # bound checked before the edge table reaches the driver


def equal_width_edges(lower, upper, n: int) -> Column:
    """H1: inner edges ``lower + i*((upper-lower)/n)``, i = 1..n-1.

    The order of operations equals ``numpy.linspace`` (step first), which
    keeps edges bit-identical. Bounds must differ.
    """
    lo, hi = F.col(lower) if isinstance(lower, str) else lower, F.col(upper) if isinstance(upper, str) else upper
    step = (hi.cast("double") - lo.cast("double")) / F.lit(float(n))
    return F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: i.cast("double") * step + lo.cast("double"))


def edge_file_table(spark: SparkSession, levels=(2, 3), granularities=GRANULARITIES) -> DataFrame:
    """Stand-in for the unshipped edge files: (level, n, seq, upper).

    ``upper = (lo + i*((hi-lo)/n))/100`` for i = 1..n with lo/hi = -level/+level,
    one row per file line; it nests across granularities like the real ones.
    """
    rows = spark.createDataFrame([(lv, n) for lv in levels for n in granularities], "level int, n int")
    seq = rows.select("level", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("seq"))
    lo = -F.col("level").cast("double")
    hi = F.col("level").cast("double")
    step = (hi - lo) / F.col("n").cast("double")
    return seq.select("level", "n", "seq", ((F.col("seq").cast("double") * step + lo) / 100).alias("upper"))


def rule_edges(levels=(2, 3), granularities=GRANULARITIES) -> dict:
    """The stand-in edge sets computed directly: {(level, n): sorted inner edges}.

    Same IEEE double operations as :func:`edge_file_table` followed by
    :func:`load_bin_edges` (upper = (i*step + lo)/100 for i = 1..n, last row
    dropped, x100), so the values are bit-identical without running a job.
    """
    out = {}
    for lv in levels:
        lo, hi = -float(lv), float(lv)
        for n in granularities:
            step = (hi - lo) / float(n)
            uppers = [(float(i) * step + lo) / 100 for i in range(1, n + 1)]
            out[(lv, n)] = sorted(u * 100 for u in uppers[:-1])
    return out


def load_bin_edges(edge_table: DataFrame) -> DataFrame:
    """Per (level, n): drop the last file row, sort, x100 -> (level, n, idx, edge)."""
    last = edge_table.groupBy("level", "n").agg(F.max("seq").alias("last_seq"))
    kept = edge_table.join(last, ["level", "n"]).filter(F.col("seq") < F.col("last_seq"))
    edges = kept.groupBy("level", "n").agg(F.array_sort(F.collect_list(F.col("upper") * 100)).alias("edges"))
    return edges.select("level", "n", F.posexplode("edges").alias("idx", "edge")) \
        .select("level", "n", (F.col("idx") + 1).alias("idx"), "edge")


def collect_edges(edges_long: DataFrame) -> dict:
    """{(level, n): [edges]} from the small edge table (size-checked)."""
    rows = edges_long.limit(MAX_EDGE_ROWS + 1).collect()
    if len(rows) > MAX_EDGE_ROWS:
        raise ValueError("edge table larger than expected for a bin-edge file set")
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r["level"], r["n"], r["idx"])):
        out.setdefault((int(r["level"]), int(r["n"])), []).append(float(r["edge"]))
    return out


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bin_index_equal_width_sql(x: str, lower: str, upper: str, n: int) -> str:
    """H3 for equal-width edges: floor guess corrected on the neighbouring edges."""
    lo = f"CAST({lower} AS DOUBLE)"
    step = f"((CAST({upper} AS DOUBLE) - {lo}) / CAST({n} AS DOUBLE))"
    g0 = f"least(greatest(floor(({x} - {lo}) / {step}), 0), {n - 1})"
    return (f"CAST(1 + CASE WHEN {g0} >= 1 AND CAST({g0} AS DOUBLE) * {step} + {lo} > {x} THEN {g0} - 1 "
            f"WHEN {g0} <= {n - 2} AND CAST({g0} + 1 AS DOUBLE) * {step} + {lo} <= {x} THEN {g0} + 1 "
            f"ELSE {g0} END AS INT)")


def bin_index_equal_width(x: Column, lower: Column, upper: Column, n: int) -> Column:
    """Column form of :func:`bin_index_equal_width_sql` for ad-hoc use."""
    lo = lower.cast("double")
    step = (upper.cast("double") - lo) / F.lit(float(n))
    g0 = F.least(F.greatest(F.floor((x - lo) / step), F.lit(0)), F.lit(n - 1))
    g = (F.when((g0 >= 1) & (g0.cast("double") * step + lo > x), g0 - 1)
         .when((g0 <= n - 2) & ((g0 + 1).cast("double") * step + lo <= x), g0 + 1)
         .otherwise(g0))
    return (g + 1).cast("int")


def _fixed_bins(df: DataFrame, x: str, fixed_edges: dict) -> tuple[DataFrame, dict]:
    """Bucket indices for every fixed edge set with ML ``Bucketizer`` (binary search).

    Returns the frame with one ``__k_<level>_<n>`` column per set and, per set,
    the SQL that turns the bucket into ``1 + #(edges <= x)``; duplicated edges
    (a degenerate file) are handled by a cumulative-count lookup.
    """
    from pyspark.ml.feature import Bucketizer

    if not fixed_edges:
        return df, {}
    names = {k: f"__k_{k[0]}_{k[1]}" for k in fixed_edges}
    splits, post = [], {}
    for k, edges in fixed_edges.items():
        e = sorted(edges)
        uniq = sorted(set(e))
        splits.append([float("-inf")] + uniq + [float("inf")])
        if len(uniq) == len(e):
            post[k] = f"CAST({names[k]} AS INT) + 1"
        else:
            cum = [sum(1 for v in e if v <= u) for u in uniq]
            arr = ", ".join(str(c) for c in [0] + cum)
            post[k] = f"element_at(array({arr}), CAST({names[k]} AS INT) + 1) + 1"
    inputs = {k: f"__x_{k[0]}_{k[1]}" for k in fixed_edges}
    d = df.select("*", *[F.col(x).cast("double").alias(inputs[k]) for k in fixed_edges])
    bk = Bucketizer(splitsArray=splits, inputCols=[inputs[k] for k in fixed_edges],
                    outputCols=[names[k] for k in fixed_edges], handleInvalid="keep")
    out = bk.transform(d).drop(*inputs.values())
    # NaN lands in the extra bucket of 'keep': clamp it to the last bin (as digitize + clip)
    post = {k: f"least({v}, {len(fixed_edges[k]) + 1})" for k, v in post.items()}
    return out, post


def add_bin_columns(df: DataFrame, rate: str, level: str, lower: str, upper: str,
                    fixed_edges: dict, granularities=GRANULARITIES) -> DataFrame:
    """H6 per row: fixed edges for levels with an edge set, equal width otherwise.

    Fixed sets use ``Bucketizer`` (binary search in the JVM); the per-row
    equal-width index is a short arithmetic SQL expression.
    """
    x = f"CAST({_q(rate)} AS DOUBLE)"
    d, post = _fixed_bins(df, rate, fixed_edges)
    exprs = []
    for n in granularities:
        expr = bin_index_equal_width_sql(x, _q(lower), _q(upper), n)
        for (lv, gn), sql in sorted(post.items()):
            if gn == n:
                expr = f"CASE WHEN {_q(level)} = {lv} THEN {sql} ELSE {expr} END"
        exprs.append(f"CAST(CASE WHEN {x} IS NULL THEN NULL ELSE {expr} END AS INT) AS __b{n}")
    tmp = [c for c in d.columns if c.startswith("__k_")]
    return d.selectExpr("*", *exprs).drop(*tmp)


def cell_offsets(granularities=GRANULARITIES) -> dict[int, int]:
    """Integer cell id of (n, bin) = offset(n) + bin - 1, cells of all granularities in a row."""
    out, acc = {}, 0
    for n in granularities:
        out[n] = acc
        acc += n
    return out


def bin_shares_wide(binned: DataFrame, keys: list[str], granularities=GRANULARITIES,
                    total_col: str | None = None, weight: str | None = None) -> DataFrame:
    """H5: one row per key with one share column per (granularity, bin).

    Counts first (partial aggregation: a key with very many rows sends one row per
    different combination of bins and task), then per key an integer-keyed map of
    at most sum(granularities) entries -- a fixed bound -- read out into
    columns (integer keys: the lookups compare ints, not label strings).
    """
    return read_shares(bin_maps(binned, keys, granularities, weight), keys, granularities, total_col)


def bin_maps(binned: DataFrame, keys: list[str], granularities=GRANULARITIES, weight: str | None = None) -> DataFrame:
    """(keys, __m, __total): the non-empty cells of each key, for joins that come before :func:`read_shares`.

    A key with few rows has few cells, so a row is far smaller than with all share columns.
    Rows are counted by their bins of all granularities together: between two neighbouring
    edges of any granularity those are the same, so a key has at most sum(granularities)
    such counts. They are gathered per key and added up to cells within the row.
    """
    at, off = [f"__b{n}" for n in granularities], cell_offsets(granularities)
    w = F.col(weight) if weight else F.lit(1)
    counts = (binned.select(*keys, *at, w.cast("long").alias("__w")).filter(F.col(at[0]).isNotNull())
              .groupBy(*keys, *at).agg(F.sum("__w").alias("__c")))
    gathered = counts.groupBy(*keys).agg(F.collect_list(F.struct(*at, "__c")).alias("__l"), F.sum("__c").alias("__total"))

    def cells(n: int) -> Column:
        def counted(b: Column) -> Column:
            return F.struct((b - 1 + off[n]).alias("cell"), F.aggregate(
                "__l", F.lit(0).cast("long"), lambda a, x: a + F.when(x[f"__b{n}"] == b, x["__c"]).otherwise(F.lit(0).cast("long"))).alias("c"))
        return F.transform(F.array_distinct(F.col(f"__l.__b{n}")), counted)

    return gathered.select(*keys, F.map_from_entries(F.concat(*[cells(n) for n in granularities])).alias("__m"), "__total")


def share_exprs(granularities=GRANULARITIES) -> dict[str, str]:
    """The SQL of every share column over the rows of :func:`bin_maps`."""
    off = cell_offsets(granularities)
    return {target_name(n, i): f"coalesce(__m[{off[n] + i - 1}], 0) / CAST(__total AS DOUBLE)" for n in granularities for i in range(1, n + 1)}


def read_shares(maps: DataFrame, kept: list[str], granularities=GRANULARITIES, total_col: str | None = None) -> DataFrame:
    """``kept`` and one share column per (granularity, bin) from rows of :func:`bin_maps`; no map gives NULL shares."""
    shares = [f"{x} AS {_q(t)}" for t, x in share_exprs(granularities).items()]
    extra = [f"__total AS {_q(total_col)}"] if total_col else []
    return maps.selectExpr(*[_q(k) for k in kept], *shares, *extra)


def pack_shares(maps: DataFrame, out: str, granularities=GRANULARITIES) -> DataFrame:
    """The rows of :func:`bin_maps` with an array of all shares in place of their map, cell by cell from its entries."""
    cells, names = sum(granularities), [*[c for c in maps.columns if c not in ("__m", "__total")], out]
    rows = maps.select(*names[:-1], "__m", "__total")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, (m, total) = batch.num_rows, batch.columns[-2:]
            row = np.repeat(np.arange(n), np.diff(m.offsets.to_numpy(zero_copy_only=False)))
            share = np.zeros((n, cells))
            share[row, m.keys.to_numpy(zero_copy_only=False)] = (m.items.to_numpy(zero_copy_only=False).astype(float)
                                                                / total.to_numpy(zero_copy_only=False).astype(float)[row])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * cells), pa.array(share.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], lists], names=names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-2], T.StructField(out, T.ArrayType(T.DoubleType()))]))


def wide_to_long(wide: DataFrame, keys: list[str], granularities=GRANULARITIES) -> DataFrame:
    """Unpivot ``NNN_iii`` share columns to (keys, n, bin, share); zeros kept."""
    names = [target_name(n, i) for n in granularities for i in range(1, n + 1)]
    long = wide.unpivot(keys, names, "label", "share")
    parts = F.split("label", "_")
    return long.select(*keys, parts.getItem(0).cast("int").alias("n"),
                       parts.getItem(1).cast("int").alias("bin"), "share")


def bin_shares_long(df: DataFrame, keys: list[str], value: str, lower, upper, n: int) -> DataFrame:
    """H4: share of rows per equal-width bin for one granularity, zeros included."""
    lo = F.col(lower) if isinstance(lower, str) else F.lit(float(lower))
    hi = F.col(upper) if isinstance(upper, str) else F.lit(float(upper))
    binned = df.select(*keys, bin_index_equal_width(F.col(value).cast("double"), lo, hi, n).alias(f"__b{n}"))
    binned = binned.filter(F.col(f"__b{n}").isNotNull())
    return wide_to_long(bin_shares_wide(binned, keys, (n,)), keys, (n,))
