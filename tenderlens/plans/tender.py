"""The tender plan (P1): notices + bids -> per-notice features and 180 targets.

One plan for the three range datasets; the per-notice base table is written once
when the plan is built, everything else is lazy:

    notices --clean, keep-first dedupe(key)--> nt --(key, level, bounds)--+
    bids ----parse rate, count per (key, rate)------------------- join on key --> bins
    bins --> weighted counts (notice, n, bin), partial agg --> per-notice map --> 180 shares + n_rates
    nt  join  shares  --> base (one row per notice with bids; materialised)
    base --> per-dataset statistics (3 rows, broadcast), categories, features --> result

Shuffles: the notices' dedupe by key, the bid join (AQE may broadcast a small
notice side), the two count aggregations, the base join. The per-dataset
statistics are one row per dataset (range3 / range2 / others).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.functions.expr import (GRANULARITIES, log1p_strict, parse_rate, range_bounds, range_level,
                                       strip_whitespace, a_value_ratio)
from tenderlens.operators import bins as B
from tenderlens.operators.clean import dedupe_keep_first, drop_null_keys, fill_mean
from tenderlens.operators.skew import salted_join
from tenderlens.roles import TenderColumns, require_columns

DATASET = "dataset"
PACKED = "__shares"  # the targets as one array
# The two range texts that get their own dataset and edge files.
RANGE3, RANGE2 = "+3%~-3%", "+2%~-2%"
DATASET_NAMES = {"range3": "DataSet_3", "range2": "DataSet_2", "others": "DataSet_etc"}
STRIPPED = ("range_text", "agency", "region", "mark")


def clean_notices(notices: DataFrame, cols: TenderColumns = TenderColumns(),
                  order: list[str] | None = None) -> DataFrame:
    """Projection, NULL drops, mean fill, '' fill, keep-first dedupe, whitespace strip.

    ``order`` names the columns that say which row of a repeated notice comes
    first (a load time, say); without it the row of smallest values stays, so a
    recomputed task picks the same one.
    """
    require_columns(notices, cols.notice_required, "notices")
    extra = [c for c in (order or []) if c not in cols.notice_required]
    nt = notices.select(*cols.notice_required, *extra)
    nt = drop_null_keys(nt, [cols.key, cols.range_text])
    nt = fill_mean(nt, [cols.bid_rate])
    nt = nt.fillna("", subset=[cols.mark])
    nt = dedupe_keep_first(nt, [cols.key], order or [c for c in cols.notice_required if c != cols.key])
    nt = nt.withColumns({getattr(cols, a): strip_whitespace(getattr(cols, a)) for a in STRIPPED})
    return nt.select(*cols.notice_required)


def parsed_bids(bids: DataFrame, cols: TenderColumns = TenderColumns(), keep=()) -> DataFrame:
    """Bids with a parsed rate; unparsable rates (no decimal point) are dropped (Q15)."""
    require_columns(bids, cols.bid_required, "bids")
    b = bids.select(cols.key, parse_rate(cols.rate_text).alias(cols.rate), *keep)
    return b.dropna(subset=[cols.key, cols.rate])


def group_to_list(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """Values per key as a list in ``order``; NULL values and keys dropped.

    API-edge operator only: a list holds a whole group in one row. The plans
    in this package keep bids long and never build it.
    """
    d = df.dropna(subset=[key, value])
    pairs = F.collect_list(F.struct(*[F.col(c) for c in order], F.col(value).alias("__v")))
    return d.groupBy(key).agg(F.transform(F.array_sort(pairs), lambda s: s["__v"]).alias(value))


def restructure(notices: DataFrame, bids: DataFrame, cols: TenderColumns = TenderColumns()) -> DataFrame:
    """Cleaned notices joined (inner) with their parsed bids.

    One row per notice with ``n_rates`` (number of parsed bids); the rates stay
    in the long bid table instead of a list cell.
    """
    nt = clean_notices(notices, cols)
    counts = parsed_bids(bids, cols).groupBy(cols.key).agg(F.count(F.lit(1)).alias("n_rates"))
    return nt.join(counts, cols.key, "inner")


def dataset_of(range_col) -> F.Column:
    """Three-way split on the (stripped) range text."""
    c = F.col(range_col)
    return (F.when(c == RANGE3, F.lit("range3")).when(c == RANGE2, F.lit("range2")).otherwise(F.lit("others")))


def separate(df: DataFrame, cols: TenderColumns = TenderColumns()) -> DataFrame:
    return df.withColumn(DATASET, dataset_of(cols.range_text))


def notice_bounds(nt: DataFrame, cols: TenderColumns = TenderColumns(), fail_fast: bool = False) -> DataFrame:
    """(key, level, lower, upper, valid) per notice from its range text."""
    b = range_bounds(cols.range_text)
    out = nt.select(cols.key, range_level(cols.range_text).alias("__level"), b.alias("__b"))
    out = out.select(cols.key, "__level", F.col("__b.lower").alias("__lower"),
                     F.col("__b.upper").alias("__upper"),
                     (F.col("__b.valid") & (F.col("__b.lower") < F.col("__b.upper"))).alias("__valid"))
    if fail_fast:
        out = out.withColumn("__valid", F.when(F.col("__level") > 0, F.lit(True)).when(
            F.col("__valid"), F.lit(True)).otherwise(F.raise_error(F.lit("range text without two percents"))))
    return out


def default_edges(spark=None) -> dict:
    """Edge sets of levels 2 and 3. Real edge files go through
    ``B.collect_edges(B.load_bin_edges(table))``; the shipped stand-in is built
    from its rule directly (bit-identical, no job)."""
    return B.rule_edges()


def calculate_target(nt: DataFrame, bids_long: DataFrame, cols: TenderColumns = TenderColumns(),
                     edges: dict | DataFrame | None = None, granularities=GRANULARITIES,
                     hot: dict | list | None = None, total_col: str | None = None, salt_buckets: int = 16,
                     maps: bool = False) -> DataFrame:
    """H6: per-notice shares for all granularities, one column per ``NNN_iii``.

    Equal rates of a notice are counted first (with map-side aggregation), so what
    is joined, binned and exploded is one weighted row per different rate: a
    notice with a third of all bids brings no more rows than it has rates; that
    replaces an estimate of hot notices, which ``hot`` can still name.
    Levels 2/3 use the fixed edge sets (a dict, or the edge table itself), level 0
    equal-width edges between the notice's own bounds. Level-0 notices whose range
    text has no valid pair of bounds give no targets: :func:`range_rejects` names them.
    ``maps`` gives the rows of ``bins.bin_maps``, to be joined before they are read into columns.
    """
    edges = default_edges(nt.sparkSession) if edges is None else edges
    if isinstance(edges, DataFrame):
        edges = B.collect_edges(B.load_bin_edges(edges))
    nb = notice_bounds(nt, cols).filter((F.col("__level") > 0) | F.col("__valid"))
    rates = bids_long.groupBy(cols.key, cols.rate).agg(F.count(F.lit(1)).alias("__w"))
    joined = salted_join(rates, nb, cols.key, "inner", salt_buckets=salt_buckets, hot=hot or {})
    binned = B.add_bin_columns(joined, cols.rate, "__level", "__lower", "__upper", edges, granularities)
    if maps:
        return B.bin_maps(binned, [cols.key], granularities, weight="__w")
    return B.bin_shares_wide(binned, [cols.key], granularities, total_col=total_col, weight="__w")


def range_rejects(nt: DataFrame, cols: TenderColumns = TenderColumns()) -> DataFrame:
    """Level-0 notices whose range text does not give two distinct percents."""
    nb = notice_bounds(nt, cols)
    return nb.filter((F.col("__level") == 0) & ~F.col("__valid")).select(cols.key)


def standardize_by(df: DataFrame, group: str | None, cols: dict[str, str], few: bool = False) -> DataFrame:
    """G1 per group: (x - mean) / population std; zero variance gives 0.

    ``cols`` maps input column -> output name. Statistics are one row per
    group, joined on the group key. ``few`` says that the groups are few by
    definition, as datasets are: their statistics are broadcast. Without it, a
    table whose size Spark overrates is shuffled by group, a task for each.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"__m_{c}"), F.stddev_pop(x).alias(f"__s_{c}")]
    g = df.groupBy(group) if group else df.groupBy()
    stats = g.agg(*aggs)
    if group:
        j = df.join(F.broadcast(stats) if few else stats, group, "left")
    else:
        j = df.crossJoin(F.broadcast(stats))
    out = {}
    for c, name in cols.items():
        s = F.col(f"__s_{c}")
        z = F.when(s.isNull() | (s == 0), F.lit(0.0)).otherwise((F.col(c).cast("double") - F.col(f"__m_{c}")) / s)
        out[name] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(z)
    return j.withColumns(out).drop(*[f"__m_{c}" for c in cols], *[f"__s_{c}" for c in cols])


def process_notices(df: DataFrame, targets: DataFrame | None, cols: TenderColumns = TenderColumns(),
                    categories: dict[str, list[str]] | None = None, text_features: int = 0,
                    keep_raw: bool = False, form: str = "columns", indexes: dict[str, DataFrame] | None = None) -> DataFrame:
    """H7: log + per-dataset standardisation, A-value ratio, multi-hot, targets.

    ``form`` "columns" makes a 0/1 column per category, "positions" one ``<col>_hot``
    column of positions for each multi-hot column, whatever the number of categories;
    ``indexes`` holds fitted category indexes by column.

    Statistics are fitted per ``dataset`` (the reference fits each range
    dataset on its own). ``text_features`` > 0 adds hashed-embedding + PCA
    columns of the title (G12 -> G13).
    """
    from tenderlens.operators.encode import categories_of_many, multi_hot, multi_hot_positions

    if form not in ("columns", "positions"):
        raise ValueError(f"form: {form}")
    hot_cols = [cols.agency, cols.region, cols.mark]
    if form == "columns" and (categories is None or any(c not in categories for c in hot_cols)):
        categories = {**categories_of_many(df, hot_cols), **(categories or {})}
    amounts = [cols.base, cols.estimate, cols.bid_rate]
    d = df.withColumns({c: log1p_strict(c) for c in amounts})
    d = d.withColumn(cols.a_value, a_value_ratio(cols.a_value, cols.base))
    d = standardize_by(d, DATASET, {**{c: f"norm_log_{c}" for c in amounts}, cols.a_value: "norm_A값/기초금액"}, few=True)
    for c in hot_cols:
        if form == "positions":
            d = multi_hot_positions(d, c, (indexes or {}).get(c))
        else:
            d = multi_hot(d, c, categories=categories[c], fitted=True)
    if text_features:
        from tenderlens.operators.text import reduced_text_features
        red = reduced_text_features(d.select(cols.key, cols.title), cols.key, cols.title, k=text_features)
        d = d.join(red, cols.key, "left")
    if targets is not None:
        d = d.join(targets, cols.key, "inner")
    if not keep_raw:
        d = d.drop(cols.title, cols.agency, cols.region, cols.base, cols.estimate, cols.a_value,
                   cols.bid_rate, cols.n_bidders, cols.mark, "n_rates")
    return d


def transform(notices: DataFrame, bids: DataFrame, cols: TenderColumns = TenderColumns(),
              edges: dict | None = None, categories: dict[str, list[str]] | None = None,
              text_features: int = 0, hot: dict | list | None = None, materialize: bool = True,
              form: str = "columns", indexes: dict[str, DataFrame] | None = None, packed: bool = False) -> DataFrame:
    """H8: the whole tender plan; one DataFrame with a ``dataset`` column.

    Bids are parsed once: the per-notice bid count comes with the target
    totals, and the inner join with the targets keeps exactly the notices
    that have parsed bids. With ``materialize`` (default) the per-notice base
    table (cleaned notices + targets) is written once as a Parquet table in
    ``spark.checkpoint.dir``: the per-dataset statistics, the category lists
    and the final projection all read it, so the bid join and the 180-share
    aggregation run once. Write the result with
    :func:`tenderlens.sources.files.write_datasets` or filter by ``dataset``.
    ``form`` and ``indexes`` are those of :func:`process_notices`. ``packed`` keeps the
    targets as maps of non-empty bins in the base table and gives them as one array,
    for a table to be written before :func:`read_targets`.
    """
    from tenderlens.session import cut_lineage
    keep = cut_lineage if materialize else (lambda d: d)
    nt = clean_notices(notices, cols)
    pb = parsed_bids(bids, cols)
    # the join sorts and moves maps of a few cells, not 180 columns
    base = nt.join(calculate_target(nt, pb, cols, edges=edges, hot=hot, maps=True), cols.key, "inner")
    if not packed:
        base = B.read_shares(base, [c for c in base.columns if c not in ("__m", "__total")], total_col="n_rates")
    base = keep(separate(base, cols))
    hot_cols = [cols.agency, cols.region, cols.mark]
    if form == "positions":
        from tenderlens.operators.encode import hot_index
        indexes = {**{c: hot_index(base, c) for c in hot_cols if c not in (indexes or {})}, **(indexes or {})}
    elif categories is None:
        from tenderlens.operators.encode import categories_of_many
        categories = categories_of_many(base, hot_cols)
    d = process_notices(base, None, cols, categories=categories, text_features=text_features, form=form, indexes=indexes)
    return B.pack_shares(d, PACKED) if packed else d


def read_targets(d: DataFrame, cols: TenderColumns = TenderColumns()) -> DataFrame:
    """The rows of :func:`transform` with ``packed``, their targets read into columns where it has them."""
    shares = [f"{PACKED}[{i}] AS `{t}`" for i, t in enumerate(B.share_exprs())]
    others = [f"`{c}`" for c in d.columns if c != PACKED]
    at = others.index(f"`{cols.range_text}`") + 1
    return d.selectExpr(*others[:at], *shares, *others[at:])
