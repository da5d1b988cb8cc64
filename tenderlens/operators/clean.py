"""Cleaning operators.

Means and modes of all columns of a stage are one aggregation, applied as a
broadcast of its single row. Medians and quartiles are exact and distributed
(``ecdf.column_quantiles``); they come to the driver as numbers, one per column
and probability, and go into the plan as literals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def _stat_col(c: str, tag: str) -> str:
    return f"__{tag}__{c}"


def _apply_stats(df: DataFrame, stats: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Replace columns with expressions over the one-row statistics table."""
    joined = df.crossJoin(F.broadcast(stats))
    out = [exprs.get(c, F.col(c)).alias(c) if c in exprs else F.col(c) for c in df.columns]
    return joined.select(*out)


def medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    from tenderlens.operators.ecdf import column_quantiles
    return {c: q[0.5] for c, q in column_quantiles(df, cols, [0.5]).items()} if cols else {}


def columns_with_nulls(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns with a NULL (or NaN), from one aggregation."""
    if not cols:
        return []
    row = nan_to_null(df, cols).agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return [c for c, n in zip(cols, row) if n]


def fill_median(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Numeric NULLs to the column's exact median (NaN treated as NULL).

    A column with nothing to fill stays as it is, integers included; a filled
    column becomes a double; a column of NULLs only stays NULL.
    """
    cols = numeric_columns(df) if cols is None else cols
    holes = columns_with_nulls(df, cols)
    if not holes:
        return df
    df = nan_to_null(df, holes)
    found = medians(df, holes)
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(found[c]).cast("double")) for c in holes})


def fill_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Numeric NULLs to the column mean."""
    df = nan_to_null(df, cols)
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(_stat_col(c, "mean")) for c in cols])
    return _apply_stats(df, stats, {c: F.coalesce(F.col(c).cast("double"), F.col(_stat_col(c, "mean")))
                                    for c in cols})


def fill_constant(df: DataFrame, cols: list[str] | None = None, value: str = "Unknown") -> DataFrame:
    """String NULLs to a constant ('Unknown', or '' for text)."""
    cols = string_columns(df) if cols is None else cols
    return df.fillna(value, subset=cols) if cols else df


def fill_empty(df: DataFrame, cols: list[str]) -> DataFrame:
    return fill_constant(df, cols, "")


def fill_mode(df: DataFrame, cols: list[str], default: str = "UNKNOWN") -> DataFrame:
    """NULLs to the most frequent value (smallest on ties); default if none.

    Two partial aggregations per column (count per value, then ``min_by`` on
    (-count, value)); no value->count map is merged in one task.
    """
    stats = None
    for c in cols:
        vc = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
        row = vc.agg(F.min_by(F.col(c), F.struct(-F.col("__n"), F.col(c))).alias(_stat_col(c, "mode")))
        stats = row if stats is None else stats.crossJoin(row)
    return _apply_stats(df, stats, {c: F.coalesce(F.col(c), F.col(_stat_col(c, "mode")), F.lit(default))
                                    for c in cols})


def nan_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """pandas has one notion of missing; Spark separates NaN and NULL."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    todo = [c for c in cols if c in fl]
    if not todo:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in todo})


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with NULL in any of the given columns."""
    return df.dropna(how="any", subset=list(cols))


def dedupe_keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order`` (never ``dropDuplicates``).

    ``min_by`` aggregates partially on the map side, so a hot key costs one
    row per map task in the shuffle; no sort and no window. The order must say
    more than the keys, or any row could win and another after a retry.
    """
    if not set(order) - set(keys):
        raise ValueError("keep-first needs an order beside the keys")
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    ordering = F.struct(*[F.col(c) for c in order])
    g = df.groupBy(*keys).agg(F.min_by(row, ordering).alias("__first"))
    return g.select(*keys, *[F.col(f"__first.{c}").alias(c) for c in others]).select(*df.columns)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed."""
    return df.distinct()


def duplicate_count(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each duplicate group -> one row."""
    cols = df.columns if cols is None else cols
    g = df.groupBy(*cols).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def iqr_bounds(df: DataFrame, cols: list[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    """[Q1 - k*IQR, Q3 + k*IQR] of each column that has values."""
    from tenderlens.operators.ecdf import column_quantiles
    out = {}
    for c, q in column_quantiles(df, cols, [0.25, 0.75]).items():
        if q[0.25] is not None:
            iqr = q[0.75] - q[0.25]
            out[c] = (q[0.25] - k * iqr, q[0.75] + k * iqr)
    return out


def cap_outliers_iqr(df: DataFrame, cols: list[str], k: float = 1.5) -> DataFrame:
    """C11: values capped to [Q1 - k*IQR, Q3 + k*IQR]; NULL stays NULL."""
    if not cols:
        return df
    df = nan_to_null(df, cols)
    exprs = {}
    for c, (lo, hi) in iqr_bounds(df, cols, k).items():
        x = F.col(c).cast("double")
        exprs[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
    return df.withColumns(exprs)


def coerce_dates(df: DataFrame, cols: list[str], fmt: str | None = None) -> DataFrame:
    """Text to timestamp; unparsable text becomes NULL (no job failure)."""
    def conv(c):
        dt = df.schema[c].dataType
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return F.col(c).cast("timestamp")
        txt = F.col(c).cast("string")
        return F.try_to_timestamp(txt, F.lit(fmt)) if fmt else F.try_to_timestamp(txt)
    return df.withColumns({c: conv(c) for c in cols})


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL count per column in one pass, as (column, n_null) rows."""
    cols = df.columns if cols is None else cols
    wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', c{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, n_null)")


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def rows_with_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows with at least one NULL."""
    return df.filter(any_null(df.columns if cols is None else cols))


def cleaning_stats(before: DataFrame, without_nulls: DataFrame, after: DataFrame, dataset_col: str | None = None
                   ) -> DataFrame:
    """C14: rows and columns before and after per dataset, rows removed for NULLs and as duplicates.

    One aggregation per state; a dataset that a step removes whole counts 0 after it.
    """
    group = [dataset_col] if dataset_col else []
    states = [d.groupBy(*group).agg(F.count(F.lit(1)).alias(f"n{i}")) for i, d in enumerate((before, without_nulls, after))]
    j = states[0]
    for state in states[1:]:
        j = j.join(state, dataset_col, "left") if group else j.crossJoin(F.broadcast(state))
    n = [F.coalesce(f"n{i}", F.lit(0)) for i in range(3)]
    return j.select(*group, n[0].alias("rows_before"), n[2].alias("rows_after"),
                    F.lit(len(before.columns)).alias("cols_before"), F.lit(len(after.columns)).alias("cols_after"),
                    (n[0] - n[1]).alias("nulls_removed"), (n[1] - n[2]).alias("duplicates_removed"))
