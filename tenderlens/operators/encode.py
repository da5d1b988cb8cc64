"""Encoders (G4-G6).

``multi_hot`` makes a column per category, for up to ``MAX_DENSE_CATEGORIES`` of
them, read on the driver behind that check; more are an error. For any number,
``multi_hot_positions`` makes one column ``<col>_hot``: the sorted positions of a
row's ones, with the width in the column's metadata, the same schema at every size.
Positions come from an index fitted in range partitions and joined to the different
cells; the linear models take such columns. ``multi_hot_long`` is the long form.
Label codes are ranks of the sorted classes, numbered in range partitions, so any
number of classes gets a code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DENSE_CATEGORIES = 1000


def _quote_regex(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def parts(c: str, sep: str = "/") -> F.Column:
    return F.split(F.col(c), _quote_regex(sep))


def categories_of(df: DataFrame, c: str, sep: str | None = "/", max_categories: int = MAX_DENSE_CATEGORIES) -> list[str] | None:
    """None for more than ``max_categories``. Sorted distinct parts of a (multi-valued) string column; an empty part is no category."""
    vals = F.explode(parts(c, sep)) if sep else F.col(c)
    d = df.select(vals.alias("v")).filter(F.col("v").isNotNull())
    if sep:
        d = d.filter(F.col("v") != "")
    rows = d.distinct().limit(max_categories + 1).collect()
    return None if len(rows) > max_categories else sorted(r[0] for r in rows)


def categories_of_many(df: DataFrame, cols: list[str], sep: str = "/",
                       max_categories: int = MAX_DENSE_CATEGORIES) -> dict[str, list[str] | None]:
    """Sorted distinct parts of several multi-valued columns in one pass; None for a column with too many.

    Numbers of parts come first, parts only of the columns within the bound.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in cols])
    d = (df.select(F.explode(pairs).alias("p"))
         .select(F.col("p.c").alias("c"), F.explode(F.split(F.col("p.v"), _quote_regex(sep))).alias("v"))
         .filter(F.col("v").isNotNull() & (F.col("v") != "")).distinct())
    sizes = {r["c"]: r["n"] for r in d.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    dense = [c for c in cols if sizes.get(c, 0) <= max_categories]
    rows = d.filter(F.col("c").isin(dense)).collect() if dense else []
    return {c: sorted(r["v"] for r in rows if r["c"] == c) if c in dense else None for c in cols}


def multi_hot(df: DataFrame, c: str, sep: str = "/", categories: list[str] | None = None,
              prefix: str | None = None, fitted: bool = False) -> DataFrame:
    """One 0/1 column ``<col>_<part>`` per distinct part; '' is not a category.

    ``fitted`` says that ``categories`` comes from a count, None for too many; too many
    raise, as :func:`multi_hot_positions` is the form without a limit.
    """
    cats = categories_of(df, c, sep) if categories is None and not fitted else categories
    cats = cats if cats is None else sorted(set(cats) - {""})
    arr = parts(c, sep)
    if cats is None:
        raise ValueError(f"{c} has over {MAX_DENSE_CATEGORIES} categories: use multi_hot_positions (form=\"positions\")")
    p = prefix if prefix is not None else f"{c}_"
    return df.withColumns({f"{p}{v}": F.coalesce(F.array_contains(arr, F.lit(v)).cast("int"), F.lit(0))
                           for v in cats})


def hot_index(df: DataFrame, c: str, sep: str = "/") -> DataFrame:
    """G4 fit: (value, code) of the sorted distinct parts, numbered from 0 at any size."""
    return label_index(df.select(F.explode(parts(c, sep)).alias(c)).filter(F.col(c) != ""), c)


def multi_hot_positions(df: DataFrame, c: str, index: DataFrame | None = None, sep: str = "/", out: str | None = None) -> DataFrame:
    """G4 at any width: ``<col>_hot``, the sorted positions of a row's ones; no ones (a null too) give an empty array.

    The index is joined to the parts of the different cells, and the cells back to the
    rows. The cells are written first, so that Spark knows their size: a few go to the
    rows, which are not dealt by cell then, a task for each. Parts that the index lacks
    have no position. The number of categories is the column's metadata ``categories``.
    """
    from tenderlens.session import cut_lineage
    index = hot_index(df, c, sep) if index is None else index
    out = out or f"{c}_hot"
    cells = df.select(F.col(c).alias("__cell")).filter(F.col("__cell").isNotNull()).distinct()
    ones = (cells.select("__cell", F.explode(F.array_distinct(parts("__cell", sep))).alias("value"))
            .join(index, "value").groupBy("__cell").agg(F.array_sort(F.collect_list("code")).alias("__ones")))
    ones = cut_lineage(ones, "hot_cells")
    held = F.coalesce(F.col("__ones"), F.array().cast("array<int>"))
    j = df.join(ones, F.col(c) == F.col("__cell"), "left")
    kept = [F.col(f"`{n}`") for n in df.columns]
    return j.select(*kept, held.alias(out, metadata={"categories": index.count()}))


def multi_hot_long(df: DataFrame, key: str, c: str, sep: str = "/") -> DataFrame:
    """G4 for wide vocabularies: (key, category) rows for every 1 cell."""
    return (df.select(key, F.explode(parts(c, sep)).alias("category"))
            .filter(F.col("category") != "").distinct())


def cardinality_profile(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    """Distinct non-NULL values per column, as (column_name, n_distinct)."""
    cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"] if cols is None else cols
    agg = F.count_distinct if exact else F.approx_count_distinct
    wide = df.agg(*[agg(F.col(c)).cast("long").alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, n_distinct)")


def one_hot_low_card(df: DataFrame, cols: list[str] | None = None, min_card: int = 2, max_card: int = 10) -> DataFrame:
    """String columns with 2..10 distinct values get ``<col>_<value>`` 0/1 columns.

    One pass counts distinct values for all string columns (E7); only the
    gated columns' values (at most ``max_card`` each) reach the driver.
    """
    cols = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"] if cols is None else cols
    if not cols:
        return df
    card = {r[0]: r[1] for r in cardinality_profile(df, cols).collect()}
    gated = [c for c in cols if min_card <= card[c] <= max_card]
    if not gated:
        return df
    # one job for the values of all gated columns (bounded: <= max_card each)
    vals = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                          for c in gated])).alias("cv"))
            .select("cv.c", "cv.v").filter(F.col("v").isNotNull()).distinct().collect())
    new = {}
    for c in gated:
        for v in sorted(r[1] for r in vals if r[0] == c):
            new[f"{c}_{v}"] = F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
    return df.withColumns(new)


def label_index(df: DataFrame, c: str) -> DataFrame:
    """G6 fit: (value, code) with the sorted classes numbered from 0; '' is a class, NULL is none.

    Classes are sorted in range partitions and written once; a class's code is its
    place in its partition after the sizes of the partitions before.
    """
    from pyspark.sql import Window

    from tenderlens.session import cut_lineage
    d = df.select(F.col(c).alias("value")).where(F.col("value").isNotNull()).distinct()
    d = d.repartitionByRange("value").sortWithinPartitions("value")
    d = cut_lineage(d.withColumn("at", F.monotonically_increasing_id()), "classes")
    d = d.select("value", F.shiftright("at", 33).alias("part"),
                 F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = d.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return d.join(starts, "part").select("value", (F.col("start") + F.col("place")).cast("int").alias("code"))


def label_encode(df: DataFrame, c: str, index: DataFrame | None = None, out: str | None = None,
                 unseen: int = -1) -> DataFrame:
    """G6 apply: one fitted index for train and test (Q12); unseen / NULL -> ``unseen``."""
    index = label_index(df, c) if index is None else index
    out = out or f"{c}_code"
    j = df.join(index.withColumnRenamed("value", "__v").withColumnRenamed("code", "__code"),
                F.col(c) == F.col("__v"), "left")
    return j.withColumn(out, F.coalesce(F.col("__code"), F.lit(unseen))).drop("__v", "__code")
