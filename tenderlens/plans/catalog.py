"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Each Spark callable takes ``(spark, sf_dir)`` and reads the driver tables
(through the views in :mod:`tenderlens.sources.views`). The oracle SQL runs
in DuckDB on the same parquet tables. Double outputs are rounded to 6 digits
on both sides (sums differ in the last bits by summation order).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}
DIGITS = 6


def query(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round double columns the same way as :func:`r` (one SQL-text projection)."""
    scale = f"CAST({float(10 ** digits)!r} AS DOUBLE)"
    exprs = []
    for f in df.schema.fields:
        name = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            # multiply, round to an integer, divide: the same IEEE steps in both engines; halves go away from zero
            # as with round(x, 0), which would make a decimal of every value
            x = f"(CAST({name} AS DOUBLE) * {scale})"
            whole = f"CASE WHEN abs({x} - rint({x})) = 0.5D THEN {x} + 0.5D * signum({x}) ELSE rint({x}) END"
            exprs.append(f"({whole}) / {scale} + CAST(0.0 AS DOUBLE) AS {name}")
        else:
            exprs.append(name)
    return df.selectExpr(*exprs)


def q(name: str) -> str:
    """Double-quote an identifier for DuckDB."""
    return '"' + name.replace('"', '""') + '"'


def r(expr: str, digits: int = DIGITS) -> str:
    scale = f"{float(10 ** digits)!r}"
    return f"(round(CAST({expr} AS DOUBLE) * CAST({scale} AS DOUBLE)) / CAST({scale} AS DOUBLE) + 0.0)"


def strip_sql(col: str) -> str:
    return f"regexp_replace(coalesce({col}, 'nan'), '\\s+', '', 'g')"


def register_all() -> None:
    # import modules that register queries (kept in separate files by area)
    from tenderlens.plans import catalog_tender  # noqa: F401
    for mod in ("catalog_clean", "catalog_features", "catalog_dist", "catalog_models", "catalog_store"):
        try:
            __import__(f"tenderlens.plans.{mod}")
        except ModuleNotFoundError as e:  # area not built yet
            if mod not in str(e):
                raise
