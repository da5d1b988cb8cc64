"""Scalar column expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Spark 4 runs with ANSI on: divisions, casts and timestamp parsing use the
``try_`` forms so that bad input becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the tender data conventions.
RANGE_LEVELS = {"+3%~-3%": 3, "+2%~-2%": 2}
RATE_PATTERN = r"(-?[0-9]+\.[0-9]+)"
PERCENT_PATTERN = r"([-+]?[0-9]+(?:\.[0-9]+)?)%"
GRANULARITIES = (10, 20, 50, 100)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_rate(c) -> Column:
    """first decimal number (a dot is required) in a text, else NULL."""
    txt = _c(c).cast("string")
    return F.nullif(F.regexp_extract(txt, RATE_PATTERN, 1), F.lit("")).try_cast("double")


def strip_whitespace(c, null_text: str = "nan") -> Column:
    """Remove every (Unicode) whitespace; NULL becomes the text ``nan``."""
    return F.regexp_replace(F.coalesce(_c(c).cast("string"), F.lit(null_text)), r"(?U)\s+", "")


def range_level(c) -> Column:
    """exact range text (after trimming) to level 3 / 2, else 0."""
    t = F.trim(_c(c))
    expr = F.lit(0)
    for text, level in reversed(list(RANGE_LEVELS.items())):
        expr = F.when(t == text, F.lit(level)).otherwise(expr)
    return expr


def range_percents(c) -> Column:
    """All ``<number>%`` tokens of a range text, as an array of doubles."""
    return F.transform(F.regexp_extract_all(_c(c), F.lit(PERCENT_PATTERN), 1),
                       lambda s: s.cast("double"))


def range_bounds(c) -> Column:
    """struct(lower, upper, valid). Valid only with exactly two percents."""
    arr = range_percents(c)
    ok = F.size(arr) == 2
    return F.struct(
        F.when(ok, F.array_min(arr)).alias("lower"),
        F.when(ok, F.array_max(arr)).alias("upper"),
        ok.alias("valid"),
    )


def log1p_strict(c) -> Column:
    """log1p; a negative input raises at run time (as the reference does)."""
    x = _c(c).cast("double")
    return F.when(x < 0, F.raise_error(F.lit("log1p_strict: negative value"))).otherwise(F.log1p(x))


def safe_ratio(a, b, zero_default: bool = True) -> Column:
    """A / b; zero or NULL denominators give 0 (guarded) or NULL."""
    r = F.try_divide(_c(a).cast("double"), _c(b).cast("double"))
    return F.coalesce(r, F.lit(0.0)) if zero_default else r


def days_between(a, b) -> Column:
    """floor of (a - b) in days, like a pandas timedelta ``.days``.

    ``timestamp_diff`` in microseconds: wall-clock difference for TIMESTAMP_NTZ
    (no session time zone, so no DST hour), instant difference otherwise.
    """
    micros = F.timestamp_diff("MICROSECOND", _c(b), _c(a))
    return F.floor(micros / F.lit(86_400_000_000)).cast("long")


def date_parts(c, name: str) -> list[Column]:
    """year, month, day, weekday (Monday = 0), quarter."""
    x = _c(c)
    return [
        F.year(x).alias(f"{name}_year"),
        F.month(x).alias(f"{name}_month"),
        F.dayofmonth(x).alias(f"{name}_day"),
        F.weekday(x).alias(f"{name}_weekday"),
        F.quarter(x).alias(f"{name}_quarter"),
    ]


def normalize_text(c) -> Column:
    """non-word characters to a space (Unicode aware), then lower case."""
    return F.lower(F.regexp_replace(F.coalesce(_c(c), F.lit("")), r"[^\p{L}\p{N}_\s]", " "))


def a_value_ratio(a, base_logged) -> Column:
    """A-value over (1 + log1p(base)); the base was already log-transformed."""
    return F.try_divide(_c(a).cast("double"), F.lit(1.0) + _c(base_logged).cast("double"))


def target_label(n, i) -> Column:
    """zero-padded ``NNN_iii`` label."""
    return F.format_string("%03d_%03d", _c(n), _c(i))


def target_name(n: int, i: int) -> str:
    return f"{n:03d}_{i:03d}"


def all_target_names() -> list[str]:
    return [target_name(n, i) for n in GRANULARITIES for i in range(1, n + 1)]


def parse_target_name(c) -> list[Column]:
    """``NNN_iii`` to (prefix, bin)."""
    parts = F.split(_c(c), "_")
    return [parts.getItem(0).alias("prefix"), parts.getItem(1).try_cast("int").alias("bin")]
