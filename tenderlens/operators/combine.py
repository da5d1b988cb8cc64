"""Combined features (F8): pairwise ratio and difference of amount columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.functions.expr import safe_ratio


def _short(c: str) -> str:
    parts = c.split("_", 2)
    return parts[2] if len(parts) > 2 else c


def pairwise_ratio_diff(df: DataFrame, cols: list[str] | None = None, prefix: str = "norm_log_") -> DataFrame:
    """``ratio_<a>_<b>`` (zero-guarded) and ``diff_<a>_<b>`` for every ordered pair a < b."""
    cols = [c for c in df.columns if c.startswith(prefix)] if cols is None else cols
    out = {}
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            out[f"ratio_{_short(a)}_{_short(b)}"] = safe_ratio(a, b)
            out[f"diff_{_short(a)}_{_short(b)}"] = F.col(a).cast("double") - F.col(b).cast("double")
    return df.withColumns(out)


def days_between_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """F9 over all pairs of Date/Timestamp columns (typed columns only, Q11)."""
    from tenderlens.functions.expr import days_between
    if cols is None:
        cols = [f.name for f in df.schema.fields if f.dataType.typeName() in ("date", "timestamp", "timestamp_ntz")]
    out = {}
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            out[f"days_between_{a}_{b}"] = days_between(a, b)
    return df.withColumns(out)
