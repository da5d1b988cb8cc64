"""The generic role-driven preprocessing plan (P2) with a user hook.

Stages: validate -> clean (essential NULLs, medians, 'Unknown', keep-first
dedupe, IQR capping, date coercion) -> transform (log of amount columns,
min-max, low-cardinality one-hot, date parts) -> features (TF-IDF of text
columns, numeric PCA, k-best selection, pairwise ratios and differences, days
between dates) -> hook -> named price ratios.

The cleaned table is written once (``cut_lineage``) with a row number, so the
statistics of the later stages read it and not the stages before. Blocks of
features computed aside (TF-IDF) are joined back on that number: a row
meets its own features only, whatever the key repeats; PCA scores are sums over a
row's own columns. Keys are never filled, scaled or retyped.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlens.functions.expr import date_parts, safe_ratio
from tenderlens.operators import clean as CL
from tenderlens.operators import encode as EN
from tenderlens.operators import scale as SC
from tenderlens.operators.combine import days_between_all, pairwise_ratio_diff
from tenderlens.roles import AMOUNT_KEYWORDS, DATE_KEYWORDS, TEXT_KEYWORDS, ColumnRoles, require_columns
from tenderlens.session import cut_lineage

Hook = Callable[[DataFrame, str, ColumnRoles], DataFrame]


ROW = "__row"
RAW = "__raw_"

# The bid-price ratios (name, numerator, denominator, zero-guarded).
PRICE_RATIOS = (
    ("낙찰가격비율", "투찰가", "예정금액", False),
    ("예정가비율", "예정금액", "기초금액", True),
    ("log_예정가비율", "norm_log_예정금액", "norm_log_기초금액", True),
    ("투찰가_기초금액비율", "투찰가", "기초금액", True),
    ("투찰가_예정금액비율", "투찰가", "예정금액", True),
)


def roles_for(name: str, configs: dict[str, ColumnRoles], default: ColumnRoles | None = None,
              by_type: dict[str, ColumnRoles] | None = None) -> ColumnRoles | None:
    """The config whose file pattern matches the dataset/file name (glob), else that of the dataset
    type the name starts with, else the default."""
    for pattern, roles in configs.items():
        if fnmatch.fnmatch(name, pattern):
            return roles
    for kind, roles in (by_type or {}).items():
        if name.startswith(kind):
            return roles
    return default


def _own(df: DataFrame, roles: ColumnRoles) -> tuple[str, ...]:
    """Columns that are carried along untouched: the key, the row number, unscaled amounts."""
    return (*([roles.key] if roles.key else []), ROW, *[c for c in df.columns if c.startswith(RAW)])


def _amount_cols(df: DataFrame, roles: ColumnRoles) -> list[str]:
    return [c for c in CL.numeric_columns(df, _own(df, roles)) if any(k in c for k in AMOUNT_KEYWORDS)]


def _date_cols(df: DataFrame, roles: ColumnRoles) -> list[str]:
    return [c for c in (roles.date or df.columns) if c in df.columns
            and (roles.date or any(k in c.lower() for k in DATE_KEYWORDS))]


def _text_cols(df: DataFrame, roles: ColumnRoles) -> list[str]:
    strings = CL.string_columns(df)
    return [c for c in roles.text if c in strings] or [c for c in strings if any(k in c for k in TEXT_KEYWORDS)]


def clean(df: DataFrame, roles: ColumnRoles) -> DataFrame:
    d = CL.drop_null_keys(df, [c for c in roles.essential if c in df.columns])
    d = CL.fill_median(d, CL.numeric_columns(d, _own(d, roles)))
    d = CL.fill_constant(d, [c for c in CL.string_columns(d) if c != roles.key], "Unknown")
    if roles.dedupe_key and roles.dedupe_key in d.columns:
        d = CL.dedupe_keep_first(d, [roles.dedupe_key],
                                 list(roles.order_cols) or [c for c in d.columns if c != roles.dedupe_key])
    d = CL.cap_outliers_iqr(d, _amount_cols(d, roles))
    dates = _date_cols(d, roles)
    return CL.coerce_dates(d, dates) if dates else d


def transform(df: DataFrame, roles: ColumnRoles, ratios_on_scaled: bool = False) -> DataFrame:
    amounts = [c for c in roles.log if c in df.columns] or _amount_cols(df, roles)
    d = SC.log1p_shifted(df, amounts) if amounts else df
    if not ratios_on_scaled:
        used = {c for _, x, y, _ in PRICE_RATIOS for c in (x, y)} & set(d.columns)
        d = d.withColumns({f"{RAW}{c}": F.col(c) for c in sorted(used)})
    keep_out = {*roles.target, *_own(d, roles)}
    scale_cols = [c for c in (roles.scale or SC.scalable_columns(d, roles.exclude_keywords))
                  if c in d.columns and c not in keep_out]
    d = SC.minmax_scale(d, scale_cols) if scale_cols else d
    texts = _text_cols(d, roles)
    cats = [c for c in (roles.categorical or CL.string_columns(d))
            if c in d.columns and c != roles.key and c not in texts]
    d = EN.one_hot_low_card(d, cats) if cats else d
    for c in [f.name for f in d.schema.fields if f.dataType.typeName() in ("timestamp", "timestamp_ntz", "date")]:
        d = d.select("*", *date_parts(c, c))
    return d


def features(df: DataFrame, roles: ColumnRoles, k_best: int = 10, advanced: bool = False) -> DataFrame:
    """Feature blocks; ``df`` carries the row number :data:`ROW`, on which blocks are joined."""
    from tenderlens.operators.select import MIN_FEATURES, MIN_ROWS, select_k_best
    from tenderlens.operators.text import tfidf_wide
    d = df
    for c in _text_cols(d, roles):
        d = tfidf_wide(d, ROW, c)
    targets = [t for t in roles.target if t in d.columns]
    if targets:
        cand = [c for c in CL.numeric_columns(d, (*targets, *_own(d, roles)))]
        if len(cand) >= MIN_FEATURES and d.limit(MIN_ROWS).count() >= MIN_ROWS:
            d = select_k_best(d, cand, targets[0], k_best)
    if advanced:
        from tenderlens.operators.reduce import add_pca_numeric
        d = add_pca_numeric(d, CL.numeric_columns(d, _own(d, roles)))
    d = pairwise_ratio_diff(d)
    return days_between_all(d)


def price_ratios(df: DataFrame, ratios=PRICE_RATIOS) -> DataFrame:
    """The named ratios whose columns are there, of the unscaled values where they were kept."""
    at = lambda c: f"{RAW}{c}" if f"{RAW}{c}" in df.columns else c
    return df.withColumns({name: safe_ratio(at(x), at(y), guarded) for name, x, y, guarded in ratios
                           if x in df.columns and y in df.columns})


def run(df: DataFrame, name: str, roles: ColumnRoles, hook: Hook | None = None, advanced: bool = False,
        save: Callable[[DataFrame, str], None] | None = None, ratios_on_scaled: bool = False) -> DataFrame:
    """P2 for one dataset; ``hook(df, name, roles)`` runs after feature engineering."""
    require_columns(df, list(roles.required), name)
    # the row number is written with the row, so every later read sees the same one
    d = cut_lineage(clean(df, roles).withColumn(ROW, F.monotonically_increasing_id()), "cleaned")
    d = transform(d, roles, ratios_on_scaled)
    if _text_cols(d, roles) or roles.target or advanced:  # statistics of the scaled table follow
        d = cut_lineage(d, "transformed")
    d = features(d, roles, advanced=advanced)
    if hook is not None:
        d = d.transform(lambda x: hook(x, name, roles))
    d = price_ratios(d)
    d = d.drop(ROW, *[c for c in d.columns if c.startswith(RAW)])
    if save is not None:
        save(d, name)
    return d
