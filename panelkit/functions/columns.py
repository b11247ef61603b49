"""Schema-level helpers. They look at column names and types only (no job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelkit.functions.constants import (DROP_PATTERNS, KEEP_COLUMNS, MERGED_PREFIXES,
                                          OUTLIER_EXCLUDE, YEAR_MAX, YEAR_MIN)


def resolve(cols, candidates):
    """First candidate (in candidate order) that is an exact column name."""
    cols = list(cols)
    for c in candidates:
        if c in cols:
            return c
    return None


def resolve_ci(cols, names):
    """First column (in table order) whose lower-cased name is in ``names``."""
    names = {n.lower() for n in names}
    for c in cols:
        if c.lower() in names:
            return c
    return None


def resolve_like(df_or_cols, terms, numeric_only: bool = False, exclude=()):
    """First column (in table order) whose lower-cased name contains a term."""
    if isinstance(df_or_cols, DataFrame):
        fields = [(f.name, f.dataType) for f in df_or_cols.schema.fields]
    else:
        fields = [(c, None) for c in df_or_cols]
    terms = [t.lower() for t in terms]
    for name, dt in fields:
        if name in exclude:
            continue
        if any(t in name.lower() for t in terms):
            if numeric_only and not isinstance(dt, T.NumericType):
                continue
            return name
    return None


def year_columns(cols, lo: int = YEAR_MIN, hi: int = YEAR_MAX):
    """Columns whose name is an integer year in [lo, hi], in table order."""
    out = []
    for c in cols:
        try:
            y = int(str(c).strip())
        except ValueError:
            continue
        if lo <= y <= hi:
            out.append(c)
    return out


def numeric_cols(df: DataFrame, exclude=()):
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_cols(df: DataFrame, exclude=()):
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def has_prefix(name: str, prefixes=tuple(MERGED_PREFIXES)) -> bool:
    return any(name.startswith(p) for p in prefixes)


def matching_columns(cols, patterns=tuple(DROP_PATTERNS), keep=tuple(KEEP_COLUMNS)):
    """Columns whose lower-cased name contains a pattern and is not kept."""
    keep = {k.lower() for k in keep}
    pats = [p.lower() for p in patterns]
    return [c for c in cols if c.lower() not in keep and any(p in c.lower() for p in pats)]


def outlier_columns(df: DataFrame, exclude=(), exempt_prefixes=tuple(MERGED_PREFIXES)):
    """Numeric columns outlier checks apply to."""
    skip = set(OUTLIER_EXCLUDE) | set(exclude)
    return [c for c in numeric_cols(df) if c not in skip and not has_prefix(c, exempt_prefixes)]


def rename_map(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename only the columns that are present."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df
