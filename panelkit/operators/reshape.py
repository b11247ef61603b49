"""Reshape: melt, pivot-first, indicator and spending extraction, topic explode.

Every operator is one lazy plan. Pivots are written as conditional
aggregates over a known domain, so they run as a single partial + final hash
aggregate (map-side combine first, then one shuffle on the index keys) and
never need a job to discover the pivot values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import columns as C
from panelkit.functions import scalars as S
from panelkit.functions.constants import INDICATOR_CODES, WIDE_KEYWORDS, YEAR_MAX, YEAR_MIN


def melt(df: DataFrame, id_vars, value_vars, var_name: str = "variable",
         value_name: str = "value") -> DataFrame:
    """Wide -> long. Value columns are made DOUBLE first (unpivot needs one type)."""
    id_vars = list(id_vars)
    value_vars = list(value_vars)
    def as_double(c):
        x = F.col(f"`{c}`")
        if isinstance(df.schema[str(c)].dataType, T.NumericType):
            return S.nan_to_null(x.cast("double"))
        return S.safe_double(x)

    typed = df.select(*[F.col(c) for c in id_vars],
                      *[as_double(c).alias(str(c)) for c in value_vars])
    return typed.unpivot(id_vars, [str(c) for c in value_vars], var_name, value_name)


def pivot_first(df: DataFrame, index, column: str, value: str, domain,
                order_by=None, names: dict | None = None) -> DataFrame:
    """Long -> wide: one column per domain value holding the first non-NULL
    ``value`` per index in ``order_by`` order (ties broken by the value).

    A hot index key is no problem: the aggregate is combined map-side, so at
    most one partial row per key and task crosses the shuffle.
    """
    index = [index] if isinstance(index, str) else list(index)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by or [])
    names = names or {}
    v = F.col(value)
    aggs = []
    for d in domain:
        key = F.struct(*[F.col(o) for o in order_by], v.alias("_v"))
        hit = (F.col(column) == F.lit(d)) & v.isNotNull()
        aggs.append(F.min(F.when(hit, key)).getField("_v").alias(names.get(d, str(d))))
    return df.groupBy(*index).agg(*aggs)


def extract_wide_panel(df: DataFrame, keywords=tuple(WIDE_KEYWORDS), lo: int = YEAR_MIN,
                       hi: int = YEAR_MAX) -> DataFrame | None:
    """Wide-by-indicator table: keep keyword columns + keys, bound the year."""
    # of several code columns the last counts
    code = next((c for c in reversed(df.columns) if "country" in c.lower() and "code" in c.lower()), None)
    year = C.resolve_like(df, ["year"])
    if code is None or year is None:
        return None
    keep = [c for c in df.columns if c not in (code, year)
            and any(k in c.upper() for k in keywords)]
    y = S.to_int(df, year)
    return (df.select(S.norm_key(F.col(f"`{code}`")).alias("country_code"), y.alias("year"),
                      *[S.safe_double(F.col(f"`{c}`")).alias(c) for c in keep])
              .where(F.col("year").between(lo, hi)))


def extract_indicators(df: DataFrame, mapping: dict | None = None, lo: int = YEAR_MIN,
                       hi: int = YEAR_MAX, entity_col: str = "Country Code",
                       code_col: str = "Indicator Code", order_by=None) -> DataFrame | None:
    """Indicator table -> panel (country_code, year, one column per indicator).

    Wide-by-year input: filter codes, pick the year columns in range *before*
    the unpivot (so the scan reads only those), melt, drop NULL values, pivot
    back with first-value semantics, rename codes to names.
    Wide-by-indicator input falls back to ``extract_wide_panel``.
    """
    mapping = mapping or INDICATOR_CODES
    years = C.year_columns(df.columns, lo, hi)
    if entity_col not in df.columns or code_col not in df.columns or not years:
        return extract_wide_panel(df, lo=lo, hi=hi)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by or [])
    base = df.where(F.col(f"`{code_col}`").isin(list(mapping)))
    base = base.select(S.norm_key(F.col(f"`{entity_col}`")).alias("country_code"),
                       F.col(f"`{code_col}`").alias("_code"),
                       *[F.col(f"`{o}`") for o in order_by],
                       *[F.col(f"`{y}`") for y in years])
    long = melt(base, ["country_code", "_code", *order_by], years, "_year", "_value")
    # year column names were validated as integers in [lo, hi] on the driver
    long = long.withColumn("_year", F.col("_year").try_cast("int")).where(F.col("_value").isNotNull())
    wide = pivot_first(long, ["country_code", "_year"], "_code", "_value", list(mapping),
                       order_by=order_by, names=mapping)
    return wide.withColumnRenamed("_year", "year")


def extract_spending(df: DataFrame, lo: int = YEAR_MIN, hi: int = YEAR_MAX,
                     order_by=None) -> DataFrame | None:
    """Long spending table -> (country_name, year, military_expenditure).

    Name column: first whose name holds country/code/iso/name; year column:
    first holding 'year'; value: 'Value' else the first numeric column named
    like spending. Text values such as '...' become NULL and are dropped.
    Names are normalised before the (name, year) de-duplication, so the later
    join on the normalised name cannot multiply rows.
    """
    from panelkit.operators.impute import dedupe_first

    name = C.resolve_like(df, ["country", "code", "iso", "name"])
    year = C.resolve_like(df, ["year"])
    value = "Value" if "Value" in df.columns else C.resolve_like(
        df, ["spending", "expenditure", "military", "defense", "defence", "value"], numeric_only=True)
    if not (name and year and value):
        return None
    order_by = [order_by] if isinstance(order_by, str) else list(order_by or [])
    out = (df.select(S.norm_key(F.col(f"`{name}`")).alias("country_name"),
                     S.to_int(df, year).alias("year"),
                     S.safe_double(F.col(f"`{value}`")).alias("military_expenditure"),
                     *[F.col(f"`{o}`") for o in order_by])
             .where(F.col("year").between(lo, hi) & F.col("military_expenditure").isNotNull()))
    out = dedupe_first(out, ["country_name", "year"], order_by or ["military_expenditure"])
    return out.select("country_name", "year", "military_expenditure")


def explode_topics(df: DataFrame, column: str, out: str = "topic") -> DataFrame:
    """Split ';' / ',' delimited topics, strip, keep those longer than 2."""
    parts = F.split(F.col(column).cast("string"), "[;,]")
    t = df.where(F.col(column).isNotNull()).select(F.explode(parts).alias("_t"))
    return t.select(S.strip("_t").alias(out)).where(F.length(out) > 2)
