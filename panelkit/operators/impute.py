"""Missing values and first-row de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions import columns as C
from panelkit.functions.constants import PRIORITY_FEATURES, SPARSE_THRESHOLD
from panelkit.operators import stats as ST
from panelkit.operators.clean import sparse_columns
from panelkit.operators.ordered import bfill, ffill, ffill_bfill  # noqa: F401


def dedupe_first(df: DataFrame, keys, order_by=()) -> DataFrame:
    """Keep the first row per key in ``order_by`` order (ties: all remaining
    columns). Written as ``min(struct(order, rest))`` per key, a hash
    aggregate that combines map-side: a key holding a third of all rows
    still sends only one partial row per task through the shuffle, where a
    ``row_number`` window would sort that whole key inside one task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    orderable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    rest = [c for c in orderable if c not in keys and c not in order_by]
    fields = [*order_by, *rest]
    if not fields:
        return df.select(*keys).dropDuplicates()
    s = F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(fields)])
    best = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(s).alias("_r"))
    name = {c: f"_{i}" for i, c in enumerate(fields)}
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col("_r").getField(name[c]).alias(c)
                         for c in df.columns if c in keys or c in name])


def impute(df: DataFrame, order_by, threshold: float = SPARSE_THRESHOLD,
           priority=tuple(PRIORITY_FEATURES), partition_by=(),
           exact_limit: int | None = None) -> DataFrame:
    """Drop sparse columns, median-impute numeric columns (an all-NULL column
    gets 0), then forward / backward fill what is still missing in
    ``order_by`` order. Medians come from one statistics job. The order and
    partition keys are left as they are (not imputed, not retyped)."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = set(order_by) | set(partition_by)
    cols = [c for c in sparse_columns(df, threshold, priority) if c not in keys]
    out = df.drop(*cols) if cols else df
    num = C.numeric_cols(out, exclude=keys)
    if num:
        med = ST.medians(out, num, exact_limit)
        fill = {}
        for c in num:
            m = med.get(c)
            v = float(m) if m is not None else 0.0
            x = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
            fill[c] = F.coalesce(x, F.lit(v))
            if not isinstance(out.schema[c].dataType, (T.DoubleType, T.FloatType)):
                fill[c] = fill[c].cast("double")
        out = out.withColumns(fill)
    rest = [c for c in out.columns if c not in num and c not in keys]
    if rest:
        out = ffill_bfill(out, rest, order_by, partition_by)
    return out
