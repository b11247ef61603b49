"""Order-dependent operators that must not collapse into one task.

A plain ``Window.orderBy(...)`` without a partition sends every row to a
single task, and so does a window partitioned by one hot key. Here the rows are cut
into range buckets of the whole order key; each bucket is windowed on its own, and a small per-bucket summary (at most
``max_buckets`` rows per partition key) gives the carry-in from the buckets
before it. The number of buckets grows with the row count, so bucket size
stays bounded (``rows_per_bucket``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.session import cut_lineage

BKT = "_bkt"
TB = "_tb"
ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 100_000


def tie_break(df: DataFrame):
    """Deterministic row hash used to order rows whose order keys tie."""
    cols = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(*[F.col(f"`{c}`") for c in cols])


def range_buckets(df: DataFrame, order_by, n_buckets: int | None = None,
                  rows_per_bucket: int = ROWS_PER_BUCKET,
                  max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """Add ``_bkt`` (bucket index) and ``_tb`` (row hash). Ordering rows by
    (order keys, ``_tb``) is ordering them by ``_bkt`` first.

    The buckets are the range partitions of the whole key (all order columns of
    any orderable type, then ``_tb``), so a value of the first column that many
    rows share is split by the columns after it, and the row hash only parts
    rows whose order keys all tie. Partition numbers are fixed by writing the
    rows once (``cut_lineage``); a recomputed sample could move the bounds.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    out = df.withColumn(TB, tie_break(df))
    if n_buckets is None:
        n = df.count()
        n_buckets = max(1, min(max_buckets, math.ceil(n / rows_per_bucket)))
    if n_buckets <= 1:
        return out.withColumn(BKT, F.lit(0))
    dealt = out.repartitionByRange(n_buckets, *[F.col(f"`{c}`").asc_nulls_first() for c in order_by], F.col(TB).asc())
    return cut_lineage(dealt.withColumn(BKT, F.spark_partition_id()))


def join_keys(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match NULL keys (a NULL partition key is a
    partition of its own, as in ``Window.partitionBy``)."""
    keys = list(keys)
    ren = {k: f"_r_{k}" for k in keys}
    r = right.withColumnsRenamed(ren)
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[ren[k]])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*ren.values())


def _ordered(cols, descending):
    return [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in cols]


def prefix_sums(df: DataFrame, order_by, value_cols, partition_by=(), descending: bool = False,
                prefix: str = "cum_", n_buckets: int | None = None) -> DataFrame:
    """Running (inclusive) sums of ``value_cols`` in ``order_by`` order."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    part = list(partition_by)
    b = range_buckets(df, order_by, n_buckets)
    bkt_order = F.col(BKT).desc() if descending else F.col(BKT).asc()
    totals = b.groupBy(*part, BKT).agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    wb = Window.partitionBy(*part).orderBy(bkt_order).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*part, BKT, *[F.coalesce(F.sum(f"_t_{v}").over(wb), F.lit(0))
                                        .alias(f"_c_{v}") for v in value_cols])
    if not part:
        carry = F.broadcast(carry)  # one row per bucket, at most max_buckets
    wl = (Window.partitionBy(*part, BKT).orderBy(*_ordered([*order_by, TB], descending))
          .rowsBetween(Window.unboundedPreceding, 0))
    local = b.select("*", *[F.sum(v).over(wl).alias(f"_l_{v}") for v in value_cols])
    out = join_keys(local, carry, [*part, BKT])
    return out.select(*df.columns, *[(F.col(f"_l_{v}") + F.coalesce(F.col(f"_c_{v}"), F.lit(0)))
                                     .alias(prefix + v) for v in value_cols])


def ordered_fill(df: DataFrame, cols, order_by, partition_by=(), direction: str = "forward",
                 n_buckets: int | None = None) -> DataFrame:
    """Forward ('forward') or backward ('backward') fill of NULLs in order."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    part = list(partition_by)
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    fwd = direction == "forward"
    b = range_buckets(df, order_by, n_buckets)
    okey = [F.col(o) for o in order_by] + [F.col(TB)]
    # per bucket: last (forward) / first (backward) non-NULL value in order
    pick = F.max if fwd else F.min
    summ = b.groupBy(*part, BKT).agg(*[
        pick(F.when(F.col(c).isNotNull(), F.struct(*okey, F.col(c).alias("_v")))).getField("_v")
        .alias(f"_s_{c}") for c in cols])
    if fwd:
        wb = Window.partitionBy(*part).orderBy(F.col(BKT).asc()).rowsBetween(Window.unboundedPreceding, -1)
        carry_expr = lambda c: F.last(f"_s_{c}", ignorenulls=True).over(wb)
    else:
        wb = Window.partitionBy(*part).orderBy(F.col(BKT).asc()).rowsBetween(1, Window.unboundedFollowing)
        carry_expr = lambda c: F.first(f"_s_{c}", ignorenulls=True).over(wb)
    carry = summ.select(*part, BKT, *[carry_expr(c).alias(f"_c_{c}") for c in cols])
    if not part:
        carry = F.broadcast(carry)
    if fwd:
        wl = (Window.partitionBy(*part, BKT).orderBy(*_ordered([*order_by, TB], False))
              .rowsBetween(Window.unboundedPreceding, 0))
        local = [F.last(c, ignorenulls=True).over(wl) for c in cols]
    else:
        wl = (Window.partitionBy(*part, BKT).orderBy(*_ordered([*order_by, TB], False))
              .rowsBetween(0, Window.unboundedFollowing))
        local = [F.first(c, ignorenulls=True).over(wl) for c in cols]
    filled = b.select("*", *[e.alias(f"_l_{c}") for e, c in zip(local, cols)])
    out = join_keys(filled, carry, [*part, BKT])
    return out.select(*[F.coalesce(F.col(f"_l_{c}"), F.col(f"_c_{c}")).alias(c) if c in cols
                        else F.col(c) for c in df.columns])


def ffill(df, cols, order_by, partition_by=(), n_buckets=None):
    return ordered_fill(df, cols, order_by, partition_by, "forward", n_buckets)


def bfill(df, cols, order_by, partition_by=(), n_buckets=None):
    return ordered_fill(df, cols, order_by, partition_by, "backward", n_buckets)


def ffill_bfill(df: DataFrame, cols, order_by, partition_by=(), n_buckets=None) -> DataFrame:
    """Forward fill, then backward fill what is left.

    After a forward fill only the rows before the first non-NULL value are
    still NULL, and a backward fill gives them exactly that first value, so
    the second pass is one grouped aggregate instead of another window.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    part = list(partition_by)
    okey = [F.col(o) for o in order_by] + [tie_break(df)]
    firsts = df.groupBy(*part).agg(*[
        F.min(F.when(F.col(c).isNotNull(), F.struct(*okey, F.col(c).alias("_v")))).getField("_v")
        .alias(f"_f_{c}") for c in cols])
    filled = ffill(df, cols, order_by, part, n_buckets)
    if part:
        j = join_keys(filled, firsts, part)
    else:
        j = filled.crossJoin(F.broadcast(firsts))  # exactly one row
    return j.select(*[F.coalesce(F.col(c), F.col(f"_f_{c}")).alias(c) if c in cols
                      else F.col(c) for c in df.columns])
