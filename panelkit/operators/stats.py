"""Column statistics and exploratory tables.

Statistics for many columns are computed in ONE aggregate job (the reference
loops per column). Only these per-column numbers reach the driver; data rows
never do.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions import columns as C
from panelkit.functions import scalars as S
from panelkit.functions.constants import EDA_ENTITY_CANDIDATES, EDA_TOPIC_CANDIDATES
from panelkit.session import cut_lineage

# Bits that a pass of the quantile selection looks at, and the accuracy of the sketch before them.
DIGIT, SKETCH = 13, 1000


def _q(c: str) -> str:
    return f"`{c}`"


# --- quantiles ---------------------------------------------------------------

def quantiles(df: DataFrame, cols, probs, exact_limit: int | None = None, approx: bool = False) -> dict:
    """Exact quantiles with linear interpolation: {col: [value per prob]}; with ``approx`` those of ``approx_quantiles``.

    One plan at every size, for all columns and ranks together. A sketch of each column
    names bounds close around each rank; a count of the values below and between
    them says exactly where the rank lies (a rank that the sketch missed goes on outside
    the bounds). The values between the bounds, about 0.4 % of the rows and those
    equal to a bound, are then counted by digits of their order-preserving 64-bit image
    (``scalars.order_key``); the digit that holds a rank gives the next bounds, until they
    meet: one or two passes as a rule, ``64 / DIGIT`` at most. All other rows only meet
    plain comparisons. The driver sees at most ``2^DIGIT`` + 1 counts a column and
    rank. ``exact_limit`` has no effect any more.
    """
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols or not probs:
        return {c: [] for c in cols}
    if approx:
        return approx_quantiles(df, cols, probs)
    x = [S.nan_to_null(F.col(_q(c)).cast("double")) for c in cols]
    near = [min(1.0, max(0.0, p + d)) for p in probs for d in (-2 / SKETCH, 2 / SKETCH)]
    first = df.agg(*[F.count(v).alias(f"n{k}") for k, v in enumerate(x)],
                   *[F.percentile_approx(v, near, SKETCH).alias(f"q{k}") for k, v in enumerate(x)]).first()
    size = {k: first[f"n{k}"] for k in range(len(cols)) if first[f"n{k}"]}
    bounds: dict = {}  # (column, rank) -> (low, high) values
    for k, n in size.items():
        for i, p in enumerate(probs):
            low = math.floor(p * (n - 1))
            bounds |= {(k, rank): tuple(first[f"q{k}"][2 * i:2 * i + 2]) for rank in (low, min(n - 1, low + 1))}
    found, prefix = _placed(df, x, bounds)
    while prefix:
        spans = sorted({(k, lo, hi) for (k, _), (lo, hi, _) in prefix.items()})
        inside = [x[k].between(S.from_order_key(lo), S.from_order_key(hi)) for k, lo, hi in spans]
        # so that at most 2^DIGIT + 1 digits lie between the bounds
        shift = [max(0, (hi - lo).bit_length() - DIGIT) for _, lo, hi in spans]
        rows = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.when(inside[j], x[k]).alias("v"), F.lit(shift[j]).alias("shift"))
                                   for j, (k, _, _) in enumerate(spans)]))
        # the image is worked out behind the explode, where its long expression occurs once
        rows = df.where(reduce(or_, inside)).select(rows.alias("p")).select("p.*").where(F.col("v").isNotNull())
        counted = rows.select("j", "shift", S.order_key("v").alias("key")).groupBy(
            "j", F.expr("shiftright(key, shift)").alias("digit")).agg(
            F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).collect()
        by_span: dict = {}
        for r in sorted(counted, key=lambda r: r.digit):
            by_span.setdefault(spans[r.j], []).append(r)
        for (k, rank), (lo, hi, left) in list(prefix.items()):
            for r in by_span[k, lo, hi]:
                if left < r.n:
                    break
                left -= r.n
            if r.lo == r.hi:
                found[k, rank] = r.lo
                del prefix[k, rank]
            else:
                prefix[k, rank] = (r.lo, r.hi, left)
    out = {}
    for k, c in enumerate(cols):
        out[c] = [None] * len(probs) if k not in size else []
        for p in probs if k in size else ():
            at = p * (size[k] - 1)
            low = math.floor(at)
            a, b = (S.from_order_key(found[k, rank]) for rank in (low, min(size[k] - 1, low + 1)))
            out[c].append(a if a == b else a + (b - a) * (at - low))  # inf - inf would be NaN
    return out


def _placed(df: DataFrame, x, bounds: dict) -> tuple[dict, dict]:
    """({(column, rank): key} of ranks that are found, {(column, rank): (low key, high key, rank between them)} of the
    others) from one count of the values below and up to each pair of bounds."""
    pairs = sorted({(k, lo, hi) for (k, _), (lo, hi) in bounds.items()})
    if not pairs:
        return {}, {}
    r = df.agg(*[F.count(F.when(x[k] < lo, 1)).alias(f"b{j}") for j, (k, lo, _) in enumerate(pairs)],
               *[F.count(F.when(x[k] <= hi, 1)).alias(f"u{j}") for j, (k, _, hi) in enumerate(pairs)]).first()
    found, prefix = {}, {}
    end = S.to_order_key(math.inf)
    for (k, rank), (lo, hi) in bounds.items():
        j = pairs.index((k, lo, hi))
        below, up_to = r[f"b{j}"], r[f"u{j}"]
        lo, hi = S.to_order_key(lo), S.to_order_key(hi)
        if rank < below:
            prefix[k, rank] = (-end, lo - 1, rank)
        elif rank >= up_to:
            prefix[k, rank] = (hi + 1, end, rank - up_to)
        elif lo == hi:
            found[k, rank] = lo
        else:
            prefix[k, rank] = (lo, hi, rank - below)
    return found, prefix


# --- mergeable sketches, and the approximate forms -------------------------------

#: log2 of the registers of a distinct sketch (relative error about 1.04 / 2^(LG_K / 2), 1.6 %), and the size of a
#: quantile sketch (a rank is off by 1.4 % of the rows or less with 99 % confidence).
LG_K, KLL_K = 12, 200


def sketches(df: DataFrame, cols, by=()) -> DataFrame:
    """(by..., column, n, distinct_sketch, quantile_sketch): what is needed of each part of a table
    to answer for any union of parts later, in a few kilobytes a part and column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), S.nan_to_null(F.col(_q(c)).cast("double")).alias("v"))
                                for c in cols]))
    return df.select(*by, pairs.alias("p")).select(*by, "p.*").groupBy(*by, "column").agg(
        F.count("v").alias("n"), F.hll_sketch_agg(S.order_key("v"), LG_K).alias("distinct_sketch"),
        F.kll_sketch_agg_double("v", KLL_K).alias("quantile_sketch"))


def merge_sketches(parts: DataFrame, by=()) -> DataFrame:
    """The sketches of the unions of the parts that share ``by``."""
    return parts.groupBy(*by, "column").agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def from_sketches(merged: DataFrame, probs, by=()) -> DataFrame:
    """(by..., column, n, n_distinct, quantiles) with the stated errors; quantiles are values of the column."""
    q = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.array(*[F.lit(float(p)) for p in probs])))
    return merged.select(*by, "column", "n", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), q.alias("quantiles"))


def approx_quantiles(df: DataFrame, cols, probs) -> dict:
    """{col: [value per prob]} from sketches: one job, each value's rank off by about 1.4 % at most."""
    cols = list(cols)
    out = {c: [None] * len(list(probs)) for c in cols}
    if cols:
        for r in from_sketches(sketches(df, cols), probs).collect():
            out[r.column] = list(r.quantiles) if r.quantiles is not None else out[r.column]
    return out


def distinct_counts(df: DataFrame, cols, approx: bool = False) -> DataFrame:
    """(column, n_distinct) of non-missing values: exact, or by a sketch (one partially aggregated job)."""
    if approx:
        return from_sketches(sketches(df, cols), [0.5]).select("column", F.col("n_distinct").cast("long").alias("n_distinct"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(_q(c)).cast("double").alias("v")) for c in cols]))
    # the image behind the explode: with one for each column the generated code is too long to compile
    vals = df.select(pairs.alias("p")).select("p.column", S.order_key("p.v").alias("v")).where(F.col("v").isNotNull()).distinct()
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return names.join(vals.groupBy("column").agg(F.count("*").alias("n")), "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).alias("n_distinct"))


def distinct_sample(df: DataFrame, cols, k: int = 20, seed: int = 42) -> DataFrame:
    """(column, rank, value): of each column the ``k`` distinct values (as text) of the smallest md5, the same on every run.

    Only values whose hash lies under a bound are made distinct and ranked; the bound
    follows from a sketch of the distinct count and rises until it holds ``k`` values (or all)."""
    cols = list(cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(_q(c)).cast("string").alias("value")) for c in cols]))
    long = df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
    long = long.withColumn("_h", F.md5(F.concat("value", F.lit(f"-{seed}"))))
    at = F.conv(F.substring("_h", 1, 8), 16, 10).cast("long")
    about = {r.column: r.d for r in long.groupBy("column").agg(F.approx_count_distinct("value").alias("d")).collect()}
    bound = {c: min(1 << 32, (1 << 32) * 4 * k // max(1, about.get(c, 1))) for c in cols}
    order = Window.partitionBy("column").orderBy("_h", "value")
    while True:
        bounds = df.sparkSession.createDataFrame(sorted(bound.items()), "column string, _bound long")
        low = long.join(F.broadcast(bounds), "column").where(at < F.col("_bound")).select("column", "value", "_h").distinct()
        out = cut_lineage(low.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
            "column", "rank", "value"))
        got = {r.column: r["n"] for r in out.groupBy("column").agg(F.count("*").alias("n")).collect()}
        short = [c for c in cols if got.get(c, 0) < k and bound[c] < 1 << 32]
        if not short:
            return out
        bound |= {c: min(1 << 32, 16 * bound[c]) for c in short}


def medians(df: DataFrame, cols, exact_limit: int | None = None) -> dict:
    return {c: v[0] for c, v in quantiles(df, cols, [0.5], exact_limit).items()}


def describe_cols(df: DataFrame, cols) -> dict:
    """{col: (mean, sample std, count)} in one job."""
    cols = list(cols)
    if not cols:
        return {}
    aggs = []
    for c in cols:
        x = S.nan_to_null(F.col(_q(c)).cast("double"))
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_samp(x).alias(f"s_{c}"), F.count(x).alias(f"n_{c}")]
    r = df.agg(*aggs).first().asDict()
    return {c: (r[f"m_{c}"], r[f"s_{c}"], r[f"n_{c}"]) for c in cols}


# --- grouped tables ------------------------------------------------------------

def value_counts(df: DataFrame, col: str, name: str = "count") -> DataFrame:
    """Frequency of each non-NULL value (partial + final hash aggregate)."""
    return df.where(F.col(_q(col)).isNotNull()).groupBy(_q(col)).agg(F.count("*").alias(name))


def top_counts(df: DataFrame, col: str, k: int, name: str = "count") -> DataFrame:
    """Top-k values by frequency (ties by value); plans as TakeOrderedAndProject."""
    return value_counts(df, col, name).orderBy(F.col(name).desc(), F.col(_q(col)).asc()).limit(k)


def top_share(df: DataFrame, col: str) -> DataFrame:
    """Share of the most frequent non-NULL value among non-NULL values."""
    vc = value_counts(df, col)
    return vc.agg(F.try_divide(F.max("count"), F.sum("count")).alias("top_share"))


def rate_by(df: DataFrame, key: str, target: str) -> DataFrame:
    """Per key: mean and count of the target (rows with NULL key/target dropped)."""
    return (df.where(F.col(key).isNotNull() & F.col(target).isNotNull())
              .groupBy(key)
              .agg(F.avg(F.col(target).cast("double")).alias("mean"), F.count("*").alias("count"))
              .where(F.col("count") > 0))


def null_profile(df: DataFrame, cols=None) -> DataFrame:
    """Per column: present count (neither NULL nor NaN), total rows, percent (one job)."""
    cols = list(cols or df.columns)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, non_null long, total long, pct double")
    one = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count(S.present(df, c)).alias(c) for c in cols])
    long = one.unpivot(["_total"], cols, "column", "non_null")
    return long.select("column", F.col("non_null").cast("long").alias("non_null"),
                       F.col("_total").cast("long").alias("total"),
                       S.pct("non_null", "_total").alias("pct"))


def histogram(df: DataFrame, col: str, max_bins: int = 30) -> DataFrame:
    """Equal-width histogram with min(max_bins, distinct) bins, last bin closed."""
    x = F.col(_q(col)).cast("double")
    st = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"),
                F.approx_count_distinct(x, 0.05).alias("nd")).first()
    spark = df.sparkSession
    if st["lo"] is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count long")
    nd = st["nd"]
    if nd < 2 * max_bins:  # 2x covers the 5% estimate error many times over
        # only a small column can have fewer distinct values than bins: count
        # them exactly (few groups, combined map-side)
        nd = df.where(x.isNotNull()).select(x.alias("_x")).distinct().count()
    nb = max(1, min(max_bins, nd))
    lo, hi = float(st["lo"]), float(st["hi"])
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / nb
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(nb - 1))
    return (df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("count"))
              .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "count"))


def pair_corr(x, y):
    """Pearson correlation over pairwise-complete rows; NULL when a side is
    constant (a plain ``corr`` raises DIVIDE_BY_ZERO under ANSI)."""
    both = x.isNotNull() & y.isNotNull()
    xx, yy = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def target_correlations(df: DataFrame, target: str, cols=None) -> DataFrame:
    """(feature, corr) of every numeric column with the target; NULL dropped."""
    cols = [c for c in (cols or C.numeric_cols(df)) if c != target]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "feature string, corr double")
    y = S.nan_to_null(F.col(_q(target)).cast("double"))
    one = df.agg(*[pair_corr(S.nan_to_null(F.col(_q(c)).cast("double")), y).alias(c) for c in cols])
    return one.unpivot([], cols, "feature", "corr").where(F.col("corr").isNotNull())


def extremes(corr: DataFrame, n: int = 15, key: str = "feature", value: str = "corr") -> DataFrame:
    """Top floor(n/2) and bottom floor(n/2) by value, each label once."""
    h = n // 2
    w_desc = Window.orderBy(F.col(value).desc(), F.col(key))
    w_asc = Window.orderBy(F.col(value).asc(), F.col(key).desc())
    # the correlation table has one row per column, so these windows are tiny
    r = corr.select(key, value, F.row_number().over(w_desc).alias("_d"),
                    F.row_number().over(w_asc).alias("_a"))
    return r.where((F.col("_d") <= h) | (F.col("_a") <= h)).select(key, value)


def best_by(df: DataFrame, key: str, metric: str) -> DataFrame:
    """Row key with the highest metric (first key on ties)."""
    order = F.struct((-F.col(metric).cast("double")).alias("m"), F.col(key).alias("k"))
    return df.where(F.col(metric).isNotNull()).agg(F.min_by(F.col(key), order).alias(key),
                                                   F.max(metric).alias(metric))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    vc = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_c"))
    w = Window.partitionBy()  # over the class table only (one row per class)
    return vc.select(label, "n_c", (F.sum("n_c").over(w) / (F.count("*").over(w) * F.col("n_c")))
                     .alias("weight"))


def quality_report(df: DataFrame, cols=None) -> DataFrame:
    """Per numeric column: non-NULL count/percent, mean, sample std."""
    cols = list(cols or C.numeric_cols(df))
    prof = null_profile(df, cols)
    if not cols:
        return prof
    aggs = []
    for c in cols:
        x = S.nan_to_null(F.col(_q(c)).cast("double"))
        aggs.append(F.struct(F.lit(c).alias("column"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std")))
    st = df.agg(F.array(*aggs).alias("a")).select(F.explode("a").alias("s")).select("s.*")
    return prof.join(st, "column", "left")


def eda_tables(df: DataFrame, target: str = "vote", max_bins: int = 30, top_entities: int = 10,
               top_topics: int = 8, top_n: int = 15) -> dict:
    """Data behind the exploratory charts: target counts, year histogram, top
    entities, top topics (or sessions), correlation extremes, yearly rate."""
    from panelkit.operators.reshape import explode_topics

    out = {}
    if target in df.columns:
        out["target_counts"] = value_counts(df, target)
    if "year" in df.columns:
        out["year_hist"] = histogram(df, "year", max_bins)
        if target in df.columns:
            out["yearly_rate"] = rate_by(df, "year", target)
    ent = C.resolve(df.columns, EDA_ENTITY_CANDIDATES)
    if ent:
        out["top_entities"] = top_counts(df, ent, top_entities)
    topic = C.resolve(df.columns, EDA_TOPIC_CANDIDATES)
    if topic == "subjects":
        t = explode_topics(df, topic)
        out["top_topics"] = top_counts(t, "topic", top_topics).select(
            S.truncate_label("topic").alias("topic"), "count")
    elif topic:
        out["top_topics"] = top_counts(df.select(F.col(topic).cast("string").alias("topic")),
                                       "topic", top_topics)
    elif "session" in df.columns:
        out["top_topics"] = top_counts(df, "session", top_topics)
    if target in df.columns:
        out["corr_extremes"] = extremes(target_correlations(df, target), top_n)
    return out


def column_summary(df: DataFrame, cols, exact_limit: int | None = None) -> DataFrame:
    """Per column: distinct count, min, max, mean, sample std, quartiles and
    median (exact), share of the most frequent value. Three jobs for all
    columns together: moments, quantiles, and one (column, value) count
    table that yields both the distinct counts and the top shares."""
    cols = list(cols)
    spark = df.sparkSession
    aggs = []
    for c in cols:
        x = S.nan_to_null(F.col(_q(c)).cast("double"))
        aggs += [F.min(x).alias(f"lo_{c}"), F.max(x).alias(f"hi_{c}"),
                 F.avg(x).alias(f"m_{c}"), F.stddev_samp(x).alias(f"s_{c}")]
    r = df.agg(*aggs).first().asDict()
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], exact_limit)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), S.nan_to_null(F.col(_q(c)).cast("double")).alias("v"))
                                for c in cols]))
    vc = (df.select(pairs.alias("p")).select("p.*").where(F.col("v").isNotNull())
            .groupBy("k", "v").agg(F.count("*").alias("n")))
    per = vc.groupBy("k").agg((F.max("n") / F.sum("n")).alias("s"), F.count("*").alias("d")).collect()
    share = {x["k"]: x["s"] for x in per}
    distinct = {x["k"]: x["d"] for x in per}
    rows = [(c, distinct.get(c, 0), r[f"lo_{c}"], r[f"hi_{c}"], r[f"m_{c}"], r[f"s_{c}"], *qs[c], share.get(c))
            for c in cols]
    return spark.createDataFrame(rows, "column string, n_distinct long, min double, max double, mean double, "
                                       "std double, q1 double, median double, q3 double, top_share double")


def audit_table(steps: dict) -> DataFrame:
    """(step_no, step, rows, cols) for an ordered {step: DataFrame} mapping;
    one count per step, all in one union plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(i).alias("step_no"), F.lit(name).alias("step"), "rows", F.lit(len(df.columns)).alias("cols"))
        for i, (name, df) in enumerate(steps.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
