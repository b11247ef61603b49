"""Exact, deterministic stratified split, k folds and fixed-size samples.

Every row gets a pseudo-random key ``md5(id | '-' seed)``. Within each
class, rows are ranked by that key; the first ``round(test_size * n_c)``
form the test set and ``rank % k`` is the fold. The same keys can be computed
in any SQL engine, so splits are reproducible outside Spark. The ids should
name a row: rows that share all ids share a key and are ordered by a hash of the row among
themselves; an id of more than ``HOT_ROWS`` rows is ranked by range buckets of that hash, not by one task.

A plain ``row_number() over (partition by label ...)`` would put a whole
class (half of a binary dataset) into one task. Instead the rank is split
into a bucket offset and a local rank: the bucket is the first five hex
digits of the key (at most 2^20 buckets per class, evenly filled because md5
is uniform); bucket counts give each bucket's starting rank through a window
over the small (class, bucket) count table, and the local rank is a window
over one (class, bucket) group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.constants import SEED
from panelkit.operators.ordered import join_keys, prefix_sums
from panelkit.session import cut_lineage

PREFIX_HEX = 5
NULL_ID = "\x00"
#: Rows with one hash prefix up to which a single task ranks them.
HOT_ROWS = 1_000_000


def hash_key(id_cols, seed: int = SEED) -> Column:
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    # a NULL part counts as a mark of its own, so every row has a key
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_ID)) for c in id_cols]
    # several parts carry their lengths: a|b, c and a, b|c differ
    base = parts[0] if len(parts) == 1 else F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    return F.md5(F.concat(base, F.lit(f"-{seed}")))


def stratified_rank(df: DataFrame, label: str, id_cols, seed: int = SEED, hot: int = HOT_ROWS) -> DataFrame:
    """Add ``_rank`` (0-based rank within the class by hash key) and ``_n_class``."""
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    hb = df.withColumn("_h", hash_key(id_cols, seed)).withColumn("_hb", F.substring("_h", 1, PREFIX_HEX))
    cnt = cut_lineage(hb.groupBy(label, "_hb").agg(F.count("*").alias("_c")))
    wc = Window.partitionBy(label).orderBy("_hb").rowsBetween(Window.unboundedPreceding, -1)
    most = cnt.agg(F.max("_c")).first()[0] or 0
    before = cnt.select(label, "_hb", F.coalesce(F.sum("_c").over(wc), F.lit(0)).alias("_before"),
                        F.sum("_c").over(Window.partitionBy(label)).alias("_n_class"))
    wl = Window.partitionBy(label, "_hb").orderBy("_h", *id_cols)
    # null-safe: rows with a NULL label form their own class, none is dropped
    if most <= hot:
        out = join_keys(hb, before, [label, "_hb"], "inner")
        return out.withColumn("_rank", F.col("_before") + F.row_number().over(wl) - 1).drop("_hb", "_before")
    # ids that many rows share: one weighted row stands for all of them in their bucket, and
    # the rows themselves are ranked by running sums over range buckets of the whole row
    many = cut_lineage(hb.groupBy(label, "_h").agg(F.count("*").alias("_w")).where(F.col("_w") > hot))
    flagged = cut_lineage(join_keys(hb, many, [label, "_h"]))
    rest = flagged.where(F.col("_w").isNull()).withColumn("_w", F.lit(1).cast("long"))
    stand = many.withColumn("_hb", F.substring("_h", 1, PREFIX_HEX))
    for c in df.columns:
        if c != label:
            stand = stand.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    rows = rest.withColumn("_one", F.lit(True)).unionByName(stand.withColumn("_one", F.lit(False)).select(*rest.columns, "_one"))
    run = F.sum("_w").over(wl.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_w")
    rows = cut_lineage(join_keys(rows, before, [label, "_hb"], "inner").withColumn("_rank", F.col("_before") + run))
    start = rows.where(~F.col("_one")).select(label, "_h", "_n_class", F.col("_rank").alias("_start"))
    hot_rows = prefix_sums(flagged.where(F.col("_w").isNotNull()).withColumn("_one", F.lit(1).cast("long")),
                           ["_h"], ["_one"], partition_by=[label, "_h"])
    hot_rows = join_keys(hot_rows, start, [label, "_h"], "inner").withColumn("_rank", F.col("_start") + F.col("cum__one") - 1)
    keep = [*df.columns, "_h", "_n_class", "_rank"]
    return rows.where("_one").select(*keep).unionByName(hot_rows.select(*keep))


def stratified_split(df: DataFrame, label: str, id_cols, test_size: float = 0.2,
                     seed: int = SEED, column: str = "is_test") -> DataFrame:
    """Add boolean ``is_test``: exactly round(test_size * n_c) rows per class."""
    r = stratified_rank(df, label, id_cols, seed)
    flag = F.col("_rank") < F.round(F.lit(test_size) * F.col("_n_class"))
    return r.withColumn(column, flag).drop("_h", "_rank", "_n_class")


def split_frames(df: DataFrame, label: str, id_cols, test_size: float = 0.2, seed: int = SEED):
    """(train, test) pair from ``stratified_split``."""
    s = stratified_split(df, label, id_cols, test_size, seed, "_is_test")
    return s.where(~F.col("_is_test")).drop("_is_test"), s.where(F.col("_is_test")).drop("_is_test")


def stratified_folds(df: DataFrame, label: str, id_cols, k: int = 5, seed: int = SEED,
                     column: str = "fold") -> DataFrame:
    """Add INT ``fold`` in [0, k): class-stratified, sizes differ by at most one."""
    r = stratified_rank(df, label, id_cols, seed)
    return r.withColumn(column, (F.col("_rank") % k).cast("int")).drop("_h", "_rank", "_n_class")


def sample_n(df: DataFrame, n: int, id_cols, seed: int = SEED) -> DataFrame:
    """The ``n`` rows with the smallest hash keys (TakeOrderedAndProject: each
    task keeps its own top n, so only n rows per task are merged)."""
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return (df.withColumn("_h", hash_key(id_cols, seed)).orderBy("_h", *id_cols).limit(n)
              .drop("_h"))
