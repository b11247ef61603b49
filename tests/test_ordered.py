"""Scale forms must equal the plain single-window forms (fixture F-G + events)."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit.operators import ordered as O
from panelkit.operators import stats as ST


def _plain_fill(df, c, order, part=()):
    w1 = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    w2 = Window.partitionBy(*part).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(c, F.coalesce(F.last(c, True).over(w1), F.first(c, True).over(w2)))


def test_fill_fixture_g(spark):
    rows = [(1, "a", None), (2, "a", 1.0), (3, "a", None), (4, "b", 3.0), (5, "b", None), (6, "b", None)]
    df = spark.createDataFrame(rows, "id int, e string, v double")
    got = {r.id: r.v for r in O.ffill_bfill(df, ["v"], ["id"]).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 1.0, 4: 3.0, 5: 3.0, 6: 3.0}
    got = {r.id: r.v for r in O.bfill(df, ["v"], ["id"]).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 3.0, 4: 3.0, 5: None, 6: None}


def test_bucketed_fill_equals_plain(spark):
    df = spark.range(0, 3000).select(
        F.col("id"), (F.col("id") % 7).alias("g"),
        F.when((F.col("id") % 5 != 0) | (F.col("id") < 40), F.lit(None)).otherwise(F.col("id") * 1.5).alias("v"))
    for part in ((), ("g",)):
        want = {r.id: r.v for r in _plain_fill(df, "v", ["id"], part).collect()}
        got = {r.id: r.v for r in O.ffill_bfill(df, ["v"], ["id"], part, n_buckets=9).collect()}
        assert got == want


def test_bucketed_prefix_sums_equal_plain(spark):
    df = spark.range(0, 2000).select((F.col("id") % 97).cast("double").alias("s"), F.lit(1).alias("one"))
    t = df.groupBy("s").agg(F.sum("one").alias("n"))
    w = Window.orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.s: r.c for r in t.select("s", F.sum("n").over(w).alias("c")).collect()}
    got = {r.s: r.cum_n for r in O.prefix_sums(t, "s", ["n"], descending=True, n_buckets=7).collect()}
    assert got == want


def test_bucketed_quantiles_equal_exact(spark):
    df = spark.range(0, 5001).select(((F.col("id") * 7919) % 1013).cast("double").alias("x"),
                                     F.when(F.col("id") % 3 == 0, F.lit(2.0)).otherwise(F.col("id") / 10).alias("y"))
    exact = ST.quantiles(df, ["x", "y"], [0.25, 0.5, 0.75])
    forced = ST.quantiles(df, ["x", "y"], [0.25, 0.5, 0.75], exact_limit=0)
    for c in ("x", "y"):
        for a, b in zip(exact[c], forced[c]):
            assert math.isclose(a, b, rel_tol=1e-12)


def test_median_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert ST.medians(df, ["x"])["x"] == 2.5


def test_hot_value_is_split_and_fill_is_exact(spark):
    # 40% of the rows share one order value: it must not land in one bucket
    n = 5000
    df = spark.range(0, n).select(
        F.col("id"), F.when(F.col("id") % 5 < 2, F.lit(1000)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 7 == 0, F.col("id") * 1.0).alias("v"))
    b = O.range_buckets(df, "k", n_buckets=10)
    hot = b.where("k = 1000").select("_bkt").distinct().count()
    assert hot > 1
    largest = b.groupBy("_bkt").count().agg(F.max("count")).first()[0]
    assert largest < 0.4 * n
    tb = O.tie_break(df)
    w1 = Window.orderBy("k", tb).rowsBetween(Window.unboundedPreceding, 0)
    w2 = Window.orderBy("k", tb).rowsBetween(0, Window.unboundedFollowing)
    want = {r.id: r.v for r in df.withColumn("v", F.coalesce(F.last("v", True).over(w1),
                                                               F.first("v", True).over(w2))).collect()}
    got = {r.id: r.v for r in O.ffill_bfill(df, ["v"], ["k"], n_buckets=10).collect()}
    assert got == want


def test_null_partition_key(spark):
    rows = [(1, None, 1.0), (2, None, None), (3, "a", None), (4, "a", 2.0), (5, None, None)]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    got = {r.id: r.v for r in O.ffill_bfill(df, ["v"], ["id"], ["g"], n_buckets=2).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 2.0, 4: 2.0, 5: 1.0}


def test_bucketed_quantiles_with_hot_value(spark):
    df = spark.range(0, 6000).select(
        F.when(F.col("id") % 5 < 2, F.lit(7.0)).otherwise((F.col("id") * 37 % 1009).cast("double")).alias("x"))
    exact = ST.quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.75, 0.9])
    forced = ST.quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.75, 0.9], exact_limit=0)
    assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(exact["x"], forced["x"]))
