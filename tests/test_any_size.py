"""One answer at every size: bucket counts, quantile paths, NaN, NULL ids."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit.operators import clean as CL
from panelkit.operators import ordered as O
from panelkit.operators import split as SP
from panelkit.operators import stats as ST


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows share the first key; a second key and a string key order them."""
    return spark.range(0, 1500).select(
        "id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("ts"),
        F.pmod(F.col("id") * 37, F.lit(1500)).alias("eid"), F.format_string("k%05d", F.pmod(F.col("id") * 91, F.lit(1500))).alias("name"),
        F.when(F.col("id") % 5 == 0, F.col("id") * 1.0).alias("v"), F.lit(1).alias("one")).cache()


@pytest.mark.parametrize("order_by", [["ts", "eid"], ["name"], ["ts", "name"]])
@pytest.mark.parametrize("n_buckets", [1, 8, 40])
def test_fill_and_prefix_sums_by_whole_key(hot, order_by, n_buckets):
    w = Window.orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.id: (r.f, r.s) for r in hot.select("id", F.last("v", True).over(w).alias("f"), F.sum("one").over(w).alias("s")).collect()}
    fill = {r.id: r.v for r in O.ffill(hot, ["v"], order_by, n_buckets=n_buckets).collect()}
    sums = {r.id: r.cum_one for r in O.prefix_sums(hot, order_by, ["one"], n_buckets=n_buckets).collect()}
    assert {i: (fill[i], sums[i]) for i in fill} == want


def test_buckets_split_a_hot_first_key_and_strings(hot):
    for order_by in (["ts", "eid"], ["name"]):
        b = O.range_buckets(hot, order_by, n_buckets=10)
        assert b.groupBy("_bkt").count().agg(F.max("count")).first()[0] < 400


def test_quantile_paths_agree_on_nan_and_inf(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(float(k), nan if k % 3 == 0 else float(k), inf if k % 4 == 0 else float(k), nan) for k in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    one = ST.quantiles(df, ["a", "b", "c", "d"], [0.25, 0.5, 0.9])
    two = ST.quantiles(df, ["a", "b", "c"], [0.25, 0.5, 0.9], exact_limit=0)
    for c, values in two.items():
        assert values == pytest.approx(one[c]), c
    assert math.isinf(one["c"][2]) and one["d"] == [None] * 3


def test_nan_is_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0 if k < 8 else nan, nan if k < 9 else 2.0, "x" if k < 5 else None) for k in range(10)],
                               "a double, b double, s string")
    pct = {r["column"]: r.non_null for r in ST.null_profile(df).collect()}
    assert pct == {"a": 8, "b": 1, "s": 5}
    assert "b" in CL.sparse_columns(df, 0.8, ())
    assert set(CL.constant_columns(df)) == {"a", "b", "s"}


def test_near_constant_is_exact(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 960, "top").otherwise(F.col("id").cast("string")).alias("near"),
                                  F.when(F.col("id") < 940, "top").otherwise(F.col("id").cast("string")).alias("not_near"))
    assert CL.constant_columns(df, 0.95) == ["near"]


def test_split_keeps_rows_with_null_ids(spark):
    df = spark.createDataFrame([(None if k % 5 == 0 else k, k % 2, k) for k in range(100)], "id int, label int, row int")
    for ids in (["id"], ["id", "row"]):
        s = SP.stratified_split(df, "label", ids)
        assert s.count() == 100 and s.where("is_test").count() == 20
        assert SP.stratified_folds(df, "label", ids).count() == 100
