"""Property tests (hypothesis, few examples: every example runs Spark jobs)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelkit.operators import features as FE
from panelkit.operators import impute as IM
from panelkit.operators import metrics as M
from panelkit.operators import reshape as R
from panelkit.operators import split as SP

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
rows = st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3),
                          st.one_of(st.none(), st.floats(-100, 100, allow_nan=False))),
                min_size=1, max_size=30)


@SETTINGS
@given(rows)
def test_melt_pivot_roundtrip(spark, data):
    df = spark.createDataFrame(data, "k int, var int, val double").withColumn("var", F.concat(F.lit("c"), "var"))
    first = IM.dedupe_first(df.where("val is not null"), ["k", "var"], ["val"])
    wide = R.pivot_first(df, "k", "var", "val", [f"c{i}" for i in range(4)], order_by=["val"])
    long = R.melt(wide, ["k"], [f"c{i}" for i in range(4)], "var", "val").where("val is not null")
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, first.select("k", "var", "val").collect()))


@SETTINGS
@given(rows)
def test_dedupe_idempotent(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v double")
    once = IM.dedupe_first(df, ["k"], ["o"])
    twice = IM.dedupe_first(once, ["k"], ["o"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=3, max_size=40))
def test_scaler_mean0_std1(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    out = FE.apply_scaler(df, FE.fit_scaler(df, ["x"])).agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(out[0]) < 1e-6
    if len(set(xs)) > 1 and max(xs) - min(xs) > 1e-6:
        assert math.isclose(out[1], 1.0, rel_tol=1e-6)


@SETTINGS
@given(st.lists(st.integers(0, 1), min_size=2, max_size=60), st.sampled_from([0.2, 0.25, 0.5]))
def test_split_exact_per_class(spark, labels, size):
    df = spark.createDataFrame(list(enumerate(labels)), "id long, y int")
    got = {r.y: r["n"] for r in SP.stratified_split(df, "y", "id", size).where("is_test")
           .groupBy("y").agg(F.count("*").alias("n")).collect()}
    for y in set(labels):
        want = int(math.floor(size * labels.count(y) + 0.5))
        assert got.get(y, 0) == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=40))
def test_auc_negated_score(spark, data):
    if len({y for y, _ in data}) < 2:
        return
    df = spark.createDataFrame([(float(y), float(s)) for y, s in data], "label double, score double")
    a = M.roc_auc(df).first()[0]
    b = M.roc_auc(df.withColumn("score", -F.col("score"))).first()[0]
    assert math.isclose(a + b, 1.0, rel_tol=1e-9)
