"""Exact selection by digits, approximate forms, distinct samples, repeated ids."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import stats as ST


def test_order_key_is_the_bits_in_order(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 0.1, 5e-324, -5e-324, 2.0 ** -1022, 2.0 ** -1022 - 5e-324, 1.7976931348623157e308,
              float("inf"), -float("inf"), 2.0 ** 1023, 1 - 2.0 ** -53, 1 + 2.0 ** -52, 8.0, 7.999999999999999, 3e-310]
    for _ in range(3000):
        v = struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0]
        if not math.isnan(v):
            values.append(v)
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.order_key("v").alias("key"))
    got = [(r.v, r.key) for r in df.collect()]
    for v, key in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        assert key == (-bits if v < 0 else bits) and S.from_order_key(key) == v
    assert [v for v, _ in sorted(got, key=lambda p: p[1])] == sorted(values)
    assert spark.range(1).select(S.order_key(F.lit(float("nan"))).alias("k")).first().k is None


@pytest.mark.parametrize("digit", [13, 3])
def test_quantiles_equal_the_percentile_of_spark(spark, digit, monkeypatch):
    monkeypatch.setattr(ST, "DIGIT", digit)
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1e3), float(rng.randint(-3, 3)), None if rng.random() < 0.4 else rng.random() * 1e-9, 7.0, k,
             rng.choice([1e300, -1e-300, 0.0, -0.0])) for k in range(1500)]
    cols = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e long, f double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.7512345, 0.99, 1.0]
    want = df.agg(*[F.percentile(F.col(c).cast("double"), probs).alias(c) for c in cols]).first()
    got = ST.quantiles(df, cols, probs)
    for c in cols:
        assert got[c] == pytest.approx(want[c], rel=1e-12, abs=1e-320), c


@pytest.mark.parametrize("missed", [(-5.0, -5.0), (9e9, 9e9), (100.0, 100.0)])
def test_a_rank_outside_the_bounds_of_the_sketch_is_still_exact(spark, monkeypatch, missed):
    df = spark.createDataFrame([(float(v),) for v in [*range(500), 1e300, -float("inf"), float("inf")]], "x double")
    x = [F.col("x")]
    found, prefix = ST._placed(df, x, {(0, 250): missed})
    assert not found and prefix[0, 250][0] < S.to_order_key(249.0) <= prefix[0, 250][1]
    monkeypatch.setattr(ST.F, "percentile_approx", lambda *a: F.array(*[F.lit(m) for m in missed]))
    assert ST.quantiles(df, ["x"], [0.5]) == {"x": [250.0]}


def test_quantiles_of_four_columns_are_compiled(spark):
    """Each order key stands behind the explode: no array of four of them, which Spark couldn't compile."""
    df = spark.createDataFrame([(float(i), i * 0.5, i * 0.25, -float(i)) for i in range(300)], "a double, b double, c double, d double")
    keys = []
    whole = S.order_key

    def counted(c):
        keys.append(c)
        return whole(c)

    S.order_key, back = counted, whole
    try:
        got = ST.quantiles(df, ["a", "b", "c", "d"], [0.25, 0.75])
        passes = len(keys)
    finally:
        S.order_key = back
    assert got == {"a": [74.75, 224.25], "b": [37.375, 112.125], "c": [18.6875, 56.0625], "d": [-224.25, -74.75]}
    assert passes <= 5  # one expression a pass, whatever the number of columns


def test_sketches_of_parts_answer_for_their_union(spark):
    df = spark.range(20_000).select(F.pmod("id", F.lit(7)).alias("part"), F.sqrt(F.col("id") % 5000).alias("x"),
                                    F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("id") % 11).alias("y"),
                                    F.lit(None).cast("double").alias("z"))
    merged = ST.merge_sketches(ST.sketches(df, ["x", "y", "z"], by=["part"]))
    probs = [0.1, 0.5, 0.9]
    got = {r.column: r for r in ST.from_sketches(merged, probs).collect()}
    assert (got["x"].n, got["z"].n, got["z"].quantiles) == (20_000, 0, None)
    assert abs(got["x"].n_distinct / 5000 - 1) < 0.06 and abs(got["y"].n_distinct / 11 - 1) < 0.06
    for q, p in zip(got["x"].quantiles, probs):
        below = df.where(F.col("x") <= q).count() / 20_000
        assert abs(below - p) < 0.03
    assert {r.column: r.n_distinct for r in ST.distinct_counts(df, ["x", "y", "z"]).collect()} == {"x": 5000, "y": 11, "z": 0}
    near = {r.column: r.n_distinct for r in ST.distinct_counts(df, ["x", "y", "z"], approx=True).collect()}
    assert abs(near["x"] / 5000 - 1) < 0.06 and near["z"] == 0
    exact, approx = (ST.quantiles(df, ["x"], [0.5], approx=a)["x"][0] for a in (False, True))
    assert abs(exact - approx) < 3


def test_distinct_sample_is_the_smallest_hashes(spark):
    import hashlib
    df = spark.range(3000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 997).alias("a"),
                                  F.when(F.col("id") % 3 > 0, F.lit("x")).alias("b"), F.lit(None).cast("int").alias("c"))
    got = {}
    for r in ST.distinct_sample(df, ["a", "b", "c"], k=15).orderBy("rank").collect():
        got.setdefault(r.column, []).append(r.value)
    values = {str(r.a) for r in df.select("a").distinct().collect()}
    assert got["a"] == sorted(values, key=lambda v: hashlib.md5(f"{v}-42".encode()).hexdigest())[:15]
    assert got["b"] == ["x"] and "c" not in got


def test_ids_that_many_rows_share(spark):
    from panelkit.operators import split as SP
    df = spark.range(900).select(F.when(F.col("id") < 450, 5).otherwise(F.col("id")).alias("id"), (F.col("id") % 3 == 0).alias("label"),
                                 F.col("id").alias("row"))
    out = SP.stratified_rank(df, "label", "id", hot=20).collect()
    for label in (True, False):
        own = [r for r in out if r.label == label]
        assert sorted(r._rank for r in own) == list(range(len(own))) and {r._n_class for r in own} == {len(own)}
        assert [r._h for r in sorted(own, key=lambda r: r._rank)] == sorted(r._h for r in own)
    assert sorted(r.row for r in out) == list(range(900))
    usual = {r.row: r._rank for r in SP.stratified_rank(df, "label", "id").collect() if r.id != 5}
    assert {r.row: r._rank for r in out if r.id != 5} == usual
    two = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c")], "x string, y string")
    assert two.select(SP.hash_key(["x", "y"])).distinct().count() == 3


def test_a_date_column_has_one_order(spark):
    from panelkit.operators import clean as CL
    from panelkit.operators import joins as J
    rows = [("01/02/2003", "01/02/2003", "Feb 1, 2003 10:00 PM", "01/02/03", "2003-02-01"),
            ("05/13/2003", "13/05/2003", "Mar 12, 2004 12:05 am", "12/31/71", "13/02/2003"),
            ("2003-04-05", "11/12/2003", "x", "07/08/68", "2003-02-03"), (None, "31/01/2004", None, None, None)]
    df = spark.createDataFrame(rows, "us_date string, eu_date string, long_date string, short_date string, iso_date string")
    assert CL.day_first(df, df.columns) == {"us_date": False, "eu_date": True, "long_date": False, "short_date": False,
                                            "iso_date": True}
    got = CL.convert_types(df).select(*[F.col(c).cast("string") for c in df.columns]).collect()
    assert [r.us_date for r in got] == ["2003-01-02 00:00:00", "2003-05-13 00:00:00", "2003-04-05 00:00:00", None]
    assert [r.eu_date and r.eu_date[:10] for r in got] == ["2003-02-01", "2003-05-13", "2003-12-11", "2004-01-31"]
    assert [r.long_date for r in got] == ["2003-02-01 22:00:00", "2004-03-12 00:05:00", None, None]
    assert [r.short_date and r.short_date[:10] for r in got] == ["2003-01-02", "1971-12-31", "2068-07-08", None]
    assert [r.iso_date and r.iso_date[:10] for r in got] == ["2003-02-01", "2003-02-13", "2003-02-03", None]
    assert [r.year for r in J.derive_year(df.select(F.col("eu_date").alias("date"))).collect()] == [2003, 2003, 2003, 2004]
