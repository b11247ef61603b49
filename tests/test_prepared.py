"""A preparation learnt on the training rows only."""

import random

import pytest
from pyspark.sql import functions as F

from panelkit.operators.prepared import Preparation


def table(spark, shift):
    """Training rows 0..199; test rows that ``shift`` moves far away."""
    rng = random.Random(3)
    rows = []
    for i in range(260):
        test = i >= 200
        x = rng.gauss(0, 1) + (shift if test else 0)
        y = int(x + rng.gauss(0, 0.5) > 0) if not test else i % 2
        rows.append((i, test, y, x, None if i % 7 == 0 else rng.random() * (shift if test else 1), 5.0,
                     None if i % 50 else 1.0, 1000.0 if i == 3 else float(i % 10)))
    return spark.createDataFrame(rows, "id long, is_test boolean, vote int, x double, gap double, constant double, "
                                       "sparse double, far double")


def learnt(spark, shift):
    df = table(spark, shift)
    return df, Preparation.fit(df.where(~F.col("is_test")).drop("is_test"), "vote", exclude=["id"])


def test_test_rows_move_no_statistic(spark):
    _, one = learnt(spark, 0.0)
    _, two = learnt(spark, 1e6)
    assert one == two
    assert set(one.features) == {"x", "gap", "far"} and one.features[0] == "x"


def test_apply_fills_and_scales_by_what_was_learnt(spark):
    df, prep = learnt(spark, 50.0)
    train = df.where(~F.col("is_test"))
    rows = {r.id: r for r in prep.apply(df).collect()}
    assert len(rows) == 260 and rows[210].x > 20  # a test row stays as far out as it is
    mean, std = prep.scaler["gap"]
    assert rows[7].gap == pytest.approx((prep.medians["gap"] - mean) / std)
    inside = prep.apply(prep.inliers(train)).agg(*[F.avg(c).alias(c) for c in prep.features]).first()
    assert all(abs(inside[c]) < 1e-9 for c in prep.features)
    lacking = prep.apply(df.drop("far")).select("far").distinct().collect()
    assert len(lacking) == 1


def test_strict_bounds_drop_training_rows_only_when_asked(spark):
    df, _ = learnt(spark, 0.0)
    train = df.where(~F.col("is_test")).drop("is_test")
    strict = Preparation.fit(train, "vote", strictness="strict", exclude=["id"])
    assert 3 not in {r.id for r in strict.inliers(train).collect()}
    none = Preparation.fit(train, "vote", strictness="none", exclude=["id"])
    assert none.inliers(train).count() == 200


def test_pipeline_fits_on_the_training_rows(spark):
    from panelkit.operators import models as MD
    from panelkit.plans import pipeline as P
    rng = random.Random(9)
    rows = [(i, "2001-01-02", f"AB{chr(65 + i % 5)}", rng.choice("YN"), rng.random() * 100, float(i % 13)) for i in range(240)]
    votes = spark.createDataFrame(rows, "rowno long, date string, ms_code string, ms_vote string, amount double, other double")
    out = P.run(votes, kinds=("nb",), grids=MD.SMALL_GRIDS, filter_issues=False, id_cols=["rowno"], fit_on="train", order_by=["rowno"])
    assert out["preparation"].features == out["features"] and out["comparison"].count() == 1
    with pytest.raises(ValueError):
        P.run(votes, fit_on="test")
