"""Scalar expressions (fixture F-A style rows)."""

from pyspark.sql import functions as F

from panelkit.functions import scalars as S


def one_col(spark, values, f, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_encode_target(spark):
    vals = ["Y", " yes", "1", "1.0", "N", "no ", "0", "A", "abstain", "X", "NON-VOTING", "non_voting",
            "maybe", None]
    assert one_col(spark, vals, S.encode_target) == [1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0]


def test_strip_unicode_and_collapse(spark):
    vals = ["  a\t\tb  c  ", "  ", None, "null", " None "]
    assert one_col(spark, vals, S.clean_text) == ["a b c", "", None, None, None]


def test_safe_double_rejects_java_suffixes(spark):
    vals = ["1d", "1e5", " 12 ", "abc", "1f", "-3.5", "nan", ".5"]
    assert one_col(spark, vals, S.safe_double) == [None, 1e5, 12.0, None, None, -3.5, None, 0.5]


def test_safe_int_and_years(spark):
    assert one_col(spark, ["1990", "2024", "bad", "1995.0", "1995.5", None], S.safe_int) == \
        [1990, 2024, None, 1995, None, None]
    assert one_col(spark, ["2001-05-02", "garbage"], S.year_from_date) == [2001, None]
    assert one_col(spark, ["45", "x"], S.year_from_session) == [1990, None]


def test_norm_key_and_clip(spark):
    assert one_col(spark, [" usa ", "Fra", None], S.norm_key) == ["USA", "FRA", None]
    assert one_col(spark, [1.0, 50.0, None, -9.0], lambda c: S.clip(c, 0.0, 10.0), "double") == \
        [1.0, 10.0, None, 0.0]


def test_truncate_label(spark):
    long = "x" * 45
    assert one_col(spark, [long, "short"], S.truncate_label) == ["x" * 40 + "...", "short"]


def test_dates_of_several_forms(spark):
    texts = ["2003-01-02", "01/02/2003", "13/02/2003", "2003/1/2", "20030102", "2 Jan 2003", "January 2, 2003", "2-Sept-2003",
             "02.01.2003", "1/2/2003 10:11:12", "2003-01-02T10:11:12", "31/31/2003", "2 Foo 2003", "1/2/2003x", "", None]
    days = one_col(spark, texts, lambda c: S.parse_date(c, "date").cast("string"))
    assert days == ["2003-01-02", "2003-01-02", "2003-02-13", "2003-01-02", "2003-01-02", "2003-01-02", "2003-01-02",
                    "2003-09-02", "2003-02-01", "2003-01-02", "2003-01-02", None, None, None, None, None]
    assert one_col(spark, texts, S.year_from_date) == [d and 2003 for d in days]
