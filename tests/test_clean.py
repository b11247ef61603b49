"""Cleaning operators (fixtures F-A, F-E, F-F)."""

import math


from panelkit.operators import clean as CL


def test_drop_invalid(spark):
    rows = [(1, "ok", 1.0, "NULL"), (2, "NULL", 1.0, "x"), (3, "ok", float("inf"), "x"),
            (4, None, 1.0, "x"), (5, "--", 1.0, "x"), (6, "fine", None, None), (7, "", 2.0, "x"),
            (8, "ok", float("nan"), "x")]
    df = spark.createDataFrame(rows, "id int, t string, v double, gdp_note string")
    kept = sorted(r.id for r in CL.drop_invalid(df).collect())
    # gdp_ columns are exempt; NULL / NaN numbers stay; NULL text is invalid
    assert kept == [1, 6, 8]


def test_standardize_codes(spark):
    rows = [("usa",), (" fra ",), ("US",), ("U1A",), (None,), ("DEUX",), ("ÉTA",)]
    df = spark.createDataFrame(rows, "country_code string")
    assert [r[0] for r in CL.standardize_codes(df).collect()] == ["USA", "FRA", "ÉTA"]


def test_where_topic(spark):
    df = spark.createDataFrame([("a; Human rights, x",), ("SECURITY council",), (None,), ("trade",)],
                               "subjects string")
    assert CL.where_topic(df).count() == 2
    assert CL.where_topic(df.withColumnRenamed("subjects", "other")).count() == 4


def test_drop_matching_keeps_listed(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "undl_id int, vote int, mandate int, url_x int, country int")
    assert CL.drop_matching(df).columns == ["vote", "mandate", "country"]


def test_drop_sparse_priority(spark):
    rows = [(i, None if i < 4 else 1.0, None if i < 8 else 1.0) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, a double, gdp_per_capita double")
    assert CL.drop_sparse(df).columns == ["id", "gdp_per_capita"]


def test_drop_constant(spark):
    n = 100
    rows = [(i, 1, "A" if i < 96 else "B", "A" if i < 94 else "B", i % 3) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, const int, near string, ok string, m3 int")
    # near: 96% top share and 2/100 distinct -> dropped; ok: 94% -> kept
    assert CL.drop_constant(df).columns == ["id", "ok", "m3"]


def test_convert_types_threshold(spark):
    # 10 rows: a 9/10 numeric -> converted; b exactly 8/10 -> not (needs > 80%)
    rows = [(str(i) if i < 9 else "x", str(i) if i < 8 else "y", "2020-01-0%d" % (i % 9 + 1)) for i in range(10)]
    df = spark.createDataFrame(rows, "a string, b string, ship_date string")
    out = CL.convert_types(df)
    types = dict(out.dtypes)
    assert types["a"] == "double" and types["b"] == "string" and types["ship_date"] == "timestamp_ntz"


def test_convert_types_keeps_dates_of_other_forms(spark):
    df = spark.createDataFrame([("2003-01-02",), ("01/02/2003",), ("2 Jan 2003 10:30",), ("soon",)], "ship_date string")
    got = [str(r[0]) for r in CL.convert_types(df).collect()]
    assert got == ["2003-01-02 00:00:00", "2003-01-02 00:00:00", "2003-01-02 10:30:00", "None"]


def test_harmonize_keeps_rows_with_other_date_forms(spark):
    from panelkit.operators.joins import harmonize
    votes = spark.createDataFrame([("2003-01-02", "FRA"), ("01/02/2003", "FRA"), ("soon", "FRA")],
                                  "date string, ms_code string")
    assert [r.year for r in harmonize(votes, filter_issues=False).collect()] == [2003, 2003]


def _outlier_df(spark):
    # x has two high outliers; z constant (IQR 0); w all NULL
    xs = [1.0, 2.0, 2.0, 3.0, 3.0, 3.0, 4.0, 4.0, 5.0, 6.0, 100.0, 200.0]
    return spark.createDataFrame([(i, x, 5.0, None) for i, x in enumerate(xs)], "id int, x double, z double, w double")


def test_outliers_iqr(spark):
    df = _outlier_df(spark)
    strict = CL.remove_outliers(df, ["x", "z", "w"], "iqr", "strict")
    assert sorted(r.id for r in strict.collect()) == list(range(10))
    # moderate needs more than 3/2 flagged columns: nothing goes
    assert CL.remove_outliers(df, ["x", "z", "w"], "iqr", "moderate").count() == 12
    capped = {r.id: r.x for r in CL.remove_outliers(df, ["x"], "iqr", "lenient").collect()}
    q1, q3 = 2.75, 5.25
    assert math.isclose(capped[11], q3 + 1.5 * (q3 - q1))


def test_outliers_zscore(spark):
    xs = [0.0] * 20 + [100.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "id int, x double")
    assert CL.remove_outliers(df, ["x"], "zscore", "strict").count() == 20


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 3), (1, "a", 3), (1, "b", 2), (2, "c", 1)], "k int, v string, o int")
    assert CL.remove_duplicates(df).count() == 3
    first = CL.remove_duplicates(df, subset=["k"], order_by=["o"]).orderBy("k").collect()
    assert [(r.k, r.v) for r in first] == [(1, "b"), (2, "c")]


def test_comprehensive_clean(spark):
    rows = [(" usa ", "Y", 1.0, "http://x"), ("FRA", "N", 2.0, "u"), ("DEU", "NULL", 3.0, "u"),
            ("ITA", "Y", 2.0, "u"), ("ES", "N", 2.0, "u")]
    df = spark.createDataFrame(rows, "country_code string, vote string, value double, undl_link string")
    out = CL.comprehensive_clean(df, remove_outliers_=False)
    assert "undl_link" not in out.columns
    assert sorted(r.country_code for r in out.collect()) == ["FRA", "ITA", "USA"]


def test_statistics_of_the_cleaning_read_written_rows(spark, monkeypatch):
    """The passes of the constant columns don't parse the texts again."""
    df = spark.createDataFrame([(i, f" {i} ", f"0{i % 9 + 1}/02/2001", "a" if i % 2 else "b") for i in range(60)],
                               "id int, amount string, vote_date string, kind string")
    seen = []
    whole = CL.drop_constant
    monkeypatch.setattr(CL, "drop_constant", lambda d: seen.append(len(d.inputFiles())) or whole(d))
    out = CL.comprehensive_clean(df)
    assert seen[0] > 0 and out.count() == 60
