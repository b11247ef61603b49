"""Reshape and joins (fixtures F-B, F-D) and the harmonise step."""


from panelkit.operators import joins as J
from panelkit.operators import reshape as R
from panelkit.operators import stats as ST


def wide_fixture(spark):
    rows = [("usa", "NY.GDP.PCAP.KD", "GDP", 1.0, 2.0, None, 1),
            ("USA", "NY.GDP.PCAP.KD", "GDP", 9.0, 9.0, 9.0, 2),
            ("USA", "SE.PRM.ENRR", "Enroll", None, 5.0, 6.0, 3),
            ("FRA", "XX.UNMAPPED", "?", 7.0, 7.0, 7.0, 4),
            ("FRA", "SE.PRM.ENRR", "Enroll", 3.0, None, 4.0, 5)]
    return spark.createDataFrame(
        rows, "`Country Code` string, `Indicator Code` string, `Indicator Name` string, "
              "`1989` double, `1990` double, `1991` double, rowno int")


def test_extract_indicators(spark):
    p = R.extract_indicators(wide_fixture(spark), order_by="rowno")
    got = {(r.country_code, r.year): (r.gdp_per_capita, r.primary_enrollment) for r in p.collect()}
    # 1989 is outside the range; the duplicate (USA, GDP) keeps the first row
    assert got == {("USA", 1990): (2.0, 5.0), ("USA", 1991): (9.0, 6.0), ("FRA", 1991): (None, 4.0)}


def test_melt_pivot_roundtrip(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "k int, a double, b double")
    long = R.melt(df, ["k"], ["a", "b"], "var", "val").where("val is not null")
    back = R.pivot_first(long, "k", "var", "val", ["a", "b"]).orderBy("k").collect()
    assert [(r.k, r.a, r.b) for r in back] == [(1, 1.0, None), (2, 3.0, 4.0)]


def test_extract_spending(spark):
    rows = [(" Norway ", "1995", "12.5"), ("norway", "1995", "99"), ("Chad", "1996", "..."),
            ("Chad", "1989", "1"), ("Peru", "x", "3")]
    df = spark.createDataFrame(rows, "Country string, Year string, Value string")
    got = {(r.country_name, r.year): r.military_expenditure for r in R.extract_spending(df).collect()}
    assert got == {("NORWAY", 1995): 12.5}


def test_explode_topics(spark):
    df = spark.createDataFrame([("a; Human rights, x",), ("Security;  Human rights",), (None,)], "subjects string")
    got = {r.topic: r["count"] for r in ST.value_counts(R.explode_topics(df, "subjects"), "topic").collect()}
    assert got == {"Human rights": 2, "Security": 1}


def test_harmonize(spark):
    votes = spark.createDataFrame(
        [("usa", "United States", "2000-01-05", "Human rights", "Y"),
         ("FRA", "France", "1989-01-01", "Security", "N"),
         ("FRA", "France", "2001-02-02", "Trade", "N"),
         ("FRA", "france ", "2001-03-03", "peacekeeping", "N")],
        "ms_code string, ms_name string, date string, subjects string, ms_vote string")
    wdi = spark.createDataFrame([("USA", "NY.GDP.PCAP.KD", 5.0, 6.0), ("FRA", "NY.GDP.PCAP.KD", 1.0, 2.0)],
                                "`Country Code` string, `Indicator Code` string, `2000` double, `2001` double")
    sipri = spark.createDataFrame([("FRANCE", 2001, "7"), ("United States", 2000, "...")],
                                  "Country string, Year int, Value string")
    h = J.harmonize(votes, wdi, sipri).orderBy("date").collect()
    assert [(r.country_code, r.year, r.gdp_per_capita, r.military_expenditure) for r in h] == \
        [("USA", 2000, 5.0, None), ("FRA", 2001, 2.0, 7.0)]


def test_null_profile_and_hist(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0), (3, 2.0), (4, 2.0)], "a int, b double")
    prof = {r.column: (r.non_null, r.total, r.pct) for r in ST.null_profile(df).collect()}
    assert prof == {"a": (4, 4, 100.0), "b": (3, 4, 75.0)}
    h = {r.bin: r["count"] for r in ST.histogram(df, "a", 30).collect()}
    assert h == {0: 1, 1: 1, 2: 1, 3: 1}


def test_join_panel_size_check_paths(spark):
    fact = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), ("C", 9)], "country_code string, year int")
    panel = spark.createDataFrame([("A", 1, 1.5), ("B", 1, 2.5)], "country_code string, year int, v double")
    small = J.join_panel(fact, panel)                            # measured, broadcast
    large = J.join_panel(fact, panel, max_broadcast_bytes=1)     # measured, over the limit
    plain = J.join_panel(fact, panel, broadcast=False)           # planner's choice
    norm = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert norm(small) == norm(large) == norm(plain)
    assert len(norm(small)) == 4
