"""Queries of the forms by column, the approximate forms, fitted preparation and the chart tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import clean as CL
from panelkit.operators import joins as J
from panelkit.operators import split as SP
from panelkit.operators import stats as ST
from panelkit.operators.prepared import Preparation
from panelkit.plans.queries import SPENDING_SQL, _round_doubles, _spending
from panelkit.session import cut_lineage
from panelkit.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str):
    def deco(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql.strip()
        return fn
    return deco


@query("date_forms", """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS us_date, CAST(o_orderdate AS TIMESTAMP) AS eu_date,
       CAST(o_orderdate AS TIMESTAMP) AS short_date,
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL (CAST(o_orderkey % 24 AS INTEGER)) HOUR AS long_date,
       CAST(o_orderdate AS TIMESTAMP) AS mixed_date
FROM orders""")
def q_date_forms(spark, d) -> DataFrame:
    """Date text that isn't ISO: each column is read in the one order of month and day that reads more of it (X9);
    two-digit years, names of months with AM / PM, and a column of two forms."""
    day = F.col("o_orderdate").cast("timestamp_ntz")
    hour = F.make_timestamp_ntz(F.lit(1990), F.lit(1), F.lit(1), (F.col("o_orderkey") % 24).cast("int"), F.lit(0), F.lit(0))
    us = F.date_format(day, "MM/dd/yyyy")
    df = table(spark, d, "orders").select(
        "o_orderkey", us.alias("us_date"), F.date_format(day, "dd.MM.yyyy").alias("eu_date"),
        F.date_format(day, "M/d/yy").alias("short_date"),
        F.concat(F.date_format(day, "MMM d, yyyy"), F.lit(" "), F.date_format(hour, "hh:mm a")).alias("long_date"),
        F.when(F.col("o_orderkey") % 10 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(us).alias("mixed_date"))
    return CL.convert_types(df)


@query("year_derive_forms", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS from_date, CAST(year(o_orderdate) AS INTEGER) AS from_year,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS from_like
FROM orders""")
def q_year_derive_forms(spark, d) -> DataFrame:
    """The year cascade (X12) from day-first dates, a ``year`` column of text and the first column named like it."""
    o = table(spark, d, "orders")
    y = F.year("o_orderdate").cast("string")
    base = o.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"))
    by_date = J.derive_year(base).select("o_orderkey", F.col("year").alias("from_date"))
    by_year = J.derive_year(o.select("o_orderkey", F.concat(F.lit(" "), y, F.lit(".0")).alias("year"))).select(
        "o_orderkey", F.col("year").alias("from_year"))
    like = o.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(y).alias("Fiscal_Year"))
    by_like = J.derive_year(like).select("o_orderkey", F.col("year").alias("from_like"))
    return by_date.join(by_year, "o_orderkey").join(by_like, "o_orderkey")


@query("harmonize_code", f"""
WITH {SPENDING_SQL.strip()}
SELECT o_orderkey, v.year, v.code AS country_code, round(s.military_expenditure, 6) AS military_expenditure
FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, upper(n_name) AS code
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) v
LEFT JOIN spending s ON v.code = s.name AND v.year = s.year AND s.military_expenditure IS NOT NULL
WHERE v.year BETWEEN 1990 AND 2023""")
def q_harmonize_code(spark, d) -> DataFrame:
    """Harmonise where the fact has no name column: spending joins on the code (J3)."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    votes = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
              .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                      F.concat(F.lit(" "), F.lower("n_name")).alias("ms_code")))
    out = J.harmonize(votes, None, _spending(spark, d), filter_issues=False)
    return _round_doubles(out.select("o_orderkey", "year", "country_code", "military_expenditure"))


SKETCH_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_orderkey"]
PROBS = [0.05, 0.25, 0.5, 0.75, 0.95]


@query("approx_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS n, TRUE AS distinct_near, {len(PROBS)} AS ranks_near FROM lineitem"
    for c in SKETCH_COLS))
def q_approx_summary(spark, d) -> DataFrame:
    """Sketches kept per ship mode, merged, against the exact answers (A4, A8 by flag): the distinct count within
    6 %, and how many quantiles have a rank within 3 % of the rows of the one asked for."""
    li = table(spark, d, "lineitem").select("l_returnflag", *SKETCH_COLS)
    kept = cut_lineage(ST.sketches(li, SKETCH_COLS, by=["l_returnflag"]))
    near = ST.from_sketches(ST.merge_sketches(kept), PROBS)
    exact = ST.distinct_counts(li, SKETCH_COLS).withColumnRenamed("n_distinct", "exact")
    values = {r.column: list(r.quantiles) for r in near.collect()}
    share = [F.struct(F.lit(c).alias("column"), F.array(*[F.avg((F.col(c) < q).cast("double")) for q in values[c]]).alias("low"),
                      F.array(*[F.avg((F.col(c) <= q).cast("double")) for q in values[c]]).alias("high")) for c in SKETCH_COLS]
    ranks = li.agg(F.array(*share).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    hit = F.expr("aggregate(transform(array(" + ", ".join(f"{p}D" for p in PROBS) + "), (p, i) -> "
                 "CASE WHEN low[i] - 0.03D <= p AND p <= high[i] + 0.03D THEN 1 ELSE 0 END), 0, (a, b) -> a + b)")
    return near.join(exact, "column").join(ranks, "column").select(
        "column", "n", (F.abs(F.col("n_distinct") / F.col("exact") - 1) <= 0.06).alias("distinct_near"), hit.alias("ranks_near"))


@query("distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in SKETCH_COLS))
def q_distinct_counts(spark, d) -> DataFrame:
    return ST.distinct_counts(table(spark, d, "lineitem"), SKETCH_COLS)


SAMPLE_COLS = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@query("distinct_sample", " UNION ALL ".join(
    f"(SELECT '{c}' AS \"column\", CAST(row_number() OVER (ORDER BY md5(v || '-42'), v) AS INTEGER) AS rank, v AS value "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM orders WHERE {c} IS NOT NULL) QUALIFY rank <= 20)"
    for c in SAMPLE_COLS))
def q_distinct_sample(spark, d) -> DataFrame:
    """Twenty distinct values a column, by hash (A12)."""
    return ST.distinct_sample(table(spark, d, "orders"), SAMPLE_COLS, 20)


_PREP = ["l_quantity", "l_extendedprice", "l_discount"]
_PREP_SQL = """
WITH base AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_returnflag = 'R' AS INTEGER) AS vote,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(l_quantity AS DOUBLE) END AS l_quantity,
         CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
         CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(l_discount AS DOUBLE) END AS l_discount FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY vote ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) - 1 AS rk,
             count(*) OVER (PARTITION BY vote) AS nc FROM base),
s AS (SELECT *, rk < round(0.2 * nc) AS is_test FROM r),
med AS (SELECT """ + ", ".join(f"median({c}) AS m_{c}" for c in _PREP) + """ FROM s WHERE NOT is_test),
f AS (SELECT id, is_test, """ + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in _PREP) + """ FROM s, med),
sc AS (SELECT """ + ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS d_{c}" for c in _PREP) + """ FROM f WHERE NOT is_test)
SELECT id, is_test, """ + ", ".join(f"round(({c} - a_{c}) / CASE WHEN d_{c} = 0 THEN 1 ELSE d_{c} END, 5) AS {c}" for c in _PREP) + """
FROM f, sc"""


@query("prep_fit_train", _PREP_SQL)
def q_prep_fit_train(spark, d) -> DataFrame:
    """Medians and scale learnt on the training rows and applied to all (fit_on = "train")."""
    li = table(spark, d, "lineitem")
    df = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                   (F.col("l_returnflag") == "R").cast("int").alias("vote"),
                   F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity").cast("double")).alias("l_quantity"),
                   F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
                   F.when(F.col("l_orderkey") % 5 != 0, F.col("l_discount").cast("double")).alias("l_discount"))
    df = cut_lineage(SP.stratified_split(df, "vote", "id", 0.2, 42, "is_test"))
    prep = Preparation.fit(df.where(~F.col("is_test")).drop("is_test"), "vote", strictness="none", exclude=["id"])
    return prep.apply(df).select("id", "is_test", *[F.round(c, 5).alias(c) for c in _PREP])


@query("eda_tables", """
WITH base AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS vote, CAST(year(o_orderdate) AS INTEGER) AS year,
                     n_name AS country, 'session ' || CAST(year(o_orderdate) - 1945 AS VARCHAR) AS session,
                     CAST(o_totalprice AS DOUBLE) AS price, CAST(c_acctbal AS DOUBLE) AS balance
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
h AS (SELECT CAST(min(year) AS DOUBLE) AS lo, CAST(max(year) AS DOUBLE) AS hi, least(30, count(DISTINCT year)) AS nb FROM base),
corr AS (SELECT 'price' AS f, corr(price, vote) AS v FROM base UNION ALL SELECT 'balance', corr(balance, vote) FROM base
         UNION ALL SELECT 'year', corr(CAST(year AS DOUBLE), vote) FROM base)
SELECT 'target_counts' AS chart, CAST(vote AS VARCHAR) AS label, CAST(count(*) AS DOUBLE) AS value FROM base GROUP BY vote
UNION ALL SELECT 'year_hist', CAST(least(CAST(floor((year - lo) / ((hi - lo) / nb)) AS INTEGER), nb - 1) AS VARCHAR), count(*)
          FROM base, h GROUP BY 2
UNION ALL SELECT 'yearly_rate', CAST(year AS VARCHAR), round(avg(vote), 6) FROM base GROUP BY year
UNION ALL SELECT * FROM (SELECT 'top_entities', country, count(*) FROM base GROUP BY country ORDER BY count(*) DESC, country LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'top_topics', session, count(*) FROM base GROUP BY session ORDER BY count(*) DESC, session LIMIT 8)
UNION ALL SELECT 'corr_extremes', f, round(v, 6) FROM corr""")
def q_eda_tables(spark, d) -> DataFrame:
    """All six chart tables (E7) as (chart, label, value); sessions stand in for topics."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    y = F.year("o_orderdate")
    df = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey).select(
        (F.col("o_orderstatus") == "F").cast("int").alias("vote"), y.alias("year"), F.col("n_name").alias("country"),
        F.concat(F.lit("session "), (y - 1945).cast("string")).alias("session"),
        F.col("o_totalprice").cast("double").alias("price"), F.col("c_acctbal").cast("double").alias("balance")))
    df = cut_lineage(df)
    out = None
    names = {"target_counts": ("vote", "count"), "year_hist": ("bin", "count"), "yearly_rate": ("year", "mean"),
             "top_entities": ("country", "count"), "top_topics": ("session", "count"), "corr_extremes": ("feature", "corr")}
    for chart, frame in ST.eda_tables(df, "vote").items():
        label, value = names[chart]
        part = frame.select(F.lit(chart).alias("chart"), F.col(label).cast("string").alias("label"),
                            F.round(F.col(value).cast("double"), 6).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out
