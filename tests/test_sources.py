"""CSV discovery and loading (S1-S5) and the Parquet sink (S6)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelkit.sources import csv as CSV
from panelkit.sources.sinks import write_results

SF = "/root/testdata/sf0.001"


def _write_csv(df, path):
    """One CSV file with a header at exactly ``path`` (through pandas: tiny)."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    df.toPandas().to_csv(path, index=False)


@pytest.fixture(scope="module")
def dirs(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    root = tempfile.mkdtemp(prefix="pk-csv-")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    votes = orders.select("o_orderkey", F.col("o_orderstatus").alias("vote"))
    _write_csv(votes.limit(50), f"{root}/votes_flat/a_small.csv")          # has a 'vote' column
    _write_csv(orders.select("o_orderkey"), f"{root}/votes_flat/b_big.csv")
    _write_csv(votes, f"{root}/votes_tree/sub/x.csv")                       # only in a sub-folder
    _write_csv(orders.select("o_orderkey").limit(10), f"{root}/wdi/small.csv")
    _write_csv(orders.select("o_orderkey", "o_totalprice"), f"{root}/wdi/large.csv")
    _write_csv(orders.select("o_orderkey").limit(5), f"{root}/wdi_named/indicators.csv")
    _write_csv(orders.select("o_orderkey", F.col("o_totalprice").alias("expenditure")).limit(20),
               f"{root}/sipri/deep/s.csv")
    return root


def test_list_csv(spark, dirs):
    flat = {os.path.basename(r.path) for r in CSV.list_csv(spark, f"{dirs}/votes_flat").collect()}
    assert flat == {"a_small.csv", "b_big.csv"}
    deep = CSV.list_csv(spark, f"{dirs}/votes_tree", recursive=True).collect()
    assert len(deep) == 1 and deep[0].bytes > 0


def test_load_by_signature(spark, dirs):
    assert "vote" in CSV.load_by_signature(spark, f"{dirs}/votes_flat").columns
    assert CSV.load_by_signature(spark, f"{dirs}/votes_tree").count() == 1500


def test_load_by_priority(spark, dirs):
    assert CSV.load_by_priority(spark, f"{dirs}/wdi_named").count() == 5
    # no preferred name, no WDI*Data* file: largest file with > 1000 rows
    assert CSV.load_by_priority(spark, f"{dirs}/wdi").columns == ["o_orderkey", "o_totalprice"]


def test_load_spending(spark, dirs):
    assert "expenditure" in CSV.load_spending(spark, f"{dirs}/sipri").columns


def test_write_results(spark, dirs):
    out = tempfile.mkdtemp(prefix="pk-out-")
    paths = write_results({"a": spark.range(5), "skip": 3}, out)
    assert len(paths) == 1 and spark.read.parquet(paths[0]).count() == 5


def test_load_by_priority_pattern_walk(spark, dirs):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    _write_csv(orders.select("o_orderkey").limit(3), f"{dirs}/wdi_walk/a.csv")
    _write_csv(orders.select("o_orderkey", "o_orderstatus"), f"{dirs}/wdi_walk/deep/WDI_Data_2023.csv")
    got = CSV.load_by_priority(spark, f"{dirs}/wdi_walk", min_bytes=10, min_rows=5)
    assert got.columns == ["o_orderkey", "o_orderstatus"] and got.count() == 1500


def test_read_csv_keeps_quoted_line_breaks(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="pk-csv-"), "a.csv")
    with open(path, "w") as f:
        f.write('id,text\n1,"two\nlines"\n2,"a ""b"""\n')
    got = {r.id: r.text for r in CSV.read_csv(spark, path).collect()}
    assert got == {"1": "two\nlines", "2": 'a "b"'}


def test_line_breaks_are_found_by_one_scan(spark):
    folder = tempfile.mkdtemp(prefix="pk-csv-")
    plain, broken = os.path.join(folder, "plain.csv"), os.path.join(folder, "broken.csv")
    with open(plain, "w") as f:
        f.write("id,text\n" + "".join(f'{i},"a ""{i}"", b"\n' for i in range(4000)))
    with open(broken, "w") as f:
        f.write("id,text\n" + "".join(f'{i},"x{chr(10) if i == 3999 else " "}y"\n' for i in range(4000)))
    assert not CSV.holds_line_breaks(spark, plain) and CSV.holds_line_breaks(spark, broken)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        for path, splits in ((plain, True), (broken, False)):
            df = CSV.read_csv(spark, path)
            assert (df.select(F.spark_partition_id()).distinct().count() > 1) == splits
            assert df.count() == 4000 and df.where("id = 3999").first().text in ('a "3999", b', "x\ny")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_spending_skips_unreadable_files(spark):
    folder = tempfile.mkdtemp(prefix="pk-csv-")
    open(os.path.join(folder, "a.csv"), "w").close()
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write("Country,Value\nX,1\n")
    assert CSV.load_spending(spark, folder).columns == ["Country", "Value"]
    os.makedirs(os.path.join(folder, "none"))
    open(os.path.join(folder, "none", "a.csv"), "w").close()
    assert CSV.load_spending(spark, os.path.join(folder, "none")) is None
    assert CSV.load_spending(spark, os.path.join(folder, "missing")) is None
