"""Exact stratified split / folds and samples."""

from pyspark.sql import functions as F

from panelkit.operators import split as SP


def test_split_exact_per_class(spark):
    df = spark.range(0, 1003).select("id", (F.col("id") % 10 < 3).cast("int").alias("y"))
    s = SP.stratified_split(df, "y", "id", 0.2)
    counts = {(r.y, r.is_test): r["count"] for r in s.groupBy("y", "is_test").count().collect()}
    n1 = df.where("y = 1").count()
    n0 = 1003 - n1
    assert counts[(1, True)] == round(0.2 * n1) and counts[(0, True)] == round(0.2 * n0)
    again = SP.stratified_split(df, "y", "id", 0.2).where("is_test").select("id")
    assert again.exceptAll(s.where("is_test").select("id")).count() == 0


def test_folds_balanced(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    f = SP.stratified_folds(df, "y", "id", 5)
    rows = f.groupBy("y", "fold").count().collect()
    assert len(rows) == 10
    for y in (0, 1):
        sizes = [r["count"] for r in rows if r.y == y]
        assert max(sizes) - min(sizes) <= 1


def test_sample_n(spark):
    df = spark.range(0, 5000)
    a = [r.id for r in SP.sample_n(df, 50, "id").collect()]
    assert len(a) == 50 and a == [r.id for r in SP.sample_n(df, 50, "id").collect()]


def test_null_labels_kept(spark):
    df = spark.range(0, 100).select("id", F.when(F.col("id") % 10 == 0, F.lit(None))
                                    .otherwise(F.col("id") % 2).alias("y"))
    s = SP.stratified_split(df, "y", "id", 0.2)
    assert s.count() == 100
    assert s.where("y is null and is_test").count() == 2
