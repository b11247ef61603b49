"""Metrics on fixture F-H: ties; ROC-AUC 8/9, average precision 0.833333."""

import math

from panelkit.operators import metrics as M

ROWS = [(0.0, 0.1), (1.0, 0.4), (0.0, 0.4), (1.0, 0.8), (0.0, 0.35), (1.0, 0.4)]


def fh(spark):
    df = spark.createDataFrame(ROWS, "label double, score double")
    return df.withColumn("prediction", (df.score >= 0.4).cast("double"))


def test_auc_and_ap(spark):
    df = fh(spark)
    assert math.isclose(M.roc_auc(df).first()[0], 8 / 9, rel_tol=1e-12)
    assert math.isclose(M.average_precision(df).first()[0], 5 / 6, rel_tol=1e-12)


def test_auc_of_negated_score(spark):
    from pyspark.sql import functions as F
    df = fh(spark).withColumn("score", -F.col("score"))
    assert math.isclose(M.roc_auc(df).first()[0], 1 - 8 / 9, rel_tol=1e-12)


def test_curves(spark):
    roc = sorted((r.fpr, r.tpr) for r in M.roc_curve(fh(spark)).collect())
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0) and len(roc) == 5
    pr = M.pr_curve(fh(spark)).collect()
    assert any(r.threshold is None and r.precision == 1.0 and r.recall == 0.0 for r in pr)


def test_confusion_and_binary(spark):
    df = fh(spark)
    cells = {(r.label, r.prediction): r["count"] for r in M.confusion(df).collect()}
    assert cells == {(0, 0): 2, (0, 1): 1, (1, 0): 0, (1, 1): 3}
    m = M.binary_metrics(df).first()
    assert math.isclose(m.accuracy, 5 / 6) and math.isclose(m.precision, 0.75) and m.recall == 1.0
    assert math.isclose(m.f1, 6 / 7)


def test_zero_division(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    m = M.binary_metrics(df).first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 1.0)
