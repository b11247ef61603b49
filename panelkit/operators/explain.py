"""Model explanations: feature importance, coefficients, top-n per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, group: str, value: str, n: int, tiebreak: str | None = None,
                  rank: str = "rank") -> DataFrame:
    """Top ``n`` rows per group by ``value`` descending.

    ``row_number() <= n`` lets Spark insert a per-partition group limit
    before the shuffle, so only n rows per group and task are exchanged even
    when one group is huge.
    """
    order = [F.col(value).desc()] + ([F.col(tiebreak).asc()] if tiebreak else [])
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("int")).where(F.col(rank) <= n)


def feature_importance(model, features) -> list:
    """(feature, importance) by model family: tree importances, |coefficients|
    of linear models, naive-Bayes mean separation. Returns driver-side rows
    (one per feature)."""
    from panelkit.operators.models import GaussianNBModel, PlattSVC, gnb_importance

    features = list(features)
    if isinstance(model, PlattSVC):
        model = model.svm
    if isinstance(model, GaussianNBModel):
        imp = {r["feature"]: r["importance"] for r in gnb_importance(model.fit_table).collect()}
        return [(f, float(imp.get(f"f{i}", 0.0))) for i, f in enumerate(features)]
    if hasattr(model, "featureImportances"):
        v = model.featureImportances.toArray()
        return [(f, float(v[i])) for i, f in enumerate(features)]
    if hasattr(model, "coefficients"):
        v = model.coefficients.toArray()
        return [(f, abs(float(v[i]))) for i, f in enumerate(features)]
    return []


def importance_frame(spark, model, features, name: str) -> DataFrame:
    rows = [(name, f, v) for f, v in feature_importance(model, features)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def coefficients(spark, model, features) -> DataFrame:
    """Signed and absolute coefficients ranked by |value|, zero flag."""
    from panelkit.operators.models import PlattSVC

    if isinstance(model, PlattSVC):
        model = model.svm
    v = model.coefficients.toArray()
    df = spark.createDataFrame([(f, float(v[i])) for i, f in enumerate(features)],
                               "feature string, coefficient double")
    w = Window.orderBy(F.abs("coefficient").desc(), F.col("feature"))  # one row per feature
    return df.select("feature", "coefficient", F.abs("coefficient").alias("abs_coefficient"),
                     F.row_number().over(w).cast("int").alias("rank"),
                     (F.col("coefficient") == 0).alias("is_zero"))
