"""Feature selection, standard scaling and model-input assembly."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import columns as C
from panelkit.functions.constants import PRIORITY_FEATURES
from panelkit.operators import stats as ST


def select_features(df: DataFrame, target: str = "vote", priority=tuple(PRIORITY_FEATURES),
                    n: int = 20) -> list:
    """Priority features with a valid correlation (in priority order), then
    the other features by |corr| descending, then any remaining numeric
    columns in table order; cut to ``n``. Target and ``year`` are excluded.
    One aggregate job computes every correlation; only the per-column
    results (one row per column) reach the driver."""
    numeric = [c for c in C.numeric_cols(df) if c not in (target, "year")]
    if not numeric or target not in df.columns:
        return numeric[:n]
    corr = {r["feature"]: abs(r["corr"]) for r in ST.target_correlations(df, target, numeric).collect()}
    if not corr:
        return numeric[:n]
    pos = {c: i for i, c in enumerate(numeric)}
    selected = [p for p in priority if p in pos and p in corr]
    rest = sorted((f for f in corr if f not in selected), key=lambda f: (-corr[f], pos[f]))
    selected += rest[:max(0, n - len(selected))]
    if len(selected) < n:
        selected += [c for c in numeric if c not in selected][:n - len(selected)]
    return selected[:n]


def select_features_df(df: DataFrame, target: str = "vote", priority=tuple(PRIORITY_FEATURES),
                       n: int = 20) -> DataFrame:
    feats = select_features(df, target, priority, n)
    return df.sparkSession.createDataFrame([(f, i + 1) for i, f in enumerate(feats)],
                                           "feature string, position int")


def fit_scaler(df: DataFrame, cols) -> dict:
    """{col: (mean, population std)} from one job (std 0 -> divide by 1)."""
    cols = list(cols)
    if not cols:
        return {}
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    r = df.agg(*aggs).first().asDict()
    out = {}
    for c in cols:
        m, s = r[f"m_{c}"], r[f"s_{c}"]
        out[c] = (m or 0.0, s if s else 1.0)
    return out


def apply_scaler(df: DataFrame, scaler: dict) -> DataFrame:
    return df.withColumns({c: (F.col(f"`{c}`").cast("double") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in scaler.items() if c in df.columns})


def assemble(df: DataFrame, features, label: str = "vote", out: str = "features",
             keep=()) -> DataFrame:
    """NULL features -> 0, assemble a vector column, label as DOUBLE."""
    features = list(features)
    filled = df.select(*[F.col(k) for k in keep],
                       *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(c) for c in features],
                       F.col(label).cast("double").alias("label"))
    return VectorAssembler(inputCols=features, outputCol=out).transform(filled).select(
        *keep, out, "label")
