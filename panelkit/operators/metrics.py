"""Binary classification metrics on any (label, score, prediction) table.

All metrics are DataFrame aggregates. Curves first collapse ties with a
``groupBy(score)`` (combined map-side, so a score shared by a third of all
rows is one partial row per task), then take running sums in descending
score order with the range-bucketed prefix sums of ``ordered``, never with a
single-task global window.

Definitions (sklearn-compatible): ROC-AUC is the trapezoid area over the
distinct-threshold ROC points; average precision is sum over thresholds of
(recall step) * precision, a step function, not a trapezoid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.ordered import join_keys, prefix_sums
from panelkit.session import cut_lineage


def _lab(label):
    return F.col(label).cast("double")


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction", by=()) -> DataFrame:
    """All four (label, prediction) cells, zero cells included, for each group of ``by``."""
    y, p = _lab(label), F.col(pred).cast("double")
    one = df.groupBy(*by).agg(*[F.count_if((y == a) & (p == b)).alias(f"c{int(a)}{int(b)}")
                   for a in (0.0, 1.0) for b in (0.0, 1.0)])
    cells = F.explode(F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                                         F.col(f"c{a}{b}").alias("count"))
                                for a in (0, 1) for b in (0, 1)]))
    return one.select(*by, cells.alias("c")).select(*by, "c.*")


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", by=()) -> DataFrame:
    """accuracy, precision, recall, f1 (0 on a zero denominator), one row for each group of ``by``."""
    y, p = _lab(label), F.col(pred).cast("double")
    c = df.groupBy(*by).agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))
    z = F.lit(0.0)
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), z)
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), z)
    return c.select(
        *by, F.coalesce(F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")),
                   z).alias("accuracy"),
        prec.alias("precision"), rec.alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), z).alias("f1"))


def prevalence(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.avg(_lab(label)).alias("prevalence"))


def score_table(df: DataFrame, label: str = "label", score: str = "score", by=()) -> DataFrame:
    """(by..., score, pos, neg) per distinct score, with running cum_pos / cum_neg
    in descending score order and class totals P, N, for each group of ``by``.

    One long table of several models' scores (``by=["model"]``) gives all their
    curves in one pass. The tie-collapsed table is written once (reliable
    checkpoint): sizing the buckets, their bounds, the totals and the windows
    then read that small table instead of re-running the scoring plan."""
    y, by = _lab(label), list(by)
    t = (df.where(F.col(score).isNotNull() & y.isNotNull())
           .groupBy(*by, F.col(score).cast("double").alias("score"))
           .agg(F.sum((y == 1).cast("long")).alias("pos"), F.sum((y != 1).cast("long")).alias("neg")))
    t = cut_lineage(t)
    cum = prefix_sums(t, "score", ["pos", "neg"], partition_by=by, descending=True)
    tot = t.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    if not by:
        return cum.crossJoin(F.broadcast(tot))  # one row
    return join_keys(cum, tot, by)


def _literal(df: DataFrame, by, row: dict) -> DataFrame:
    """One row of constants for each group of ``by`` in a score table."""
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    return groups.select(*by, *[F.lit(v).cast("double").alias(k) for k, v in row.items()])


def roc_points(st: DataFrame, by=()) -> DataFrame:
    """(by..., threshold, fpr, tpr) of a score table: one point per distinct score, plus (inf, 0, 0)."""
    pts = st.select(*by, F.col("score").alias("threshold"),
                    F.try_divide(F.col("cum_neg"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("cum_pos"), F.col("P")).alias("tpr"))
    return _literal(st, by, {"threshold": float("inf"), "fpr": 0.0, "tpr": 0.0}).unionByName(pts)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr): one point per distinct score, plus (inf, 0, 0)."""
    return roc_points(score_table(df, label, score))


def _auc_expr():
    term = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)
    return F.try_divide(F.sum(term), F.first("P") * F.first("N"))


def _ap_expr():
    term = (F.col("pos") / F.col("P")) * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return F.sum(F.when(F.col("pos") > 0, term))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Trapezoid ROC area; equals the Mann-Whitney U statistic with ties / 2."""
    return score_table(df, label, score).agg(_auc_expr().alias("roc_auc"))


def pr_points(st: DataFrame, by=()) -> DataFrame:
    """(by..., threshold, precision, recall) of a score table, per distinct score
    up to the first one of full recall, then the end point (NULL, 1, 0)."""
    prev_full = (F.col("cum_pos") - F.col("pos")) >= F.col("P")
    pts = st.where(~prev_full | (F.col("P") == 0)).select(
        *by, F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        F.try_divide(F.col("cum_pos"), F.col("P")).alias("recall"))
    return pts.unionByName(_literal(st, by, {"threshold": None, "precision": 1.0, "recall": 0.0}))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall) per distinct score, descending, up to the
    first threshold reaching full recall, then the end point (NULL, 1, 0)."""
    return pr_points(score_table(df, label, score))


def average_precision(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return score_table(df, label, score).agg(_ap_expr().alias("average_precision"))


def evaluate(pred: DataFrame, label: str = "label", prediction: str = "prediction",
             score: str = "score", model: str | None = None) -> DataFrame:
    """Six metrics in one row: accuracy, precision, recall, f1, roc_auc, pr_auc."""
    m = binary_metrics(pred, label, prediction)
    ranks = score_table(pred, label, score).agg(_auc_expr().alias("roc_auc"), _ap_expr().alias("pr_auc"))
    out = m.crossJoin(ranks)  # one row each
    if model is not None:
        out = out.select(F.lit(model).alias("model"), "*")
    return out


def scored(preds: dict, label: str = "label", prediction: str = "prediction", score: str = "score") -> DataFrame:
    """model -> predictions frame  =>  one written table (model, label, score, prediction); each model scores once."""
    parts = [p.select(F.lit(name).alias("model"), _lab(label).alias("label"), F.col(score).cast("double").alias("score"),
                      F.col(prediction).cast("double").alias("prediction")) for name, p in preds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut_lineage(out)


def rank_metrics(df: DataFrame, by, label: str = "label", score: str = "score") -> DataFrame:
    """(by..., roc_auc, pr_auc) of each group of a long score table, in one pass."""
    return _ranks(score_table(df, label, score, by), by)


def _ranks(st: DataFrame, by) -> DataFrame:
    return st.groupBy(*by).agg(_auc_expr().alias("roc_auc"), _ap_expr().alias("pr_auc"))


def compare_scored(long: DataFrame, st: DataFrame) -> DataFrame:
    """One row of six metrics per model, from (model, label, score, prediction) and its score table."""
    counts = binary_metrics(long, "label", "prediction", ["model"])
    out = join_keys(counts, _ranks(st, ["model"]), ["model"])
    return out.select("model", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


def compare(preds: dict, label: str = "label", prediction: str = "prediction",
            score: str = "score") -> DataFrame:
    """model -> predictions frame  =>  one metrics row per model."""
    long = scored(preds, label, prediction, score)
    return compare_scored(long, score_table(long, by=["model"]))


def best_model(cmp: DataFrame, metric: str = "roc_auc") -> DataFrame:
    from panelkit.operators.stats import best_by
    return best_by(cmp, "model", metric)


def model_tables(preds: dict, label: str = "label", prediction: str = "prediction",
                 score: str = "score") -> dict:
    """Data behind the model charts: metric bars, ROC, PR (+ baseline), confusion.

    All come from one written table of scores and one score table over all
    models, so no model scores twice and the curves are one pass."""
    by = ["model"]
    long = scored(preds, label, prediction, score)
    st = cut_lineage(score_table(long, by=by))
    first = F.col("model") == next(iter(preds))  # all models score the same rows
    return {"comparison": compare_scored(long, st), "roc": roc_points(st, by), "pr": pr_points(st, by),
            "confusion": confusion(long, by=by), "pr_baseline": prevalence(long.where(first))}
