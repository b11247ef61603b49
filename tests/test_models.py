"""Gaussian naive Bayes against Spark's own, and one grid search end to end."""

import math

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelkit.operators import features as FE
from panelkit.operators import metrics as M
from panelkit.operators import models as MD
from panelkit.operators import split as SP


def data(spark):
    return spark.range(0, 400).select(
        "id", (F.col("id") % 2).cast("double").alias("label"),
        ((F.col("id") % 2) * 2 + F.sin("id")).alias("a"), (F.cos("id") * 3).alias("b"))


def test_gnb_matches_spark_naive_bayes(spark):
    df = data(spark)
    fit = {(r.label, r.feature): (r.mean, r.var) for r in MD.gnb_fit(df, "label", ["a", "b"], 0.0).collect()}
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    nb = NaiveBayes(modelType="gaussian").fit(vec)
    theta, sigma = nb.theta.toArray(), nb.sigma.toArray()
    for k, lab in enumerate([0.0, 1.0]):
        for j, f in enumerate(["a", "b"]):
            assert math.isclose(fit[(lab, f)][0], theta[k][j], rel_tol=1e-9)
            assert math.isclose(fit[(lab, f)][1], sigma[k][j], rel_tol=1e-6)


def test_grid_search_and_evaluate(spark):
    df = data(spark)
    train, test = SP.split_frames(df, "label", "id")
    train = SP.stratified_folds(train, "label", "id", 5)
    tr = FE.assemble(train, ["a", "b"], "label", keep=("id", "fold"))
    te = FE.assemble(test, ["a", "b"], "label", keep=("id",))
    for kind in ("nb", "lr"):
        model, params, scores = MD.grid_search(kind, tr, MD.SMALL_GRIDS[kind])
        pred = MD.predict(model, te, kind, keep=("id",))
        row = M.evaluate(pred).first()
        assert row.roc_auc > 0.9 and scores.count() == len(MD.grid_points(MD.SMALL_GRIDS[kind]))


def test_registered_queries_search_the_whole_grid(monkeypatch):
    from panelkit.plans import model_queries as Q

    class Stop(Exception):
        pass

    def stop(*_, **__):
        raise Stop

    calls = []
    monkeypatch.setattr(Q, "prepared", lambda spark, d: (None, None))
    monkeypatch.setattr(MD, "grid_search", lambda kind, tr, grid=None: calls.append((kind, grid)) or (None, None, None))
    monkeypatch.setattr(MD, "predict", lambda *a, **k: None)
    for at, name in ((Q.M, "compare"), (Q.M, "evaluate"), (Q.EX, "coefficients"), (Q.EX, "importance_frame")):
        monkeypatch.setattr(at, name, stop)
    queries = [Q._fit_eval(kind) for kind in MD.MODEL_NAMES] + [
        Q.q_compare_models, Q.q_grid_scores, Q.q_lr_coefficients, Q.q_rf_importance]
    for q in queries:
        try:
            q(None, None)
        except Stop:
            pass
    assert [k for k, _ in calls] == [*MD.MODEL_NAMES, *MD.MODEL_NAMES, "lr", "lr", "rf"]
    assert all((grid or MD.FULL_GRIDS[kind]) == MD.FULL_GRIDS[kind] for kind, grid in calls)


def test_compared_models_are_searched_side_by_side(spark, monkeypatch):
    import threading

    from panelkit.plans import model_queries as Q
    together = threading.Barrier(len(MD.MODEL_NAMES))
    rows = spark.createDataFrame([(1.0, 0.9, 1.0), (0.0, 0.2, 0.0)], "label double, score double, prediction double")

    def search(kind, train, grid):
        together.wait(30)
        return kind, {"kind": kind}, None

    monkeypatch.setattr(Q, "prepared", lambda spark, d: (rows, rows))
    monkeypatch.setattr(MD, "grid_search", search)
    monkeypatch.setattr(MD, "predict", lambda model, df, kind, keep: df)
    got = {r.model: r.params for r in Q.q_compare_models(spark, "").collect()}
    assert got == {name: str({"kind": kind}) for kind, name in MD.MODEL_NAMES.items()}
