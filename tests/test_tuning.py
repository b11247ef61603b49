"""Shared fits of the grid search against separate fits, and held-out calibration."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelkit.operators import boosting as BO
from panelkit.operators import metrics as M
from panelkit.operators import models as MD
from panelkit.operators import tuning as T


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(scale=0.8, size=300) > 0.3).astype(float)
    rows = [(i, int(i % 5), float(y[i]), *map(float, np.round(x[i], 2))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, fold int, label double, a double, b double, c double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).coalesce(2).cache()


def test_tree_cut_at_a_depth_is_the_tree_of_that_depth(train):
    data = MD.with_class_weights(train)
    for leaf in (1, 4):
        est, pm = MD.estimator("dt", 300)
        deep = est.fit(data, pm({"max_depth": None, "min_samples_leaf": leaf}))
        depths = [1, 2, 4, 6, MD.MAX_DEPTH]
        got = {r.id: r.scores for r in T.tree_scores(deep, train, depths).collect()}
        for k, depth in enumerate(depths):
            alone = est.fit(data, pm({"max_depth": depth, "min_samples_leaf": leaf})).transform(train)
            want = {r.id: r.p[1] for r in alone.select("id", vector_to_array("probability").alias("p")).collect()}
            assert all(math.isclose(got[i][k], want[i], abs_tol=1e-12) for i in want)


def chances(model, df):
    return {r.id: r.p for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("p")).collect()}


def test_boosted_fits_in_step_equal_separate_fits(train):
    fits = [BO.Fit(2, 0.3, 1.0), BO.Fit(3, 0.1, 0.7), BO.Fit(3, 0.1, 0.7, without=1)]
    cuts, blocks = BO.fit_many(train, fits, 12, fold_col="fold")
    held = {(r.point, r.score) for r in BO.held_out(blocks, fits, [[], [], [(0, 5), (1, 12)]]).collect()}
    for fit, df in ((fits[0], train), (fits[1], train)):
        for rounds in (5, 12):
            alone = BO.BoostedTrees(maxIter=rounds, maxDepth=fit.depth, stepSize=fit.rate, subsamplingRate=fit.subsample).fit(df)
            got, want = chances(fit.model(cuts, rounds), train), chances(alone, train)
            assert all(math.isclose(got[i], want[i], abs_tol=1e-6) for i in want)
    inside = train.where("fold = 1")
    for point, rounds in ((0, 5), (1, 12)):
        want = sorted(chances(fits[2].model(cuts, rounds), inside).values())
        got = sorted(s for p, s in held if p == point)
        assert np.allclose(sorted(set(np.round(want, 6))), sorted(set(np.round(got, 6))), atol=2e-6)


def test_boosting_against_brute_force(spark):
    """One tree of depth 1 on few values: the best split and its leaves by hand."""
    rows = [(float(v), float(y)) for v, y in [(1, 0), (1, 0), (2, 0), (2, 1), (3, 1), (3, 1), (4, 1), (4, 1)] * 6]
    df = VectorAssembler(inputCols=["v"], outputCol="features").transform(spark.createDataFrame(rows, "v double, label double"))
    model = BO.BoostedTrees(maxIter=1, maxDepth=1, stepSize=0.5).fit(df)
    best = None
    for cut in (1.0, 2.0, 3.0):
        parts = [[y for v, y in rows if v <= cut], [y for v, y in rows if v > cut]]
        g = [sum(0.5 - y for y in p) for p in parts]
        h = [0.25 * len(p) for p in parts]
        gain = sum(a * a / (b + 1) for a, b in zip(g, h)) - sum(g) ** 2 / (sum(h) + 1)
        if best is None or gain > best[0]:
            best = (gain, cut, [-a / (b + 1) * 0.5 for a, b in zip(g, h)])
    got = {r.v: r.m for r in model.transform(df).select("v", vector_to_array("rawPrediction")[1].alias("m")).collect()}
    assert all(math.isclose(got[v], best[2][v > best[1]], rel_tol=1e-6) for v in got)
    assert model.featureImportances.toArray().tolist() == [1.0]


def test_naive_bayes_from_additive_statistics(train):
    points = MD.grid_points({"var_smoothing": [1e-9, 1e-2]})
    got = T.point_scores(T.held_out_scores("nb", train, points), 2)
    for i, p in enumerate(points):
        aucs = []
        for fold in range(5):
            model = MD.GaussianNB(varSmoothing=p["var_smoothing"]).fit(train.where(f"fold <> {fold}"))
            aucs.append(M.roc_auc(MD.predict(model, train.where(f"fold = {fold}"), "nb", keep=("id",))).first()[0])
        assert math.isclose(got[i][0], sum(aucs) / 5, abs_tol=1e-9) and math.isclose(got[i][1], np.std(aucs), abs_tol=1e-9)


def test_sigmoid_on_held_out_margins_is_not_overconfident(spark):
    """Many features without signal: margins of the training rows lie far out, held-out ones don't."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(160, 60))
    y = rng.integers(0, 2, 160)
    cols = [f"v{i}" for i in range(60)]
    df = spark.createDataFrame([(int(i % 5), float(y[i]), *map(float, x[i])) for i in range(160)],
                               "fold int, label double, " + ", ".join(f"{c} double" for c in cols))
    df = VectorAssembler(inputCols=cols, outputCol="features").transform(df).select("fold", "label", "features").cache()
    model, _, _ = MD.grid_search("svc", df, {"C": [1.0]})
    fresh = rng.normal(size=(200, 60))
    new = spark.createDataFrame([(*map(float, r),) for r in fresh], ", ".join(f"{c} double" for c in cols))
    new = VectorAssembler(inputCols=cols, outputCol="features").transform(new).withColumn("label", F.lit(0.0))

    def spread(m):
        p = [r[0] for r in m.transform(new).select(vector_to_array("probability")[1]).collect()]
        return float(np.mean(np.abs(np.array(p) - 0.5)))

    own = LinearSVC(regParam=1 / 160, maxIter=100, standardization=True).fit(df)
    seen = own.transform(df).select("label", vector_to_array("rawPrediction")[1].alias("score"))
    assert spread(model) < 0.15 < spread(MD.calibrate_svc(own, seen))


def test_one_pass_tables_equal_single_ones(spark):
    rng = np.random.default_rng(6)
    preds = {}
    for name in ("m1", "m2"):
        rows = [(float(rng.integers(0, 2)), float(np.round(rng.random(), 1))) for _ in range(80)]
        df = spark.createDataFrame(rows, "label double, score double")
        preds[name] = df.withColumn("prediction", (F.col("score") > 0.5).cast("double")).cache()
    t = M.model_tables(preds)
    key = lambda r: tuple(-1.0 if v is None else round(v, 9) for v in r)
    for name, p in preds.items():
        one = f"model = '{name}'"
        for table, single in (("roc", M.roc_curve(p)), ("pr", M.pr_curve(p)), ("confusion", M.confusion(p)),
                              ("comparison", M.evaluate(p))):
            assert sorted(map(key, t[table].where(one).drop("model").collect())) == sorted(map(key, single.collect()))


def test_logistic_regression_against_newton_steps(train):
    """The L2 fit of a grid point minimises the weighted loss + |w|^2 / (2 C n), intercept free."""
    data = MD.with_class_weights(train)
    est, pm = MD.estimator("lr", 300)
    model = est.copy({est.tol: 1e-10}).fit(data, pm({"C": 0.1, "penalty": "l2"}))
    rows = data.select(vector_to_array("features").alias("x"), "label", "weight").collect()
    x = np.array([[1.0, *r.x] for r in rows])
    y, s = np.array([r.label for r in rows]), np.array([r.weight for r in rows])
    w, ridge = np.zeros(4), np.diag([0, 1, 1, 1]) / (0.1 * 300)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (s * (p - y)) / s.sum() + ridge @ w
        hess = (x * (s * p * (1 - p))[:, None]).T @ x / s.sum() + ridge
        w -= np.linalg.solve(hess, grad)
    assert np.allclose([model.intercept, *model.coefficients.toArray()], w, atol=1e-4)


def test_a_forest_of_one_tree_on_all_features_is_the_tree(train):
    tree, pm = MD.estimator("dt", 300, weight=None)
    forest, rf = MD.estimator("rf", 300, weight=None)
    one = tree.fit(train, pm({"max_depth": 4, "min_samples_leaf": 1}))
    other = forest.copy({forest.bootstrap: False}).fit(train, rf({"n_estimators": 1, "max_depth": 4, "max_features": "all"}))
    a, b = ({r.id: r.p for r in m.transform(train).select("id", vector_to_array("probability")[1].alias("p")).collect()}
            for m in (one, other))
    assert all(math.isclose(a[i], b[i], abs_tol=1e-12) for i in a)


def test_forests_that_draw_as_many_features_are_one_fit(train, monkeypatch):
    points = MD.grid_points({"n_estimators": [5], "max_depth": [3], "max_features": ["sqrt", "log2"]})
    assert T.units("rf", points, 4) == [[0, 1]] and T.units("rf", points, 100) == [[0], [1]]
    alone = [T.point_scores(T.held_out_scores("rf", train, [p]), 1)[0] for p in points]
    made = []
    whole = MD.estimator
    monkeypatch.setattr(MD, "estimator", lambda *a, **k: made.append(a) or whole(*a, **k))
    assert T.point_scores(T.held_out_scores("rf", train, points), 2) == alone
    assert len(made) == 5  # one fit a fold


def test_few_rows_spread_the_fits_over_tasks_and_change_none(spark):
    from pyspark.ml.functions import array_to_vector
    rows = spark.range(0, 400, 1, 1).select(
        F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("a"),
        (F.col("id") % 7 > 3).cast("double").alias("label"), (F.col("id") % 2).cast("int").alias("fold"))
    data = rows.select(array_to_vector("a").alias("features"), "label", "fold")
    fits = [BO.Fit(depth, 0.3, 0.8, fold) for depth in (1, 3) for fold in (0, 1)]
    sc = spark.sparkContext
    sc.setJobGroup("spread", "spread")
    try:
        BO.fit_many(data, fits, 2, fold_col="fold")
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("spread") for s in tracker.getJobInfo(j).stageIds]
        assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) == min(4, sc.defaultParallelism)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    for fit in fits:
        alone = BO.Fit(fit.depth, fit.rate, fit.subsample, fit.without)
        BO.fit_many(data, [alone], 2, fold_col="fold")
        for ours, theirs in zip(fit.trees, alone.trees):
            assert all(np.array_equal(a, b) for a, b in zip(ours, theirs))


def test_leaves_hand_down_what_a_row_reaches():
    # the root splits, its left child is a leaf, its right child splits
    feature = np.array([[0, -1, 1, -1, -1, -1, -1]])
    cut = np.array([[3, 0, 5, 0, 0, 0, 0]], np.uint8)
    value = np.array([[9.0, 1.0, 8.0, 0.0, 0.0, 2.0, 4.0]])
    bins = np.array([[0, 63], [3, 0], [4, 5], [4, 6]], np.uint8)
    walk = [x[0] for x in BO.passable(feature, cut)]
    node = BO.descend(*walk, bins.ravel(), np.arange(4) * 2, 2)
    assert BO.handed_down(feature, value, 2)[0][node].tolist() == [1.0, 1.0, 2.0, 4.0]
