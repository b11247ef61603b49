"""Forests of a search from counts of equal binned rows."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelkit.operators import forest as FO
from panelkit.operators import models as MD
from panelkit.operators import tuning as T

GRID = {"n_estimators": [5, 10], "max_depth": [2, None], "max_features": ["sqrt", "log2"]}


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 4)).round(1)
    y = x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=400) > 0
    rows = [(int(i % 5), float(y[i]), [float(v) for v in x[i]]) for i in range(400)]
    df = spark.createDataFrame([*rows, *rows[:50]], "fold int, label double, a array<double>")  # rows that come twice
    return df.select("fold", "label", array_to_vector("a").alias("features")).cache()


@pytest.fixture(scope="module")
def cells(train):
    return FO.cells(MD.with_class_weights(train), "features", "label", "weight", "fold", 4)


def test_the_search_makes_no_fit_of_its_own_for_a_point(train, monkeypatch):
    def none(*a, **k):
        raise AssertionError("a separate fit")

    monkeypatch.setattr(MD, "estimator", none)
    model, best, scores = MD.grid_search("rf", train, GRID)
    found = {r.params: r.mean_auc for r in scores.collect()}
    assert len(found) == 8 and best in MD.grid_points(GRID) and min(found.values()) > 0.6
    p = MD.predict(model, train, "rf", keep=())
    assert p.where((F.col("score") > 0.5) != (F.col("prediction") == 1)).count() == 0
    assert p.where((F.col("prediction") == F.col("label"))).count() > 0.8 * p.count()
    assert abs(sum(model.featureImportances.toArray()) - 1) < 1e-9


def test_scores_like_forests_of_spark(train, spark):
    points = MD.grid_points({"n_estimators": [60], "max_depth": [4], "max_features": ["sqrt"]})
    data = MD.with_class_weights(train)
    long, _ = T.forest_search(data, points, "fold", "features", "label", "weight", 42)
    assert {(r.fold, r.label): r["count"] for r in long.groupBy("fold", "label").count().collect()} == {
        (r.fold, r.label): r["count"] for r in train.groupBy("fold", "label").count().collect()}
    ours = T.point_scores(long, 1)[0][0]
    theirs = T.point_scores(T.held_out_scores("rf", data, points, weight="weight"), 1)[0][0]
    assert abs(ours - theirs) < 0.02


def test_fewer_trees_and_less_depth_are_parts_of_the_same_forest(cells):
    for number in range(3):
        whole = FO._tree(cells, 1, number, 2, 30, 7)
        for depth in (0, 1, 3, 6):
            small = FO._tree(cells, 1, number, 2, depth, 7)
            a, b = (FO.scores(t, depth)[FO.reached(t, cells.bins)] for t in (whole, small))
            assert np.array_equal(a, b)
            nodes, gain = FO.compact(whole, depth, 4)
            t = FO.Tree(*nodes, nodes[3], [])
            assert np.array_equal(nodes[3][FO.reached(t, cells.bins)], a)
            assert np.isclose(gain.sum(), float((nodes[0] >= 0).any()))


def test_best_split_by_brute_force(cells):
    rng = np.random.default_rng(1)
    mass = rng.poisson(1.0, len(cells.bins)) * cells.weight
    node = rng.integers(0, 3, len(cells.bins))
    gain, f, b = FO._best_splits(cells.bins, cells.label, mass, node, np.array([[0, 1], [2, 3], [1, 3]]))

    def gini(on):
        w = np.bincount(cells.label[on], mass[on], 2)
        return w.sum() - (w ** 2).sum() / w.sum() if w.sum() else 0.0

    for k, features in enumerate([[0, 1], [2, 3], [1, 3]]):
        own = node == k
        tries = [gini(own) - gini(own & (cells.bins[:, j] <= c)) - gini(own & (cells.bins[:, j] > c))
                 for j in features for c in range(31)]
        assert np.isclose(gain[k], max(tries))
        left = own & (cells.bins[:, f[k]] <= b[k])
        assert np.isclose(gain[k], gini(own) - gini(left) - gini(own & ~left))


def test_cells_hold_every_row(train, cells):
    assert cells.count.sum() == 450 and cells.folds == [0, 1, 2, 3, 4] and len(cells.bins) <= 400
    assert all(len(c) <= 31 for c in cells.cuts)


def test_rows_that_cells_cannot_stand_for_go_to_spark(train, monkeypatch):
    assert FO.cells(train.withColumn("label", F.col("label") * 2), "features", "label", None, "fold", 4) is None
    monkeypatch.setattr(FO, "CELL_BYTES", 100)
    assert FO.cells(train, "features", "label", None, "fold", 4) is None
    _, _, scores = MD.grid_search("rf", train, {"n_estimators": [3], "max_depth": [3], "max_features": ["sqrt"]})
    assert scores.first().mean_auc > 0.6
