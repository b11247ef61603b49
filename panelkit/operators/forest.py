"""Random forests of a grid search for a binary label, grown from counts of equal binned rows.

Trees look at their rows only through ``BINS`` bins a feature, so rows equal in bins, label and
weight are one cell with a count, and the bootstrap of a cell of n rows is one Poisson draw of mean
n. One pass over the rows makes the cells. Each task then grows whole trees from them, level by level
in numpy: gini impurity, each node draws its features, children of one row or more, as Spark's forests do.
A tree draws from (seed, number of the tree, fold), level after level, so

* the first k trees of a forest are a forest of k trees, and
* a tree cut at a depth is the tree grown to that depth (sibling leaves that predict the same class merge
  after the cut, bottom up, as in Spark's trees).

Points that differ only in ``n_estimators`` and ``max_depth`` share one forest a fold. The rows
of the fold are scored where a tree grows; only sums of scores leave the task. The cells are a table of counts and
go to all tasks; where they would take more than ``CELL_BYTES``, ``cells`` gives None and the forests are fitted by
Spark, point by point.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.boosting import binned
from panelkit.session import cut_lineage

# the tasks get these functions by value: executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32  # Spark's default
PROBED = 511
CELL_BYTES = 64 << 20
TREES = 10  # that a task grows
NODES = 4096  # whose sums a task holds at once


@dataclass
class Cells:
    """Rows equal in bins, label and weight, with their number in each fold."""

    cuts: list
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    folds: list
    count: np.ndarray

    def sample(self, fold: int | None) -> np.ndarray:
        """The numbers of rows outside the fold with that position; None: of all rows."""
        whole = self.count.sum(axis=1)
        return whole if fold is None else whole - self.count[:, fold]


@dataclass
class Tree:
    """Nodes level by level, those of level i from ``starts[i]`` on; the right child follows the left one (-1: none)."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    stats: np.ndarray
    gain: np.ndarray
    starts: list


def spread_cuts(values: list, most: int = BINS - 1) -> np.ndarray:
    """Up to ``most`` cuts of a feature from its sorted quantiles, spread over its rows as Spark does; a value up to
    a cut lies below it."""
    value, number = np.unique(np.array(values, float), return_counts=True)
    if len(value) <= most + 1:
        return value[:-1]
    cuts, stride, target, seen = [], number.sum() / (most + 1), number.sum() / (most + 1), number[0]
    for i in range(1, len(value)):
        if abs(seen - target) < abs(seen + number[i] - target):
            cuts.append(value[i - 1])
            target += stride
        seen += number[i]
    return np.array(cuts[:most])


def cells(data: DataFrame, features: str, label: str, weight: str | None, fold_col: str, n_features: int) -> Cells | None:
    """The cells of the rows; None if they are too many, or labels aren't 0 and 1 or weights are null."""
    x = vector_to_array(F.col(features))
    probs = [(i + 1) / (PROBED + 1) for i in range(PROBED)]
    ends = data.agg(*[F.percentile_approx(x[i], probs, 10_000).alias(f"q{i}") for i in range(n_features)],
                    *[F.max(x[i]).alias(f"m{i}") for i in range(n_features)]).first()
    cuts = [spread_cuts([*(ends[f"q{i}"] or []), *([] if ends[f"m{i}"] is None else [ends[f"m{i}"]])]) for i in range(n_features)]
    rows = data.select(x.alias("x"), F.col(label).cast("double").alias("label"),
                       (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
                       F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)).alias("fold"))

    def task(batches):
        for b in batches:
            if b.num_rows:
                at = binned(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts)), cuts)
                made = pa.array([r.tobytes() for r in at], pa.binary())
                yield pa.RecordBatch.from_arrays([made, *[b.column(c) for c in ("label", "weight", "fold")]],
                                                 ["bins", "label", "weight", "fold"])

    counted = cut_lineage(rows.mapInArrow(task, "bins binary, label double, weight double, fold int")
                          .groupBy("bins", "label", "weight", "fold").agg(F.count("*").alias("n")))
    fit = counted.agg(F.count("*"), F.bool_and(F.col("label").isNotNull() & F.col("label").isin(0.0, 1.0)
                                               & F.col("weight").isNotNull())).first()
    if not fit[0] or not fit[1] or fit[0] * (n_features + 28) > CELL_BYTES:
        return None
    t = counted.toArrow()  # bounded by CELL_BYTES
    bins = np.frombuffer(b"".join(t.column("bins").to_pylist()), np.uint8).reshape(-1, n_features)
    y, w, fold, n = (t.column(c).to_numpy() for c in ("label", "weight", "fold", "n"))
    key = np.concatenate([bins.astype(float), y[:, None], w[:, None]], axis=1)
    key, at = np.unique(key, axis=0, return_inverse=True)  # in the same order on every run
    folds = sorted(set(fold.tolist()))
    count = np.zeros((len(key), len(folds)), np.int64)
    np.add.at(count, (at.ravel(), np.searchsorted(folds, fold)), n)
    return Cells(cuts, key[:, :-2].astype(np.uint8), key[:, -2].astype(np.intp), key[:, -1], folds, count)


def grow(bins: np.ndarray, label: np.ndarray, mass: np.ndarray, n_drawn: int, depth: int, draw) -> Tree:
    """A tree of the cells of positive ``mass``; every node draws ``n_drawn`` features."""
    on = np.flatnonzero(mass)
    bins, label, mass = bins[on], label[on], mass[on]
    at, size, n_features = np.zeros(len(on), np.intp), 1, bins.shape[1]
    parts, starts = [], [0]
    for level in range(depth + 1):
        stats = np.bincount(at * 2 + label, mass, 2 * size).reshape(size, 2)
        feature, cut, gain = np.full(size, -1, np.int16), np.zeros(size, np.uint8), np.zeros(size)
        child = np.full(size, -1, np.int32)
        starts.append(starts[-1] + size)
        parts.append((feature, cut, child, stats, gain))
        mixed = np.flatnonzero(stats.min(axis=1) > 0)
        if level == depth or not len(mixed):
            break
        drawn = draw.random((size, n_features)).argsort(axis=1)[:, :n_drawn]
        slot = np.full(size, -1, np.intp)
        slot[mixed] = np.arange(len(mixed))
        # pure nodes need their rows no more
        own = slot[at]
        stay = own >= 0
        bins, label, mass, at, own = bins[stay], label[stay], mass[stay], at[stay], own[stay]
        if len(mixed) > NODES:
            order = np.argsort(own, kind="stable")
            bins, label, mass, at, own = bins[order], label[order], mass[order], at[order], own[order]
        for a in range(0, len(mixed), NODES):
            node = mixed[a:a + NODES]
            lo, hi = np.searchsorted(own, [a, a + NODES]) if len(mixed) > NODES else (0, len(own))
            best, f, b = _best_splits(bins[lo:hi], label[lo:hi], mass[lo:hi], own[lo:hi] - a, drawn[node])
            split = best > 1e-12 * stats[node].sum(axis=1)
            feature[node[split]], cut[node[split]], gain[node[split]] = f[split], b[split], best[split]
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        child[split] = starts[-1] + 2 * np.arange(len(split))
        stay = feature[at] >= 0
        bins, label, mass, at = bins[stay], label[stay], mass[stay], at[stay]
        right = bins[np.arange(len(at)), feature[at]] > cut[at]
        at, size = child[at] - starts[-1] + right, 2 * len(split)
    return Tree(*[np.concatenate(p) for p in zip(*parts)], starts)


def _best_splits(bins, label, mass, node, drawn):
    """(decrease of the gini impurity times the weight, feature, bin) of each node's best split on its drawn features."""
    m, k = drawn.shape
    sums = np.empty((m, k, BINS, 2))
    row = np.arange(len(node))
    for j in range(k):
        code = (node * BINS + bins[row, drawn[node, j]]) * 2 + label
        sums[:, j] = np.bincount(code, mass, m * BINS * 2).reshape(m, BINS, 2)
    below = np.cumsum(sums, axis=2)
    whole = below[:, :1, -1:, :]
    above = whole - below
    weight = below.sum(axis=-1), above.sum(axis=-1), whole.sum(axis=-1)
    least = 1e-11 * weight[2]  # sums of weights are inexact: less than this is no row
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((below ** 2).sum(axis=-1) / weight[0] + (above ** 2).sum(axis=-1) / weight[1]
                - (whole ** 2).sum(axis=-1) / weight[2])
    gain[(weight[0] <= least) | (weight[1] <= least)] = -np.inf
    gain = gain.reshape(m, -1)
    best = gain.argmax(axis=1)
    j, b = np.divmod(best, BINS)
    return gain[np.arange(m), best], drawn[np.arange(m), j], b


def reached(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The last node of each row."""
    at = np.zeros(len(bins), np.intp)
    row = np.arange(len(bins))
    while len(row):
        child = tree.child[at[row]]
        row, child = row[child >= 0], child[child >= 0]
        node = at[row]
        at[row] = child + (bins[row, tree.feature[node]] > tree.cut[node])
    return at


def leaves(tree: Tree, depth: int) -> np.ndarray:
    """Which nodes are leaves of the tree cut at that depth; a node below a leaf may be marked too."""
    leaf, vote = tree.child < 0, tree.stats[:, 1] > tree.stats[:, 0]
    levels = len(tree.starts) - 1
    if depth < levels:
        leaf[tree.starts[depth]:] = True
    for level in reversed(range(min(depth, levels))):
        node = np.arange(tree.starts[level], tree.starts[level + 1])
        node = node[~leaf[node]]
        left = tree.child[node]
        leaf[node] = leaf[left] & leaf[left + 1] & (vote[left] == vote[left + 1])
    return leaf


def scores(tree: Tree, depth: int) -> np.ndarray:
    """By node: the share of class 1 in the leaf of the tree cut at that depth which the node is or lies below."""
    done, value = leaves(tree, depth), tree.stats[:, 1] / tree.stats.sum(axis=1)
    for a, b in zip(tree.starts, tree.starts[1:]):
        node = np.arange(a, b)
        node = node[done[node] & (tree.child[node] >= 0)]
        for right in (0, 1):
            value[tree.child[node] + right], done[tree.child[node] + right] = value[node], True
    return value


def compact(tree: Tree, depth: int, n_features: int):
    """(feature, cut, left child, share of class 1) of the nodes of the tree cut at that depth, and the features' shares
    of the gain."""
    leaf = leaves(tree, depth)
    inner, keep = ~leaf, np.zeros(len(leaf), bool)
    keep[0] = True
    for a, b in zip(tree.starts, tree.starts[1:]):
        node = np.arange(a, b)
        node = node[keep[node] & inner[node]]
        keep[tree.child[node]] = keep[tree.child[node] + 1] = True
    at = np.flatnonzero(keep)
    inner = inner[at]
    feature = np.where(inner, tree.feature[at], -1).astype(np.int16)
    child = np.where(inner, (np.cumsum(keep) - 1)[tree.child[at]], -1).astype(np.int32)
    gain = np.bincount(feature[inner], tree.gain[at[inner]], n_features)
    return (feature, tree.cut[at], child, tree.stats[at, 1] / tree.stats[at].sum(axis=1)), gain / gain.sum() if gain.sum() else gain


def _tree(c: Cells, fold: int | None, number: int, n_drawn: int, depth: int, seed: int) -> Tree:
    draw = np.random.default_rng([seed, number, len(c.folds) if fold is None else fold])
    own = c.sample(fold)
    mass = draw.poisson(own) * c.weight
    return grow(c.bins, c.label, mass if mass.any() else own * c.weight, n_drawn, depth, draw)


def _plain(c: Cells) -> tuple:
    """What a broadcast carries: executors lack the class."""
    return c.cuts, c.bins, c.label, c.weight, c.folds, c.count


def _batches(n: int) -> list[range]:
    return [range(a, min(a + TREES, n)) for a in range(0, n, TREES)]


def held_out(data: DataFrame, c: Cells, units: list[tuple[int, list[tuple[int, int, int]]]], seed: int) -> DataFrame:
    """(point, fold, label, score): every row scored by the forests that haven't seen its fold.

    ``units``: (features a node draws, [(point, trees, depth), ...]) of the points that share their trees.
    """
    sc = data.sparkSession.sparkContext
    shared = sc.broadcast(_plain(c))
    jobs = [(u, fold, batch) for u, (_, points) in enumerate(units) for fold in range(len(c.folds))
            for batch in _batches(max(n for _, n, _ in points))]

    def votes(job):
        (u, fold, batch), own = job, Cells(*shared.value)
        n_drawn, points = units[u]
        held = own.bins[own.count[:, fold] > 0]
        out = np.zeros((len(points), len(held)))
        for number in batch:
            tree = _tree(own, fold, number, n_drawn, max(d for _, _, d in points), seed)
            at = reached(tree, held)
            for depth in {d for _, _, d in points}:
                score = scores(tree, depth)[at]
                for i, (_, n, d) in enumerate(points):
                    if d == depth and number < n:
                        out[i] += score
        return (u, fold), (batch.start, out)

    def rows(item):
        (u, fold), parts = item
        own, points = Cells(*shared.value), units[u][1]
        # added in the order of the trees, so that reruns agree to the last bit
        total = sum(out for _, out in sorted(parts, key=lambda p: p[0]))
        held = np.flatnonzero(own.count[:, fold])
        mean = (total / np.array([n for _, n, _ in points])[:, None]).T.tolist()
        for i, s in zip(held.tolist(), mean):
            yield u, own.folds[fold], float(own.label[i]), int(own.count[i, fold]), s

    made = sc.parallelize(jobs, len(jobs)).map(votes).groupByKey(len(units) * len(c.folds)).flatMap(rows)
    per_cell = cut_lineage(data.sparkSession.createDataFrame(
        made, "unit int, fold int, label double, n long, scores array<double>", verifySchema=False))
    numbers = F.element_at(F.array(*[F.array(*[F.lit(p) for p, _, _ in points]) for _, points in units]), F.col("unit") + 1)
    pairs = F.explode(F.arrays_zip(numbers.alias("point"), F.col("scores").alias("score")))
    by_point = per_cell.select("fold", "label", "n", pairs.alias("p"))
    return by_point.select("p.point", "fold", "label", "p.score", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("_row")
                           ).drop("_row")


def fit(data: DataFrame, c: Cells, n_drawn: int, trees: int, depth: int, seed: int, features: str = "features") -> ForestModel:
    """The forest of all rows."""
    sc = data.sparkSession.sparkContext
    shared, n_features = sc.broadcast(_plain(c)), len(c.cuts)

    def grow_batch(batch):
        own = Cells(*shared.value)
        return [compact(_tree(own, None, t, n_drawn, depth, seed), depth, n_features) for t in batch]

    grown = sc.parallelize(_batches(trees), len(_batches(trees))).flatMap(grow_batch).collect()
    return ForestModel(c.cuts, [t for t, _ in grown], sum(g for _, g in grown))._set(featuresCol=features)


class ForestModel(Model, HasFeaturesCol, HasPredictionCol):
    """Trees as arrays (feature, cut, left child, share of class 1) with ``transform`` like Spark's classifiers."""

    def __init__(self, cuts=(), trees=(), gains=()):
        super().__init__()
        self.cuts, self.trees, self.gains = list(cuts), list(trees), np.array(gains)

    @property
    def featureImportances(self) -> DenseVector:
        """The features' shares of a tree's gain, added over the trees, as shares."""
        return DenseVector(self.gains / self.gains.sum() if self.gains.sum() else self.gains)

    def _transform(self, df: DataFrame) -> DataFrame:
        cuts, trees = self.cuts, self.trees

        @F.pandas_udf("double")
        def chance(x):
            import pandas as pd
            if not len(x):
                return pd.Series([], dtype="float64")
            bins, total = binned(np.stack(x.to_numpy()), cuts), np.zeros(len(x))
            for feature, cut, child, value in trees:
                total += value[reached(Tree(feature, cut, child, value, value, []), bins)]
            return pd.Series(total / len(trees))

        p, n = F.col("_chance"), len(trees)
        out = df.withColumn("_chance", chance(vector_to_array(F.col(self.getFeaturesCol()))))
        return out.withColumns({"rawPrediction": array_to_vector(F.array((1 - p) * n, p * n)),
                                "probability": array_to_vector(F.array(1 - p, p)),
                                self.getPredictionCol(): (p > 0.5).cast("double")}).drop("_chance")
