"""Gradient-boosted trees for a binary label: all settings and folds in one boosting run.

Second-order boosting of the logistic loss (leaf weight ``-G / (H + L2)``, splits by
gain, children of hessian ``MIN_CHILD`` or more) on quantile bins of the features. A grid
search asks for many fits to the same rows; here they grow in step. One job per
tree level reads the rows once and adds up, over all fits together, the
gradients by (fit, node, feature, bin) of the nodes that still grow. A search with
90 fits so reads the rows as often as one fit does, and starts as many jobs.

The binned rows are written once in blocks. Where these make fewer partitions than there
are cores, the fits are dealt to groups, and each group is a task of its own for each partition. The
margins of the fits travel with the blocks as a persisted RDD that is checkpointed every ``CHECKPOINT`` rounds, so a
lost executor recomputes at most that many rounds. Only sums reach the driver: a
level has at most 2^level nodes a fit, ``BINS`` bins a feature. Round k does not depend on later
rounds, so the first k rounds are the model of k rounds; and a fit is the same,
whatever fits grow with it (the row sample of a round depends on block, round and seed).
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import checkpoint_dir, cut_lineage

# the tasks get these functions by value: executors need numpy and pyarrow, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

L2, MIN_CHILD, MIN_GAIN = 1.0, 1.0, 1e-6
BINS = 64
CHECKPOINT = 20


class Fit:
    """One fit: its setting, the fold it doesn't see (None: it sees all), and what it has grown.

    Trees are rows of heap-ordered arrays (children of i are 2i + 1 and 2i + 2):
    feature (-1: leaf), bin up to which rows go left, leaf value, gain.
    """

    def __init__(self, depth: int, rate: float, subsample: float, without=None):
        self.depth, self.rate, self.subsample, self.without = depth, rate, subsample, without
        self.trees: list[tuple] = []

    def model(self, cuts, rounds: int | None = None) -> BoostedModel:
        return BoostedModel(cuts, [np.stack(x) for x in zip(*self.trees[:rounds])])


def quantile_cuts(data: DataFrame, features: str, n_features: int) -> list[np.ndarray]:
    """Up to ``BINS`` - 1 cuts of each feature; a value up to a cut lies below it."""
    x = vector_to_array(F.col(features))
    probs = [(i + 1) / BINS for i in range(BINS - 1)]
    row = data.agg(*[F.percentile_approx(x[i], probs, 10_000).alias(f"q{i}") for i in range(n_features)],
                   *[F.max(x[i]).alias(f"m{i}") for i in range(n_features)]).first()
    # no row lies above the largest value
    return [np.array([v for v in sorted(set(row[f"q{i}"] or [])) if v < row[f"m{i}"]]) for i in range(n_features)]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _matrix(column: pa.Array, n_features: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_features)


def _blocks(data: DataFrame, cuts, fold_col: str | None, features: str, label: str) -> DataFrame:
    """The rows as written blocks: (block, bins, label, fold), arrays as bytes."""
    fold = F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)) if fold_col else F.lit(-1)
    rows = data.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("label"),
                       fold.alias("fold"), F.monotonically_increasing_id().alias("row"))

    def task(batches):
        for b in batches:
            if b.num_rows:
                made = (binned(_matrix(b.column("x"), len(cuts)), cuts).tobytes(),
                        b.column("label").to_numpy(zero_copy_only=False).astype(np.float32).tobytes(),
                        b.column("fold").to_numpy(zero_copy_only=False).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([b.column("row").slice(0, 1), *[pa.array([m], pa.binary()) for m in made]],
                                                 ["block", "bins", "label", "fold"])

    return cut_lineage(rows.mapInArrow(task, "block long, bins binary, label binary, fold binary"))


def _open(row, n_features: int):
    return (row[0], np.frombuffer(row[1], np.uint8).reshape(-1, n_features), np.frombuffer(row[2], np.float32),
            np.frombuffer(row[3], np.int32))


def descend(feature: np.ndarray, cut: np.ndarray, flat: np.ndarray, row: np.ndarray, levels: int) -> np.ndarray:
    """The node of a tree that each row reaches after so many levels; rows that come to a leaf go on to the left.

    ``flat`` holds the bins row by row, ``row`` where each row begins in it. ``feature`` and ``cut`` are as
    ``passable`` makes them.
    """
    node = np.zeros(len(row), np.intp)
    for _ in range(levels):
        right = flat.take(row + feature.take(node)) > cut.take(node)
        node += node
        node += right
        node += 1
    return node


def passable(feature: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trees whose leaves send all rows to the left."""
    leaf = feature < 0
    return np.where(leaf, 0, feature).astype(np.intp), np.where(leaf, 255, cut).astype(np.uint8)


def handed_down(feature: np.ndarray, value: np.ndarray, levels: int) -> np.ndarray:
    """The values of leaves, repeated along the way to the left down to the last level."""
    value = value.copy()
    for level in range(levels):
        at = np.arange(2 ** level - 1, 2 ** (level + 1) - 1)
        value[:, 2 * at + 1] = np.where(feature[:, at] < 0, value[:, at], value[:, 2 * at + 1])
    return value


def _sums(elements, feature, cut, slot, span, level, without, subsample, number, seed):
    """(fit, gradient and hessian sums (slots, features, bins, 2)) of the blocks of a partition.

    ``slot`` numbers the growing nodes; those of fit m are span[m] to span[m + 1].
    """
    held: dict = {}
    for block, bins, label, fold, margins in elements:
        n_features = bins.shape[1]
        flat, codes = bins.ravel(), bins.T.astype(np.intp)
        draw = np.random.default_rng([seed, block, number]).random(len(bins))
        seen: dict = {}
        for m, margin in margins.items():
            n = int(span[m + 1] - span[m])
            if not n:
                continue
            sample = without[m], subsample[m]
            if sample not in seen:
                seen[sample] = np.flatnonzero((fold != sample[0]) & (draw < sample[1]))
            row = seen[sample]
            at = slot[m].take(descend(feature[m], cut[m], flat, row * n_features, level))
            on = at >= 0
            if not on.all():
                row, at = row[on], at[on]
            p = 1 / (1 + np.exp(-margin.take(row).astype(np.float64)))
            g, h = p - label.take(row), p * (1 - p)
            first = (at - span[m]) * BINS
            out = held.setdefault(m, np.zeros((n, n_features, BINS, 2)))
            for f in range(n_features):
                cell = first + codes[f].take(row)
                for k, w in enumerate((g, h)):
                    out[:, f, :, k] += np.bincount(cell, w, n * BINS).reshape(n, BINS)
    yield from held.items()


def _add_round(element, feature, cut, value, depth):
    block, bins, label, fold, margins = element
    flat, row = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    return block, bins, label, fold, {
        m: (margin + value[m].take(descend(feature[m], cut[m], flat, row, depth[m]))).astype(np.float32)
        for m, margin in margins.items()}


def _leaf(g, h, rate):
    return -g / (h + L2) * rate


def fit_many(data: DataFrame, fits: list[Fit], rounds: int, features: str = "features", label: str = "label",
             fold_col: str | None = None, seed: int = 42) -> tuple[list[np.ndarray], DataFrame]:
    """Grow all fits by ``rounds`` rounds; gives the cuts of the features and the written blocks."""
    meta = data.schema[features].metadata.get("ml_attr", {})
    n_features = meta.get("num_attrs") or len(data.select(features).first()[0])
    cuts = quantile_cuts(data, features, n_features)
    blocks = _blocks(data, cuts, fold_col, features, label)
    checkpoint_dir(data.sparkSession)
    depth = np.array([f.depth for f in fits])
    rate = np.array([f.rate for f in fits])
    subsample = np.array([f.subsample for f in fits])
    without = np.array([-(1 << 30) if f.without is None else f.without for f in fits])
    deepest, size, n_fits = int(depth.max()), 2 ** (int(depth.max()) + 1) - 1, len(fits)

    # few rows make few partitions: then the fits are dealt to groups, each with the rows a task group of its own
    rows = blocks.rdd
    context = data.sparkSession.sparkContext
    groups = min(n_fits, max(1, -(-context.defaultParallelism // max(1, rows.getNumPartitions()))))

    def start(row, own):
        opened = _open(row, n_features)
        return (*opened, {m: np.zeros(len(opened[1]), np.float32) for m in own})

    parts = [rows.map(lambda r, own=range(k, n_fits, groups): start(r, own)) for k in range(groups)]
    state = (context.union(parts) if groups > 1 else parts[0]).persist(StorageLevel.MEMORY_AND_DISK)
    old = None
    for number in range(rounds):
        feature = np.full((n_fits, size), -1, np.int16)
        cut = np.zeros((n_fits, size), np.uint8)
        value, gains = np.zeros((n_fits, size)), np.zeros((n_fits, size))
        grow = [(m, 0) for m in range(n_fits)]
        for level in range(deepest):
            grow = sorted((m, i) for m, i in grow if level < depth[m])
            if not grow:
                break
            slot = np.full((n_fits, size), -1, np.int32)
            m, i = np.array(grow).T
            slot[m, i] = np.arange(len(grow))
            span = np.searchsorted(m, np.arange(n_fits + 1))
            walk = (*passable(feature, cut), slot, span, level, without, subsample, number, seed)
            sums = state.mapPartitions(lambda e, a=walk: _sums(e, *a))
            if rows.getNumPartitions() > 1:  # else a fit's sums come from one task
                sums = sums.reduceByKey(np.add, min(n_fits, context.defaultParallelism))
            total = np.zeros((len(grow), n_features, BINS, 2))
            for of, own in sums.collect():  # a fit's sums have the size of its nodes, whatever the rows
                total[span[of]:span[of + 1]] = own
            if old is not None:
                old = old.unpersist() and None
            best, f, b, left, both = best_splits(total)
            value[m, i] = _leaf(both[:, 0], both[:, 1], rate[m])
            on = best > MIN_GAIN
            m, i, f, b, left, both = m[on], i[on], f[on], b[on], left[on], both[on]
            feature[m, i], cut[m, i], gains[m, i] = f, b, best[on]
            grow = []
            for child, sums in ((2 * i + 1, left), (2 * i + 2, both - left)):
                value[m, child] = _leaf(sums[:, 0], sums[:, 1], rate[m])
                large = sums[:, 1] >= 2 * MIN_CHILD  # smaller ones can't have two children
                grow += zip(m[large].tolist(), child[large].tolist())
        for m, fit in enumerate(fits):
            own = 2 ** (fit.depth + 1) - 1
            fit.trees.append((feature[m, :own], cut[m, :own], value[m, :own].astype(np.float32), gains[m, :own]))
        step = (*passable(feature, cut), handed_down(feature, value, deepest), depth)
        old, state = state, state.map(lambda e, a=step: _add_round(e, *a)).persist(
            StorageLevel.MEMORY_AND_DISK)
        if (number + 1) % CHECKPOINT == 0:
            state.checkpoint()
    for rdd in (old, state):
        if rdd is not None:
            rdd.unpersist()
    return cuts, blocks


def best_splits(total: np.ndarray):
    """(gain, feature, bin, sums of the left child, sums of the node) of the best split of each slot."""
    below = np.cumsum(total, axis=2)
    both = below[:, 0, -1, :]
    node = both[:, None, None, :]
    above = node - below

    def weight(s):
        return s[..., 0] ** 2 / (s[..., 1] + L2)

    gain = weight(below) + weight(above) - weight(node)
    gain[(below[..., 1] < MIN_CHILD) | (above[..., 1] < MIN_CHILD)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    at = np.argmax(flat, axis=1)
    f, b = np.unravel_index(at, gain.shape[1:])
    slots = np.arange(len(gain))
    return flat[slots, at], f, b, below[slots, f, b], both


def staged(trees: list[np.ndarray], bins: np.ndarray, stages: list[int]) -> list[np.ndarray]:
    """The log odds of class 1 after so many rounds, for each stage."""
    levels = (trees[0].shape[1] + 1).bit_length() - 2
    feature, cut = passable(*trees[:2])
    value = handed_down(trees[0], trees[2], levels)
    flat, row = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    out = {}
    margin, done = np.zeros(len(bins)), 0
    for stage in sorted(set(stages)):
        for k in range(done, stage):
            margin = margin + value[k].take(descend(feature[k], cut[k], flat, row, levels))
        done = stage
        out[stage] = margin
    return [out[s] for s in stages]


def held_out(blocks: DataFrame, fits: list[Fit], stages: list[list[tuple[int, int]]]) -> DataFrame:
    """(point, fold, label, score): every row scored by the fits that haven't seen its fold.

    ``stages`` gives for each fit its (point, rounds) pairs.
    """
    own = [(f.without, [np.stack(x) for x in list(zip(*f.trees))[:3]], s) for f, s in zip(fits, stages) if f.without is not None]
    shared = blocks.sparkSession.sparkContext.broadcast(own)

    def task(batches):
        for batch in batches:
            for r in batch.to_pylist():
                n = len(r["label"]) // 4
                _, bins, label, fold = _open((r["block"], r["bins"], r["label"], r["fold"]), len(r["bins"]) // n)
                for without, trees, points in shared.value:
                    on = fold == without
                    for (point, _), odds in zip(points, staged(trees, bins[on], [k for _, k in points])):
                        score = 1 / (1 + np.exp(-odds))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(score), point, np.int32)), pa.array(fold[on]),
                             pa.array(label[on].astype(np.float64)), pa.array(score)], ["point", "fold", "label", "score"])

    return cut_lineage(blocks.mapInArrow(task, "point int, fold int, label double, score double"))


class BoostedModel(Model, HasFeaturesCol, HasPredictionCol):
    """Trees (arrays of all rounds) with ``transform`` like Spark's classifiers."""

    def __init__(self, cuts=(), trees=()):
        super().__init__()
        self.cuts, self.trees = list(cuts), list(trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Mean gain of the splits on each feature, as shares."""
        feature, gain = self.trees[0], self.trees[3]
        mean = np.array([gain[feature == f].mean() if (feature == f).any() else 0.0 for f in range(len(self.cuts))])
        return DenseVector(mean / mean.sum() if mean.sum() else mean)

    def _transform(self, df: DataFrame) -> DataFrame:
        cuts, trees, rounds = self.cuts, self.trees[:3], len(self.trees[0])

        @F.pandas_udf("double")
        def log_odds(x):
            import pandas as pd
            if not len(x):
                return pd.Series([], dtype="float64")
            return pd.Series(staged(trees, binned(np.stack(x.to_numpy()), cuts), [rounds])[0])

        odds, p = F.col("_odds"), 1 / (1 + F.exp(-F.col("_odds")))
        out = df.withColumn("_odds", log_odds(vector_to_array(F.col(self.getFeaturesCol()))))
        return out.withColumns({"rawPrediction": array_to_vector(F.array(-odds, odds)),
                                "probability": array_to_vector(F.array(1 - p, p)),
                                self.getPredictionCol(): (odds > 0).cast("double")}).drop("_odds")


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """One fit with the parameters of a grid point."""

    maxIter = Param(Params._dummy(), "maxIter", "rounds", typeConverter=TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", typeConverter=TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", typeConverter=TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows a round sees",
                            typeConverter=TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the row samples", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=100, maxDepth=3,
                 stepSize=0.1, subsamplingRate=1.0, seed=42):
        super().__init__()
        self._setDefault(maxIter=100, maxDepth=3, stepSize=0.1, subsamplingRate=1.0, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> BoostedModel:
        value = self.getOrDefault
        fit = Fit(value(self.maxDepth), value(self.stepSize), value(self.subsamplingRate))
        cuts, _ = fit_many(df, [fit], value(self.maxIter), self.getFeaturesCol(), self.getLabelCol(), seed=value(self.seed))
        return fit.model(cuts)._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
