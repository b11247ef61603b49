"""Cross-validated scores of every grid point, with no more fits than the grid needs.

``held_out_scores`` gives one long table (point, fold, label, score): each row
of the training table is scored once per point, by the model that has not
seen its fold. All AUCs then come from one pass over that table
(``metrics.rank_metrics``).

* **Boosted trees.** Round k of a boosting run does not depend on later rounds,
  so the points that differ only in ``n_estimators`` share one fit of the largest
  number, scored after each of them; and all fits grow in one run (``boosting``),
  which also gives the models on all rows.
* **Decision tree.** A split depends only on the rows of its node, so the points
  that differ only in ``max_depth`` share the deepest tree; its truncations are
  scored. Spark merges sibling leaves that predict the same class, bottom up,
  after growing; ``truncated`` does the same to a truncation, which gives what a
  separate fit to that depth gives.
* **Naive Bayes.** Count, mean and sum of squared deviations per (fold, class) come from one
  aggregate; those of a training set are the merge of the other folds'. All
  smoothings are scored in one pass.
* **Forests.** ``forest_search`` grows one forest a fold from counts of equal binned rows (``forest``): fewer
  trees are its first ones, less depth cuts them. Points whose ``max_features`` rules draw the same number of
  features (``sqrt`` and ``log2`` of 4 are both 2) share it.
* The other families (and forests on rows with too many distinct bins for that) are fitted per point and
  fold, in parallel threads.

Folds and grid points are few; rows never reach the driver.
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.operators import boosting as BO
from panelkit.operators import forest as FO
from panelkit.operators import metrics as MT
from panelkit.operators import models as MD
from panelkit.session import checkpoint_dir, cut_lineage

#: The grid axis whose smaller values are stages of the fit with the largest one.
STAGED = {"gbt": "n_estimators", "dt": "max_depth"}


def drawn(rule, n_features: int):
    """How many features a split of a forest draws under ``sqrt`` or ``log2``, counted as Spark does; other rules as they are."""
    if rule == "sqrt":
        return math.ceil(math.sqrt(n_features))
    if rule == "log2":
        return max(1, math.ceil(math.log(n_features) / math.log(2)))
    return rule


def units(kind: str, points: list[dict], n_features: int | None = None) -> list[list[int]]:
    """Point numbers by fit: points that share one fit, else each on its own. Forests whose rules draw
    the same number of ``n_features`` features are the same fit."""
    axis, by = STAGED.get(kind), {}
    alike = axis or (kind == "rf" and n_features)
    for i, p in enumerate(points):
        rest = tuple((k, drawn(v, n_features) if k == "max_features" and n_features else v)
                     for k, v in p.items() if k != axis)
        by.setdefault(rest if alike else i, []).append(i)
    return list(by.values())


def _stage(kind: str, point: dict) -> int:
    v = point[STAGED[kind]]
    return MD.MAX_DEPTH if v is None else v


def held_out_scores(kind: str, data: DataFrame, points: list[dict], fold_col: str = "fold", features: str = "features",
                    label: str = "label", weight: str | None = None, seed: int = 42, parallelism: int = 8) -> DataFrame:
    """(point, fold, label, score) of every row of ``data`` and grid point."""
    sizes = {r[0]: r[1] for r in data.groupBy(fold_col).count().collect()}
    n = sum(sizes.values())
    if kind == "nb":
        return _nb_scores(data, points, fold_col, features, label)
    if kind == "gbt":
        return boosted_search(data, points, fold_col, features, label, seed, list(sizes))[0]
    jobs = [(unit, fold) for unit in units(kind, points, width(data, features)) for fold in sizes]

    def fit_and_score(job) -> DataFrame:
        unit, fold = job
        # what a model is fitted on decides its regularisation: the rows of the other folds
        est, param_map = MD.estimator(kind, n - sizes[fold], features, label, weight, seed)
        inside = F.col(fold_col).eqNullSafe(F.lit(fold))
        top = points[max(unit, key=lambda i: _stage(kind, points[i]) if kind in STAGED else 0)]
        model = est.fit(data.where(~inside), param_map(top))
        rows = data.where(inside)
        if kind in STAGED:
            scored = tree_scores(model, rows, [_stage(kind, points[i]) for i in unit])
        else:
            scored = MD.score_column(model.transform(rows), kind).withColumn("scores", F.array(*["score"] * len(unit)))
        pairs = F.explode(F.arrays_zip(F.array(*[F.lit(i) for i in unit]).alias("point"), F.col("scores").alias("score")))
        out = scored.select(F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("double").alias("label"),
                            pairs.alias("p")).select("p.point", "fold", "label", "p.score")
        return cut_lineage(out)

    session = data.sparkSession
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        parts = pool.map(inheritable_thread_target(session)(fit_and_score), jobs, chunksize=1)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def point_scores(long: DataFrame, n_points: int) -> list[tuple[float, float]]:
    """(mean, standard deviation) over the folds of each point's ROC-AUC; a fold with one class has none."""
    auc: dict = {}
    for r in MT.rank_metrics(long, ["point", "fold"]).collect():  # a row per point and fold
        if r.roc_auc is not None:
            auc.setdefault(r.point, []).append(r.roc_auc)
    out = []
    for i in range(n_points):
        a = auc.get(i, [0.0])
        mean = sum(a) / len(a)
        out.append((mean, math.sqrt(sum((v - mean) ** 2 for v in a) / len(a))))
    return out


def boosted_search(data: DataFrame, points: list[dict], fold_col: str, features: str, label: str, seed: int,
                   folds: list | None = None):
    """(held-out scores of all points, function giving the model of a point on all rows), from one boosting run."""
    if folds is None:
        folds = [r[0] for r in data.select(fold_col).distinct().collect()]  # a row per fold
    fits, stages, whole = [], [], {}
    for unit in units("gbt", points):
        p = points[unit[0]]
        for fold in [*folds, None]:
            fits.append(BO.Fit(p["max_depth"], p["learning_rate"], p["subsample"], fold))
            stages.append([(i, points[i]["n_estimators"]) for i in unit])
        whole |= {i: fits[-1] for i in unit}
    cuts, blocks = BO.fit_many(data, fits, max(p["n_estimators"] for p in points), features, label, fold_col, seed)
    long = BO.held_out(blocks, fits, stages)
    return long, lambda i: whole[i].model(cuts, points[i]["n_estimators"])


def forest_search(data: DataFrame, points: list[dict], fold_col: str, features: str, label: str, weight: str | None, seed: int):
    """(held-out scores of all points, function giving the forest of a point on all rows) from counts of equal binned
    rows; None where these don't stand for the rows (``forest.cells``) or a rule names no number of features."""
    wide = width(data, features)
    drawing = [wide if p["max_features"] == "all" else drawn(p["max_features"], wide) for p in points]
    if not all(isinstance(k, int) for k in drawing):
        return None
    cells = FO.cells(data, features, label, weight, fold_col, wide)
    if cells is None:
        return None
    depth = [p["max_depth"] or MD.MAX_DEPTH for p in points]
    by: dict = {}
    for i, p in enumerate(points):
        by.setdefault(min(drawing[i], wide), []).append((i, p["n_estimators"], depth[i]))
    long = FO.held_out(data, cells, list(by.items()), seed)
    return long, lambda i: FO.fit(data, cells, min(drawing[i], wide), points[i]["n_estimators"], depth[i], seed, features)


def tree_scores(model, rows: DataFrame, depths: list[int]) -> DataFrame:
    """``rows`` with an array ``scores``: the score of class 1 of a decision tree cut at each depth."""
    table = truncated(tree_nodes(model), depths)
    lookup = rows.sparkSession.createDataFrame(
        [(leaf, [t[leaf] for t in table]) for leaf in range(len(table[0]))], "_leaf long, scores array<double>")
    at = model.copy().setLeafCol("_at").transform(rows)
    # a row per leaf of the model, which the driver holds anyway
    return at.withColumn("_leaf", F.col("_at").cast("long")).join(F.broadcast(lookup), "_leaf").drop("_leaf", "_at")


def tree_nodes(model) -> dict[int, tuple]:
    """{id: (prediction, class weights, left child, right child)} of a decision tree; leaves have children -1."""
    spark = SparkSession.builder.getOrCreate()
    path = f"{checkpoint_dir(spark).rstrip('/')}/panelkit-tree-{model.uid}"
    model.write().overwrite().save(path)
    return {r.id: (r.prediction, r.impurityStats, r.leftChild, r.rightChild)
            for r in spark.read.parquet(f"{path}/data").collect()}


def truncated(nodes: dict[int, tuple], depths: list[int]) -> list[list[float]]:
    """For each depth, by leaf of the whole tree (in pre-order): the score of class 1 in the tree cut at that depth.

    A node at the depth becomes a leaf; then sibling leaves that predict the same
    class merge into their parent, bottom up.
    """
    order, todo = [], [0]
    level = {0: 0}
    while todo:  # pre-order
        i = todo.pop()
        order.append(i)
        _, _, left, right = nodes[i]
        if left >= 0:
            level[left] = level[right] = level[i] + 1
            todo += [right, left]
    out = []
    for depth in depths:
        leaf = {}
        for i in reversed(order):
            prediction, _, left, right = nodes[i]
            if left < 0 or level[i] >= depth:
                leaf[i] = prediction
            elif left in leaf and right in leaf and leaf[left] == leaf[right]:
                leaf[i] = prediction
        scores, cover = [], {}
        for i in order:
            _, stats, left, right = nodes[i]
            own = cover.get(i)
            if own is None and i in leaf:
                own = stats[1] / sum(stats) if sum(stats) else 0.0
            if left < 0:
                scores.append(own)
            elif own is not None:
                cover[left] = cover[right] = own
        out.append(scores)
    return out


# --- naive Bayes from additive statistics ---------------------------------------------------

def fold_moments(data: DataFrame, fold_col: str, features: str, label: str, n_features: int) -> dict:
    """{(fold, label): (n, means, sums of squared deviations)} from one aggregate."""
    x = vector_to_array(F.col(features))
    flat = data.select(F.col(fold_col).alias("fold"), F.col(label).cast("double").alias("label"),
                       *[x[i].alias(f"f{i}") for i in range(n_features)])
    per = flat.groupBy("fold", "label").agg(
        F.count("*").alias("n"), F.array(*[F.avg(f"f{i}") for i in range(n_features)]).alias("mean"),
        F.array(*[F.var_pop(f"f{i}") for i in range(n_features)]).alias("var"))
    return {(r.fold, r.label): (r.n, list(r["mean"]), [v * r.n for v in r["var"]]) for r in per.collect()}


def merge_moments(parts: list[tuple]) -> tuple:
    """The moments of disjoint sets together (sums of squares about the joint mean)."""
    n = sum(p[0] for p in parts)
    width = len(parts[0][1])
    mean = [sum(p[0] * p[1][i] for p in parts) / n for i in range(width)]
    square = [sum(p[2][i] + p[0] * (p[1][i] - mean[i]) ** 2 for p in parts) for i in range(width)]
    return n, mean, square


def nb_params(moments: dict, without=None) -> tuple[dict, float]:
    """({label: (prior, means, variances)}, largest variance of a feature) of the rows outside a fold."""
    by_label: dict = {}
    for (fold, lab), m in moments.items():
        if without is None or fold != without:
            by_label.setdefault(lab, []).append(m)
    merged = {lab: merge_moments(parts) for lab, parts in by_label.items()}
    n, _, square = merge_moments(list(merged.values()))
    out = {lab: (m[0] / n, m[1], [s / m[0] for s in m[2]]) for lab, m in merged.items()}
    return out, max([s / n for s in square] + [0.0])


def _nb_scores(data, points, fold_col, features, label) -> DataFrame:
    wide = width(data, features)
    moments = fold_moments(data, fold_col, features, label, wide)
    folds = sorted({fold for fold, _ in moments})
    fitted = [nb_params(moments, fold) for fold in folds]
    rows = data.select(F.col(fold_col).cast("int").alias("fold"), F.col(label).cast("double").alias("label"),
                       vector_to_array(F.col(features)).alias("x"),
                       F.array_position(F.array(*[F.lit(f) for f in folds]), F.col(fold_col)).cast("int").alias("at"))

    def of_fold(value) -> Column:
        """A number for each fold, taken for the row's fold."""
        return F.element_at(F.array(*[F.lit(float(value(*f))) for f in fitted]), F.col("at"))

    def score(point) -> Column:
        """The log odds of class 1 (the chance itself rounds to 0 or 1 far out) under the parameters of the row's fold."""
        def var(params, most, lab, i):
            v = params[lab][2][i] + point["var_smoothing"] * most
            return v if v > 0 else 1e-300

        def base(params, most):
            if set(params) != {0.0, 1.0}:
                return math.inf if 1.0 in params else -math.inf
            return sum(sign * (math.log(params[lab][0]) - sum(0.5 * math.log(2 * math.pi * var(params, most, lab, i))
                                                             for i in range(wide))) for lab, sign in ((1.0, 1), (0.0, -1)))

        out = of_fold(base)
        for i in range(wide):
            for lab, sign in ((1.0, -1), (0.0, 1)):
                apart = F.col("x")[i] - of_fold(lambda p, m, lab=lab, i=i: p[lab][1][i] if lab in p else 0.0)
                out = out + apart * apart * of_fold(
                    lambda p, m, lab=lab, i=i, sign=sign: sign / (2 * var(p, m, lab, i)) if lab in p else 0.0)
        return out

    scores = F.array(*[score(p) for p in points]).alias("score")
    pairs = F.explode(F.arrays_zip(F.array(*[F.lit(i) for i in range(len(points))]).alias("point"), scores))
    return cut_lineage(rows.select("fold", "label", pairs.alias("p")).select("p.point", "fold", "label", "p.score"))


def width(data: DataFrame, features: str) -> int:
    meta = data.schema[features].metadata.get("ml_attr", {})
    return meta.get("num_attrs") or len(data.select(features).first()[0])
