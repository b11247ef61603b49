"""Binary classifiers with Spark ML, grid search over stratified folds.

Six model families: logistic regression (L1 / L2), decision tree, random
forest, gradient-boosted trees, linear SVM (with a Platt-scaled
probability) and Gaussian naive Bayes. Class-balanced weights go to LR, DT,
RF and SVM. Naive Bayes is written with DataFrame aggregates only (per-class
mean / population variance), so its fit is one grouped aggregate and it is
checkable in SQL. Boosted trees are ``panelkit.operators.boosting``;
searches are ``panelkit.operators.tuning``.

Scoring always uses ROC-AUC computed exactly (``numBins=0``), not Spark's
default 1000-bin down-sampled curve.
"""

from __future__ import annotations

import math
import warnings

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.constants import NB_STD_EPS, SEED
from panelkit.operators.boosting import BoostedTrees
from panelkit.operators.stats import class_weights

# Grids as in the reference search (solver axis, min_samples_split and the
# RBF kernel have no Spark counterpart and are left out).
FULL_GRIDS = {
    "lr": {"C": [0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"]},
    "dt": {"max_depth": [5, 10, 15, 20, None], "min_samples_leaf": [1, 2, 4]},
    "rf": {"n_estimators": [100, 200], "max_depth": [15, 20, None], "max_features": ["sqrt", "log2"]},
    "gbt": {"n_estimators": [50, 100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.3],
            "subsample": [0.8, 1.0]},
    "svc": {"C": [0.1, 1.0, 10.0]},
    "nb": {"var_smoothing": [1e-9, 1e-8, 1e-7, 1e-6, 1e-5]},
}
# A small grid to pass instead (the full search is 99 points x 5 folds).
SMALL_GRIDS = {
    "lr": {"C": [0.1, 1.0], "penalty": ["l2"]},
    "dt": {"max_depth": [5], "min_samples_leaf": [1, 4]},
    "rf": {"n_estimators": [20], "max_depth": [5], "max_features": ["sqrt"]},
    "gbt": {"n_estimators": [20], "max_depth": [3], "learning_rate": [0.1], "subsample": [1.0]},
    "svc": {"C": [1.0]},
    "nb": {"var_smoothing": [1e-9]},
}
WEIGHTED = {"lr", "dt", "rf", "svc"}
MODEL_NAMES = {"lr": "Logistic Regression", "dt": "Decision Tree", "rf": "Random Forest",
               "gbt": "Gradient Boosting", "svc": "SVM", "nb": "Naive Bayes"}
MAX_DEPTH = 30  # Spark's limit stands in for "unbounded"
# Solver tolerance: the reference's solvers stop at 1e-4 (logistic
# regression) and 1e-3 (SVM); Spark's 1e-6 default only adds iterations,
# each of which is a distributed job.
SOLVER_TOL = 1e-4
PARTITION_BYTES = 64 << 20


# --- Gaussian naive Bayes as DataFrame aggregates ------------------------------------

def gnb_fit(df: DataFrame, label: str, cols, var_smoothing: float = 1e-9) -> DataFrame:
    """(label, feature, prior, mean, var): per-class mean and population
    variance plus ``var_smoothing * max feature variance``. One grouped
    aggregate for the classes, one global aggregate for the smoothing."""
    cols = list(cols)
    y = F.col(label).cast("double")
    # one pass over the data: per-class count, mean, population variance;
    # the overall variance of each feature (for the smoothing term) follows
    # from these per-class moments, over a table of one row per class
    per = df.groupBy(y.alias("label")).agg(
        F.count("*").alias("_nc"),
        *[F.avg(F.col(c).cast("double")).alias(f"_m{i}") for i, c in enumerate(cols)],
        *[F.var_pop(F.col(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(cols)])
    w = Window.partitionBy()  # over the class table only
    n = F.sum("_nc").over(w)
    per = per.withColumns({f"_g{i}": F.sum(F.col("_nc") * F.col(f"_m{i}")).over(w) / n for i in range(len(cols))})
    tot_var = []
    for i in range(len(cols)):
        apart = F.col(f"_m{i}") - F.col(f"_g{i}")  # no difference of large squares
        tot_var.append(F.sum(F.col("_nc") * (F.col(f"_v{i}") + apart * apart)).over(w) / n)
    mx = F.greatest(*tot_var, F.lit(0.0))
    structs = [F.struct(F.lit(c).alias("feature"), F.col(f"_m{i}").alias("mean"), F.col(f"_v{i}").alias("var0"))
               for i, c in enumerate(cols)]
    j = per.select("label", (F.col("_nc") / n).alias("prior"), F.array(*structs).alias("_s"),
                   (F.lit(var_smoothing) * mx).alias("_eps"))
    return j.select("label", F.explode("_s").alias("s"), "prior", "_eps").select(
        "label", F.col("s.feature").alias("feature"), "prior", F.col("s.mean").alias("mean"),
        (F.col("s.var0") + F.col("_eps")).alias("var"))


def gnb_params(fit: DataFrame) -> dict:
    """Small parameter table -> {label: (prior, {feature: (mean, var)})}."""
    out = {}
    for r in fit.collect():
        out.setdefault(r["label"], [r["prior"], {}])[1][r["feature"]] = (r["mean"], r["var"])
    return out


def gnb_scores(df: DataFrame, params: dict, value=lambda f: F.col(f)):
    """(jll_0, jll_1) column expressions for a binary model."""
    jll = {}
    for lab, (prior, feats) in params.items():
        e = F.lit(math.log(prior))
        for f, (m, v) in feats.items():
            v = v if v and v > 0 else 1e-300
            e = e - F.lit(0.5 * math.log(2 * math.pi * v)) - (value(f) - F.lit(m)) ** 2 / F.lit(2 * v)
        jll[lab] = e
    return jll


def gnb_predict(df: DataFrame, params: dict, value=lambda f: F.col(f)) -> DataFrame:
    """Adds prediction (argmax class) and score P(class 1)."""
    jll = gnb_scores(df, params, value)
    j0, j1 = jll.get(0.0), jll.get(1.0)
    if j0 is None or j1 is None:
        only = 1.0 if j1 is not None else 0.0
        return df.withColumn("score", F.lit(only)).withColumn("prediction", F.lit(only))
    d = j0 - j1
    score = F.when(d > 700, F.lit(0.0)).otherwise(1.0 / (1.0 + F.exp(d)))
    return df.withColumn("raw", j1 - j0).withColumn("score", score).withColumn(
        "prediction", (F.col("raw") > 0).cast("double"))


def gnb_importance(fit: DataFrame) -> DataFrame:
    """|mean_1 - mean_0| / (std_1 + std_0), zero denominators -> 1e-10; with
    one class, 1 / (std + 1e-10)."""
    p = fit.groupBy("feature").agg(
        F.max(F.when(F.col("label") == 0, F.col("mean"))).alias("m0"),
        F.max(F.when(F.col("label") == 1, F.col("mean"))).alias("m1"),
        F.max(F.when(F.col("label") == 0, F.sqrt("var"))).alias("s0"),
        F.max(F.when(F.col("label") == 1, F.sqrt("var"))).alias("s1"))
    den = F.col("s1") + F.col("s0")
    den = F.when(den == 0, F.lit(NB_STD_EPS)).otherwise(den)
    two = F.abs(F.col("m1") - F.col("m0")) / den
    one = 1.0 / (F.coalesce(F.col("s0"), F.col("s1")) + F.lit(NB_STD_EPS))
    return p.select("feature", F.when(F.col("m0").isNotNull() & F.col("m1").isNotNull(), two)
                    .otherwise(one).alias("importance"))


class GaussianNBModel(Model, HasFeaturesCol, HasPredictionCol):
    def __init__(self, params=None, n_features=0, fit_table=None):
        super().__init__()
        self.gnb = params or {}
        self.n_features = n_features
        self.fit_table = fit_table

    def _transform(self, df):
        arr = vector_to_array(F.col(self.getFeaturesCol()))
        out = gnb_predict(df, self.gnb, value=lambda f: arr[int(f[1:])])
        out = out.withColumn("rawPrediction", F.col("raw") if "raw" in out.columns else F.lit(0.0))
        out = out.withColumn("probability", array_to_vector(F.array(1.0 - F.col("score"), F.col("score"))))
        return out.drop("raw")


class GaussianNB(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    varSmoothing = Param(Params._dummy(), "varSmoothing", "variance smoothing",
                         typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction",
                 varSmoothing=1e-9):
        super().__init__()
        self._setDefault(varSmoothing=1e-9)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        meta = df.schema[self.getFeaturesCol()].metadata.get("ml_attr", {})
        n = meta.get("num_attrs") or len(df.select(self.getFeaturesCol()).first()[0])
        arr = vector_to_array(F.col(self.getFeaturesCol()))
        cols = [f"f{i}" for i in range(n)]
        flat = df.select(F.col(self.getLabelCol()).alias("label"), *[arr[i].alias(c) for i, c in enumerate(cols)])
        fit = gnb_fit(flat, "label", cols, self.getOrDefault(self.varSmoothing))
        m = GaussianNBModel(gnb_params(fit), n, fit)
        m._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return m


# --- estimators and grids ----------------------------------------------------------------

def with_class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Balanced weights joined back per class (a table of one row per class)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(F.broadcast(w), label, "left")


def estimator(kind: str, n_train: int, features: str = "features", label: str = "label",
              weight: str | None = "weight", seed: int = SEED, max_iter: int = 1000):
    """(estimator, function mapping a grid point to a ParamMap)."""
    wc = {"weightCol": weight} if (weight and kind in WEIGHTED) else {}
    if kind == "lr":
        est = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, tol=SOLVER_TOL,
                                 standardization=False, **wc)

        def pm(p):
            return {est.regParam: 1.0 / (p["C"] * max(n_train, 1)),
                    est.elasticNetParam: 1.0 if p["penalty"] == "l1" else 0.0}
    elif kind == "dt":
        est = DecisionTreeClassifier(featuresCol=features, labelCol=label, seed=seed, **wc)

        def pm(p):
            return {est.maxDepth: p["max_depth"] or MAX_DEPTH, est.minInstancesPerNode: p["min_samples_leaf"]}
    elif kind == "rf":
        est = RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed, **wc)

        def pm(p):
            return {est.numTrees: p["n_estimators"], est.maxDepth: p["max_depth"] or MAX_DEPTH,
                    est.featureSubsetStrategy: p["max_features"]}
    elif kind == "gbt":
        est = BoostedTrees(featuresCol=features, labelCol=label, seed=seed)

        def pm(p):
            return {est.maxIter: p["n_estimators"], est.maxDepth: p["max_depth"],
                    est.stepSize: p["learning_rate"], est.subsamplingRate: p["subsample"]}
    elif kind == "svc":
        est = LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter, tol=SOLVER_TOL, **wc)

        def pm(p):
            return {est.regParam: 1.0 / (p["C"] * max(n_train, 1))}
    elif kind == "nb":
        est = GaussianNB(featuresCol=features, labelCol=label)

        def pm(p):
            return {est.varSmoothing: p["var_smoothing"]}
    else:
        raise ValueError(f"unknown model kind {kind}")
    return est, pm


def grid_points(grid: dict) -> list:
    pts = [{}]
    for k, vals in grid.items():
        pts = [{**p, k: v} for p in pts for v in vals]
    return pts


def score_column(pred: DataFrame, kind: str) -> DataFrame:
    """Positive-class score: probability[1], or for SVM the margin."""
    if "probability" in pred.columns and kind != "svc":
        return pred.withColumn("score", vector_to_array("probability")[1])
    return pred.withColumn("score", vector_to_array("rawPrediction")[1])


class PlattSVC:
    """Linear SVM + one-feature logistic regression on its margin."""

    def __init__(self, svm_model, calib):
        self.svm, self.calib = svm_model, calib

    def transform(self, df):
        s = self.svm.transform(df).withColumn("_margin", vector_to_array("rawPrediction")[1])
        s = VectorAssembler(inputCols=["_margin"], outputCol="_mf").transform(s)
        c = self.calib.transform(s.drop("rawPrediction", "probability").withColumnRenamed("prediction", "_svm_pred"))
        return c.withColumn("prediction", F.col("_svm_pred")).drop("_margin", "_mf", "_svm_pred")


def calibrate_svc(model, margins: DataFrame):
    """The sigmoid over the margin, fitted on (label, score) rows whose margins
    come from models that have not seen them: the margins of a model's own training rows
    lie too far out and would make the probability overconfident."""
    s = VectorAssembler(inputCols=["score"], outputCol="_mf").transform(margins.select("label", "score"))
    lr = LogisticRegression(featuresCol="_mf", labelCol="label", maxIter=100).fit(s.select("_mf", "label"))
    return PlattSVC(model, lr)


def search_input(data: DataFrame, n_rows: int, n_features: int) -> DataFrame:
    """The training rows in as few partitions as their bytes need: every
    optimizer iteration and every tree level is a job over all of them."""
    need = max(1, math.ceil(n_rows * (n_features + 4) * 8 / PARTITION_BYTES))
    return data.coalesce(need)  # never more than there are


def grid_search(kind: str, train: DataFrame, grid: dict | None = None, fold_col: str = "fold",
                features: str = "features", label: str = "label", parallelism: int = 8,
                seed: int = SEED, k: int = 5):
    """Stratified k-fold grid search scored by exact ROC-AUC; refits the best
    point on all training rows. Returns (model, best params, scores DataFrame).

    ``tuning.held_out_scores`` makes the folds' scores (staged fits for the tree
    families, additive statistics for naive Bayes). The SVM's probability is
    fitted on the best point's held-out margins."""
    from panelkit.operators import tuning

    points = grid_points(grid or FULL_GRIDS[kind])
    weight = "weight" if kind in WEIGHTED else None
    data = with_class_weights(train, label) if weight else train
    n_train = train.count()
    data = search_input(data, n_train, tuning.width(train, features)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = None
        if kind == "gbt":
            found = tuning.boosted_search(data, points, fold_col, features, label, seed)
        elif kind == "rf":
            found = tuning.forest_search(data, points, fold_col, features, label, weight, seed)
        if found is not None:
            long, model_of = found
        else:
            long = tuning.held_out_scores(kind, data, points, fold_col, features, label, weight, seed, parallelism)
            est, param_map = estimator(kind, n_train, features, label, weight, seed)
            model_of = lambda i: est.fit(data, param_map(points[i]))
        scores = tuning.point_scores(long, len(points))
        best_i = max(range(len(points)), key=lambda i: (scores[i][0], -i))
        model = model_of(best_i)
        if kind == "svc":
            model = calibrate_svc(model, long.where(F.col("point") == best_i))
    finally:
        data.unpersist()
    sdf = train.sparkSession.createDataFrame(
        [(MODEL_NAMES[kind], str(p), *scores[i]) for i, p in enumerate(points)],
        "model string, params string, mean_auc double, std_auc double")
    return model, points[best_i], sdf


def predict(model, df: DataFrame, kind: str, keep=("row_id",), label: str = "label") -> DataFrame:
    """(keep..., label, score, prediction)."""
    p = score_column(model.transform(df), kind)
    return p.select(*keep, F.col(label).cast("double").alias("label"), "score",
                    F.col("prediction").cast("double").alias("prediction"))


def train_all(train: DataFrame, kinds=("lr", "dt", "rf", "gbt", "svc", "nb"), grids: dict | None = None,
              fold_col: str = "fold", parallelism: int = 8, k: int = 5) -> dict:
    """Fit every model; a failing model is skipped with a warning."""
    out = {}
    for kind in kinds:
        try:
            out[kind] = grid_search(kind, train, (grids or FULL_GRIDS).get(kind), fold_col,
                                    parallelism=parallelism, k=k)
        except Exception as e:  # noqa: BLE001 - isolate one model's failure
            warnings.warn(f"{MODEL_NAMES[kind]} was not trained: {e}", RuntimeWarning, stacklevel=2)
    return out


def cv_score(kind: str, train: DataFrame, fold_col: str = "fold", k: int = 5, features: str = "features",
             label: str = "label", seed: int = SEED) -> DataFrame | None:
    """Default-parameter model scored by k-fold CV: mean ROC-AUC and the
    mean +- 2 std band; only run when there are more than 2k rows."""
    from panelkit.operators import tuning

    n = train.count()
    if n <= 2 * k:
        return None
    defaults = {"lr": {"C": 1.0, "penalty": "l2"}, "dt": {"max_depth": None, "min_samples_leaf": 1},
                "rf": {"n_estimators": 100, "max_depth": None, "max_features": "sqrt"},
                "gbt": {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0},
                "svc": {"C": 1.0}, "nb": {"var_smoothing": 1e-9}}
    weight = "weight" if kind in WEIGHTED else None
    data = with_class_weights(train, label) if weight else train
    data = search_input(data, n, tuning.width(train, features))
    long = tuning.held_out_scores(kind, data, [defaults[kind]], fold_col, features, label, weight, seed)
    mean, std = tuning.point_scores(long, 1)[0]
    return train.sparkSession.createDataFrame(
        [(MODEL_NAMES[kind], mean, std, mean - 2 * std, mean + 2 * std)],
        "model string, mean_auc double, std_auc double, low double, high double")
