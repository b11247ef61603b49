"""End-to-end run: harmonise -> clean -> impute -> quality report -> encode ->
EDA tables -> feature selection -> split / scale / folds -> train ->
evaluate -> explain.

Everything up to the split is one lazy plan cut twice: after harmonise +
clean (the statistics passes re-read it) and after the model-input assembly
(every CV fit re-reads it). Both cuts are reliable checkpoints in the shared
checkpoint folder, so an executor loss recomputes from the cut, not from the
CSV scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import columns as C
from panelkit.functions import scalars as S
from panelkit.functions.constants import TARGET_CANDIDATES
from panelkit.operators import clean as CL
from panelkit.operators import explain as EX
from panelkit.operators import features as FE
from panelkit.operators import impute as IM
from panelkit.operators import joins as J
from panelkit.operators import metrics as M
from panelkit.operators import models as MD
from panelkit.operators import split as SP
from panelkit.operators import stats as ST
from panelkit.operators.prepared import Preparation
from panelkit.session import cut_lineage


def prepare(votes: DataFrame, indicators: DataFrame | None = None, spending: DataFrame | None = None,
            order_by=None, filter_issues: bool = True, outlier_strictness: str = "moderate",
            target: str = "ms_vote", topic_patterns=None, indicator_mapping: dict | None = None,
            learn: bool = True) -> DataFrame:
    """Harmonise, clean, impute, encode. ``order_by`` gives the row order
    for the fill semantics (default: the first column). Without ``learn`` only the
    row-wise steps run: no column, outlier or missing value is judged by the other rows."""
    h = J.harmonize(votes, indicators, spending, filter_issues=filter_issues, topic_patterns=topic_patterns,
                    indicator_mapping=indicator_mapping)
    tcol = target if target in h.columns else C.resolve_ci(h.columns, TARGET_CANDIDATES)
    if tcol is None:
        raise ValueError("no target column")
    # the cleaning statistics passes (types, constants, outliers) all re-read
    # this: cut here so they start from the checkpoint, not from the scans
    h = cut_lineage(h)
    cleaned = cut_lineage(CL.comprehensive_clean(h, outlier_strictness=outlier_strictness, remove_outliers_=learn,
                                                 remove_constants=learn))
    if tcol not in cleaned.columns:
        raise ValueError(f"cleaning dropped the target {tcol}: it is constant or mostly missing")
    order = order_by or [c for c in cleaned.columns if c != tcol][:1]
    # encoded last: rows without a target are dropped by the cleaning, and rows
    # that differ only in the target are no duplicates
    done = IM.impute(cleaned, order_by=order) if learn else cleaned
    done = done.withColumn("vote", S.encode_target(F.col(f"`{tcol}`")))
    return done.drop(tcol) if tcol != "vote" else done


def run(votes: DataFrame, indicators: DataFrame | None = None, spending: DataFrame | None = None,
        id_cols=None, kinds=("lr", "dt", "rf", "gbt", "svc", "nb"), grids: dict | None = None,
        n_features: int = 20, test_size: float = 0.2, k: int = 5, order_by=None,
        filter_issues: bool = True, topic_patterns=None, indicator_mapping: dict | None = None,
        fit_on: str = "all") -> dict:
    """Whole pipeline; returns result tables (DataFrames) and fitted models.

    ``fit_on`` "all" cleans, imputes and selects features on all rows before the split, as the
    reference does; "train" learns all of it on the training rows (``prepared.Preparation``)."""
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on is 'all' or 'train'")
    df = prepare(votes, indicators, spending, order_by, filter_issues, topic_patterns=topic_patterns,
                 indicator_mapping=indicator_mapping, learn=fit_on == "all")
    out = {"quality": ST.quality_report(df)}
    out.update({f"eda_{k2}": v for k2, v in ST.eda_tables(df, "vote").items()})
    feats = FE.select_features(df, "vote", n=n_features) if fit_on == "all" else []
    if fit_on == "all" and not feats:
        raise ValueError("no numeric features left")
    ids = id_cols or [c for c in df.columns if c not in feats and c != "vote"]
    out["class_weights"] = ST.class_weights(df, "vote")
    flagged = cut_lineage(SP.stratified_split(df, "vote", ids, test_size, column="_is_test"))
    train = flagged.where(~F.col("_is_test")).drop("_is_test")
    test = flagged.where(F.col("_is_test")).drop("_is_test")
    if fit_on == "all":
        scaler = FE.fit_scaler(train, feats)
        train, test = FE.apply_scaler(train, scaler), FE.apply_scaler(test, scaler)
    else:
        prep = out["preparation"] = Preparation.fit(train, "vote", n_features, exclude=id_cols or ())
        feats = prep.features
        if not feats:
            raise ValueError("no numeric features left")
        train, test = prep.apply(prep.inliers(train)), prep.apply(test)
    train = SP.stratified_folds(train, "vote", ids, k)
    train = train.withColumn("row_id", F.monotonically_increasing_id())
    test = test.withColumn("row_id", F.monotonically_increasing_id())
    tr = cut_lineage(FE.assemble(train, feats, "vote", keep=("row_id", "fold")))
    te = cut_lineage(FE.assemble(test, feats, "vote", keep=("row_id",)))
    models, preds, imps, scores = {}, {}, [], []
    for kind, (model, params, sc) in MD.train_all(tr, kinds, grids, k=k).items():
        name = MD.MODEL_NAMES[kind]
        models[name] = (model, params)
        preds[name] = MD.predict(model, te, kind)
        imps.append(EX.importance_frame(df.sparkSession, model, feats, name))
        scores.append(sc)
    if not preds:
        raise RuntimeError("every model failed to train")
    out.update(M.model_tables(preds))
    out["best_model"] = M.best_model(out["comparison"])
    acc = imps[0]
    for x in imps[1:]:
        acc = acc.unionByName(x)
    out["importance"] = acc
    out["top_importance"] = EX.top_per_group(acc, "model", "importance", 15, tiebreak="feature")
    sc_all = scores[0]
    for x in scores[1:]:
        sc_all = sc_all.unionByName(x)
    out["grid_scores"] = sc_all
    if "Logistic Regression" in models:
        out["lr_coefficients"] = EX.coefficients(df.sparkSession, models["Logistic Regression"][0], feats)
    out["features"] = feats
    out["models"] = models
    return out
