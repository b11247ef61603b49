"""Model queries on documents x labels (the one table pair with real signal).

Features are text statistics Spark computes from whole documents; the label is
``labels.quality``. Train / test come from the exact stratified split, folds
from the exact stratified k-fold on the training rows, scaling is fitted on
the training rows only. Naive Bayes has SQL oracles; the Spark ML models
(iterative fits) get rows-only checks.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import explain as EX
from panelkit.operators import features as FE
from panelkit.operators import metrics as M
from panelkit.operators import models as MD
from panelkit.operators import split as SP
from panelkit.plans.queries import INDICATOR_MAP, PANEL_SQL, SPENDING_SQL, _indicator_wide, _round_doubles, _spending, share_of
from panelkit.session import cut_lineage
from panelkit.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}
FEATURES = ["letter_share", "digit_share", "space_share", "upper_share"]


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def dq_features(spark, d) -> DataFrame:
    # shares in the scan's stage: four numbers a document meet the labels, not its text
    doc = table(spark, d, "documents").select(
        "doc_id", share_of("[^a-zA-Z]").alias("letter_share"), share_of("[^0-9]").alias("digit_share"),
        share_of("[^ ]").alias("space_share"), share_of("[^A-Z]").alias("upper_share"))
    lb = table(spark, d, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return doc.join(lb, "doc_id").select("doc_id", "label", *FEATURES)


DQF_SQL = """
dqf AS (
  SELECT doc_id, CAST(quality AS DOUBLE) AS label,
         length(regexp_replace(text, '[^a-zA-Z]', '', 'g')) / n_chars AS letter_share,
         length(regexp_replace(text, '[^0-9]', '', 'g')) / n_chars AS digit_share,
         length(regexp_replace(text, '[^ ]', '', 'g')) / n_chars AS space_share,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) / n_chars AS upper_share
  FROM documents JOIN labels USING (doc_id))"""

GNB_SQL = DQF_SQL.strip() + """,
gstats AS (SELECT greatest(var_pop(letter_share), var_pop(digit_share), var_pop(space_share), var_pop(upper_share), 0.0) AS mx,
                count(*) AS n FROM dqf),
long AS (SELECT doc_id, label, 'letter_share' AS feature, letter_share AS x FROM dqf
         UNION ALL SELECT doc_id, label, 'digit_share', digit_share FROM dqf
         UNION ALL SELECT doc_id, label, 'space_share', space_share FROM dqf
         UNION ALL SELECT doc_id, label, 'upper_share', upper_share FROM dqf),
fit AS (SELECT label, feature, count(*) / max(gstats.n) AS prior, avg(x) AS mean, var_pop(x) + 1e-9 * max(gstats.mx) AS var
        FROM long, gstats GROUP BY label, feature)"""


@query("gnb_fit", f"""
WITH {GNB_SQL}
SELECT label, feature, round(prior, 6) AS prior, round(mean, 6) AS mean, round(var, 6) AS var FROM fit""")
def q_gnb_fit(spark, d):
    fit = MD.gnb_fit(dq_features(spark, d), "label", FEATURES, 1e-9)
    return fit.select("label", "feature", *[F.round(c, 6).alias(c) for c in ("prior", "mean", "var")])


@query("gnb_predict", f"""
WITH {GNB_SQL},
jll AS (SELECT l.doc_id, f.label,
               ln(max(f.prior)) - sum(0.5 * ln(2 * pi() * f.var) + (l.x - f.mean) * (l.x - f.mean) / (2 * f.var)) AS j
        FROM long l JOIN fit f ON l.feature = f.feature GROUP BY l.doc_id, f.label),
p AS (SELECT doc_id, max(CASE WHEN label = 0 THEN j END) AS j0, max(CASE WHEN label = 1 THEN j END) AS j1
      FROM jll GROUP BY doc_id)
SELECT doc_id, CAST(CASE WHEN j1 - j0 > 0 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
       round(CASE WHEN j0 - j1 > 700 THEN 0.0 ELSE 1.0 / (1.0 + exp(j0 - j1)) END, 6) AS score
FROM p""")
def q_gnb_predict(spark, d):
    # fit and predict both read the features: extract them from the texts once
    df = cut_lineage(dq_features(spark, d))
    params = MD.gnb_params(MD.gnb_fit(df, "label", FEATURES, 1e-9))
    p = MD.gnb_predict(df, params)
    return p.select("doc_id", "prediction", F.round("score", 6).alias("score"))


@query("gnb_importance", f"""
WITH {GNB_SQL},
p AS (SELECT feature, max(CASE WHEN label = 0 THEN mean END) AS m0, max(CASE WHEN label = 1 THEN mean END) AS m1,
             max(CASE WHEN label = 0 THEN sqrt(var) END) AS s0, max(CASE WHEN label = 1 THEN sqrt(var) END) AS s1
      FROM fit GROUP BY feature)
SELECT feature, round(abs(m1 - m0) / CASE WHEN s1 + s0 = 0 THEN 1e-10 ELSE s1 + s0 END, 6) AS importance FROM p""")
def q_gnb_importance(spark, d):
    fit = MD.gnb_fit(dq_features(spark, d), "label", FEATURES, 1e-9)
    return MD.gnb_importance(fit).select("feature", F.round("importance", 6).alias("importance"))


# --- Spark ML models (rows-only checks) ---------------------------------------------------

def prepared(spark, d):
    """(train, test) with scaled assembled features, folds on train."""
    # a text without characters has no shares: they are missing, and the means stay numbers;
    # written first, as the split counts its rows before it ranks them: the texts are read once
    df = cut_lineage(dq_features(spark, d).withColumns({c: S.finite(c) for c in FEATURES}))
    # one cut after the split flag: train, test and the scaler fit all read
    # it instead of each re-running the text features and the split windows
    flagged = cut_lineage(SP.stratified_split(df, "label", "doc_id", 0.2, 42, "_is_test"))
    train = flagged.where(~F.col("_is_test")).drop("_is_test")
    test = flagged.where(F.col("_is_test")).drop("_is_test")
    sc = FE.fit_scaler(train, FEATURES)
    train = FE.apply_scaler(train, sc)
    test = FE.apply_scaler(test, sc)
    train = SP.stratified_folds(train, "label", "doc_id", 5, 42)
    tr = FE.assemble(train, FEATURES, "label", keep=("doc_id", "fold"))
    te = FE.assemble(test, FEATURES, "label", keep=("doc_id",))
    # every CV fit and optimizer pass would otherwise re-run the text
    # features, the split windows and the scaler job: cut the lineage once
    return cut_lineage(tr), cut_lineage(te)


def _fit_eval(kind: str):
    def run(spark, d):
        tr, te = prepared(spark, d)
        model, params, _ = MD.grid_search(kind, tr, MD.FULL_GRIDS[kind])
        pred = MD.predict(model, te, kind, keep=("doc_id",))
        out = M.evaluate(pred, model=MD.MODEL_NAMES[kind])
        return out.select("model", *[F.round(c, 6).alias(c) for c in out.columns if c != "model"])
    run.__name__ = f"q_{kind}_metrics"
    return run


for _k in ("lr", "dt", "rf", "gbt", "svc"):
    query(f"{_k}_metrics")(_fit_eval(_k))

_SHARES = ["letter_share", "digit_share", "space_share", "upper_share"]
_Z = ", ".join(f"({c} - m{i}) / CASE WHEN s{i} IS NULL OR s{i} = 0 THEN 1 ELSE s{i} END AS f{i}"
               for i, c in enumerate(_SHARES))
_SC = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_SHARES))
_LONG = " UNION ALL ".join(f"SELECT doc_id, label, is_test, 'f{i}' AS feature, f{i} AS x FROM z"
                           for i in range(len(_SHARES)))
NB_METRICS_SQL = f"""
WITH {DQF_SQL.strip()},
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) - 1 AS rk,
             count(*) OVER (PARTITION BY label) AS nc FROM dqf),
s AS (SELECT *, rk < round(0.2 * nc) AS is_test FROM r),
sc AS (SELECT {_SC} FROM s WHERE NOT is_test),
z AS (SELECT doc_id, label, is_test, {_Z} FROM s, sc),
long AS ({_LONG}),
tr AS (SELECT * FROM long WHERE NOT is_test),
gs AS (SELECT max(v) AS mx, max(n) AS n FROM (SELECT var_pop(x) AS v, count(*) AS n FROM tr GROUP BY feature)),
fit AS (SELECT label, feature, count(*) / max(gs.n) AS prior, avg(x) AS mean, var_pop(x) + 1e-9 * greatest(max(gs.mx), 0) AS var
        FROM tr, gs GROUP BY label, feature),
jll AS (SELECT l.doc_id, f.label,
               ln(max(f.prior)) - sum(0.5 * ln(2 * pi() * f.var) + (l.x - f.mean) * (l.x - f.mean) / (2 * f.var)) AS j
        FROM long l JOIN fit f ON l.feature = f.feature WHERE l.is_test GROUP BY l.doc_id, f.label),
p AS (SELECT j.doc_id, max(z.label) AS label,
             max(CASE WHEN j.label = 0 THEN j END) AS j0, max(CASE WHEN j.label = 1 THEN j END) AS j1
      FROM jll j JOIN z ON j.doc_id = z.doc_id GROUP BY j.doc_id),
pred AS (SELECT doc_id, label, CASE WHEN j1 - j0 > 0 THEN 1.0 ELSE 0.0 END AS prediction,
                CASE WHEN j0 - j1 > 700 THEN 0.0 ELSE 1.0 / (1.0 + exp(j0 - j1)) END AS score FROM p),
c AS (SELECT sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn,
             sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn FROM pred),
st AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
       FROM pred GROUP BY score),
cum AS (SELECT score, pos, neg,
               sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
               sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM st),
rk AS (SELECT sum(neg * (cum_pos - pos / 2.0)) / (max(P) * max(N)) AS roc_auc,
              sum(CASE WHEN pos > 0 THEN (pos / P) * (cum_pos / (cum_pos + cum_neg)) END) AS pr_auc FROM cum)
SELECT 'Naive Bayes' AS model,
       round(coalesce((tp + tn) / nullif(tp + fp + tn + fn, 0), 0), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
FROM c, rk"""

# Naive Bayes is pure arithmetic, so its whole train / test evaluation has an oracle
query("nb_metrics", NB_METRICS_SQL)(_fit_eval("nb"))


@query("grid_scores")
def q_grid_scores(spark, d):
    """Cross-validated ROC-AUC (mean, std over 5 stratified folds) per grid point."""
    tr, _ = prepared(spark, d)
    _, _, scores = MD.grid_search("lr", tr, MD.FULL_GRIDS["lr"])
    return scores


@query("lr_coefficients")
def q_lr_coefficients(spark, d):
    tr, _ = prepared(spark, d)
    model, _, _ = MD.grid_search("lr", tr, MD.FULL_GRIDS["lr"])
    return EX.coefficients(spark, model, FEATURES)


@query("rf_importance")
def q_rf_importance(spark, d):
    tr, _ = prepared(spark, d)
    model, _, _ = MD.grid_search("rf", tr, MD.FULL_GRIDS["rf"])
    return EX.importance_frame(spark, model, FEATURES, MD.MODEL_NAMES["rf"])


def _side_by_side(spark, run, items: list) -> list:
    """What ``run`` gives for each item, in threads of the session; without one, one after another."""
    if spark is None:
        return [run(x) for x in items]
    with ThreadPool(len(items)) as pool:
        return pool.map(inheritable_thread_target(spark)(run), items, chunksize=1)


@query("compare_models")
def q_compare_models(spark, d):
    """Train all six models, compare on the test rows, add the winning parameters of
    each and the best-model flag. The searches run side by side: most of their
    jobs have fewer tasks than there are cores."""
    tr, te = prepared(spark, d)

    def search(kind):
        model, params, _ = MD.grid_search(kind, tr, MD.FULL_GRIDS[kind])
        return MD.predict(model, te, kind, keep=("doc_id",)), str(params)

    found = _side_by_side(spark, search, list(MD.MODEL_NAMES))
    preds = {name: pred for name, (pred, _) in zip(MD.MODEL_NAMES.values(), found)}
    won = [(name, params) for name, (_, params) in zip(MD.MODEL_NAMES.values(), found)]
    cmp = M.compare(preds)
    best = M.best_model(cmp).select(F.col("model").alias("_best"))
    params = spark.createDataFrame(won, "model string, params string")
    return cmp.join(F.broadcast(params), "model").crossJoin(best).withColumn(
        "is_best", F.col("model") == F.col("_best")).drop("_best")  # one row per model


_CURVES_SQL = f"""
WITH {DQF_SQL.strip()},
long AS ({" UNION ALL ".join(f"SELECT '{c}' AS model, label, {c} AS score, CASE WHEN {c} > 0.3 THEN 1.0 ELSE 0.0 END AS prediction FROM dqf" for c in _SHARES)}),
st AS (SELECT model, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
       FROM long GROUP BY model, score),
cum AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER (PARTITION BY model) AS P,
               sum(neg) OVER (PARTITION BY model) AS N
        FROM st WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rk AS (SELECT model, sum(neg * (cum_pos - pos / 2.0)) / (max(P) * max(N)) AS roc_auc,
              sum(CASE WHEN pos > 0 THEN (pos / P) * (cum_pos / (cum_pos + cum_neg)) END) AS pr_auc FROM cum GROUP BY model),
c AS (SELECT model, sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS tn,
             sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn FROM long GROUP BY model),
cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(label, prediction))
SELECT 'roc' AS chart, model, round(score, 6) AS a, round(cum_neg / N, 6) AS b, round(cum_pos / P, 6) AS c FROM cum
UNION ALL SELECT DISTINCT 'roc', model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM cum
UNION ALL SELECT 'pr', model, round(score, 6), round(cum_pos / (cum_pos + cum_neg), 6), round(cum_pos / P, 6)
          FROM cum WHERE cum_pos - pos < P
UNION ALL SELECT DISTINCT 'pr', model, NULL, 1.0, 0.0 FROM cum
UNION ALL SELECT 'confusion', m.model, cells.label, cells.prediction,
                 (SELECT count(*) FROM long l WHERE l.model = m.model AND l.label = cells.label AND l.prediction = cells.prediction)
          FROM (SELECT DISTINCT model FROM long) m, cells
UNION ALL SELECT 'quality', model, round((tp + tn) / (tp + fp + tn + fn), 6), round(coalesce(tp / nullif(tp + fp, 0), 0), 6),
                 round(coalesce(tp / nullif(tp + fn, 0), 0), 6) FROM c
UNION ALL SELECT 'areas', model, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6), round(roc_auc, 6), round(pr_auc, 6)
          FROM c JOIN rk USING (model)
UNION ALL SELECT 'baseline', NULL, round(avg(label), 6), NULL, NULL FROM dqf"""


@query("model_tables", _CURVES_SQL)
def q_model_tables(spark, d):
    """The chart tables of several models (E8) in one pass, as (chart, model, a, b, c).

    The models here are the four text shares as scores, cut at 0.3. quality: accuracy,
    precision, recall; areas: f1, ROC area, average precision."""
    df = cut_lineage(dq_features(spark, d))
    preds = {c: df.select("label", F.col(c).alias("score"), (F.col(c) > 0.3).cast("double").alias("prediction"))
             for c in FEATURES}
    t = M.model_tables(preds)

    def chart(name, frame, a, b, c):
        cols = [F.round(F.col(x).cast("double"), 6).alias(y) if x else F.lit(None).cast("double").alias(y)
                for x, y in ((a, "a"), (b, "b"), (c, "c"))]
        model = F.col("model") if "model" in frame.columns else F.lit(None).cast("string").alias("model")
        return frame.select(F.lit(name).alias("chart"), model, *cols)

    out = chart("roc", t["roc"], "threshold", "fpr", "tpr")
    for part in (chart("pr", t["pr"], "threshold", "precision", "recall"),
                 chart("confusion", t["confusion"], "label", "prediction", "count"),
                 chart("quality", t["comparison"], "accuracy", "precision", "recall"),
                 chart("areas", t["comparison"], "f1", "roc_auc", "pr_auc"),
                 chart("baseline", t["pr_baseline"], "prevalence", None, None)):
        out = out.unionByName(part)
    return out


# --- whole preparation pipeline on driver-derived inputs -------------------------------------

def pipeline_inputs(spark, d):
    """votes-like fact (orders x customer x nation, with vote tokens, dates,
    priorities as topics, alphabetic codes), a wide-by-year indicator table
    and a spending table, all derived from the driver tables."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
                                         "o_orderstatus", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    code = F.concat(F.lit("N"), F.expr("chr(65 + c_nationkey)"), F.lit("X"))
    votes = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
              .select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                      F.col("o_orderpriority").alias("subjects"), code.alias("ms_code"),
                      F.lower("n_name").alias("ms_name"),
                      F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N")
                       .otherwise("A").alias("ms_vote"),
                      F.col("o_totalprice").alias("amount"), F.col("c_acctbal").alias("balance")))
    wdi = _indicator_wide(spark, d)
    wdi = wdi.withColumn("Country Code", F.concat(F.lit("N"), F.expr("chr(65 + cast(`Country Code` as int))"),
                                                  F.lit("X")))
    return votes, wdi, _spending(spark, d)


_OUTLIER_COLS = ["o_orderkey", "amount", "balance", "avg_quantity", "avg_discount", "avg_tax"]
_IMPUTED = ["year", "amount", "balance", "avg_quantity", "avg_discount", "avg_tax", "military_expenditure"]
_TEXTS = ["country_code", "date", "subjects", "ms_code", "ms_name"]
PREPARE_SQL = f"""
WITH {PANEL_SQL.strip()}, {SPENDING_SQL.strip()},
votes AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
         o_orderpriority AS subjects, 'N' || chr(CAST(65 + c_nationkey AS INTEGER)) || 'X' AS ms_code, lower(n_name) AS ms_name,
         CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' ELSE 'A' END AS ms_vote,
         CAST(o_totalprice AS DOUBLE) AS amount, CAST(c_acctbal AS DOUBLE) AS balance
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
h AS (
  SELECT v.*, v.ms_code AS country_code, p.avg_quantity, p.avg_discount, p.avg_tax, s.military_expenditure
  FROM votes v
  LEFT JOIN panel p ON v.ms_code = 'N' || chr(CAST(65 + CAST(p.country_code AS INTEGER) AS INTEGER)) || 'X' AND v.year = p.year
  LEFT JOIN spending s ON upper(trim(v.ms_name)) = s.name AND v.year = s.year AND s.military_expenditure IS NOT NULL
  WHERE v.year BETWEEN 1990 AND 2023 AND regexp_matches(v.subjects, 'urgent|high|medium', 'i')
    AND regexp_full_match(v.ms_code, '[A-Za-z]{{3}}')),
q AS (SELECT {", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in _OUTLIER_COLS)}
      FROM (SELECT DISTINCT * FROM h)),
kept AS (SELECT h.* FROM (SELECT DISTINCT * FROM h) h, q WHERE {" + ".join(
    f"CASE WHEN b_{c} > a_{c} AND ({c} < a_{c} - 1.5 * (b_{c} - a_{c}) OR {c} > b_{c} + 1.5 * (b_{c} - a_{c})) THEN 1 ELSE 0 END"
    for c in _OUTLIER_COLS)} <= {len(_OUTLIER_COLS) / 2}),
med AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in _IMPUTED)} FROM kept)
SELECT o_orderkey, {", ".join(_TEXTS)},
       {", ".join(f"round(CAST(coalesce({c}, m_{c}, 0) AS DOUBLE), 6) AS {c}" for c in _IMPUTED)},
       CAST(ms_vote = 'Y' AS INTEGER) AS vote
FROM kept, med"""


@query("pipeline_prepare", PREPARE_SQL)
def q_pipeline_prepare(spark, d):
    """Harmonise -> comprehensive clean -> impute -> target encode."""
    from panelkit.plans.pipeline import prepare

    votes, wdi, sp = pipeline_inputs(spark, d)
    out = prepare(votes, wdi, sp, order_by=["o_orderkey"], topic_patterns=["urgent", "HIGH", "medium"],
                  indicator_mapping=INDICATOR_MAP)
    return _round_doubles(out)


_SMOOTHINGS = MD.FULL_GRIDS["nb"]["var_smoothing"]


def _nb_cv_sql(smoothings) -> str:
    """Mean and deviation over five folds of the ROC area of naive Bayes, by smoothing."""
    values = ", ".join(f"({i}, CAST({e!r} AS DOUBLE), '{str({'var_smoothing': e}).replace(chr(39), chr(39) * 2)}')"
                       for i, e in enumerate(smoothings))
    head = NB_METRICS_SQL[:NB_METRICS_SQL.index("long AS (")].rstrip().rstrip(",")
    long = " UNION ALL ".join(f"SELECT doc_id, label, fold, 'f{i}' AS feature, f{i} AS x FROM fo" for i in range(len(_SHARES)))
    return f"""{head},
fo AS (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) - 1) % 5 AS fold
       FROM z WHERE NOT is_test),
lf AS ({long}),
sm AS (SELECT * FROM (VALUES {values}) t(point, eps, params)),
tr AS (SELECT k, label, feature, x FROM lf, (SELECT unnest(range(5)) AS k) ks WHERE fold <> k),
gs AS (SELECT k, max(v) AS mx, max(n) AS n FROM (SELECT k, feature, var_pop(x) AS v, count(*) AS n FROM tr GROUP BY k, feature)
       GROUP BY k),
fit AS (SELECT tr.k, label, feature, count(*) / max(gs.n) AS prior, avg(x) AS mean, var_pop(x) AS v0, max(gs.mx) AS mx
        FROM tr JOIN gs ON gs.k = tr.k GROUP BY tr.k, label, feature),
jll AS (SELECT point, l.fold, l.doc_id, max(l.label) AS y, f.label,
               ln(max(f.prior)) - sum(0.5 * ln(2 * pi() * (v0 + eps * mx)) + (x - mean) * (x - mean) / (2 * (v0 + eps * mx))) AS j
        FROM lf l JOIN fit f ON l.fold = f.k AND l.feature = f.feature, sm GROUP BY point, l.fold, l.doc_id, f.label),
p AS (SELECT point, fold, doc_id, max(y) AS label,
             max(CASE WHEN label = 1 THEN j END) - max(CASE WHEN label = 0 THEN j END) AS score
      FROM jll GROUP BY point, fold, doc_id),
st AS (SELECT point, fold, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
       FROM p GROUP BY point, fold, score),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY point, fold ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS cum_pos FROM st),
auc AS (SELECT point, fold, sum(neg * (cum_pos - pos / 2.0)) / (sum(pos) * sum(neg)) AS auc FROM cum GROUP BY point, fold)"""


@query("cv_score_nb", f"""{_nb_cv_sql([1e-9])}
SELECT 'Naive Bayes' AS model, round(avg(auc), 6) AS mean_auc, round(stddev_pop(auc), 6) AS std_auc,
       round(avg(auc) - 2 * stddev_pop(auc), 6) AS low, round(avg(auc) + 2 * stddev_pop(auc), 6) AS high FROM auc""")
def q_cv_score_nb(spark, d):
    """Default-parameter naive Bayes, 5-fold CV ROC-AUC mean +- 2 std (M8)."""
    tr, _ = prepared(spark, d)
    out = MD.cv_score("nb", tr)
    return out.select("model", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query("nb_grid_scores", f"""{_nb_cv_sql(_SMOOTHINGS)}
SELECT 'Naive Bayes' AS model, max(params) AS params, round(avg(auc), 6) AS mean_auc, round(stddev_pop(auc), 6) AS std_auc
FROM auc JOIN sm USING (point) GROUP BY point""")
def q_nb_grid_scores(spark, d):
    """Cross-validated ROC-AUC of every smoothing, from the additive statistics of the folds (M7)."""
    tr, _ = prepared(spark, d)
    _, _, scores = MD.grid_search("nb", tr, MD.FULL_GRIDS["nb"])
    return scores.select("model", "params", F.round("mean_auc", 6).alias("mean_auc"), F.round("std_auc", 6).alias("std_auc"))
