"""Every operator accepts an empty input with a schema (no error, empty or
neutral output)."""

import pytest

from panelkit.operators import clean as CL
from panelkit.operators import impute as IM
from panelkit.operators import metrics as M
from panelkit.operators import ordered as O
from panelkit.operators import reshape as R
from panelkit.operators import split as SP
from panelkit.operators import stats as ST

SCHEMA = "id long, country_code string, year int, vote int, x double, subjects string, gdp_per_capita double"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_row_operators(empty):
    for op in (CL.drop_invalid, CL.standardize_codes, CL.drop_matching, CL.clean_text_columns,
               CL.convert_types, CL.drop_sparse, CL.drop_constant, CL.remove_duplicates,
               lambda d: CL.where_year(d, "year"), CL.where_topic,
               lambda d: CL.remove_outliers(d, ["x"]),
               lambda d: CL.remove_outliers(d, ["x"], "zscore", "strict"),
               lambda d: CL.remove_outliers(d, ["x"], "iqr", "lenient")):
        assert op(empty).count() == 0


def test_stats_and_reshape(empty):
    assert ST.value_counts(empty, "vote").count() == 0
    assert ST.rate_by(empty, "year", "vote").count() == 0
    assert ST.histogram(empty, "x").count() == 0
    assert ST.target_correlations(empty, "vote").count() == 0
    assert {r.column: r.non_null for r in ST.null_profile(empty).collect()}["x"] == 0
    assert ST.quantiles(empty, ["x"], [0.5]) == {"x": [None]}
    assert R.explode_topics(empty, "subjects").count() == 0
    assert R.pivot_first(empty, "id", "country_code", "x", ["A"]).count() == 0
    assert R.melt(empty, ["id"], ["x", "gdp_per_capita"]).count() == 0


def test_windows_splits_metrics(spark, empty):
    assert O.ffill_bfill(empty, ["x"], ["id"]).count() == 0
    assert IM.dedupe_first(empty, ["id"], ["year"]).count() == 0
    assert IM.impute(empty, ["id"]).count() == 0
    assert SP.stratified_split(empty, "vote", "id").count() == 0
    assert SP.stratified_folds(empty, "vote", "id").count() == 0
    pred = spark.createDataFrame([], "label double, score double, prediction double")
    assert M.binary_metrics(pred).first().accuracy == 0.0
    assert M.roc_auc(pred).first().roc_auc is None
    assert M.roc_curve(pred).count() == 1


def test_comprehensive_clean_rejects_empty(empty):
    with pytest.raises(ValueError):
        CL.comprehensive_clean(empty)
