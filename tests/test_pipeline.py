"""The whole run on driver-derived inputs with two fast models."""

import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_run_end_to_end(spark):
    from panelkit.operators.models import SMALL_GRIDS
    from panelkit.plans.model_queries import pipeline_inputs
    from panelkit.plans.pipeline import run
    from panelkit.plans.queries import INDICATOR_MAP

    votes, wdi, sp = pipeline_inputs(spark, SF)
    out = run(votes, wdi, sp, kinds=("nb", "lr"), grids=SMALL_GRIDS, order_by=["o_orderkey"], id_cols=["o_orderkey"],
              topic_patterns=["urgent", "high", "medium"], indicator_mapping=INDICATOR_MAP)
    cmp = out["comparison"].collect()
    assert {r.model for r in cmp} == {"Naive Bayes", "Logistic Regression"}
    assert all(0.0 <= r.roc_auc <= 1.0 for r in cmp)
    assert out["best_model"].count() == 1
    assert out["confusion"].count() == 8 and out["roc"].count() > 2
    assert set(out["features"]) <= set(out["quality"].toPandas()["column"]) | {"vote"}
