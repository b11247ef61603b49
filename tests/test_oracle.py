"""Every registered query with an oracle must match DuckDB at sf0.001."""

import math
import os

import pytest

SF = "/root/testdata/sf0.001"
FAST = ["indicator_extract", "panel_melt", "panel_pivot_first", "panel_join_name", "harmonize",
        "drop_invalid_rows", "code_standardize", "drop_constant_cols", "text_clean", "type_convert",
        "target_encode", "dedupe_first", "outliers_iqr_moderate", "outliers_cap", "quality_report",
        "year_hist", "feature_select", "impute_median", "ffill_bfill", "strat_split", "strat_folds",
        "roc_points", "pr_points", "avg_precision", "gnb_predict", "top_features"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return "inf" if math.isinf(v) else f"{round(v, 6):.6f}"
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    from panelkit.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    want = sorted(tuple(norm(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["year", "mean", "count", "avg_quantity"] and df.count() > 0
