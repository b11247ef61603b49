"""Queries on the shares of a text's characters where a text has none, against their SQL."""

import duckdb
import pytest

import __spark_entry__ as E

DOCS = [(1, "Abc d", "en", "a", 5), (2, "", "en", "a", 0), (3, "xy 12", "en", "b", 5), (4, "zzzz", "de", "b", 4),
        (5, "1234 5", "de", "c", 6), (6, "ab", "de", "d", 0)]
LABELS = [(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 0, 0), (5, 0, 0), (6, 1, 0)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty-texts")
    frames = {"documents": spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long"),
              "labels": spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")}
    con = duckdb.connect()
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{d}/{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{d}/{name}.parquet/*.parquet')")
    return str(d), con


def as_text(rows):
    return sorted(tuple("" if v is None else f"{float(v):.6f}" if isinstance(v, int | float) or hasattr(v, "is_nan") else v
                        for v in r) for r in rows)


@pytest.mark.parametrize("name", ["roc_points", "roc_auc", "pr_points", "avg_precision", "best_model", "confusion",
                                  "binary_metrics"])
def test_shares_of_empty_texts(spark, tables, name):
    d, con = tables
    want = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert as_text([r[c] for c in cols] for r in E.queries()[name](spark, d).collect()) == as_text(want.fetchall())


def test_model_input_has_numbers_only(spark, tables):
    from panelkit.plans.model_queries import prepared

    rows = [x for part in prepared(spark, tables[0]) for x in part.collect()]
    assert len(rows) == len(LABELS) and all(abs(v) < 1e9 for r in rows for v in r.features)
