"""The registered queries against their SQL, and the pipeline's stages."""

import math
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def norm(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


@pytest.mark.parametrize("name", ["op1_mixing", "op4_chat", "op9_dedup"])
def test_query_matches_sql(spark, name):
    import duckdb
    from panelkit.llm.queries import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = [c[0] for c in cur.description]
    want = sorted(str(tuple(map(norm, r))) for r in cur.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(str(tuple(norm(r[c]) for c in cols)) for r in df.collect()) == want


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    from panelkit.llm import dedup, encode, jaccard, mixing, pieces
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(cp.STAGES) == 5
    good = cp.quality(spark, docs, SF).cache()
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    once = cp.exact_dedup(spark, good, SF).cache()
    keep = {r.doc_id for r in dedup.exact_groups(good).filter("kept").collect()}
    assert {r.doc_id for r in once.collect()} == keep and once.columns == docs.columns
    apart = cp.near_dedup(spark, once, SF).cache()
    groups = jaccard.near_groups(once).collect()
    assert sorted(r.doc_id for r in apart.collect()) == sorted({r.class_id for r in groups})
    mixed = cp.mix(spark, apart, SF)
    reps = {r.doc_id: r.reps for r in mixing.mix(apart).collect()}
    assert mixed.columns == docs.columns and mixed.count() == sum(reps.values())
    out = cp.tokenize(spark, mixed, SF)
    back = encode.decode(out, pieces.Vocabulary.load(encode.MODEL), encode.MODEL, "back").collect()
    texts = {r.doc_id: r.text for r in apart.collect()}
    assert all(r.back == texts[r.doc_id] for r in back) and len(back) == sum(reps.values())
