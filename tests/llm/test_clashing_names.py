"""Every operator on tables with columns named like internal ones, and the pipeline on an empty table."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from panelkit.llm import align, collocations, dedup, encode, jaccard, mixing, pieces, quality_model, setsketch

SF = "/root/testdata/sf0.001"
ODD = ["_id", "_text", "_reps", "_rep", "_all", "node", "size", "reps", "grp", "label", "ids", "n_pieces", "x y", "row", "content", "h"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    for k, c in enumerate(ODD):
        d = d.withColumn(c, F.lit(f"v{k}"))
    return d.cache()


@pytest.fixture(scope="module")
def vocab():
    return pieces.Vocabulary.load(encode.MODEL)


CASES = {
    "mixing": lambda d, lab, v: mixing.mixed_rows(d),
    "encode": lambda d, lab, v: encode.decode(encode.encode(d, v, encode.MODEL), v, encode.MODEL, "back"),
    "counts": lambda d, lab, v: encode.count_tokens(d, v, encode.MODEL),
    "quality": lambda d, lab, v: quality_model.good_documents(d, lab),
    "jaccard": lambda d, lab, v: jaccard.one_of_each_group(d),
    "dedup": lambda d, lab, v: dedup.without_copies(d),
    "collocations": lambda d, lab, v: collocations.collocations(d, least=3),
    "align": lambda d, lab, v: align.align(d),
    "summaries": lambda d, lab, v: align.summaries(d),
    "setsketch": lambda d, lab, v: setsketch.near_components(d),
}


@pytest.mark.parametrize("name", CASES)
def test_clashing_names(spark, docs, vocab, name):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = CASES[name](docs, labels, vocab)
    rows = out.collect()
    assert rows
    if name in ("mixing", "quality", "jaccard", "dedup"):  # what stays keeps every column
        assert out.columns == docs.columns
        assert all(r[c] == f"v{k}" for r in rows for k, c in enumerate(ODD))
    if name == "encode":
        texts = {r.doc_id: r.text for r in docs.collect()}
        assert all(r.back == (texts[r.doc_id] or "") and r["_text"] == "v1" for r in rows)


def test_pipeline_on_an_empty_table_and_on_odd_columns(spark, docs, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []
    d = docs
    for _, stage in cp.STAGES[:-1]:
        d = stage(spark, d, SF)
        assert d.columns == docs.columns
    assert cp.STAGES[-1][1](spark, d, SF).count() > 0
