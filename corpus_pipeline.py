"""A training corpus from ``documents``: drop poor texts, copies and near copies, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns the documents that go on,
with the columns of ``documents``; the last one returns ids. ``run`` writes
what a stage returns as Parquet in the shared folder and reads it again.

1. Quality classifier: documents scored below 0.7 go.
2. Exact dedup: of equal texts the row with the largest id stays.
3. N-gram Jaccard join: of each group the row with the smallest id stays.
4. Mixing: sources weigh 5, 2, 1 by code point; 150 % of the words that are
   left, no source above two epochs. A document taken twice is two rows.
5. SentencePiece: ids and number of pieces of each row, and the digest of what
   the ids decode to.

Without labels of both kinds there is no classifier, and stage 1 keeps all.

A null text is an empty text. Ids name documents: rows that share an id are
taken equally often by the mix. An empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import dedup, encode, jaccard, mixing, pieces, quality_model
from panelkit.llm.tables import cut_lineage, read


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.good_documents(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocab = pieces.Vocabulary.load(encode.MODEL)
    coded = encode.encode(docs.select("doc_id", "source", "lang", "text"), vocab, encode.MODEL)
    back = encode.decode(coded, vocab, encode.MODEL, "back")
    return back.select(*coded.columns, F.sha2("back", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", tokenize),
]

#: SQL can't express the classifier, the joins at this size or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
