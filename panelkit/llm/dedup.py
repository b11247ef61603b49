"""Exact dedup by Grace hash partitioning.

Records are dealt to buckets by a hash of their normalised text (A-Z lower-cased)
until a bucket fits in memory, and each bucket is run through an open-addressing
table that compares complete contents. Spark's shuffle files are the spill files.

Level 0 takes the records as the input files deal them: each task's table finds
the copies it holds and leaves, for each distinct text, one record that stands
for its rows. So a text with very many copies is one record per task before
anything is shuffled. ``_merge`` deals these records to buckets by hash. The
number of buckets is doubled until the largest fits. A hash that alone holds
more than ``BUCKET_BYTES`` can't be split by doubling and doesn't count there:
its records are kept out of the buckets, dealt by hash and a salt, collapsed, and
merged again, which leaves one record per salt. A record alone in such a hash (a
very long text) has no copy and meets no table.

Memory: a bucket holds up to twice ``BUCKET_BYTES``. The tables of level 0 and of
the salts are emptied beyond a limit, which is at least four records of the
longest text where these have to be compared; rows leave only their (id, class) behind.

Result: ``keep_id`` is the largest id of equal texts, ``group_size`` their
number, ``kept`` marks one row. A null text counts as empty. Null ids are below
all others; if all ids of a group are null, one of these rows stays and
``keep_id`` is null. Of rows that share the largest id exactly one stays. An
empty table gives an empty result. Extra columns are carried on request.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import FOLD, fold_case, slices, text_buffer

#: Bytes of records in a bucket, and what a record counts besides its text.
BUCKET_BYTES = 64 << 20
RECORD_BYTES = 64
NO_ID = -(1 << 63)
FOLD_BYTES = FOLD.tobytes()


class ContentTable:
    """An open-addressing table of byte strings: linear probing by hash, complete compare."""

    def __init__(self):
        self.slots = np.full(64, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def _slot(self, h: int, content: bytes | None) -> int:
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0 and not (
                content is not None and self.hashes[k] == h and self.contents[k] == content):
            at = (at + 1) & mask
        return at

    def add(self, h: int, content: bytes) -> int:
        """The class of a content; a new content gets the next number."""
        at = self._slot(h, content)
        if self.slots[at] >= 0:
            return int(self.slots[at])
        self.hashes.append(h)
        self.contents.append(content)
        self.slots[at] = len(self.contents) - 1
        if 2 * len(self.contents) > len(self.slots):
            self.slots = np.full(2 * len(self.slots), -1, np.int64)
            for k, other in enumerate(self.hashes):
                self.slots[self._slot(other, None)] = k
        return len(self.contents) - 1


def _collapse_task(batches, carry: list[str], limit: int):
    """Rows (row, top, n, content, *carry) to rows with their class.

    Of each class: ``name`` (unique among all tasks), ``keep`` (largest top),
    ``size`` and the digest; ``first`` marks the record that has ``keep``, and
    that one also brings its content.
    """
    task = TaskContext.get().partitionId()
    held, table, rows, tables = 0, ContentTable(), [], 0
    for batch in batches:
        for piece in slices(batch, "content"):
            data, offsets = text_buffer(piece.column("content"))
            own = []
            for k in range(piece.num_rows):
                text = data[offsets[k]:offsets[k + 1]].tobytes().translate(FOLD_BYTES)
                own.append(table.add(hash(text), text))
            rows.append((piece, own))
            held += len(data)
            if held > limit:
                yield from _leave(table, rows, carry, f"{task}.{tables}")
                held, table, rows, tables = 0, ContentTable(), [], tables + 1
    if rows:
        yield from _leave(table, rows, carry, f"{task}.{tables}")


def _leave(table: ContentTable, rows: list, carry: list[str], name: str):
    n = len(table.contents)
    best, size, at = [(NO_ID - 1, 0)] * n, [0] * n, 0
    for piece, own in rows:
        for c, top, k in zip(own, piece.column("top").to_pylist(), piece.column("n").to_pylist()):
            best[c] = max(best[c], (NO_ID if top is None else top, -at))
            size[c] += k
            at += 1
    digest = [hashlib.sha256(x).hexdigest() for x in table.contents]
    at = 0
    for piece, own in rows:
        first = np.array([best[c][1] == -(at + i) for i, c in enumerate(own)], bool)
        at += len(own)
        text = piece.column("content").take(pa.array(np.arange(len(own)), mask=~first))
        out = {"row": piece.column("row"), "top": piece.column("top"), "first": pa.array(first), "content": text,
               "keep": pa.array([None if best[c][0] == NO_ID else best[c][0] for c in own], pa.int64()),
               "size": pa.array([size[c] for c in own], pa.int64()), "sha": pa.array([digest[c] for c in own]),
               "name": pa.array([f"{name}.{c}" for c in own], pa.string())}
        yield pa.RecordBatch.from_arrays([*out.values(), *[piece.column(c) for c in carry]], [*out, *carry])


def _collapse(records: DataFrame, carry: list[str], limit: int) -> DataFrame:
    schema = T.StructType.fromDDL("row string, top long, first boolean, content string, keep long, size long, "
                                  "sha string, name string")
    schema = T.StructType([*schema.fields, *[records.schema[c] for c in carry]])
    return records.select("row", "top", "n", "content", *carry).mapInArrow(
        lambda it: _collapse_task(it, carry, limit), schema)


def _merge(stand: DataFrame, limit: int) -> DataFrame:
    """(row, keep, size, first) of the records that stand for classes; ``row`` is their name."""
    records = stand.select(F.col("name").alias("row"), F.col("keep").alias("top"), F.col("size").alias("n"), "content")
    h = F.xxhash64(fold_case(F.col("content")))
    weight = F.octet_length("content") + RECORD_BYTES
    buckets = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_hash = records.groupBy(h.alias("h")).agg(F.sum(weight).alias("held"), F.count("*").alias("records"))
    while True:  # F.hash is what repartition deals by
        by_bucket = by_hash.groupBy(F.pmod(F.hash("h"), F.lit(buckets))).agg(
            F.sum("held").alias("all"), F.sum(F.when(F.col("held") <= limit, F.col("held"))).alias("held"),
            F.max("held").alias("most"))
        total, held, most = by_bucket.agg(F.sum("all"), F.max("held"), F.max("most")).first()
        if not held or held <= 2 * limit:
            break
        buckets = max(2 * buckets, total // limit)
    if not total or most <= limit:
        return _collapse(records.repartition(buckets, h), [], sys.maxsize).select("row", "keep", "size", "first")
    # no doubling splits the hashes over the limit: they are taken out of the buckets
    hot = by_hash.filter(F.col("held") > limit).withColumn(
        "parts", F.least(F.ceil(F.col("held") / limit), F.ceil(F.col("records") / 2)).cast("int"))
    marked = records.withColumn("h", h).join(F.broadcast(hot), "h", "left")  # at most total / limit hashes
    plain = _collapse(marked.filter(F.col("parts").isNull()).repartition(buckets, "h"), [], sys.maxsize)
    out = plain.select("row", "keep", "size", "first").union(  # a record alone in its hash has no copy
        marked.filter("records = 1").select("row", F.col("top").alias("keep"), F.col("n").alias("size"), F.lit(True)))
    many, longest = hot.filter("records > 1").agg(F.count("*"), F.max(F.col("held") / F.col("records"))).first()
    if not many:
        return out
    # two records or more a salt on average, side by side, so each round leaves fewer
    salted = marked.filter("records > 1").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("parts")))
    salted = salted.repartition(max(buckets, total // limit), "h", "salt").sortWithinPartitions("h", "salt")
    once = cut_lineage(_collapse(salted, [], max(2 * limit, 4 * int(longest))))
    return out.union(_lift(once, _merge(once.filter("first"), limit), ["row"]))


def _lift(rows: DataFrame, above: DataFrame, cols: list[str]) -> DataFrame:
    """Give rows what the level above found for the record that stands for them."""
    up = above.select(F.col("row").alias("name"), F.col("keep").alias("_keep"), F.col("size").alias("_size"),
                      F.col("first").alias("_first"))
    return rows.join(up, "name").select(*cols, F.col("_keep").alias("keep"), F.col("_size").alias("size"),
                                        (F.col("first") & F.col("_first")).alias("first"))


def _level0(docs: DataFrame, carry: dict[str, str], limit: int) -> DataFrame:
    records = docs.select(F.lit(None).cast("string").alias("row"), F.col("doc_id").cast("long").alias("top"),
                          F.lit(1).cast("long").alias("n"), F.col("text").alias("content"),
                          *[F.col(c).alias(r) for c, r in carry.items()])
    return _collapse(records, list(carry.values()), limit)


def exact_groups(docs: DataFrame, limit: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    out = cut_lineage(_level0(docs, {}, limit))
    rows = _lift(out, _merge(out.filter("first"), limit), ["top", "sha"])
    return rows.select(F.col("top").alias("doc_id"), F.col("keep").alias("keep_id"),
                       F.col("size").alias("group_size"), F.col("first").alias("kept"),
                       F.col("sha").alias("text_sha256"))


def without_copies(docs: DataFrame, limit: int = BUCKET_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    carry = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c != "text"}
    out = cut_lineage(_level0(docs, carry, limit).filter("first"))
    rows = _lift(out, _merge(out, limit), ["content", *carry.values()]).filter("first")
    back = {r: c for c, r in carry.items()}
    return rows.select(F.col("content").alias("text"), *[F.col(r).alias(c) for r, c in back.items()]).select(docs.columns)


def op9_dedup(spark, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return exact_groups(read(spark, sf_dir, "documents"))


OP9_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""
