"""Mixing sources to target weights by capped water-filling.

``targets`` shares a budget of words among sources by weight. A source whose
share exceeds ``max_epochs`` times its size is clamped there, and what it
leaves is shared among the others by weight, until no share is above its
clamp. ``mix`` turns a target into repetitions: every document is taken
``floor(target / size)`` times, and the documents that come first in the order
of ``md5(doc_id-seed)`` once more, up to the word where the source's target is
met (the document at that word is taken if most of it lies before it). So a
source misses its target by half a document at most, and reruns agree.

Scale: documents are reduced to (id, source, size, order key) once. The order
within a source is cut into about sqrt(documents) ranges of the hash; words are
summed by range (combined before the shuffle), and only the range that holds
the target's last word is ordered row by row. No source is collected or sorted
as a whole.

Inputs: a null text has size 0; a null source is a source of its own; a source
without a weight, or with a null, zero or negative one, gets the target 0. Rows
that repeat are rows of their own; equal ids share a place in the order, and
which of two rows of equal id and size goes first makes no difference to the
result. An empty table gives an empty result. Columns besides the id, source
and text are carried by ``mixed_rows`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.tables import cut_lineage, read
from panelkit.llm.text import free_name, words_column

SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = 17


def sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, place): ``place`` is a hash of the id in [0, 2^60)."""
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"-{seed}")))
    return docs.select("doc_id", "source", F.size(words_column(F.col("text"))).cast("long").alias("size"),
                       F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("place"))


def cyclic_weights(sources: DataFrame, cycle=(5.0, 2.0, 1.0)) -> DataFrame:
    """Weights for the rows of ``sources``, repeating the cycle over the sources
    by code point, null last. One row per source, so one task orders them."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    values = F.array(*[F.lit(float(x)) for x in cycle])
    at = (F.row_number().over(order) - 1) % len(cycle)
    return sources.select("source", F.element_at(values, (at + 1).cast("int")).alias("weight"))


def targets(sources: DataFrame, weights: DataFrame, share: float = SHARE,
            max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to (source, source_size, ...).

    One round is one aggregate of a row; the clamped set only grows, so there
    are at most as many rounds as sources and in practice a handful.
    """
    w = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    key = weights.select(F.col("source").alias("_s"), w.alias("_w"))
    table = cut_lineage(sources.join(key, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
                        .withColumn("_w", F.coalesce("_w", F.lit(0.0)))
                        .withColumn("_cap", F.col("source_size") * F.lit(float(max_epochs))))
    budget = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    # words per unit of weight: a source is clamped where weight * level reaches its cap
    level, clamped = 0.0, -1
    while True:
        full = F.col("_w") * F.lit(level) >= F.col("_cap")
        n, words, rest = table.filter(F.col("_w") > 0).agg(
            F.count(F.when(full, 1)), F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_w"))), F.lit(0.0))).first()
        if n == clamped or not rest:
            break
        clamped, level = n, (budget - words) / rest
    target = F.when(F.col("_w") > 0, F.least(F.col("_w") * F.lit(level), F.col("_cap"))).otherwise(0.0)
    return table.withColumn("target", target).drop("_w", "_cap")


def _taken(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``reps`` to documents joined with their source's plan."""
    ranges = F.ceil(F.sqrt("n_docs")).cast("long")
    scale = F.lit(float(1 << 60))
    s = plan.withColumn("ranges", ranges).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
    at = F.floor(F.col("place") / scale * F.col("ranges")).cast("long")
    keyed = docs.join(s.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop(
        "_s").withColumn("range", at)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = keyed.groupBy("source", "range").agg(F.sum("size").alias("held"), F.first("need").alias("need"))
    held = held.withColumn("done", F.coalesce(F.sum("held").over(before), F.lit(0)))
    # the range in which the running sum reaches what is needed
    last = held.filter((F.col("done") < F.col("need")) & (F.col("done") + F.col("held") >= F.col("need"))).select(
        F.col("source").alias("_s"), F.col("range").alias("last"), "done")
    keyed = keyed.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    run = Window.partitionBy("source").orderBy("place", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = keyed.filter(F.col("range") == F.col("last"))
    reached = F.col("done") + F.coalesce(F.sum("size").over(run), F.lit(0))
    inside = inside.withColumn("more", ((reached < F.col("need")) & (
        reached + F.col("size") / 2 <= F.col("need"))).cast("long"))
    rest = keyed.filter(F.col("last").isNull() | (F.col("range") != F.col("last"))).withColumn(
        "more", F.coalesce(F.col("range") < F.col("last"), F.lit(False)).cast("long"))
    return inside.unionByName(rest).withColumn("reps", (F.col("whole") + F.col("more")).cast("long"))


def mix(docs: DataFrame, weights=cyclic_weights, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, reps, taken), a row per document.

    ``weights`` is a frame (source, weight) or a function from the sources to one.
    """
    rows = cut_lineage(sizes(docs, seed))
    sources = cut_lineage(rows.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                     F.count("*").alias("n_docs")))
    plan = targets(sources, weights(sources) if callable(weights) else weights, share, max_epochs)
    plan = cut_lineage(plan)
    return _taken(rows, plan).select("doc_id", "source", "size", "source_size", "target", "reps",
                                     (F.col("size") * F.col("reps")).alias("taken"))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    Ids should be unique; rows that share an id are taken equally often (the
    most that any of them is).
    """
    own, times, at = (free_name(docs.columns, n) for n in ("mix_id", "mix_reps", "mix_rep"))
    reps = mix(docs, **how).filter("reps > 0").groupBy("doc_id").agg(F.max("reps").alias(times))
    reps = reps.withColumnRenamed("doc_id", own)
    out = docs.join(reps, F.col("doc_id").eqNullSafe(F.col(own)))
    return out.withColumn(at, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(
        *[F.col(f"`{c}`") for c in docs.columns])


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents: 150 % of all words, weights 5, 2, 1, two epochs at most."""
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "reps")


OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '-{SEED}'), 1, 15) AS BIGINT) AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, CAST([5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]
             AS DOUBLE) AS weight, source_size * CAST({MAX_EPOCHS} AS DOUBLE) AS cap FROM s),
r AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS caps_below, sum(weight) OVER (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
             AS weight_left, (SELECT {SHARE} * sum(source_size) FROM s) AS budget FROM w),
l AS (SELECT max((budget - caps_below) / weight_left) FILTER ((budget - caps_below) / weight_left < cap / weight) AS level FROM r),
p AS (SELECT source, source_size, least(weight * level, cap) AS target FROM w, l),
q AS (SELECT d.*, p.source_size, p.target,
        CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size) ELSE 0 END AS whole,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
t AS (SELECT *, CAST(whole + CASE WHEN before < target - whole * source_size
                     AND before + size / 2.0 <= target - whole * source_size
                     THEN 1 ELSE 0 END AS BIGINT) AS reps FROM q)
SELECT doc_id, size, source_size, target, CAST(size * reps AS BIGINT) AS taken, reps FROM t
"""
