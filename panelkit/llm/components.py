"""Connected components of an edge table, and of pairs within a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.tables import cut_lineage

#: Up to so many edges (16 bytes each) one task labels them; beyond it the rounds below do.
ONE_TASK = 500_000


def local_labels(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each of n members' component, from pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def _one_task(batches):
    got = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if b.num_rows]
    if got:
        a, b = (np.concatenate(x) for x in zip(*got))
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        label = local_labels(at[:len(a)], at[len(a):], len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "root"])


def components(edges: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, root) of every node of the edges (a long, b long); ``root`` is its component's smallest node.

    A few edges are labelled by one task. More of them go through rounds that
    hang each node's larger neighbours, then its smaller ones, on its smallest
    neighbour, until every node hangs on its root. The least neighbour is a
    combined aggregate, so a node with many edges is no single task.
    """
    edges = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    if edges.count() <= one_task:
        return edges.repartition(1).mapInArrow(_one_task, "node long, root long")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = cut_lineage(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(edges.join(least, "a").select("a", F.col("m").alias("b")))
                            .filter("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = cut_lineage(large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .unionByName(least.select("a", F.col("m").alias("b")))
                            .filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        # done when every node has one edge and no root hangs on another
        done = small.groupBy("a").count().filter("count > 1").isEmpty() and small.join(
            small.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        edges = small
        if done:
            break
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
