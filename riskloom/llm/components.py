"""Connected components: spanning forests inside a task, labels over a table of edges."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.materialize import materialize


def spanning_edges(n: int, edges: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A forest over nodes 0..n-1 that connects what the edges connect, each node hung on the smallest of its tree."""
    root = np.arange(n)
    for i, j in edges:
        while True:
            a, b = root[i], root[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    hung = np.flatnonzero(root != np.arange(n))
    return root[hung], hung


def component_labels(edges: DataFrame, spark: SparkSession, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """Columns node and label (the smallest node of its component) for every node of an edge.

    Each round a node takes the smallest label next to it, then the label of that label (pointer jumping), so the number of
    rounds grows with the logarithm of the longest path in practice. Only minima are kept per node, never its list of neighbours;
    each round is written to the shared folder, so a lost executor costs one round at most.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    both = materialize(both.unionAll(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = materialize(
        both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels"
    )
    for _ in range(max_rounds):
        near = (
            both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        )
        taken = labels.join(near.select(F.col("u").alias("node"), "near"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        up = taken.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = taken.join(up, "label", "left").select("node", "was", F.least("label", "above").alias("label"))
        labels = materialize(jumped, "labels")
        changed = labels.where("label < was").limit(1).count()
        labels = labels.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError(f"labels still change after {max_rounds} rounds")
