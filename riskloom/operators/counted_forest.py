"""Random forests on distinct rows: few-valued features make few cells, however many rows, and a bag is a number of rows per cell."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.learners import LABEL, WEIGHT, Learner, mean_score
from riskloom.plans.materialize import materialize

#: Rows from which cells are worth one fit per tree, cells that a row of them may make at most, and trees fitted at once.
COUNT_FROM, MOST_SHARE, AT_ONCE = 500_000, 0.25, 8
#: Files per fold and tasks per fit: cells are few, so the passes of a fit cost more in starting tasks than in work.
PARTS = 4


def count_cells(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., _n): distinct rows and how many there are of each."""
    return rows.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count(F.lit(1)).alias("_n"))


def draw_bags(cells: DataFrame, keys: Sequence[str], trees: int, bag: float, seed: int = 0) -> DataFrame:
    """`cells` and `_bag`, how many rows of the cell the bag of each tree holds.

    A bag takes every row a Poisson number of times with mean `bag`, so it takes a cell's n rows a Poisson number of times with mean n x `bag`. The draws are
    seeded by the cell itself, whatever the partitions.
    """

    @F.pandas_udf("array<int>")
    def draw(mark: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([np.random.default_rng((seed, m % (1 << 64))).poisson(bag * k, trees).astype(np.int32) for m, k in zip(mark.tolist(), n.tolist())])

    return cells.withColumn("_bag", draw(F.xxhash64(*[F.col(f"`{c}`") for c in keys]), "_n"))


class CountedRows:
    """Labelled rows as cells with the bags of a forest's trees, written once for all fits on them."""

    def __init__(self, cells: DataFrame, learner: Learner, label: str, fold: str):
        self.cells, self.learner, self.label, self.fold = cells, learner, label, fold
        sums = cells.select(fold, F.posexplode("_bag").alias("tree", "w")).groupBy(fold, "tree").agg(F.sum("w").alias("w")).collect()  # a row per fold and tree
        self.folds = sorted({r[fold] for r in sums})
        held = {(r[fold], r["tree"]): r["w"] for r in sums}
        trees = learner.counted.trees
        self.weight = {(j, t): sum(held[i, t] for i in self.folds if i != j) for j in self.folds for t in range(trees)}

    def scored(self, features: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
        """(fold, target, prediction), a row per labelled row, of the forests fitted outside each fold on `features` (cells, fold) -> cells with `features`."""
        y = F.col(self.label).cast("double").alias(LABEL, metadata={"ml_attr": {"type": "nominal", "num_vals": 2}})
        spec = self.learner.counted

        outside = {j: features(self.cells.where(F.col(self.fold) != j).coalesce(PARTS), j).select("features", y, "_bag").persist() for j in self.folds}

        def fit(at: tuple[int, int]) -> Model:
            j, t = at
            ready = outside[j].where(F.col("_bag")[t] > 0).select("features", LABEL, F.col("_bag")[t].cast("double").alias(WEIGHT))
            return spec.build(self.weight[at], t).fit(ready)

        every = list(self.weight)
        try:
            with ThreadPool(AT_ONCE) as pool:
                fitted = dict(zip(every, pool.map(fit, every, chunksize=1)))
        finally:
            for cells in outside.values():
                cells.unpersist()
        parts = None
        for j in self.folds:
            own = features(self.cells.where(F.col(self.fold) == j), j).select(self.fold, F.col(self.label).alias("target"), "_n", "features")
            part = mean_score(self.learner, [fitted[j, t] for t in range(spec.trees)], own).drop("features")
            parts = part if parts is None else parts.unionByName(part)
        return materialize(parts, "counted").select(self.fold, "target", "prediction", F.explode(F.sequence(F.lit(1), "_n"))).drop("col")


def counted_rows(rows: DataFrame, keys: Sequence[str], learner: Learner, label: str = "target", fold: str = "fold", count_from: int = COUNT_FROM) -> CountedRows | None:
    """`rows` as cells of equal `keys` (label and fold among them); None if the learner is no forest or cells would not make its fits cheaper."""
    if learner.counted is None or len(learner.seeds) > 1:
        return None
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.count(label).alias("known"), F.count(fold).alias("folded")).first()
    if one["n"] < max(count_from, 1) or one["known"] < one["n"] or one["folded"] < one["n"]:
        return None
    plain = materialize(count_cells(rows, keys), "cells")
    facts = {r[fold]: (r["n"], r["p"]) for r in plain.groupBy(fold).agg(F.sum("_n").alias("n"), F.sum(F.col(label) * F.col("_n")).alias("p")).collect()}
    total = [sum(f[i] for f in facts.values()) for i in (0, 1)]
    both = all(0 < total[1] - p < total[0] - n for n, p in facts.values())
    if not both or plain.count() > MOST_SHARE * one["n"]:
        return None
    drawn = draw_bags(plain, keys, learner.counted.trees, learner.counted.bag).repartition(PARTS)
    return CountedRows(materialize(drawn, "bags", [fold]), learner, label, fold)
