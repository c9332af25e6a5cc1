"""Hashed logistic learner with FTRL-proximal updates in synchronous batches.

Every epoch deals the rows into `batches` parts by a hash of their id. For each part, the weights of all buckets are joined to
the rows' cells and summed per row, the errors are summed per bucket, and each bucket takes one FTRL step with that sum as its
gradient. The number of steps is an argument and does not depend on the number of rows: a larger table has larger parts. The
step size of a bucket is at most about alpha a part however many rows stand behind it, since its gradient is divided by the
root of the sum of its squares. The state is a table of (bucket, z, n per fit), never a driver or task object, and several
fits (one per held-out fold) share all passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import HASH_DIM, hash_row, sigmoid_clip
from riskloom.operators.lookup import lookup_join
from riskloom.plans.materialize import materialize


def start_z(bucket: Column, seed: int) -> Column:
    """Starting z in [0, 1), uniform and a function of the bucket alone, so buckets never seen also have one."""
    text = F.concat(F.lit(f"{seed}:"), bucket.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / float(2**32)


def weight_of(z: Column, n: Column, p: FTRL) -> Column:
    w = (F.signum(z) * p.l1 - z) / ((p.beta + F.sqrt(n)) / p.alpha + p.l2)
    return F.when(F.abs(z) <= p.l1, 0.0).otherwise(w)


@dataclass
class FTRL:
    """Settings and, after `fit`, the state. fits: the folds left out, one fit each; None is a fit on all rows."""

    cols: Sequence[str]
    alpha: float = 0.1
    beta: float = 1.0
    l1: float = 1e-5
    l2: float = 1.0
    dim: int = HASH_DIM
    interactions: bool = False
    epochs: int = 3
    batches: int = 8
    seed: int = 4689571
    fast_hash: bool = False
    fits: Sequence[int | None] = (None,)
    state: DataFrame | None = None
    buckets: int = 0
    cells: int = 0

    def _hashed(self) -> Column:
        return hash_row(self.cols, self.dim, self.interactions, self.fast_hash)

    def fit(self, df: DataFrame, label: str = "target", id: str = "id", fold: str | None = None) -> FTRL:
        held = F.col(fold) if fold else F.lit(None).cast("int")
        rows = df.select(F.col(id).alias("id"), F.col(label).cast("double").alias("y"), held.alias("fold"), self._hashed().alias("x"))
        rows = materialize(rows, "hashed")
        counted = rows.select(F.explode("x").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("weight_"))
        start = []
        for k in range(len(self.fits)):
            start += [start_z(F.col("bucket"), self.seed).alias(f"z{k}"), F.lit(0.0).alias(f"n{k}")]
        state = materialize(counted.select("bucket", "weight_", *start), "state")
        size = state.agg(F.count(F.lit(1)).alias("n"), F.sum("weight_").alias("w")).first()
        self.buckets, self.cells = size["n"], size["w"] or 0
        for epoch in range(self.epochs):
            turn = F.pmod(F.xxhash64(F.col("id"), F.lit(self.seed), F.lit(epoch)), F.lit(self.batches))
            for part in range(self.batches):
                state = self._step(rows.where(turn == part), state)
        self.state = state
        return self

    def _margins(self, rows: DataFrame, state: DataFrame) -> DataFrame:
        """(id, m0, m1, ...): sums of the weights of each row's cells. All cells of a row start in the same task, so the sums
        are complete before the shuffle."""
        ks = range(len(self.fits))
        side = state.select(F.col("bucket").alias("key_"), "weight_", *[weight_of(F.col(f"z{k}"), F.col(f"n{k}"), self).alias(f"w{k}") for k in ks])
        unseen = weight_of(start_z(F.col("bucket"), self.seed), F.lit(0.0), self)
        cells = rows.select("id", F.explode("x").alias("bucket"))
        weighted = lookup_join(cells, side, "bucket", {f"w{k}": (f"w{k}", unseen) for k in ks}, self.buckets, self.cells)
        return weighted.groupBy("id").agg(*[F.sum(f"w{k}").alias(f"m{k}") for k in ks])

    def _step(self, rows: DataFrame, state: DataFrame) -> DataFrame:
        errors = []
        for k, j in enumerate(self.fits):
            error = sigmoid_clip(f"m{k}") - F.col("y")
            errors.append((error if j is None else F.when(F.col("fold") == j, 0.0).otherwise(error)).alias(f"g{k}"))
        graded = rows.join(self._margins(rows, state), "id").select("x", *errors)
        ks = range(len(self.fits))
        sums = graded.select(F.explode("x").alias("bucket"), *[f"g{k}" for k in ks]).groupBy("bucket").agg(*[F.sum(f"g{k}").alias(f"g{k}") for k in ks])
        new = []
        for k in ks:
            z, n, g = F.col(f"z{k}"), F.col(f"n{k}"), F.coalesce(F.col(f"g{k}"), F.lit(0.0))
            pull = (F.sqrt(n + g * g) - F.sqrt(n)) / self.alpha * weight_of(z, n, self)
            new += [(z + g - pull).alias(f"z{k}"), (n + g * g).alias(f"n{k}")]
        return materialize(state.join(sums, "bucket", "left").select("bucket", "weight_", *new), "state")

    def predictions(self, df: DataFrame, id: str = "id") -> DataFrame:
        """(id, p0, p1, ...): one prediction per fit."""
        rows = df.select(F.col(id).alias("id"), self._hashed().alias("x"))
        found = self._margins(rows, self.state)
        return found.select(F.col("id").alias(id), *[sigmoid_clip(f"m{k}").alias(f"p{k}") for k in range(len(self.fits))])

    def transform(self, df: DataFrame, id: str = "id") -> DataFrame:
        """Add `prediction`, the mean over the fits."""
        mean = sum((F.col(f"p{k}") for k in range(1, len(self.fits))), F.col("p0")) / len(self.fits)
        return df.join(self.predictions(df, id).select(id, mean.alias("prediction")), id)


def ftrl_oof(train: DataFrame, settings: FTRL, label: str = "target", fold: str = "fold", id: str = "id") -> DataFrame:
    """Out-of-fold predictions (id, fold, target, prediction): all folds are fitted in the same passes."""
    rows = materialize(train.select(id, label, fold, *settings.cols), "ftrl")
    settings.fits = sorted(r[0] for r in rows.select(fold).distinct().collect())
    scores = settings.fit(rows, label, id, fold).predictions(rows, id)
    own = F.coalesce(*[F.when(F.col(fold) == j, F.col(f"p{k}")) for k, j in enumerate(settings.fits)])
    return rows.join(scores, id).select(id, fold, F.col(label).alias("target"), own.alias("prediction"))
