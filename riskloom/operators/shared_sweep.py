"""Settings of one linear logistic model, all settings and folds fitted in the same passes over sparse rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.shared_fits import LEAST_STEPS, MOST_KEPT, MOST_STEPS, _Descent
from riskloom.plans.materialize import materialize

#: Widest vector that is turned into sparse rows here (it crosses to Python once as an array of that length), and numbers of one step in a task.
MOST_INPUTS, MOST_CELLS = 4096, 1 << 16


@dataclass(frozen=True)
class Convex:
    """Mean weighted log loss, positives weighted by `positive_weight`, plus alpha / 2 times the squared weights (intercept left out)."""

    alpha: float
    positive_weight: float
    max_iter: int


def sparse_rows(train: DataFrame, keep: Sequence[str], label: str, fold: str) -> DataFrame:
    """(keep..., _y, _fold, at, x) written: places and values of a row's non-zero inputs; place 0 is the intercept, so no row is empty."""
    kinds = [train.schema[c] for c in keep]
    schema = T.StructType([*kinds, T.StructField("_y", T.IntegerType()), T.StructField("_fold", T.IntegerType()),
                           T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            dense = batch.column("_x").flatten().to_numpy().reshape(batch.num_rows, -1)
            dense = np.concatenate((np.ones((len(dense), 1)), dense), axis=1)
            row, at = np.nonzero(dense)
            ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(dense))))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (at.astype(np.int32), dense[row, at])]
            names = [*keep, "_y", "_fold"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *lists], names=[*names, "at", "x"])

    numbers = [F.col(label).cast("int").alias("_y"), F.col(fold).cast("int").alias("_fold")]
    dense = train.select(*keep, *numbers, vector_to_array("features").alias("_x"))
    return materialize(dense.mapInArrow(run, schema), "sparse")


def _steps(batches: Iterator[pa.RecordBatch], width: int, columns: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the rows with places and values as grids; what a row does not fill points at place `width` with value 0."""
    step = max(64, MOST_CELLS // columns)
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            n = part.column("at").value_lengths().to_numpy()
            own = np.repeat(np.arange(len(n)), n)
            spot = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, x = np.full((len(n), n.max()), width), np.zeros((len(n), n.max()))
            at[own, spot] = part.column("at").flatten().to_numpy()
            x[own, spot] = part.column("x").flatten().to_numpy()
            yield part, at, x


def _margins(weights: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Margins of every column; `weights` ends with a row of zeros for unfilled places."""
    z = np.zeros((len(at), weights.shape[1]))
    for c in range(at.shape[1]):
        z += weights[at[:, c]] if (x[:, c] == 1.0).all() else weights[at[:, c]] * x[:, c, None]
    return z


def _sums(rows: DataFrame, weights: np.ndarray, outside: np.ndarray, heavier: np.ndarray, curvature: bool) -> np.ndarray:
    """(1 + width, columns): summed loss and gradient (or second derivatives) over the rows outside each column's fold, one pass for all columns."""
    width, columns = weights.shape
    sent = rows.sparkSession.sparkContext.broadcast(np.concatenate((weights, np.zeros((1, columns)))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, seen = np.zeros((width + 1, columns)), np.zeros(columns), False
        for part, at, x in _steps(batches, width, columns):
            seen = True
            up = part.column("_y").to_numpy()[:, None] == 1
            mass = np.where(up, heavier, 1.0) * (part.column("_fold").to_numpy()[:, None] != outside)
            wrong = np.where(up, -1.0, 1.0) * _margins(sent.value, at, x)
            small = np.exp(-np.abs(wrong))
            off = np.where(wrong >= 0, 1.0, small) / (1.0 + small)  # probability of the other label
            if curvature:
                each, values = mass * off * (1.0 - off), x * x
            else:
                loss += (mass * (np.maximum(wrong, 0.0) + np.log1p(small))).sum(axis=0)
                each, values = mass * off * np.where(up, -1.0, 1.0), x
            order = np.argsort(at, axis=None, kind="stable")
            spots = at.ravel()[order]
            cut = np.flatnonzero(np.concatenate(([True], spots[1:] != spots[:-1])))
            value = values.ravel()[order]
            cells = each[order // at.shape[1]]
            total[spots[cut]] += np.add.reduceat(cells if (value == 1.0).all() else cells * value[:, None], cut, axis=0)
        if seen:
            total[1:] = total[:-1].copy()
            total[0] = loss
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["sums"])

    parts = rows.select("_y", "_fold", "at", "x").mapInArrow(run, "sums array<double>")
    merged = parts.agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).first()
    sent.unpersist()
    return merged["sums"].toArray().reshape(width + 1, columns)


def fit_settings(rows: DataFrame, settings: Sequence[Convex], facts: dict[int, tuple[int, int]], width: int, tolerance: float = 1e-5) -> np.ndarray:
    """(width, settings x folds): weights of every setting outside every fold, fold by fold within a setting; row 0 are the intercepts.

    `facts`: rows and positives of each fold, `width` counts the intercept. A model takes at most its `max_iter` steps, as the estimator would; each pass
    over the rows serves all models that have not converged (largest gradient component under `tolerance`).
    """
    folds = sorted(facts)
    n = np.array([sum(v[0] for k, v in facts.items() if k != j) for _ in settings for j in folds], float)
    p = np.array([sum(v[1] for k, v in facts.items() if k != j) for _ in settings for j in folds], float)
    outside = np.tile(np.array(folds), len(settings))
    heavier, alpha, most = (np.repeat([getattr(s, f) for s in settings], len(folds)) for f in ("positive_weight", "alpha", "max_iter"))
    mass = n - p + heavier * p
    weights = np.zeros((width, len(outside)))
    weights[0] = np.log(heavier * p / (n - p))
    penalty = np.outer(np.concatenate(([0.0], np.ones(width - 1))), alpha)
    second = _sums(rows, weights, outside, heavier, True)[1:] / mass + penalty
    memory = min(MOST_STEPS, max(LEAST_STEPS, MOST_KEPT // (2 * weights.size)))
    descents = [_Descent(weights[:, c].copy(), 1.0 / np.maximum(second[:, c], 1e-12), tolerance, memory) for c in range(len(outside))]
    taken = np.zeros(len(outside), int)
    while open_ := [c for c, d in enumerate(descents) if not d.done]:
        asked = np.stack([descents[c].trial for c in open_], axis=1)
        sums = _sums(rows, asked, outside[open_], heavier[open_], False)
        for i, c in enumerate(open_):
            d, w = descents[c], asked[:, i]
            before = d.point
            d.take(sums[0, i] / mass[c] + 0.5 * (penalty[:, c] * w * w).sum(), sums[1:, i] / mass[c] + penalty[:, c] * w)
            taken[c] += d.point is not before
            d.done = d.done or taken[c] > most[c]
    return np.stack([d.point for d in descents], axis=1)


def score_settings(rows: DataFrame, keep: Sequence[str], weights: np.ndarray, folds: Sequence[int], names: Sequence[str]) -> DataFrame:
    """`keep` and one probability per setting (columns `names`), each row scored by the models fitted outside its fold."""
    sent = rows.sparkSession.sparkContext.broadcast(np.concatenate((weights, np.zeros((1, weights.shape[1])))))
    schema = T.StructType([*[rows.schema[c] for c in keep], *[T.StructField(c, T.DoubleType()) for c in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at, x in _steps(batches, len(sent.value) - 1, sent.value.shape[1]):
            z = _margins(sent.value, at, x).reshape(len(at), len(names), len(folds))
            own = np.searchsorted(np.array(folds), part.column("_fold").to_numpy())
            score = 1.0 / (1.0 + np.exp(-np.clip(z[np.arange(len(at)), :, own], -700, 700)))
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], *[pa.array(score[:, i].copy()) for i in range(len(names))]], names=[*keep, *names])

    return rows.mapInArrow(run, schema)
