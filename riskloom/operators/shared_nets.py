"""Feed-forward nets of several folds and bags fitted together: each step is one pass over sparse rows for all of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.shared_fits import _Descent

#: Rows that a task works on at once, steps that a net remembers and shorter steps that it tries, both as the estimator does.
BLOCK, MEMORY, MOST_TRIES = 512, 10, 10


@dataclass(frozen=True)
class Net:
    """Sigmoid units, two softmax outputs, mean cross-entropy; at most `iterations` quasi-Newton steps."""

    hidden: tuple[int, ...]
    iterations: int


class _Scaled(_Descent):
    """Steps of a function that need not be convex: the first along the gradient, half as long as one; later ones scaled by the newest curvature."""

    def __init__(self, start: np.ndarray, tolerance: float, most: int):
        super().__init__(start, np.ones(1), tolerance, MEMORY)
        self.most, self.taken = most, -1

    def take(self, value: float, gradient: np.ndarray) -> None:
        before = self.point
        if before is None:
            self.diagonal = 0.5 / max(np.linalg.norm(gradient), 1e-12)
        else:
            s, y = self.trial - before, gradient - self.gradient
            if s @ y > 0:
                self.diagonal = (s @ y) / (y @ y)
        super().take(value, gradient)
        self.taken += self.point is not before
        # the first step only finds the scale, so it is not counted
        if not self.done and (self.taken > self.most or self.step < 0.5**MOST_TRIES):
            self.done = True


def _layers(weights: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """(nets, 1 + inputs, outputs) of each layer, first row the biases, of flat weights in the estimator's order."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        inner = weights[:, at : at + a * b].reshape(-1, a, b)
        out.append(np.concatenate((weights[:, None, at + a * b : at + a * b + b], inner), axis=1))
        at += (a + 1) * b
    return out


def _flat(layers: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.concatenate((w[:, 1:].reshape(len(w), -1), w[:, 0]), axis=1) for w in layers], axis=1)


def _gradient(x: np.ndarray, y: np.ndarray, layers: Sequence[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Summed loss per net and the gradient of each layer; `x` begins with a column of ones."""
    first, n = layers[0], len(x)
    z = (x @ first.transpose(1, 0, 2).reshape(first.shape[1], -1)).reshape(n, len(first), -1).transpose(1, 0, 2)
    units = []
    for w in layers[1:]:
        units.append(1.0 / (1.0 + np.exp(-np.clip(z, -80, 80))))
        z = units[-1] @ w[:, 1:] + w[:, :1]
    z = z.astype(np.float64)
    top = z.max(axis=2, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(axis=2, keepdims=True)
    each = np.arange(n)
    loss = (np.log(total) + top)[:, :, 0].sum(axis=1) - z[:, each, y].sum(axis=1)
    off = e / total
    off[:, each, y] -= 1.0
    off = off.astype(x.dtype)
    found = []
    for w, a in zip(layers[:0:-1], reversed(units)):
        found.append(np.concatenate((off.sum(axis=1, keepdims=True), a.transpose(0, 2, 1) @ off), axis=1))
        off = (off @ w[:, 1:].transpose(0, 2, 1)) * a * (1.0 - a)
    wide = np.ascontiguousarray(off.transpose(1, 0, 2)).reshape(n, -1)
    found.append((x.T @ wide).reshape(x.shape[1], len(first), -1).transpose(1, 0, 2))
    return loss, found[::-1]


def _sums(rows: DataFrame, weights: np.ndarray, sizes: Sequence[int], outside: Sequence[int | None]) -> np.ndarray:
    """(nets, 1 + weights): summed loss and gradient over the rows outside each net's fold (None: all rows), one pass for all nets."""
    sent = rows.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    outside, sizes = list(outside), list(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(outside), 1 + sent.value.shape[1]))
        asked: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            fold, y = (batch.column(c).to_numpy() for c in ("_fold", "_y"))
            n = batch.column("at").value_lengths().to_numpy()
            begin = np.concatenate(([0], np.cumsum(n)))
            at, value = (batch.column(c).flatten().to_numpy() for c in ("at", "x"))
            for f in np.unique(fold).tolist():
                if f not in asked:
                    nets = [k for k, j in enumerate(outside) if j is None or j != f]
                    asked[f] = nets, _layers(sent.value[nets], sizes)
                nets, layers = asked[f]
                if not nets:
                    continue
                mine = np.flatnonzero(fold == f)
                for part in np.split(mine, range(BLOCK, len(mine), BLOCK)):
                    long = np.repeat(np.arange(len(part)), n[part])
                    spot = np.arange(len(long)) - np.repeat(np.cumsum(n[part]) - n[part], n[part]) + np.repeat(begin[part], n[part])
                    x = np.zeros((len(part), sizes[0] + 1), np.float32)
                    x[long, at[spot]] = value[spot]
                    loss, found = _gradient(x, y[part], layers)
                    total[nets, 0] += loss
                    held = sums.setdefault(f, [np.zeros(g.shape) for g in found])
                    for s, g in zip(held, found):
                        s += g
        for f, held in sums.items():
            total[asked[f][0], 1:] += _flat(held)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["net", "sums"])

    parts = rows.select("_y", "_fold", "at", "x").mapInArrow(run, "net int, sums array<double>")
    merged = parts.groupBy("net").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()  # a row per net
    sent.unpersist()
    return np.stack([r["sums"].toArray() for r in sorted(merged, key=lambda r: r["net"])])


def fit_nets(rows: DataFrame, sizes: Sequence[int], starts: np.ndarray, outside: Sequence[int | None], n: Sequence[int], iterations: int, tolerance: float = 1e-6) -> np.ndarray:
    """Weights of every net, fitted from `starts` (nets, weights) on the `n` rows outside its fold; `rows` come from `sparse_rows`.

    Sums are taken in double precision, the products of a block in single. Nets that have taken their steps leave the passes.
    """
    descents = [_Scaled(w.copy(), tolerance, iterations) for w in starts]
    while open_ := [k for k, d in enumerate(descents) if not d.done]:
        sums = _sums(rows, np.stack([descents[k].trial for k in open_]), sizes, [outside[k] for k in open_])
        for s, k in zip(sums, open_):
            descents[k].take(s[0] / n[k], s[1:] / n[k])
    return np.stack([d.point for d in descents])
