"""Many logistic fits over one table of one-hot positions, advanced together: each step is one pass over the rows for all of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.metrics import GINI, POOLED, Metric

#: Weights that one pass may carry (8 bytes each, sent to every executor once); more fits take several passes a step.
MOST_WEIGHTS = 4_000_000
#: Numbers that the driver may keep of earlier steps, and the most and least steps that a model remembers.
MOST_KEPT, MOST_STEPS, LEAST_STEPS = 32_000_000, 200, 12


@dataclass(frozen=True)
class Codes:
    """(fold, codes, n, pos): rows with equal codes and fold are one cell. codes[b] is the position in block b; `widths[b]` and above mean none."""

    cells: DataFrame
    widths: list[int]
    folds: list[int]

    def size(self, blocks: Sequence[int]) -> int:
        return 1 + sum(self.widths[b] for b in blocks)


@dataclass
class FoldFits:
    """Models of one choice of blocks: column j of `weights` is fitted outside fold folds[j]; row 0 is the intercept, then the blocks in order."""

    blocks: tuple[int, ...]
    weights: np.ndarray

    def of_block(self, codes: Codes, block: int) -> np.ndarray:
        start = 1 + sum(codes.widths[b] for b in self.blocks[: self.blocks.index(block)])
        return self.weights[start : start + codes.widths[block]]


def _margins(codes: np.ndarray, blocks: Sequence[int], widths: Sequence[int], weights: np.ndarray) -> np.ndarray:
    z = np.repeat(weights[:1], len(codes), axis=0)
    start = 1
    for b in blocks:
        table = np.concatenate((weights[start : start + widths[b]], np.zeros((1, weights.shape[1]))))
        z += table[np.minimum(codes[:, b], widths[b])]
        start += widths[b]
    return z


def _batches(batches: Iterator[pa.RecordBatch], step: int = 1 << 14) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            codes = part.column("codes").flatten().to_numpy().reshape(part.num_rows, -1)
            yield codes, *(part.column(c).to_numpy() for c in ("fold", "n", "pos"))


def _sums(codes: Codes, fits: Sequence[FoldFits], positive_weight: float, curvature: bool) -> dict[int, np.ndarray]:
    """One pass: for each of `fits` an array (1 + size, folds) of the summed loss and gradient (or second derivatives) outside each fold."""
    widths, folds = list(codes.widths), np.array(codes.folds)
    sent = codes.cells.sparkSession.sparkContext.broadcast([(f.blocks, f.weights) for f in fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        total = [np.zeros((1 + len(w), w.shape[1])) for _, w in models]
        seen = False
        for x, fold, n, pos in _batches(batches):
            seen = True
            apart = fold[:, None] != folds[None, :]
            up, down = (positive_weight * pos)[:, None] * apart, (n - pos)[:, None] * apart
            sorted_by: dict[int, tuple[np.ndarray, ...]] = {}
            for (blocks, weights), sums in zip(models, total):
                z = _margins(x, blocks, widths, weights)
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                if curvature:
                    each = (up + down) * p * (1.0 - p)
                else:
                    sums[0] += (up * np.logaddexp(0.0, -z) + down * np.logaddexp(0.0, z)).sum(axis=0)
                    each = down * p - up * (1.0 - p)
                sums[1] += each.sum(axis=0)
                start = 2
                for b in blocks:
                    if b not in sorted_by:
                        order = np.argsort(x[:, b], kind="stable")
                        code = x[order, b]
                        cut = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
                        keep = code[cut] < widths[b]
                        sorted_by[b] = order, cut, code[cut][keep], keep
                    order, cut, code, keep = sorted_by[b]
                    sums[start + code] += np.add.reduceat(each[order], cut, axis=0)[keep]
                    start += widths[b]
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([t.ravel() for t in total], pa.list_(pa.float64()))], names=["fit", "sums"]
            )

    parts = codes.cells.mapInArrow(run, "fit int, sums array<double>")
    merged = parts.groupBy("fit").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect()  # one row per fit, MOST_WEIGHTS in all
    sent.unpersist()
    return {r["fit"]: r["sums"].toArray().reshape(-1, len(folds)) for r in merged}


class _Descent:
    """Limited-memory quasi-Newton steps for one convex function, driven from outside: evaluate at `trial`, then `take` value and gradient."""

    def __init__(self, start: np.ndarray, diagonal: np.ndarray, tolerance: float, memory: int = LEAST_STEPS):
        self.trial, self.diagonal, self.tolerance, self.memory = start, diagonal, tolerance, memory
        self.point = self.value = self.gradient = self.direction = None
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self.step, self.done, self.stalled = 1.0, False, 0

    def take(self, value: float, gradient: np.ndarray) -> None:
        if self.point is not None:
            slope = self.gradient @ self.direction
            noise = 1e-14 * max(1.0, abs(self.value))
            if not value <= self.value + 1e-4 * self.step * slope + noise:
                self.step *= 0.5 if self.step > 1e-10 else 0.0
                if not self.step:  # no descent left within the arithmetic's precision
                    self.trial, self.done = self.point, True
                    return
                self.trial = self.point + self.step * self.direction
                return
            s, y = self.trial - self.point, gradient - self.gradient
            if s @ y > 0:
                self.pairs = [*self.pairs[1 - self.memory :], (s, y)] if len(self.pairs) >= self.memory else [*self.pairs, (s, y)]
            self.stalled = self.stalled + 1 if self.value - value <= noise else 0
        self.point, self.value, self.gradient = self.trial, value, gradient
        if np.abs(gradient).max() <= self.tolerance or self.stalled >= 5:
            self.done = True
            return
        q, marks = gradient.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (y @ s)
            q -= a * y
            marks.append(a)
        q *= self.diagonal
        for (s, y), a in zip(self.pairs, reversed(marks)):
            q += (a - (y @ q) / (y @ s)) * s
        self.direction, self.step = -q, 1.0
        self.trial = self.point + self.direction


def fit_shared(
    codes: Codes, choices: Sequence[Sequence[int]], alpha: float = 0.0005, positive_weight: float = 1.0, start: FoldFits | None = None,
    tolerance: float = 1e-7, max_passes: int = 200,
) -> list[FoldFits]:
    """For every choice of blocks one L2 logistic model outside each fold (intercept not penalised): mean weighted loss + alpha / 2 * squared weights.

    All models advance side by side; a pass over the cells returns one gradient per model, already summed by Spark, and the driver keeps only weights. Models that have
    converged (largest gradient component under `tolerance`) leave the passes. `start` gives first weights for the blocks it holds. Raises if
    some model has not converged after `max_passes`.

    Pairs of columns repeat what their columns say, so the curvature that couples blocks has to be learned from earlier steps: models remember up to
    MOST_STEPS of them, fewer if they are so wide that all together would keep over MOST_KEPT numbers.
    """
    if not choices:
        return []
    facts = {r["fold"]: (r["n"], r["p"]) for r in codes.cells.groupBy("fold").agg(F.sum("n").alias("n"), F.sum("pos").alias("p")).collect()}
    n = np.array([sum(v[0] for k, v in facts.items() if k != j) for j in codes.folds], float)
    p = np.array([sum(v[1] for k, v in facts.items() if k != j) for j in codes.folds], float)
    if not (p > 0).all() or not (n > p).all():
        raise ValueError("each fit needs rows of both labels outside its fold")
    mass = n - p + positive_weight * p
    out: list[FoldFits] = []
    for choice in choices:
        blocks = tuple(choice)
        weights = np.zeros((codes.size(blocks), len(codes.folds)))
        weights[0] = np.log(positive_weight * p / (n - p))
        fits = FoldFits(blocks, weights)
        if start is not None:
            weights[0] = start.weights[0]
            for b in blocks:
                if b in start.blocks:
                    fits.of_block(codes, b)[:] = start.of_block(codes, b)
        out.append(fits)
    groups, held = [[]], 0
    for k, f in enumerate(out):
        if groups[-1] and held + f.weights.size > MOST_WEIGHTS:
            groups, held = [*groups, []], 0
        groups[-1].append(k)
        held += f.weights.size

    def passed(which: list[int], curvature: bool) -> Iterator[tuple[int, np.ndarray]]:
        for group in groups:
            asked = [k for k in group if k in which]
            if asked:
                found = _sums(codes, [out[k] for k in asked], positive_weight, curvature)
                yield from ((asked[i], v) for i, v in found.items())

    every = list(range(len(out)))
    penalty = {k: np.concatenate(([0.0], np.full(len(out[k].weights) - 1, alpha))) for k in every}
    steps = min(MOST_STEPS, max(LEAST_STEPS, MOST_KEPT // (2 * sum(f.weights.size for f in out))))
    descents = {}
    for k, second in passed(every, True):
        diagonal = 1.0 / np.maximum(second[1:] / mass + penalty[k][:, None], 1e-12)
        descents[k] = [_Descent(out[k].weights[:, j].copy(), diagonal[:, j], tolerance, steps) for j in range(len(codes.folds))]
    for _ in range(max_passes):
        open_ = [k for k in every if not all(d.done for d in descents[k])]
        if not open_:
            return out
        for k, sums in passed(open_, False):
            for j, d in enumerate(descents[k]):
                if not d.done:
                    w = d.trial
                    d.take(sums[0, j] / mass[j] + 0.5 * (penalty[k] * w * w).sum(), sums[1:, j] / mass[j] + penalty[k] * w)
                out[k].weights[:, j] = d.point if d.done else d.trial
    raise RuntimeError(f"{len(open_)} of {len(out)} models have not converged after {max_passes} passes")


def shared_scores(codes: Codes, fits: Sequence[FoldFits], metric: Metric = GINI) -> list[dict[int, float]]:
    """Metric per fold and pooled (-1) of each of `fits`, every row scored by the model fitted outside its fold."""
    widths, folds = list(codes.widths), list(codes.folds)
    sent = codes.cells.sparkSession.sparkContext.broadcast([(f.blocks, f.weights) for f in fits])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {j: i for i, j in enumerate(folds)}
        for x, fold, n, pos in _batches(batches):
            own = np.array([place[j] for j in fold.tolist()])
            for k, (blocks, weights) in enumerate(sent.value):
                z = _margins(x, blocks, widths, weights)[np.arange(len(x)), own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), k, np.int32)), pa.array(fold.astype(np.int32)), pa.array(np.round(z, 9) + 0.0), pa.array(pos), pa.array(n)],
                    names=["fit", "fold", "score", "pos", "n"],
                )

    rows = codes.cells.mapInArrow(run, "fit int, fold int, score double, pos long, n long")
    if metric.term is not None:  # a loss rates probabilities, a ranking the margins themselves
        rows = rows.withColumn("score", 1.0 / (1.0 + F.exp(-F.col("score"))))
    rows = rows.withColumn("fold", F.explode(F.array("fold", F.lit(POOLED))))
    cells = rows.groupBy("fit", "fold", "score").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    out: list[dict[int, float]] = [{} for _ in fits]
    for r in metric.rate(cells, ["fit", "fold"]).collect():  # folds + 1 rows per fit
        out[r["fit"]][r["fold"]] = r[metric.name]
    return out
