"""Linear blending of prediction tables: weights that are best by a metric, per-fold calibration, stacked predictions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalars import linear_blend
from riskloom.operators.metrics import GINI, Metric
from riskloom.plans.materialize import materialize

# bins of the search's histograms, and size of the quantile sketches that place their edges (exact up to about as many distinct scores)
SCORE_BINS = 4096
SKETCH = 4096
FULL = -1


def require_complete(df: DataFrame, models: Sequence[str]) -> None:
    """Blending has no rule for missing scores: a null or NaN prediction is an error, in fits and in applications alike."""
    holes = [F.count_if(F.col(f"`{m}`").isNull() | F.isnan(F.col(f"`{m}`").cast("double"))).alias(f"n{i}") for i, m in enumerate(models)]
    row = df.agg(*holes).first()
    bad = {m: row[f"n{i}"] for i, m in enumerate(models) if row[f"n{i}"]}
    if bad:
        raise ValueError(f"predictions are missing (model: rows): {bad}; fill or drop them first")


def tuple_counts(rows: DataFrame, models: Sequence[str], label: str, fold: str) -> DataFrame:
    """(label, fold, models..., _n): rows with equal predictions, fold and label put together, so few-valued predictions make a small table."""
    scores = [F.col(f"`{m}`").cast("double").alias(m) for m in models]
    return rows.select(F.col(label).cast("long").alias(label), fold, *scores).groupBy(label, fold, *[F.col(f"`{m}`") for m in models]).agg(F.count(F.lit(1)).alias("_n"))


def _edges(cells: DataFrame, models: Sequence[str], fold: str, trials: list[tuple]) -> list[np.ndarray]:
    """Bin edges of every trial: quantiles of its score over all distinct tuples outside its fold, from sketches that tasks build and Spark merges.

    A tuple counts once however many rows it has, so a value of many rows costs one bin.
    """
    ranks = F.expr("CAST(split('" + ",".join(repr(i / SCORE_BINS) for i in range(1, SCORE_BINS)) + "', ',') AS ARRAY<DOUBLE>)")
    out: list[np.ndarray] = []
    for start in range(0, len(trials), 32):  # as many expressions as one plan bears well
        part = trials[start : start + 32]
        scores = [F.when(F.col(fold) != j, linear_blend(dict(zip(models, w)))) for _, j, w in part]
        quantiles = [F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(z, SKETCH), ranks).alias(f"q{i}") for i, z in enumerate(scores)]
        for q in cells.agg(*quantiles).first():
            at = np.unique(np.asarray(q, float))
            out.append((at[1:] + at[:-1]) / 2)  # between two scores, so that the last digit of a sum does not move a score
    return out


def _candidate_ginis(cells: DataFrame, models: Sequence[str], label: str, fold: str, trials: list[tuple]) -> dict[int, float]:
    """Gini of every trial (key, fit, weights) from one pass over the distinct tuples, up to ties within a bin.

    Each tuple is scored by all trials whose fit does not hold its fold out. A task scores a batch against
    all trials by one matrix product and counts the scores in at most SCORE_BINS bins per trial, so the shuffle carries at
    most trials x bins rows per task, whatever the number of rows. Bins hold about equally many distinct tuples (`_edges`), so an
    outlier or another scale takes no resolution from the rest, and up to SCORE_BINS distinct scores each have their own bin.
    """
    w = np.array([t[2] for t in trials], dtype=float).T
    fits = np.array([t[1] for t in trials])
    edges = _edges(cells, models, fold, trials)
    names, size = list(models), len(trials)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, pos = np.zeros((size, SCORE_BINS), np.int64), np.zeros((size, SCORE_BINS), np.int64)
        for batch in batches:
            scores = batch[names].to_numpy(float) @ w
            y, f, rows = batch["_y"].to_numpy() == 1, batch["_f"].to_numpy(), batch["_n"].to_numpy()
            for t in range(size):
                use = f != fits[t]
                spots = np.searchsorted(edges[t], scores[use, t], side="right")
                np.add.at(n[t], spots, rows[use])
                np.add.at(pos[t], spots[y[use]], rows[use][y[use]])
        trial, spot = np.nonzero(n)
        yield pd.DataFrame({"trial": trial, "spot": spot, "pos": pos[trial, spot], "n": n[trial, spot]})

    scored = cells.select(F.col(label).alias("_y"), F.col(fold).cast("int").alias("_f"), "_n", *[F.col(f"`{m}`") for m in names])
    counted = scored.mapInPandas(count, "trial long, spot long, pos long, n long")
    bins = counted.groupBy("trial", "spot").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    neg = F.col("n") - F.col("pos")
    upto = Window.partitionBy("trial").orderBy("spot").rowsBetween(Window.unboundedPreceding, 0)  # at most SCORE_BINS rows
    won = F.col("pos").cast("double") * (2 * F.sum(neg).over(upto) - neg)
    placed = bins.select("trial", "pos", neg.alias("neg"), won.alias("won"))
    sums = placed.groupBy("trial").agg(F.sum("won").alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("q")).collect()
    return {trials[r["trial"]][0]: r["w"] / (float(r["p"]) * float(r["q"])) - 1.0 for r in sums}


def _candidate_losses(cells: DataFrame, models: Sequence[str], label: str, fold: str, trials: list[tuple], metric: Metric) -> dict[int, float]:
    """Signed metric of every trial for a metric that is a mean over the rows: one sum per trial and task, no bins, exact."""
    y, n = F.col(label) * F.col("_n"), F.col("_n")
    sizes = {j: F.sum(F.when(F.col(fold) != j, n)).alias(f"n{i}") for i, j in enumerate(sorted({t[1] for t in trials}))}
    rows = cells.agg(*sizes.values()).first()
    held = dict(zip(sizes, rows))
    out: dict[int, float] = {}
    for start in range(0, len(trials), 32):  # as many expressions as one plan bears well
        part = trials[start : start + 32]
        sums = [F.sum(F.when(F.col(fold) != j, metric.term(linear_blend(dict(zip(models, w))), y, n))).alias(f"s{i}") for i, (_, j, w) in enumerate(part)]
        out |= {key: metric.sign * s / held[j] for (key, j, _), s in zip(part, cells.agg(*sums).first())}
    return out


def exact_values(rows: DataFrame, models: Sequence[str], label: str, fold: str, blends: dict[int, Sequence[float]], metric: Metric = GINI) -> dict[int, float]:
    """Exact metric, signed so that more is better, of one blend per fit over the rows outside its fold, all fits in one job. A column `_n` counts rows."""
    n = F.col("_n") if "_n" in rows.columns else F.lit(1)
    blended = [F.struct(F.lit(j).alias("_fit"), linear_blend(dict(zip(models, w))).alias("score")) for j, w in blends.items()]
    long = rows.select(label, fold, n.alias("_n"), F.inline(F.array(*blended))).where(F.col(fold) != F.col("_fit"))
    cells = long.groupBy("_fit", "score").agg(F.sum(F.col(label).cast("long") * F.col("_n")).alias("pos"), F.sum("_n").cast("long").alias("n"))
    return {r["_fit"]: metric.sign * r[metric.name] for r in metric.rate(cells, ["_fit"]).collect()}


def _normed(w: Sequence[float]) -> list[float]:
    size = sum(abs(x) for x in w)
    return [x / size for x in w] if size else list(w)


def fit_blend(
    rows: DataFrame, models: Sequence[str], label: str = "target", fold: str = "fold", fits: Sequence[int] = (FULL,),
    max_iter: int = 200, step: float = 0.25, min_step: float = 0.01, negative: bool = True, metric: Metric = GINI,
) -> dict[int, list[float]]:
    """Blend weights that are best by `metric` (Gini, AUC or log loss), by coordinate steps from equal weights, for all `fits` at once.

    Fit j uses the rows outside fold j (FULL: all rows). Every iteration rates the current weights and one step up and
    down per model for every unfinished fit in a single job. Where no step improves, the weights found with this step size are
    rated exactly, beside those of the last such rating, the better ones are kept, and the step is halved. At the end a single
    model is taken where its exact rating beats the blend. Weights are scaled so
    that their absolute values add up to 1. Null and NaN predictions are an error.
    """
    cells = materialize(tuple_counts(rows, models, label, fold), "blend")
    return _fit_cells(cells, models, label, fold, fits, max_iter, step, min_step, negative, metric)


def _fit_cells(
    rows: DataFrame, models: Sequence[str], label: str, fold: str, fits: Sequence[int], max_iter: int, step: float, min_step: float, negative: bool, metric: Metric,
) -> dict[int, list[float]]:
    """`fit_blend` on the written cells of `tuple_counts`."""
    require_complete(rows, models)
    weights = {j: _normed([1.0] * len(models)) for j in fits}
    proven = dict(weights)
    exact = exact_values(rows, models, label, fold, weights, metric)
    steps = {j: step for j in fits}
    best: dict[int, float] = {}
    for _ in range(max_iter):
        open_fits = [j for j in fits if steps[j] >= min_step]
        if not open_fits:
            break
        trials, owner = [], {}
        for j in open_fits:
            options = [] if j in best else [weights[j]]
            for i in range(len(models)):
                for sign in (1.0, -1.0):
                    w = list(weights[j])
                    w[i] += sign * steps[j]
                    if negative or w[i] >= 0.0:
                        options.append(_normed(w))
            for w in options:
                owner[len(trials)] = (j, w)
                trials.append((len(trials), j, w))
        found = _candidate_ginis(rows, models, label, fold, trials) if metric.term is None else _candidate_losses(rows, models, label, fold, trials, metric)
        stuck = []
        for j in open_fits:
            mine = [(g, owner[t][1]) for t, g in found.items() if owner[t][0] == j]
            score, w = max(mine, key=lambda x: (x[0], x[1]))
            if score > best.get(j, -np.inf) + 1e-9:
                best[j], weights[j] = score, w
            else:
                steps[j] /= 2.0
                stuck.append(j)
        moved = {j: weights[j] for j in stuck if weights[j] != proven[j]}
        _prove(rows, models, label, fold, moved, proven, exact, metric)
        for j in stuck:
            if weights[j] != proven[j]:
                weights[j] = proven[j]
                best.pop(j)
    _prove(rows, models, label, fold, {j: weights[j] for j in fits if weights[j] != proven[j]}, proven, exact, metric)
    for i in range(len(models)):
        _prove(rows, models, label, fold, {j: [float(k == i) for k in range(len(models))] for j in fits}, proven, exact, metric)
    return proven


def _prove(rows: DataFrame, models: Sequence[str], label: str, fold: str, offered: dict[int, list[float]], proven: dict, exact: dict, metric: Metric) -> None:
    """Take the offered weights where their exact rating is better."""
    if offered:
        for j, value in exact_values(rows, models, label, fold, offered, metric).items():
            if value > exact[j]:
                proven[j], exact[j] = list(offered[j]), value


@dataclass
class StackResult:
    """oof: (id, fold, target, prediction); test: (id, prediction); weights: (fold, model, weight)."""

    oof: DataFrame
    test: DataFrame | None
    weights: DataFrame

    def scores(self, metric: Metric = GINI) -> DataFrame:
        return metric.by_fold(self.oof, "target", "prediction")

    def mean_weights(self) -> DataFrame:
        return self.weights.groupBy("model").agg(F.avg("weight").alias("weight"))


def calibrate(rows: DataFrame, score: str, label: str, n: int, weight: str | None = None):
    """One-feature logistic regression that maps a blend to probabilities (unit inverse strength); column `weight` tells how many of the `n` rows each one stands for."""
    vector = VectorAssembler(inputCols=[score], outputCol="features")
    estimator = LogisticRegression(labelCol=label, featuresCol="features", regParam=1.0 / n, standardization=False)
    fitted = (estimator.setWeightCol(weight) if weight else estimator).fit(vector.transform(rows))

    def apply(df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return fitted.transform(vector.transform(df)).select(*keep, vector_to_array("probability")[1].alias("prediction"))

    return apply


def stack(
    oof: DataFrame, models: Sequence[str], test: DataFrame | None = None, label: str = "target", fold: str = "fold",
    id: str = "id", max_iter: int = 200, negative: bool = True, metric: Metric = GINI,
) -> StackResult:
    """Blend wide out-of-fold predictions fold by fold, by `metric`; test predictions are averaged over the folds row by row."""
    spark = oof.sparkSession
    rows = materialize(oof.select(id, label, fold, *models), "stack")
    sizes = {r[fold]: r["n"] for r in rows.groupBy(fold).agg(F.count(F.lit(1)).alias("n")).collect()}
    folds = sorted(sizes)
    if test is not None:
        require_complete(test, models)
    cells = materialize(tuple_counts(rows, models, label, fold), "blend")
    weights = _fit_cells(cells, models, label, fold, folds, max_iter, 0.25, 0.01, negative, metric)
    blends = {j: linear_blend(dict(zip(models, weights[j]))) for j in folds}

    def fit(j: int):
        # equal rows as one weighted row: the fits grow with the distinct predictions, not with the rows
        scored = cells.where(F.col(fold) != j).withColumn("_z", blends[j])
        return calibrate(scored, "_z", label, sum(sizes.values()) - sizes[j], "_n")

    with ThreadPool(len(folds)) as pool:
        calibrations = dict(zip(folds, pool.map(fit, folds, chunksize=1)))
    parts, test_parts = None, []
    scored_test = test
    for j in folds:
        held = rows.where(F.col(fold) == j).withColumn("_z", blends[j])
        part = calibrations[j](held, [id, fold, F.col(label).alias("target")])
        parts = part if parts is None else parts.unionByName(part)
        if test is not None:
            kept = [F.col(f"`{c}`") for c in scored_test.columns]
            scored_test = calibrations[j](scored_test.withColumn("_z", blends[j]), kept).withColumnRenamed("prediction", f"_p{j}")
            test_parts.append(F.col(f"_p{j}"))
    predicted = None
    if test is not None:
        total = test_parts[0]
        for p in test_parts[1:]:
            total = total + p
        predicted = scored_test.select(id, (total / len(folds)).alias("prediction"))
    listed = [(j, m, float(w)) for j in folds for m, w in zip(models, weights[j])]
    return StackResult(parts, predicted, spark.createDataFrame(listed, "fold int, model string, weight double"))
