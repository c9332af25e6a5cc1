"""k-fold out-of-fold training: fit outside fold j, predict fold j, pool, score; and predictions for unlabelled rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.columns import require_columns
from riskloom.operators.learners import FEATURES, LABEL, Facts, Learner, mean_score
from riskloom.operators.metrics import gini, gini_by_fold
from riskloom.operators.shared_nets import fit_nets
from riskloom.operators.shared_sweep import MOST_INPUTS, fit_settings, score_settings, sparse_rows
from riskloom.operators.shared_trees import GrownTrees, binned_blocks, grow
from riskloom.plans.materialize import materialize

# (table, fold or None for the fit on all rows) -> table with a `features` vector
Prepare = Callable[[DataFrame, int | None], DataFrame]
# (table, label, score) -> one row per fold and a pooled one
Metric = Callable[[DataFrame, str, str], DataFrame]


@dataclass
class OofResult:
    """oof: (id, fold, target, prediction); test: (id, prediction) or None; models[j]: the models fitted outside fold j."""

    learner: Learner
    oof: DataFrame
    test: DataFrame | None
    models: dict[int, list[Model]]
    refit: list[Model] = field(default_factory=list)

    def scores(self, metric: Metric = gini_by_fold) -> DataFrame:
        """Metric per fold and pooled (fold -1): a function of (table, label, score)."""
        return metric(self.oof, "target", "prediction")

    def importances(self) -> DataFrame:
        """(fold, position, importance): tree importances or linear coefficients of the first model of every fold."""
        rows = []
        for j, models in self.models.items():
            m = models[0]
            rows.append((j, (m.featureImportances if hasattr(m, "featureImportances") else m.coefficients).toArray().tolist()))
        vectors = self.oof.sparkSession.createDataFrame(rows, "fold int, v array<double>")
        return vectors.select("fold", F.posexplode("v").alias("position", "importance"))


def fold_facts(train: DataFrame, label: str, fold: str) -> dict[int, Facts]:
    rows = train.groupBy(fold).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")).collect()
    return {r[fold]: Facts(r["n"], r["p"]) for r in rows}


def oof_predict(
    train: DataFrame,
    learner: Learner,
    test: DataFrame | None = None,
    mode: str = "refit",
    prepare: Prepare | None = None,
    label: str = "target",
    fold: str = "fold",
    id: str = "id",
    parallel: int = 2,
    store: bool = True,
) -> OofResult:
    """Train one learner over the folds of `train`.

    The prepared rows are written once, partitioned by fold, so every fit reads only the folds it needs. The fits are
    ordinary distributed jobs; `parallel` of them run at once, each of which may cache its rows; nets of all folds and bags are fitted in the
    same passes (`operators/shared_nets.py`), boosted trees of all folds grown in the same passes (`operators/shared_trees.py`). mode="refit" predicts test rows with a model of all
    train rows, "mean" with the average of the fold models. `prepare` adds features that depend on the fold.
    """
    require_columns(train, id, label, fold)
    if mode not in ("refit", "mean"):
        raise ValueError("mode is 'refit' or 'mean'")
    ready = prepare or (lambda df, j: df)
    rows = materialize(train, "train", [fold]) if store else train
    facts = fold_facts(rows, label, fold)
    total = Facts(sum(f.rows for f in facts.values()), sum(f.positives for f in facts.values()))
    jobs: list[int | None] = sorted(facts)
    if test is not None and mode == "refit":
        jobs.append(None)

    def fit(j: int | None) -> list[Model]:
        if j is None:
            return learner.fit(ready(rows, None), total, label)
        outside = Facts(total.rows - facts[j].rows, total.positives - facts[j].positives)
        return learner.fit(ready(rows.where(F.col(fold) != j), j), outside, label)

    fitted = _nets_together(rows, learner, jobs, label, fold) if prepare is None else None
    if fitted is None:
        fitted = _trees_together(rows, learner, jobs, facts, prepare, label, fold, id)
    if fitted is None:
        with ThreadPool(min(parallel, len(jobs))) as pool:
            fitted = dict(zip(jobs, pool.map(fit, jobs, chunksize=1)))
    refit = fitted.pop(None, [])

    parts = [
        mean_score(learner, fitted[j], ready(rows.where(F.col(fold) == j), j)).select(
            id, fold, F.col(label).alias("target"), "prediction"
        )
        for j in sorted(facts)
    ]
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    predicted = None
    if test is not None:
        if mode == "refit":
            predicted = mean_score(learner, refit, ready(test, None)).select(id, "prediction")
        else:
            predicted = mean_over_folds(learner, fitted, test, prepare).select(id, "prediction")
    return OofResult(learner, oof, predicted, fitted, refit)


def _plain_facts(rows: DataFrame, label: str, fold: str) -> tuple[int, dict[int, tuple[int, int]]] | None:
    """Width of the vectors, rows and positives of each fold; None unless every row has a fold and a label, and each fit has rows of both labels."""
    first = rows.select("features").first()
    width = first["features"].size if first else 0
    facts = {r[0]: tuple(r)[1:] for r in rows.groupBy(fold).agg(F.count(label), F.sum(F.col(label).cast("long")), F.count("*")).collect()}  # a row per fold
    n, p = (sum(f[i] or 0 for f in facts.values()) for i in (0, 1))
    plain = None not in facts and all(f[0] == f[2] and 0 < p - f[1] < n - f[0] for f in facts.values())
    return (width, {j: f[:2] for j, f in facts.items()}) if plain and 0 < width <= MOST_INPUTS else None


def _nets_together(rows: DataFrame, learner: Learner, jobs: Sequence[int | None], label: str, fold: str) -> dict[int | None, list[Model]] | None:
    """Models of every fold (None: all rows) and bag, fitted in the same passes from the estimator's own first weights; None if they have to be fitted one by one."""
    found = _plain_facts(rows, label, fold) if learner.net is not None else None
    if found is None:
        return None
    width, facts = found
    total = Facts(*(sum(f[i] for f in facts.values()) for i in (0, 1)))
    sizes = [width, *learner.net.hidden, 2]
    # no iteration on two rows: the estimator's first weights, and later a model of given weights
    two = rows.sparkSession.createDataFrame([(Vectors.sparse(width, {}), float(y)) for y in (0, 1)], [FEATURES, LABEL])

    def still(seed: int, weights: np.ndarray | None = None) -> Model:
        estimator = learner.build(total, seed).setMaxIter(0)
        return (estimator if weights is None else estimator.setInitialWeights(Vectors.dense(weights))).fit(two)

    starts = {seed: still(seed).weights.toArray() for seed in learner.seeds}
    nets = [(j, seed) for j in jobs for seed in learner.seeds]
    n = [total.rows - (facts[j][0] if j is not None else 0) for j, _ in nets]
    sparse = sparse_rows(rows, [], label, fold)
    fitted = fit_nets(sparse, sizes, np.stack([starts[seed] for _, seed in nets]), [j for j, _ in nets], n, learner.net.iterations)
    out: dict[int | None, list[Model]] = {j: [] for j in jobs}
    for (j, seed), weights in zip(nets, fitted):
        out[j].append(still(seed, weights))
    return out


def _trees_together(
    rows: DataFrame, learner: Learner, jobs: Sequence[int | None], facts: dict[int, Facts], prepare: Prepare | None, label: str, fold: str, id: str,
) -> dict[int | None, list[Model]] | None:
    """Boosted trees of every fold (None: all rows), grown in the same passes; None if they have to be fitted one by one."""
    if learner.grown is None or len(learner.seeds) > 1 or not facts or None in facts or any(f.positives is None for f in facts.values()):
        return None
    n = sum(f.rows for f in facts.values())
    odd = F.count_if(F.col(label).isNull() | ~F.col(label).isin(0, 1))
    if any(n == f.rows for f in facts.values()) or rows.agg(odd).first()[0]:
        return None
    # features that do not depend on the fold are read once for all models
    held = list(jobs) if prepare is not None else [None]
    views = [(lambda df, j=j: prepare(df, j)) for j in jobs] if prepare is not None else [lambda df: df]
    found = binned_blocks(rows, views, held, label, fold, id, n, jobs)
    if found is None:
        return None
    return {j: [m] for j, m in zip(jobs, grow(*found, n, learner.grown, jobs))}


def attach_predictions(rows: DataFrame, predictions: DataFrame, id: str = "id") -> DataFrame:
    """Predictions of all folds attached to the rows by id; rows without one get null."""
    return rows.join(predictions.select(id, "prediction"), id, "left")


def largest_gradient(rows: DataFrame, learner: Learner, model: Model, penalty: Callable[[Facts], float], label: str = "target") -> float:
    """Largest absolute component of the gradient of a linear learner's objective at a fitted model, per unit of weight.

    The objective is the weighted mean loss (squared or logistic, by the learner) plus half of `penalty` times the squared
    coefficients. At an optimum it is zero up to the solver's tolerance.
    """
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("p")).first()
    facts = Facts(one["n"], one["p"])
    weight = learner.weight(facts, label) if learner.weight is not None else F.lit(1.0)
    score = F.col("prediction") if learner.margin else vector_to_array("probability")[1]
    off = model.transform(rows.withColumns({"_y": learner.label(label), "_w": weight})).withColumn("_off", score - F.col("_y"))
    # sums take weights of one sign, so errors above and below are added up apart
    above, below = F.greatest("_off", F.lit(0.0)) * F.col("_w"), F.greatest(-F.col("_off"), F.lit(0.0)) * F.col("_w")
    sums = off.select("features", above.alias("_a"), below.alias("_b"), "_w").agg(
        Summarizer.sum(F.col("features"), F.col("_a")).alias("a"), Summarizer.sum(F.col("features"), F.col("_b")).alias("b"), F.sum("_w").alias("w")
    ).first()
    gradient = (sums["a"].toArray() - sums["b"].toArray()) / sums["w"] + penalty(facts) * model.coefficients.toArray()
    return float(abs(gradient).max())


def mean_over_folds(learner: Learner, models: dict[int, list[Model]], test: DataFrame, prepare: Prepare | None) -> DataFrame:
    """Average of the fold models' scores on unlabelled rows."""
    if prepare is None:
        return mean_score(learner, [m for j in sorted(models) for m in models[j]], test)
    names = []
    df = test
    for j in sorted(models):
        scored = mean_score(learner, models[j], prepare(df, j), f"_fold{j}")
        names.append(f"_fold{j}")
        df = scored.select(*[F.col(f"`{c}`") for c in test.columns], *names)
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return df.withColumn("prediction", total / len(names))


def sweep(train: DataFrame, learners: dict[str, Learner], label: str = "target", fold: str = "fold", metric: Metric = gini_by_fold) -> DataFrame:
    """Out-of-fold scores of several settings on the same stored rows: setting and the columns of the metric.

    Settings of one convex model are fitted together, all folds and settings in the same passes; others one after the other.
    """
    rows = materialize(train, "sweep", [fold])
    together = _sweep_together(rows, learners, label, fold)
    found = None
    for i, (name, learner) in enumerate(learners.items()):
        if together is None:
            scores = oof_predict(rows, learner, label=label, fold=fold, store=False).scores(metric)
        else:
            scores = metric(together.select("id", fold, F.col(label).alias("target"), F.col(f"_setting{i}").alias("prediction")), "target", "prediction")
        scores = scores.withColumn("setting", F.lit(name))
        found = scores if found is None else found.unionByName(scores)
    return found


def _sweep_together(rows: DataFrame, learners: dict[str, Learner], label: str, fold: str) -> DataFrame | None:
    """Rows with one out-of-fold prediction per setting (`_setting<i>`); None if the settings have to be fitted one by one."""
    if any(x.convex is None or len(x.seeds) > 1 for x in learners.values()):
        return None
    found = _plain_facts(rows, label, fold)
    if found is None:
        return None
    width, facts = found
    keep = list(dict.fromkeys(["id", fold, label]))
    sparse = sparse_rows(rows, keep, label, fold)
    weights = fit_settings(sparse, [x.convex for x in learners.values()], facts, width + 1)
    return materialize(score_settings(sparse, keep, weights, sorted(facts), [f"_setting{i}" for i in range(len(learners))]), "swept")


def coefficient_audit(importances: DataFrame, names: DataFrame, low_support: int = 100) -> DataFrame:
    """Mean coefficient of every one-hot column next to its support in train and test, largest first."""
    mean = importances.groupBy("position").agg(F.avg("importance").alias("coefficient"))
    joined = names.join(mean, "position")
    rare = ((F.col("n_train") <= low_support) | (F.col("n_test") <= low_support)).cast("int")
    return joined.select("feature", "value", "n_train", "n_test", "coefficient", rare.alias("low_support")).orderBy(
        F.desc(F.abs("coefficient")), "feature", "value"
    )


def best_rounds(curve: DataFrame, top: int = 3, value: str = "auc") -> DataFrame:
    """Boosting rounds with the best mean validation score over the folds."""
    return (
        curve.groupBy("round").agg(F.avg(value).alias("mean_score"), F.stddev_pop(value).alias("std_score"))
        .orderBy(F.desc("mean_score"), "round").limit(top)
    )


def leaf_values(tree: Model) -> list[float]:
    """Predictions of a regression tree's leaves, in the order in which Spark numbers them (left before right)."""
    return [float(x) for x in re.findall(r"Predict: (\S+)", tree.toDebugString)]


def _leaf_tables(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Leaf values of all trees in one array, times the weight of their tree, and the place at which each tree's leaves begin."""
    if isinstance(model, GrownTrees):
        return model.leaf_tables()
    values = [weight * np.array(leaf_values(tree)) for tree, weight in zip(model.trees, model.treeWeights)]
    starts = np.cumsum([0, *[len(v) for v in values[:-1]]])
    return np.concatenate(values), starts


def _leaves(model: Model, rows: DataFrame, *keep: str) -> tuple[DataFrame, Callable[[pa.Array], Iterator[tuple[int, np.ndarray]]]]:
    """`keep` and a column `_from` of `rows`, and a function that tells from `_from` the leaf that a row reaches in each tree: (first row, leaves by row and tree) of parts of the rows."""
    if isinstance(model, GrownTrees):
        return rows.select(*keep, vector_to_array("features").alias("_from")), model.reached
    copy = model.copy()
    told = copy.setLeafCol("_leaf").transform(rows).select(*keep, vector_to_array("_leaf", "float32").alias("_from"))
    return told, lambda leaf: [(0, leaf.flatten().to_numpy().reshape(len(leaf), -1).astype(np.int64))] if len(leaf) else []


def round_cells(model: Model, rows: DataFrame, rounds: Sequence[int], centre: float, bins: int = 2048, label: str = "target") -> DataFrame:
    """(round, bin, pos, n): rows and positives by round and by bin of their margin after it.

    A row falls through all trees once. A task counts all rounds of its rows in one array and returns its filled cells, so what is
    shuffled grows with tasks x rounds x bins and not with rows x rounds. Bins are equal steps of the probability that a margin stands for once
    the odds at `centre` are moved to even, which spreads the scores of rare positives over all bins.
    """
    values, starts = _leaf_tables(model)
    chosen = np.array([r for r in rounds if r <= len(starts)], np.int64)
    step = max(1, (1 << 20) // len(starts))
    leaves, reached = _leaves(model, rows.withColumn("_y", F.col(label).cast("int")), "_y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, len(chosen) * bins), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                labels = part.column("_y").to_numpy()
                for first, leaf in reached(part.column("_from")):
                    margin = np.cumsum(values[starts + leaf], axis=1)[:, chosen - 1]
                    even = 1.0 / (1.0 + np.exp(np.clip(-2.0 * (margin - centre), -700, 700)))
                    cell = np.minimum((even * bins).astype(np.int64), bins - 1) + bins * np.arange(len(chosen))
                    positive = labels[first : first + len(leaf)] == 1
                    for k in (0, 1):
                        counts[k] += np.bincount(cell[positive == k].ravel(), minlength=counts.shape[1])
        total = counts.sum(axis=0)
        filled = np.flatnonzero(total)
        columns = [pa.array(chosen[filled // bins].astype(np.int32)), pa.array((filled % bins).astype(np.int32)), pa.array(counts[1, filled]), pa.array(total[filled])]
        yield pa.RecordBatch.from_arrays(columns, names=["round", "bin", "pos", "n"])

    counted = leaves.mapInArrow(run, "round int, bin int, pos long, n long")
    return counted.groupBy("round", "bin").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))


def auc_of_bins(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., n_rows, n_pos, auc, auc_error) of (by, bin, pos, n) cells, with pairs in one bin counted half.

    The AUC of the unbinned scores differs from `auc` by at most `auc_error`, half the share of pairs of a positive and a negative that meet in a
    bin. The windows hold at most one row per bin.
    """
    before = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    neg = F.col("n") - F.col("pos")
    ranked = cells.withColumn("_below", F.coalesce(F.sum(neg).over(before), F.lit(0)))
    wide = "decimal(38,0)"
    won = F.col("pos").cast("decimal(18,0)") * (2 * F.col("_below") + neg).cast("decimal(18,0)")
    tied = F.col("pos").cast("decimal(18,0)") * neg.cast("decimal(18,0)")
    sums = ranked.groupBy(*by).agg(
        F.sum("n").alias("n_rows"), F.sum("pos").alias("n_pos"), F.sum(won.cast(wide)).alias("_won"), F.sum(tied.cast(wide)).alias("_tied")
    )
    pairs = 2 * F.col("n_pos").cast("double") * (F.col("n_rows") - F.col("n_pos")).cast("double")
    share = lambda c: F.when(pairs > 0, F.col(c).cast("double") / pairs)
    return sums.select(*by, "n_rows", "n_pos", share("_won").alias("auc"), share("_tied").alias("auc_error"))


def round_scores(result: OofResult, train: DataFrame, rounds: Sequence[int], prepare: Prepare | None = None,
                 label: str = "target", fold: str = "fold", bins: int = 2048) -> DataFrame:
    """(fold, round, n_rows, n_pos, auc, auc_error): validation AUC of the boosted models cut after each of `rounds` trees."""
    ready = prepare or (lambda df, j: df)
    facts = fold_facts(train, label, fold)
    rate = sum(f.positives for f in facts.values()) / max(1, sum(f.rows for f in facts.values()))
    centre = 0.5 * np.log(rate / (1 - rate)) if 0 < rate < 1 else 0.0
    kind = train.schema[fold].dataType
    parts = [
        round_cells(models[0], ready(train.where(F.col(fold) == j), j), rounds, centre, bins, label).select(F.lit(j).cast(kind).alias(fold), "round", "bin", "pos", "n")
        for j, models in result.models.items()
    ]
    return auc_of_bins(reduce(DataFrame.unionByName, parts), [fold, "round"])


def _margins_at(at: int, values: np.ndarray, starts: np.ndarray, reached: Callable) -> Callable[[str], Column]:
    """Sum of the first `at` trees' leaf values."""

    @F.arrow_udf("double")
    def margin(leaf: pa.Array) -> pa.Array:
        out = np.zeros(len(leaf))
        for first, part in reached(leaf):
            out[first : first + len(part)] = values[starts[:at] + part[:, :at]].sum(axis=1)
        return pa.array(out)

    return margin


def round_margins(result: OofResult, train: DataFrame, at: int, prepare: Prepare | None = None,
                  label: str = "target", fold: str = "fold", id: str = "id") -> DataFrame:
    """(id, fold, label, margin) of the validation rows of every fold after `at` rounds."""
    ready = prepare or (lambda df, j: df)
    parts = []
    for j, models in result.models.items():
        values, starts = _leaf_tables(models[0])
        if at > len(starts):
            raise ValueError(f"{at} rounds of {len(starts)}")
        leaves, reached = _leaves(models[0], ready(train.where(F.col(fold) == j), j), id, fold, label)
        parts.append(leaves.select(id, fold, label, _margins_at(at, values, starts, reached)("_from").alias("margin")))
    return reduce(DataFrame.unionByName, parts)


def training_scores(result: OofResult, train: DataFrame, prepare: Prepare | None = None, label: str = "target", fold: str = "fold") -> DataFrame:
    """(fold, n_rows, n_pos, gini) of every fold's model on the rows that it was fitted on: how much more it knows of them."""
    ready = prepare or (lambda df, j: df)
    parts = None
    for j, models in result.models.items():
        seen = ready(train.where(F.col(fold) != j), j).withColumn(fold, F.lit(j))
        part = mean_score(result.learner, models, seen).select(fold, F.col(label).alias("target"), "prediction")
        parts = part if parts is None else parts.unionByName(part)
    return gini(parts, "target", "prediction", [fold])
