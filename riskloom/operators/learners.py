"""Model families as recipes for `pyspark.ml` estimators.

A learner says how to build its estimator from two facts of the training rows (their number and positives), how to
weight rows, and how to read a score from the fitted model's output.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    FMClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import class_weight, sigmoid
from riskloom.operators.shared_nets import Net
from riskloom.operators.shared_sweep import Convex
from riskloom.operators.shared_trees import Trees, share_of

LABEL, FEATURES, WEIGHT = "_label", "features", "_weight"


@dataclass(frozen=True)
class Facts:
    rows: int
    positives: int

    @property
    def rate(self) -> float:
        return self.positives / self.rows


@dataclass(frozen=True)
class CountedTrees:
    """A forest whose trees may be fitted one by one on distinct rows, weighted by how many of each the tree's bag holds."""

    trees: int
    bag: float
    build: Callable[[float, int], Estimator]  # (rows of the bag, seed)


@dataclass(frozen=True)
class Learner:
    name: str
    build: Callable[[Facts, int], Estimator]  # (facts, seed)
    weight: Callable[[Facts, str], Column] | None = None
    label: Callable[[str], Column] = lambda y: F.col(y).cast("double")
    margin: bool = False  # score is a sigmoid of a regression output
    seeds: Sequence[int] = (0,)
    convex: Convex | None = None  # what the estimator minimises, if sweeps may fit it next to others in the same passes
    counted: CountedTrees | None = None  # the same model on distinct rows with counts, if there is such a form
    net: Net | None = None  # what the estimator minimises, if all folds and bags may be fitted in the same passes
    trees: int = 0  # trees of a boosted model
    grown: Trees | None = None  # the same trees, if those of all folds may be grown in the same passes

    def bag(self, n: int) -> Learner:
        """The same learner fitted with n seeds, scores averaged."""
        return replace(self, seeds=tuple(range(n)))

    def fit(self, rows: DataFrame, facts: Facts, label: str) -> list[Model]:
        rows = rows.withColumn(LABEL, self.label(label))
        if self.weight is not None:
            rows = rows.withColumn(WEIGHT, self.weight(facts, label))
        return [self.build(facts, seed).fit(rows) for seed in self.seeds]

    def score(self, model: Model, df: DataFrame, name: str) -> DataFrame:
        out = model.transform(df)
        value = sigmoid("prediction") if self.margin else vector_to_array("probability")[1]
        return out.select(*[F.col(f"`{c}`") for c in df.columns], value.alias(name))


def mean_score(learner: Learner, models: Sequence[Model], df: DataFrame, name: str = "prediction") -> DataFrame:
    """Average score of several models, computed row by row (one column per model, no shuffle)."""
    parts = [f"_score{i}" for i in range(len(models))]
    keep = [F.col(f"`{c}`") for c in df.columns]
    for part, model in zip(parts, models):
        df = learner.score(model, df, part)
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.select(*keep, (total / len(parts)).alias(name))


def _balanced(facts: Facts, label: str) -> Column:
    return class_weight(label, facts.rate)


def _ones(facts: Facts, label: str) -> Column:
    return F.lit(1.0)


def logistic(c: float = 0.1, max_iter: int = 300, balanced: bool = True) -> Learner:
    """L2 logistic regression with inverse strength c (intercept not penalised)."""
    return Learner(
        "logistic",
        lambda facts, seed: LogisticRegression(
            labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, maxIter=max_iter,
            regParam=1.0 / (c * facts.rows), elasticNetParam=0.0, standardization=False,
        ),
        _balanced if balanced else _ones,
    )


def sgd_logistic(alpha: float = 0.002, positive_weight: float = 1.0, max_iter: int = 50) -> Learner:
    """L2 logistic regression with per-row penalty alpha; positives may carry another weight (mean weight is 1)."""

    def weight(facts: Facts, label: str) -> Column:
        mean = (facts.positives * positive_weight + facts.rows - facts.positives) / facts.rows
        return F.when(F.col(label) == 1, positive_weight / mean).otherwise(1.0 / mean)

    return Learner(
        "sgd_logistic",
        lambda facts, seed: LogisticRegression(
            labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, maxIter=max_iter, regParam=alpha,
            elasticNetParam=0.0, standardization=False,
        ),
        weight,
        convex=Convex(alpha, positive_weight, max_iter),
    )


def ridge(alpha: float = 3000.0, solver: str = "auto") -> Learner:
    """Balanced ridge regression on labels -1/+1; the score is a sigmoid of the decision value. Spark chooses the solver."""
    return Learner(
        "ridge",
        lambda facts, seed: LinearRegression(
            labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, regParam=alpha / facts.rows, elasticNetParam=0.0,
            standardization=False, solver=solver,
        ),
        _balanced,
        label=lambda y: (2 * F.col(y) - 1).cast("double"),
        margin=True,
    )


def boosted_trees(trees: int = 370, depth: int = 4, step: float = 0.07, subsample: float = 0.9, columns: str = "0.8",
                  min_rows: int = 1, positive_weight: float = 1.6, name: str = "boosted_trees") -> Learner:
    """Gradient-boosted trees; leaf penalties and leaf-wise growth have no counterpart in `pyspark.ml`."""
    share = share_of(columns)
    return Learner(
        name,
        lambda facts, seed: GBTClassifier(
            labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, maxIter=trees, maxDepth=depth, stepSize=step,
            subsamplingRate=subsample, featureSubsetStrategy=columns, minInstancesPerNode=min_rows, seed=seed,
        ),
        lambda facts, label: F.when(F.col(label) == 1, positive_weight).otherwise(1.0),
        trees=trees,
        grown=None if share is None else Trees(trees, depth, share, min_rows, subsample, step, positive_weight),
    )


def boosted_leaves(trees: int = 500) -> Learner:
    """Preset of the full feature set: 20-leaf trees, small steps (depth 5 is the nearest limit)."""
    return boosted_trees(trees, 5, 0.03, 0.8, "0.8", 10, 1.0, "boosted_leaves")


def regularized_forest(trees: int = 125) -> Learner:
    """Preset of about 1000 leaves in total: 8-leaf trees, large steps."""
    return boosted_trees(trees, 3, 0.5, 1.0, "all", 10, 1.0, "regularized_forest")


def random_forest(trees: int = 400, depth: int = 10, bag: float = 0.632, columns: str = "0.6", min_rows: int = 30,
                  min_gain: float = 0.0) -> Learner:
    def tree(rows: float, seed: int) -> Estimator:
        splits = rows >= 2 * min_rows  # the least node is told as a share, which has to be under one half
        return RandomForestClassifier(
            labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, numTrees=1, maxDepth=depth if splits else 0, subsamplingRate=1.0, bootstrap=False,
            featureSubsetStrategy=columns, minInstancesPerNode=1, minWeightFractionPerNode=min((min_rows - 0.5) / rows, 0.4999) if splits else 0.0,
            minInfoGain=min_gain, seed=seed,
        )

    return Learner(
        "random_forest",
        lambda facts, seed: RandomForestClassifier(
            labelCol=LABEL, featuresCol=FEATURES, numTrees=trees, maxDepth=depth, subsamplingRate=bag,
            featureSubsetStrategy=columns, minInstancesPerNode=min_rows, minInfoGain=min_gain, seed=seed,
        ),
        counted=CountedTrees(trees, bag, tree),
    )


def feed_forward(inputs: int, hidden: Sequence[int] = (50, 25), iterations: int = 20, bags: int = 5) -> Learner:
    return Learner(
        "feed_forward",
        lambda facts, seed: MultilayerPerceptronClassifier(
            labelCol=LABEL, featuresCol=FEATURES, layers=[inputs, *hidden, 2], maxIter=iterations, blockSize=512, seed=seed
        ),
        net=Net(tuple(hidden), iterations),
    ).bag(bags)


def factorization(factors: int = 4, step: float = 0.1, reg: float = 2e-6, iterations: int = 11) -> Learner:
    return Learner(
        "factorization",
        lambda facts, seed: FMClassifier(
            labelCol=LABEL, featuresCol=FEATURES, factorSize=factors, stepSize=step, regParam=reg, maxIter=iterations, seed=seed
        ),
    )
