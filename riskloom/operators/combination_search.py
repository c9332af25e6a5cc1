"""Search for column combinations by refits of any learner on target means: a combination stays if the score grows.

Every trial is a row of a log table that is only appended to; a search that was broken off goes on where the log ends.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalars import combine_key
from riskloom.operators.counted_forest import COUNT_FROM, counted_rows
from riskloom.operators.encoders import MEAN_WEIGHT, TargetMean
from riskloom.operators.learners import Learner
from riskloom.operators.metrics import POOLED, gini_by_fold
from riskloom.operators.oof import Metric, oof_predict
from riskloom.plans.materialize import exists, materialize

LOG = "step int, combination string, score double, best_before double, kept int, settings string"
BASE = -1  # step of the model without combinations


def combination_name(columns: Sequence[str]) -> str:
    return "_plus_".join(columns)


@dataclass
class CombinationMeans:
    """Rows with the base columns and, per combination, an array with its target mean outside every fold."""

    rows: DataFrame
    base: list[str]
    combinations: list[str]
    m: float | None

    def features(self, df: DataFrame, chosen: Sequence[str], j: int) -> DataFrame:
        """One vector of the base columns and the chosen combinations' means outside fold j."""
        kept = [F.col(f"`{c}`") for c in df.columns if c not in {*self.base, *self.combinations}]
        picked = df.select(*kept, *self.base, *[F.col(f"`{c}`")[j].alias(c) for c in chosen])
        return VectorAssembler(inputCols=[*self.base, *chosen], outputCol="features").transform(picked)


def combination_means(
    train: DataFrame, base: Sequence[str], candidates: Sequence[Sequence[str]], label: str = "target", m: float | None = MEAN_WEIGHT
) -> CombinationMeans:
    """Target means of all candidates (two or more columns each) from one vocabulary pass, looked up once and written.

    `train` has id, fold and the label. Trials then only select columns, so neither the passes over the rows nor the plan grow
    with the number of trials.
    """
    names = [combination_name(c) for c in candidates]
    if len(set(names)) != len(names) or any(len(set(c)) < 2 for c in candidates):
        raise ValueError("candidates are different combinations of two or more columns")
    joined = []
    for columns, name in zip(candidates, names):
        key = combine_key(columns[0], columns[1])
        for c in columns[2:]:
            key = combine_key(key, c)
        joined.append(key.alias(name))
    df = train.select("id", F.col(label).alias("target"), "fold", *base, *joined)
    if names:
        k = len(df.select("fold").distinct().collect())
        means = TargetMean(names, m, suffix="_each").fit(df, fold="fold", k=k)
        df = means.transform(df, "each").select("id", "target", "fold", *base, *[F.col(f"`{c}_each`").alias(c) for c in names])
    return CombinationMeans(materialize(df, "combinations", ["fold"]), list(base), names, m)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The trials of a search so far: none if there is no log yet."""
    return spark.read.schema(LOG).parquet(path) if exists(spark, path) else spark.createDataFrame([], LOG)


def keep_if_improves(
    tables: CombinationMeans, learner: Learner, log: str, min_gain: float = 0.0, metric: Metric = gini_by_fold, value: str = "gini",
    smaller_is_better: bool = False, count_from: int = COUNT_FROM,
) -> DataFrame:
    """Try the candidates in their order; one stays if the pooled out-of-fold score beats the best so far by more than `min_gain`.

    Returns the log at `log` (a path every executor can reach): step -1 is the model without combinations. Each row is appended after its
    fits, so a restart repeats at most one trial; it refuses a log that was begun with a learner of another name, another base, candidate list, metric or limit. A
    null score (one class only) never improves anything.

    From `count_from` rows on, forests are fitted on distinct rows with counts where those are far fewer (`operators/counted_forest.py`), so that the fits do not grow with the
    rows: the columns and means that trials choose from have few values in common.
    """
    spark = tables.rows.sparkSession
    settings = str((learner.name, tables.base, tables.combinations, tables.m, min_gain, value, smaller_is_better))
    done = sorted(read_log(spark, log).collect(), key=lambda r: r["step"])  # a row per candidate
    if any(r["settings"] != settings for r in done):
        raise ValueError(f"{log} was begun with other settings")
    chosen = [r["combination"] for r in done if r["kept"] and r["step"] > BASE]
    best = next((r["score"] for r in reversed(done) if r["kept"]), None)

    left = len(tables.combinations) + 1 - len(done)
    counted = counted_rows(tables.rows, ["target", "fold", *tables.base, *tables.combinations], learner, count_from=count_from) if left else None

    def rate(columns: Sequence[str]) -> float | None:
        if counted is not None:
            scores = metric(counted.scored(lambda df, j: tables.features(df, columns, j)), "target", "prediction")
        else:
            scores = oof_predict(tables.rows, learner, prepare=lambda df, j: tables.features(df, columns, j), store=False).scores(metric)
        return next(r[value] for r in scores.collect() if r["fold"] == POOLED)

    for step in range(len(done) - 1, len(tables.combinations)):
        name = tables.combinations[step] if step > BASE else None
        score = rate([*chosen, name] if name else chosen)
        gain = None if score is None or best is None else (best - score if smaller_is_better else score - best)
        kept = name is None or (score is not None and (best is None or gain > min_gain))
        row = (step, name, score, best, int(kept), settings)
        spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(log)
        if kept:
            best = score
            chosen += [name] if name else []
    return read_log(spark, log)
