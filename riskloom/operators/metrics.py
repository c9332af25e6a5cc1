"""Ranking and loss metrics as aggregations: Gini, AUC, log loss, fold summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import LOGLOSS_EPS, logloss
from riskloom.plans.ordering import global_rank, running_totals

POOLED = -1


def score_cells(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and rows per distinct score: all a ranking metric needs, pre-aggregated before the shuffle."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n")
    )


def gini_of_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Gini = 2 AUC - 1 with mid-rank ties from (by, score, pos, n) cells.

    Counts are kept as exact integers (decimals) up to the last division, so the result does not depend on the
    order of summation.
    """
    cells = cells.withColumn("neg", F.col("n") - F.col("pos"))
    ranked = running_totals(cells, [F.col("score")], ["neg"], by)
    wide = "decimal(38,0)"
    won = F.col("pos").cast("decimal(18,0)") * (2 * F.col("cum_neg") - F.col("neg")).cast("decimal(18,0)")
    totals = ranked.groupBy(*by).agg(
        F.sum(won.cast(wide)).alias("_won"), F.sum("pos").alias("_p"), F.sum("neg").alias("_q")
    )
    pairs = F.col("_p").cast("double") * F.col("_q").cast("double")
    rows = (F.col("_p") + F.col("_q")).alias("n_rows")
    value = F.when(pairs > 0, F.col("_won").cast("double") / pairs - 1.0)
    return totals.select(*by, rows, F.col("_p").alias("n_pos"), value.alias("gini"))


def gini(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n_rows, n_pos, gini)."""
    return gini_of_cells(score_cells(df, label, score, by), by)


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return gini(df, label, score, by).select(*by, "n_rows", "n_pos", ((F.col("gini") + 1.0) / 2.0).alias("auc"))


def gini_by_fold(df: DataFrame, label: str, score: str, fold: str = "fold") -> DataFrame:
    """Gini per fold and pooled (fold -1)."""
    return GINI.by_fold(df, label, score, fold)


def gini_normalized(df: DataFrame, label: str, score: str, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Gini of the prediction over Gini of the label itself, ties broken by id.

    The area under the running sum of positives is a sum over positives of (n - position), so only positions are
    needed, not a running sum. The label's own ordering has a closed form.
    """
    keys = [F.col(score).desc(), F.col(id)]
    placed = global_rank(df.select(*by, id, label, score), keys, by, "_at")
    wide = "decimal(38,0)"
    totals = placed.groupBy(*by).agg(
        F.sum(F.when(F.col(label) == 1, F.col("_at") + 1).otherwise(0).cast(wide)).alias("_places"),
        F.sum(F.col(label).cast("long")).alias("_p"),
        F.count(F.lit(1)).alias("_n"),
    )
    p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
    # sum over rows of the running share of positives, minus (n + 1) / 2, over n
    raw = ((n + 1.0) - F.col("_places").cast("double") / p - (n + 1.0) / 2.0) / n
    best = ((n + 1.0) - (p + 1.0) / 2.0 - (n + 1.0) / 2.0) / n
    return totals.select(*by, raw.alias("gini_raw"), (raw / best).alias("gini_normalized"))


def log_loss(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(logloss(score, label)).alias("log_loss"))


@dataclass(frozen=True)
class Metric:
    """A metric that is worked out from (score, pos, n) cells, which tasks build and Spark merges by adding them up.

    sign: 1 if more is better, -1 if less is. finish: cells and groups to (by..., n_rows, n_pos, value). term: for metrics that are means over the rows, what
    a cell adds to the sum; such a metric needs no order of the scores, so any number of trial scores are rated by plain sums. Scores have to be
    probabilities then. gain: what a gain of this metric is as a gain of AUC or of the mean loss, in which thresholds are given.
    """

    name: str
    sign: int
    finish: Callable[[DataFrame, Sequence[str]], DataFrame]
    term: Callable[[Column, Column, Column], Column] | None = None
    gain: float = 1.0

    def rate(self, cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """(by..., n_rows, n_pos, <name>)."""
        return self.finish(cells, by)

    def by_fold(self, df: DataFrame, label: str, score: str, fold: str = "fold") -> DataFrame:
        """One row per fold and one pooled row (fold -1). Rows are aggregated once; only score cells are doubled."""
        cells = score_cells(df, label, score, [fold])
        cells = cells.withColumn(fold, F.explode(F.array(F.col(fold), F.lit(POOLED).cast(df.schema[fold].dataType))))
        cells = cells.groupBy(fold, "score").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        return self.rate(cells, [fold])


def auc_of_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return gini_of_cells(cells, by).select(*by, "n_rows", "n_pos", ((F.col("gini") + 1.0) / 2.0).alias("auc"))


def cell_loss(score: Column, pos: Column, n: Column, eps: float = LOGLOSS_EPS) -> Column:
    """Log loss of a cell's rows together; a missing score has none."""
    p = F.greatest(F.least(score, F.lit(1.0 - eps)), F.lit(eps))
    return F.when(score.isNotNull(), -(pos * F.log(p) + (n - pos) * F.log(1.0 - p)))


def log_loss_of_cells(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    totals = cells.groupBy(*by).agg(
        F.sum("n").alias("n_rows"), F.sum("pos").alias("n_pos"), F.sum(cell_loss(F.col("score"), F.col("pos"), F.col("n"))).alias("_loss")
    )
    return totals.select(*by, "n_rows", "n_pos", (F.col("_loss") / F.col("n_rows")).alias("log_loss"))


GINI = Metric("gini", 1, gini_of_cells, gain=0.5)
AUC = Metric("auc", 1, auc_of_cells)
LOG_LOSS = Metric("log_loss", -1, log_loss_of_cells, cell_loss)


def fold_summary(scores: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.groupBy(*by).agg(
        F.avg(value).alias("mean_score"), F.stddev_pop(value).alias("std_score"), F.count(F.lit(1)).alias("folds")
    )
