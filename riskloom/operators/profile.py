"""Table profiles: cardinality, missing values, class balance, value support, pair usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import MISSING, missing_flag
from riskloom.plans.vocabulary import long_values


def group_mean(df: DataFrame, key: str, label: str = "target") -> DataFrame:
    """Rows, positives and mean target per value, next to the overall mean."""
    groups = df.groupBy(F.col(key).alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"), F.avg(label).alias("mean")
    )
    return groups.withColumn("prior", df.agg(F.avg(label)).scalar())


def cardinality_profile(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values per column in train, in test and in both together."""
    keep = ["_tr"]
    both = train.select(F.lit(1).alias("_tr"), *cols).unionByName(test.select(F.lit(0).alias("_tr"), *cols))
    seen = long_values(both, cols, keep).groupBy("feature", "value").agg(
        F.max("_tr").alias("in_train"), F.max(1 - F.col("_tr")).alias("in_test")
    )
    return seen.groupBy("feature").agg(
        F.sum("in_train").alias("n_train_values"),
        F.sum("in_test").alias("n_test_values"),
        F.count(F.lit(1)).alias("n_values"),
    )


def missing_profile(df: DataFrame, cols: Sequence[str], sentinel: int = MISSING) -> DataFrame:
    """(feature, has_missing, n_missing) from a single aggregation over all columns."""
    flat = df.agg(*[F.sum(missing_flag(c, sentinel)).cast("long").alias(c) for c in cols])
    long = flat.unpivot([], list(cols), "feature", "n_missing")
    return long.select("feature", (F.col("n_missing") > 0).cast("int").alias("has_missing"), "n_missing")


def balanced_weights(df: DataFrame, label: str = "target") -> DataFrame:
    """n / (2 * class count) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    weight = counts.agg(F.sum("n")).scalar() / (2.0 * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))


def value_support(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per value in train and test (column sums of the one-hot matrix, without building it)."""
    both = train.select(F.lit(1).alias("_tr"), *cols).unionByName(test.select(F.lit(0).alias("_tr"), *cols))
    return long_values(both, cols, ["_tr"]).groupBy("feature", "value").agg(
        F.sum("_tr").cast("long").alias("n_train"), F.sum(1 - F.col("_tr")).cast("long").alias("n_test")
    )


def pair_usage(pairs: DataFrame) -> DataFrame:
    """How often each feature occurs in a (f1, f2) table, most used first."""
    return (
        pairs.select(F.explode(F.array("f1", "f2")).alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n_pairs"))
        .orderBy(F.desc("n_pairs"), "feature")
    )
