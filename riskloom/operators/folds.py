"""Deterministic k-fold numbers, stratified or plain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_key(id: str, seed: int) -> Column:
    """Seeded pseudo-random text that orders the rows the same way on every run and in every engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id).cast("string")))


def _slice_of(key: Column, digits: int) -> Column:
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("int")


def assign_folds(
    df: DataFrame,
    id: str = "id",
    k: int = 5,
    seed: int = 15,
    stratify: str | None = "target",
    exact: bool = True,
    name: str = "fold",
    digits: int = 4,
) -> DataFrame:
    """Add a fold number in 0..k-1.

    Exact mode shuffles inside each class (by `shuffle_key`) and deals the rows out in turn, so fold sizes differ by
    at most one per class. A class may hold nearly all rows, so it is never one window group: the hash is uniform,
    hence its first `digits` hex digits cut every class into 16**digits even slices; row numbers are taken inside a
    slice and shifted by the sizes of the slices before it. That table (classes x 16**digits rows) is joined on the same
    keys the rows are already partitioned by, so the rows are shuffled once.
    With exact=False the fold is a hash of the id: no shuffle at all, fold sizes equal only on average.
    """
    key = shuffle_key(id, seed)
    if not exact:
        return df.withColumn(name, F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), F.lit(k)).cast("int"))
    # a text that is never null, so that window and join agree on one partitioning
    kind = F.concat(F.lit("="), F.coalesce(F.col(stratify).cast("string"), F.lit("")), F.col(stratify).isNull().cast("string")) if stratify else F.lit("=")
    slices = df.select(kind.alias("_class"), _slice_of(key, digits).alias("_slice")).groupBy("_slice", "_class").agg(
        F.count(F.lit(1)).alias("_n")
    )
    earlier = Window.partitionBy("_class").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select("_class", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_slice", "_class").orderBy("_key", id)  # the slice first: a sort tells rows apart by a number
    ranked = (
        df.withColumns({"_class": kind, "_key": key})
        .withColumn("_slice", _slice_of(F.col("_key"), digits))
        .withColumn("_at", F.row_number().over(inside) - 1)
    )
    return ranked.join(offsets, ["_slice", "_class"]).select(
        *df.columns, F.pmod(F.col("_before") + F.col("_at"), F.lit(k)).cast("int").alias(name)
    )


def seeded_shuffle(df: DataFrame, id: str = "id", seed: int = 15) -> DataFrame:
    """Rows in a reproducible random order (a global sort: only for consumers that depend on order)."""
    return df.orderBy(shuffle_key(id, seed), id)


def training_part(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.where(F.col(name) != fold)


def validation_part(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.where(F.col(name) == fold)
