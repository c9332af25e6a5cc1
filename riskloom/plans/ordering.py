"""Positions and running totals over a total order without a one-task window.

A global sort range-partitions the rows. The row's partition and place inside it are written with the rows,
so the partition boundaries stay fixed afterwards. What crosses partitions is one small row per partition
(and group), which is the only thing that is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.plans.materialize import materialize

# monotonically_increasing_id() keeps the partition number above this bit
PARTITION_BIT = 33
# offsets are broadcast up to this many rows (a few MB)
MAX_OFFSETS = 200_000


def _placed(df: DataFrame, keys: Sequence[Column], by: Sequence[str]) -> DataFrame:
    ordered = df.orderBy(*[F.col(b) for b in by], *keys)
    placed = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    return placed.withColumn("_range", F.shiftright("_place", PARTITION_BIT))


def _earlier(by: Sequence[str]) -> Window:
    group = [F.col(b) for b in by] or [F.lit(0)]
    return Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def _same_range(by: Sequence[str]) -> Column:
    """Null-safe match of rows with the `_o_` columns of their range, so that a null group is kept."""
    match = F.col("_range") == F.col("_o_range")
    for i, b in enumerate(by):
        match = match & F.col(b).eqNullSafe(F.col(f"_o_{i}"))
    return match


def _renamed(by: Sequence[str]) -> list[Column]:
    return [*[F.col(b).alias(f"_o_{i}") for i, b in enumerate(by)], F.col("_range").alias("_o_range")]


def global_rank(df: DataFrame, keys: Sequence[Column], by: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Zero-based position of each row in the order of `keys` within `by` (keys must be unique there).

    The offsets are one row per group and range partition; they are broadcast if they are few, else joined by shuffle.
    """
    placed = _placed(df, keys, by)
    ranges = placed.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    shift = F.coalesce(F.sum("_n").over(_earlier(by)), F.lit(0)) - F.col("_first")
    ranges = materialize(ranges.select(*_renamed(by), shift.alias("_shift")), "ranges")
    if ranges.count() <= MAX_OFFSETS:  # read from the files' footers
        ranges = F.broadcast(ranges)
    return (
        placed.join(ranges, _same_range(by))
        .withColumn(name, F.col("_place") + F.col("_shift"))
        .select(*df.columns, name)
    )


def running_totals(
    df: DataFrame, keys: Sequence[Column], values: Sequence[str], by: Sequence[str] = (), prefix: str = "cum_"
) -> DataFrame:
    """Sum of each of `values` over all rows up to and including this one, in the order of `keys` within `by`.

    The running sum inside a range already partitions the rows by (by, range), so joining the totals of the earlier
    ranges needs no further shuffle of the rows.
    """
    placed = _placed(df, keys, by)
    sums = [F.sum(v).alias(f"_t_{v}") for v in values]
    ranges = placed.groupBy(*by, "_range").agg(*sums)
    before = [F.coalesce(F.sum(f"_t_{v}").over(_earlier(by)), F.lit(0)).alias(f"_b_{v}") for v in values]
    ranges = ranges.select(*_renamed(by), *before)
    inside = Window.partitionBy(*by, "_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(v).over(inside).alias(f"_l_{v}") for v in values])
    return local.join(ranges, _same_range(by)).select(
        *df.columns, *[(F.col(f"_b_{v}") + F.col(f"_l_{v}")).alias(f"{prefix}{v}") for v in values]
    )
