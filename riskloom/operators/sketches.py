"""Distinct values from HyperLogLog sketches that are kept as a table and merged, so that no part is scanned twice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.columns import HIGH_CARDINALITY, LOW_CARDINALITY
from riskloom.plans.vocabulary import long_values

# size of a sketch: 2^12 registers, at most 4 KB
LG_REGISTERS = 12
# standard errors on either side that an estimate is trusted for
SIGMAS = 4


def relative_error(lg: int = LG_REGISTERS) -> float:
    """Standard error of an estimate from merged sketches, as a share of the true count."""
    return 1.04 / 2 ** (lg / 2)


def value_sketches(df: DataFrame, cols: Sequence[str], part: str = "part", lg: int = LG_REGISTERS) -> DataFrame:
    """(feature, part, sketch): one sketch per column and part from one scan; tasks send one sketch per column and part they have met.

    Values are told apart by their exact text, as in a vocabulary; nulls are no value. Keep the result: sketches of parts that come later are
    simply added to it.
    """
    long = long_values(df, cols, [part])
    return long.groupBy("feature", part).agg(F.hll_sketch_agg("value", lg).alias("sketch"))


def merged(sketches: DataFrame, groups: Mapping[str, Sequence[str]], part: str = "part", lg: int = LG_REGISTERS) -> DataFrame:
    """(feature, group, estimate, low, high) for named unions of parts, e.g. {"both": ["train", "test"]}; the rows are not looked at again.

    The true count lies in low..high but for about one estimate in 16,000 (four standard errors).
    """
    named = F.map_from_entries(F.array(*[F.struct(F.lit(g), F.array(*map(F.lit, parts))) for g, parts in groups.items()]))
    rows = sketches.select("feature", part, "sketch", F.explode(named).alias("group", "_parts")).where(F.array_contains("_parts", F.col(part)))
    found = rows.groupBy("feature", "group").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    spread = SIGMAS * relative_error(lg)
    low = F.floor(F.col("estimate") / (1 + spread)).alias("low")
    return found.select("feature", "group", "estimate", low, F.ceil(F.col("estimate") / (1 - spread)).alias("high"))


def route_by_sketches(
    df: DataFrame, sketches: DataFrame, groups: Mapping[str, Sequence[str]], part: str = "part", low: int = LOW_CARDINALITY, high: int = HIGH_CARDINALITY
) -> DataFrame:
    """(feature, group, route), the same as by exact counts: only columns whose bounds have a limit between them are counted exactly.

    That recount is one pass over the undecided columns; none if there are none.
    """
    n = F.col("n")
    routed = F.when(n <= low, "passthrough").when(n < high, "onehot").otherwise("drop")
    rated = merged(sketches, groups, part)
    same = [(F.col("low") <= limit) == (F.col("high") <= limit) for limit in (low, high - 1)]
    sure = rated.where(same[0] & same[1]).select("feature", "group", F.col("estimate").alias("n"))
    open_ = [r["feature"] for r in rated.where(~(same[0] & same[1])).select("feature").distinct().collect()]  # names of columns
    if open_:
        named = F.map_from_entries(F.array(*[F.struct(F.lit(g), F.array(*map(F.lit, parts))) for g, parts in groups.items()]))
        values = long_values(df, open_, [part]).select("feature", "value", part).distinct()
        spread = values.select("feature", "value", part, F.explode(named).alias("group", "_parts")).where(F.array_contains("_parts", F.col(part)))
        exact = spread.select("feature", "group", "value").distinct().groupBy("feature", "group").agg(F.count(F.lit(1)).alias("n"))
        undecided = rated.where(~(same[0] & same[1])).select("feature", "group")
        sure = sure.unionByName(exact.join(undecided, ["feature", "group"]))
    return sure.select("feature", "group", routed.alias("route"))
