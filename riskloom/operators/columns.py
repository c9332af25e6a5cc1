"""Column roles, column selection, sentinel handling and train/test unions. Only metadata reaches the driver."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import MISSING, is_sentinel, missing_flag

# fixed values: cardinality limits of the one-hot routing
LOW_CARDINALITY = 2
HIGH_CARDINALITY = 110


@dataclass(frozen=True)
class Roles:
    """Column roles read off the names."""

    categorical: list[str]
    binary: list[str]
    numeric: list[str]

    def as_rows(self) -> list[tuple[str, str]]:
        named = [("categorical", self.categorical), ("binary", self.binary), ("numeric", self.numeric)]
        return [(c, role) for role, cols in named for c in cols]


def column_roles(columns: Sequence[str], skip: Sequence[str] = ("id", "target", "fold", "is_test")) -> Roles:
    """`_cat` anywhere in the name is categorical (so combinations of them are, too), `_bin` binary, the rest numeric."""
    used = [c for c in columns if c not in skip]
    cats = [c for c in used if "_cat" in c]
    bins = [c for c in used if "_bin" in c and c not in cats]
    return Roles(cats, bins, [c for c in used if c not in cats and c not in bins])


def drop_group(df: DataFrame, pattern: str, prefix: bool = False) -> DataFrame:
    """Drop columns whose name contains (or starts with) the pattern."""
    hit = [c for c in df.columns if (c.startswith(pattern) if prefix else pattern in c)]
    return df.drop(*hit)


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("id", "target", "fold")) -> DataFrame:
    wanted = [c for c in keep if c in df.columns] + list(features)
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")
    return df.select(*[F.col(f"`{c}`") for c in wanted])


def noise_columns(raw: Sequence[str], features: Sequence[str], keep: Sequence[str] = ("id", "target", "fold")) -> list[str]:
    """Columns to drop later: everything of the raw table outside the keep list. Take it before adding derived columns."""
    return [c for c in raw if c not in set(features) | set(keep)]


def replace_sentinel(df: DataFrame, to: int, cols: Sequence[str], sentinel: int = MISSING) -> DataFrame:
    """Replace the sentinel, in text columns as text."""
    swap = {c: F.when(is_sentinel(c, sentinel), F.lit(to).cast(df.schema[c].dataType)).otherwise(F.col(f"`{c}`")) for c in cols}
    return df.withColumns(swap)


def cardinalities(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> dict[str, int]:
    """Distinct values per column.

    Exact counts first reduce to distinct (column, value) pairs, which pre-aggregate before the shuffle and spread one
    big column over all tasks; `approximate` keeps only sketches.
    """
    if approximate:
        row = df.agg(*[F.approx_count_distinct(f"`{c}`").alias(f"n{i}") for i, c in enumerate(cols)]).first()
        return {c: row[f"n{i}"] for i, c in enumerate(cols)}
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]
    long = df.select(F.inline(F.array(*pairs))).where("value IS NOT NULL").distinct()
    found = {r["feature"]: r["n"] for r in long.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(c, 0) for c in cols}


def route(n: int, low: int = LOW_CARDINALITY, high: int = HIGH_CARDINALITY) -> str:
    """`passthrough` for at most `low` values, `onehot` below `high`, `drop` from there on."""
    return "passthrough" if n <= low else "onehot" if n < high else "drop"


def route_by_cardinality(
    df: DataFrame, cols: Sequence[str], low: int = LOW_CARDINALITY, high: int = HIGH_CARDINALITY
) -> dict[str, str]:
    return {c: route(n, low, high) for c, n in cardinalities(df, cols).items()}


def missing_columns(df: DataFrame, cols: Sequence[str], sentinel: int = MISSING) -> list[str]:
    """Columns that hold the sentinel at least once (one pass over all of them)."""
    row = df.agg(*[F.max(missing_flag(c, sentinel)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"m{i}"] == 1]


def add_missing_flags(
    train: DataFrame, *others: DataFrame, cols: Sequence[str], sentinel: int = MISSING, detect: bool = True
) -> list[DataFrame]:
    """Add `<c>_miss` to every table for each column in which train holds the sentinel."""
    hit = missing_columns(train, cols, sentinel) if detect else list(cols)
    return [df.withColumns({f"{c}_miss": missing_flag(c, sentinel) for c in hit}) for df in (train, *others)]


def union_origin(train: DataFrame, test: DataFrame, target: str = "target", fill: int | None = None) -> DataFrame:
    """Train and test in one table with `is_test`; the missing target of test rows is null or a constant."""
    right = test.withColumn("is_test", F.lit(1))
    if fill is not None:
        right = right.withColumn(target, F.lit(fill))
    return train.withColumn("is_test", F.lit(0)).unionByName(right, allowMissingColumns=True)


def align_columns(train: DataFrame, test: DataFrame, target: str = "target") -> None:
    """Raise unless both tables have the same columns (apart from the target)."""
    left, right = set(train.columns) - {target, "fold"}, set(test.columns) - {target, "fold"}
    if left != right:
        raise ValueError(f"only in train: {sorted(left - right)}; only in test: {sorted(right - left)}")


def require_columns(df: DataFrame | None, *cols: str) -> None:
    """Precondition of the model jobs: the table is there and holds the named columns."""
    if df is None:
        raise ValueError("a table is required here")
    absent = [c for c in cols if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")
