"""Joining fitted per-value tables back to the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only below this number of rows (about 20 MB of long keys and doubles).
MAX_BROADCAST_ROWS = 200_000
# A value is hot when it covers more than this share of all rows; hence there are at most 1 / share hot values.
HOT_SHARE = 0.001


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    key: str,
    outputs: dict[str, tuple[str, Column]],
    rows: int,
    total: int,
    spread: str = "id",
    limit: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Left-join `table` (columns `key_`, `weight_` and payload) on `df[key]`.

    outputs: new column -> (payload column, value for keys that are not in the table).
    rows: known number of table rows; total: sum of `weight_`, the rows behind the table.

    Up to `limit` rows the table is broadcast. Beyond that the few hot values are broadcast (their number is bounded
    by 1 / HOT_SHARE), and only rows with other values are shuffled on the key; rows already served, or without a
    key, are spread by `spread`. So no task receives more than its share, however skewed the values are.
    """
    payload = sorted({src for src, _ in outputs.values()})

    def side(t: DataFrame, mark: str, *more: str) -> DataFrame:
        return t.selectExpr("key_ AS _key", f"true AS {mark}", *[f"{p} AS {mark}_{p}" for p in payload], *more)

    left = df.withColumn("_key", F.col(f"`{key}`"))
    if rows <= limit:
        joined = left.join(F.broadcast(side(table, "_h")), "_key", "left")
        new = {name: F.when(F.col("_h"), F.col(f"_h_{src}")).otherwise(default) for name, (src, default) in outputs.items()}
        return joined.withColumns(new).drop("_key", "_h", *[f"_h_{p}" for p in payload])

    is_hot = f"weight_ >= {max(1.0, HOT_SHARE * total)!r}D"
    served = left.join(F.broadcast(side(table.where(is_hot), "_h")), "_key", "left")
    spared = F.col("_h").isNotNull() | F.col("_key").isNull()
    salt = F.when(spared, F.xxhash64(F.col(spread)).bitwiseOR(F.lit(1))).otherwise(0)  # odd, so never the 0 of the table
    served = served.withColumns({"_salt": salt, "_key": F.when(~spared, F.col("_key"))})
    cold = side(table.where(f"NOT ({is_hot})"), "_c", "0L AS _salt")
    joined = served.join(cold, ["_key", "_salt"], "left")
    new = {
        name: F.when(F.col("_h"), F.col(f"_h_{src}")).when(F.col("_c"), F.col(f"_c_{src}")).otherwise(default)
        for name, (src, default) in outputs.items()
    }
    return joined.withColumns(new).drop("_key", "_salt", "_h", "_c", *[f"{m}_{p}" for m in ("_h", "_c") for p in payload])
