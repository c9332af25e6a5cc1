"""Per-value statistics of many columns in one pass: the state behind every encoder.

Rows are unpivoted to (feature, value) and aggregated at once, so the shuffle carries one partial row per value and
task, also for a value that covers a third of the table. Leave-one-fold-out figures come from per-fold sums kept in
the same row (total minus fold), not from a pass per fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.lookup import lookup_join
from riskloom.plans.materialize import materialize
from riskloom.plans.ordering import global_rank

VALUE_COLUMNS = ["feature", "num", "real", "value"]


def value_kind(df: DataFrame, col: str) -> str:
    """"num" (integral), "real" (fractional) or "value" (text): the column of a vocabulary that holds values as they are."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        return "num"
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "real"
    if isinstance(kind, T.StringType):
        return "value"
    raise TypeError(f"{col}: {kind.simpleString()} columns cannot be encoded")


def real_text(col: str) -> str:
    """SQL for the text of a fractional value: shortest digits that read back as the same value, one zero."""
    return f"CAST(CAST(`{col}` AS DOUBLE) + 0D AS STRING)"


def long_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), totals: bool = False) -> DataFrame:
    """(feature, num, real, value, keep...) rows: `value` is the text of every value, num or real its number.

    With `totals` every row also counts for a feature without a name.
    """
    cells = ["struct('' AS feature, CAST(NULL AS BIGINT) AS num, CAST(NULL AS DOUBLE) AS real, '' AS value)"] if totals else []
    for c in cols:
        kind = value_kind(df, c)
        num = f"CAST(`{c}` AS BIGINT)" if kind == "num" else "CAST(NULL AS BIGINT)"
        real = f"CAST(`{c}` AS DOUBLE) + 0D" if kind == "real" else "CAST(NULL AS DOUBLE)"
        text = {"num": f"CAST({num} AS STRING)", "real": real_text(c), "value": f"`{c}`"}[kind]
        cells.append(f"struct('{c}' AS feature, {num} AS num, {real} AS real, {text} AS value)")
    return df.selectExpr(*[f"`{c}`" for c in keep], f"inline(array({', '.join(cells)}))").where("value IS NOT NULL")


@dataclass
class Vocabulary:
    """table: one row per (feature, value) with
    n_train, n_test, first_train, first_test (smallest id), and with a label pos (positives in train),
    and with folds fold_n, fold_pos (arrays over the folds, train only)."""

    table: DataFrame
    cols: list[str]
    kinds: dict[str, str]
    rows: dict[str, int]
    n_train: int
    n_test: int
    pos: int = 0
    fold_n: tuple[int, ...] = ()
    fold_pos: tuple[int, ...] = ()

    @property
    def total(self) -> int:
        return self.n_train + self.n_test

    def only(self, cols: Sequence[str]) -> Vocabulary:
        """The same statistics limited to some columns."""
        return replace(self, cols=list(cols), table=self.table.where(F.col("feature").isin(list(cols))))

    def attach(
        self,
        df: DataFrame,
        table: DataFrame,
        feature: str,
        outputs: dict[str, tuple[str, Column]],
        column: str | None = None,
        spread: str = "id",
    ) -> DataFrame:
        """Join one feature's rows of a table derived from `self.table` back to `df` (see lookup_join)."""
        key = "num" if self.kinds[feature] == "num" else "value"
        payload = sorted({src for src, _ in outputs.values()})
        side = table.where(F.col("feature") == feature).select(
            F.col(key).alias("key_"), (F.col("n_train") + F.col("n_test")).alias("weight_"), *payload
        )
        own = column or feature
        if self.kinds[feature] != "real":
            return lookup_join(df, side, own, outputs, self.rows[feature], self.total, spread)
        texts = df.withColumn("_real", F.expr(real_text(own)))
        return lookup_join(texts, side, "_real", outputs, self.rows[feature], self.total, spread).drop("_real")


def fit_vocabulary(
    train: DataFrame,
    test: DataFrame | None,
    cols: Sequence[str],
    label: str | None = None,
    fold: str | None = None,
    k: int = 5,
    id: str = "id",
) -> Vocabulary:
    """Collect the statistics of every value of `cols`; `test` may be None (fit on train only)."""
    cols = list(cols)
    kinds = {c: value_kind(train, c) for c in cols}
    y = f"CAST(`{label}` AS BIGINT)" if label else "CAST(NULL AS BIGINT)"
    own = f"CAST(`{fold}` AS INT)" if fold else "CAST(NULL AS INT)"
    names = [f"`{c}`" for c in cols]
    rows = train.selectExpr("1 AS _tr", f"`{id}` AS _id", f"{y} AS _y", f"{own} AS _k", *names)
    if test is not None:
        blank = ["0 AS _tr", f"`{id}` AS _id", "CAST(NULL AS BIGINT) AS _y", "CAST(NULL AS INT) AS _k"]
        rows = rows.unionByName(test.selectExpr(*blank, *names))
    js = range(k) if fold else range(0)
    long = long_values(rows, cols, ["_tr", "_id", "_y", "_k"], totals=True)
    aggs = [
        "CAST(sum(_tr) AS BIGINT) AS n_train",
        "CAST(sum(1 - _tr) AS BIGINT) AS n_test",
        "min(IF(_tr = 1, _id, NULL)) AS first_train",
        "min(IF(_tr = 0, _id, NULL)) AS first_test",
    ]
    if label:
        aggs.append("coalesce(sum(_y), 0L) AS pos")
    if fold:
        aggs.append(f"array({', '.join(f'sum(IF(_k = {j}, 1L, 0L))' for j in js)}) AS fold_n")
        aggs.append(f"array({', '.join(f'sum(IF(_k = {j}, coalesce(_y, 0L), 0L))' for j in js)}) AS fold_pos")
    stored = materialize(long.groupBy(*VALUE_COLUMNS).agg(*[F.expr(a) for a in aggs]), "vocabulary")
    table = stored.where("feature != ''")
    sizes = {r["feature"]: r["n"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = stored.where("feature = ''").first()  # none without rows
    return Vocabulary(
        table=table,
        cols=cols,
        kinds=kinds,
        rows={c: sizes.get(c, 0) for c in cols},
        n_train=total["n_train"] if total else 0,
        n_test=total["n_test"] if total else 0,
        pos=total["pos"] if total and label else 0,
        fold_n=(tuple(total["fold_n"]) if total else (0,) * k) if fold else (),
        fold_pos=(tuple(total["fold_pos"]) if total else (0,) * k) if fold else (),
    )


def sorted_codes(table: DataFrame, name: str = "code") -> DataFrame:
    """Dense codes from 0 per feature: numeric order for numbers, binary order for text."""
    return global_rank(table, [F.col("num"), F.col("real"), F.col("value")], ["feature"], name)


def first_seen_codes(table: DataFrame, name: str = "code") -> DataFrame:
    """Dense codes from 0 per feature by first appearance, train rows before test rows."""
    keys = [F.col("first_train").asc_nulls_last(), F.col("first_test"), F.col("num"), F.col("real"), F.col("value")]
    return global_rank(table, keys, ["feature"], name)
