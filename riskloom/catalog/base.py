"""Registry of queries and the SQL text they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.folds import assign_folds
from riskloom.operators.metrics import gini
from riskloom.plans.materialize import materialize
from riskloom.sources.order_risk import order_risk, split_origin

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with SQL over the same tables where SQL can express it."""

    def add(fn: Query) -> Query:
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return add


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_risk(spark, sf_dir)


def wide_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide table written once, for queries that read it several times."""
    return materialize(order_risk(spark, sf_dir), "wide")


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_origin(wide_stored(spark, sf_dir))


def hidden_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the unlabelled rows: known here, never shown to a model."""
    return order_risk(spark, sf_dir).where("is_test = 1").select("id", "target")


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with a stratified fold number."""
    return assign_folds(split_origin(order_risk(spark, sf_dir))[0])


FX = """
l AS (
  SELECT l_orderkey,
         CAST(COUNT(*) AS INT) AS n_lines,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
         MAX(l_discount) AS max_disc,
         MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_ret,
         MAX(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS has_f
  FROM lineitem GROUP BY l_orderkey),
b AS (
  SELECT o.o_orderkey AS id,
         CAST(('0x' || SUBSTR(MD5('t|' || CAST(o.o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) AS h,
         CAST(SUBSTR(o.o_orderpriority, 1, 1) AS INT) AS prio_cat,
         ASCII(o.o_orderstatus) AS status_cat,
         ASCII(c.c_mktsegment) AS seg_cat,
         c.c_nationkey AS nation_cat,
         o.o_custkey AS cust_cat,
         COALESCE(l.has_ret, -1) AS ret_bin,
         COALESCE(l.has_f, -1) AS fstat_bin,
         COALESCE(l.n_lines, -1) AS n_lines,
         CASE WHEN l.l_orderkey IS NULL THEN -1e0 ELSE SQRT(CAST(o.o_custkey AS DOUBLE)) / 4e1 END AS reg_03,
         COALESCE(l.sum_qty, -1e0) AS qty_12,
         o.o_totalprice AS price_13,
         c.c_acctbal AS bal_14,
         SQRT(CAST(COALESCE(l.n_lines, 0) AS DOUBLE)) AS root_15,
         COALESCE(l.max_disc, -1e0) AS calc_disc
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN l ON o.o_orderkey = l.l_orderkey),
fx AS (
  SELECT id,
         CASE WHEN h < 129000000 + (CASE WHEN prio_cat = 1 THEN 344000000 ELSE 0 END)
                                 + (CASE WHEN ret_bin = 1 THEN 172000000 ELSE 0 END)
                                 + (CASE WHEN prio_cat % 2 = nation_cat % 2 THEN 344000000 ELSE 0 END)
              THEN 1 ELSE 0 END AS target,
         CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS is_test,
         prio_cat, status_cat, seg_cat, nation_cat, cust_cat, ret_bin, fstat_bin, n_lines,
         reg_03, qty_12, price_13, bal_14, root_15, calc_disc
  FROM b)"""

FOLDS = """
tr AS (
  SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY target ORDER BY MD5('15:' || CAST(id AS VARCHAR)), id) - 1) % 5 AS INT)
            AS fold
  FROM fx WHERE is_test = 0)"""


def over_fx(body: str, *ctes: str) -> str:
    """SQL over the wide table; extra common table expressions come after it."""
    return "WITH " + ",\n".join([FX.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


def over_folds(body: str, *ctes: str) -> str:
    """SQL over `tr`, the labelled rows with their fold."""
    return over_fx(body, FOLDS, *ctes)


def long_sql(cols: list[str], source: str, keep: str) -> str:
    """UNION ALL that turns columns into (feature, num, value) rows."""
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS BIGINT) AS num, CAST({c} AS VARCHAR) AS value, {keep} FROM {source}"
        for c in cols
    )


def facts_sql(*flags: str, where: str = "tr", columns: str = "id, fold, target") -> str:
    """Rows of a model job as far as SQL knows them: keys, folds and labels, and flags that have to be true."""
    return over_folds(f"SELECT {', '.join([columns, *[f'TRUE AS {f}' for f in ('in_range', 'above_floor', *flags)]])} FROM {where}")


def with_facts(scored: DataFrame, floor: float, labels: DataFrame | None = None, flags: dict[str, bool] | None = None) -> DataFrame:
    """Keys, folds and labels of scored rows, whether each score is a probability, and whether their pooled Gini is over `floor`.

    `labels` (id, target) are given for unlabelled rows, whose labels the model has not seen.
    """
    rows = materialize(scored, "scored")
    rated = rows if labels is None else rows.join(labels, "id")
    pooled = gini(rated, "target", "prediction").first()["gini"]
    keys = [c for c in ("id", "fold", "target") if c in rows.columns]
    in_range = F.coalesce((F.col("prediction") >= 0) & (F.col("prediction") <= 1), F.lit(False)).alias("in_range")
    stated = {"above_floor": bool(pooled > floor), **(flags or {})}
    return rows.select(*keys, in_range, *[F.lit(v).alias(k) for k, v in stated.items()])
