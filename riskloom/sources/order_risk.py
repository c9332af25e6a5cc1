"""A wide labelled/unlabelled risk table derived from the order, customer and line-item tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: thresholds of the planted signal on a 32-bit hash
BASE_RATE = 129_000_000
PRIORITY_LIFT = 344_000_000
RETURN_LIFT = 172_000_000
PARITY_LIFT = 344_000_000

CATEGORICAL = ["prio_cat", "status_cat", "seg_cat", "nation_cat", "cust_cat"]
BINARY = ["ret_bin", "fstat_bin"]
CONTINUOUS = ["reg_03", "qty_12", "price_13", "bal_14", "root_15"]


def exact_sum(col: str) -> list[Column]:
    """Aggregates that `exact_total` turns into the sum of a column rounded to hundredths.

    Values that are whole hundredths below ten million, as nearly all are, are added as long integers; only others pay for decimals.
    """
    x = F.col(col)
    cents = F.rint(x * 100)
    plain = (F.abs(cents) < 1e9) & (cents / 100 == x)
    return [F.sum(F.when(plain, cents.cast("long"))).alias("_cents"), F.sum(F.when(~plain, x.cast("decimal(18,2)"))).alias("_odd")]


def exact_total() -> Column:
    """The nearest double of the exact sum; null if there was no value."""
    whole = F.coalesce("_cents", F.lit(0)).cast("decimal(19,0)") * F.lit("0.01").cast("decimal(2,2)")
    both = (whole + F.coalesce("_odd", F.lit(0).cast("decimal(28,2)"))).cast("double")
    return F.when(F.col("_odd").isNull() & (F.abs("_cents") < 2**53), F.col("_cents") / 100).when(F.col("_cents").isNotNull() | F.col("_odd").isNotNull(), both)


def order_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: `id`, `target`, `is_test` and feature columns, with -1 where an order has no lines."""
    lines = (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(
            F.count(F.lit(1)).cast("int").alias("lines"),
            *exact_sum("l_quantity"),
            F.max("l_discount").alias("disc"),
            F.max((F.col("l_returnflag") == "R").cast("int")).alias("ret"),
            F.max((F.col("l_linestatus") == "F").cast("int")).alias("fin"),
        )
        .withColumn("qty", exact_total())
    )
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment"
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnRenamed("o_orderkey", "id")
    digest = F.md5(F.concat(F.lit("t|"), F.col("id").cast("string")))
    wide = (
        orders.join(customer, "o_custkey")
        .join(lines, "id", "left")
        .select(
            "id",
            F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("h"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("prio_cat"),
            F.ascii("o_orderstatus").alias("status_cat"),
            F.ascii("c_mktsegment").alias("seg_cat"),
            F.col("c_nationkey").alias("nation_cat"),
            F.col("o_custkey").alias("cust_cat"),
            F.coalesce("ret", F.lit(-1)).alias("ret_bin"),
            F.coalesce("fin", F.lit(-1)).alias("fstat_bin"),
            F.coalesce("lines", F.lit(-1)).alias("n_lines"),
            F.when(F.col("lines").isNull(), -1.0)
            .otherwise(F.sqrt(F.col("o_custkey").cast("double")) / 40.0)
            .alias("reg_03"),
            F.coalesce("qty", F.lit(-1.0)).alias("qty_12"),
            F.col("o_totalprice").alias("price_13"),
            F.col("c_acctbal").alias("bal_14"),
            F.sqrt(F.coalesce("lines", F.lit(0)).cast("double")).alias("root_15"),
            F.coalesce("disc", F.lit(-1.0)).alias("calc_disc"),
        )
    )
    threshold = (
        F.lit(BASE_RATE)
        + F.when(F.col("prio_cat") == 1, PRIORITY_LIFT).otherwise(0)
        + F.when(F.col("ret_bin") == 1, RETURN_LIFT).otherwise(0)
        + F.when(F.col("prio_cat") % 2 == F.col("nation_cat") % 2, PARITY_LIFT).otherwise(0)
    )
    features = [c for c in wide.columns if c not in ("id", "h")]
    return wide.select(
        "id",
        (F.col("h") < threshold).cast("int").alias("target"),
        (F.col("id") % 5 == 0).cast("int").alias("is_test"),
        *features,
    )


def split_origin(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled rows, and unlabelled rows without their target."""
    train = df.where("is_test = 0").drop("is_test")
    test = df.where("is_test = 1").drop("is_test", "target")
    return train, test
