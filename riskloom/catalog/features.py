"""Scalar features: bins, flags, products, decodes, hashes, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import over_fx, query, train_test, wide, wide_stored
from riskloom.functions import scalars as S
from riskloom.operators.columns import add_missing_flags
from riskloom.operators.scaling import EqualWidthBinner, MinMax
from riskloom.sources.order_risk import split_origin

BINNED = ["qty_12", "price_13", "bal_14"]
BINS = 50


def _edges(c: str, n: int) -> str:
    compare = " + ".join(f"(CASE WHEN {c} > lo_{c} + {i} * ((hi_{c} - lo_{c}) / {n}) THEN 1 ELSE 0 END)" for i in range(1, n))
    return f"{compare} AS {c}"


@query(
    over_fx(
        "SELECT id, " + ", ".join(_edges(c, BINS) for c in BINNED) + " FROM fx, span",
        "span AS (SELECT " + ", ".join(f"MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in BINNED) + " FROM fx)",
    )
)
def cut_equal_width(spark, sf_dir):
    df = wide_stored(spark, sf_dir)
    return EqualWidthBinner(BINNED, BINS).fit(df).transform(df).select("id", *BINNED)


@query(
    over_fx(
        """
SELECT id, CASE WHEN ret_bin = -1 THEN 1 ELSE 0 END AS ret_bin_miss, CASE WHEN fstat_bin = -1 THEN 1 ELSE 0 END
       AS fstat_bin_miss, CASE WHEN n_lines = -1 THEN 1 ELSE 0 END AS n_lines_miss,
       CASE WHEN reg_03 = -1 THEN 1 ELSE 0 END AS reg_03_miss, CASE WHEN qty_12 = -1 THEN 1 ELSE 0 END AS qty_12_miss,
       CASE WHEN calc_disc = -1 THEN 1 ELSE 0 END AS calc_disc_miss
FROM fx WHERE is_test = 0"""
    )
)
def missing_flags(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    cols = [c for c in test.columns if c != "id"]
    flagged, _ = add_missing_flags(train, test, cols=cols)
    return flagged.select("id", *[c for c in flagged.columns if c.endswith("_miss")])


@query(
    over_fx(
        """
SELECT id, CAST(prio_cat AS VARCHAR) || '_' || CAST(nation_cat AS VARCHAR) AS prio_cat_plus_nation_cat,
       CAST(ret_bin AS VARCHAR) || '_' || CAST(n_lines AS VARCHAR) AS ret_bin_plus_n_lines
FROM fx"""
    )
)
def combine_pair(spark, sf_dir):
    pairs = [("prio_cat", "nation_cat"), ("ret_bin", "n_lines")]
    made = S.combine(wide(spark, sf_dir), pairs)
    return made.select("id", *[f"{a}_plus_{b}" for a, b in pairs])


@query(
    over_fx(
        """
SELECT id, n_lines * (prio_cat + 1) AS lines_prio, n_lines * (prio_cat + 1) * bal_14 AS lines_prio_bal,
       price_13 * qty_12 AS price_qty, price_13 * (CASE WHEN reg_03 = -1 THEN 1 ELSE -1 END) AS price_miss_reg,
       root_15 * (CASE WHEN ret_bin = -1 THEN 1 ELSE -1 END) AS root_miss_ret
FROM fx"""
    )
)
def interaction_products(spark, sf_dir):
    up = F.col("prio_cat") + 1
    return wide(spark, sf_dir).select(
        "id",
        S.product(["n_lines", up]).alias("lines_prio"),
        S.product(["n_lines", up, "bal_14"]).alias("lines_prio_bal"),
        S.product(["price_13", "qty_12"]).alias("price_qty"),
        S.product(["price_13", S.signed_flag("reg_03")]).alias("price_miss_reg"),
        S.product(["root_15", S.signed_flag("ret_bin")]).alias("root_miss_ret"),
    )


@query(
    over_fx(
        """
SELECT id, CAST(((k - 1) % 27 + 27) % 27 + 1 AS INT) AS federal, CAST(FLOOR((k - 1) / 27e0) AS INT) AS municipality
FROM (SELECT id, CAST(ROUND_EVEN((reg_03 * 4e1) * (reg_03 * 4e1), 0) AS BIGINT) AS k FROM fx)"""
    )
)
def region_decode(spark, sf_dir):
    return wide(spark, sf_dir).select("id", S.region_decode("reg_03").alias("r")).select("id", "r.federal", "r.municipality")


@query(over_fx("SELECT id, CAST(TRUNC(root_15 * root_15) AS INT) AS root_15_sq FROM fx"))
def square_trunc(spark, sf_dir):
    return wide(spark, sf_dir).select("id", S.square_trunc("root_15").alias("root_15_sq"))


@query(over_fx("SELECT id, ROUND(1 / (1 + EXP(-(bal_14 / 1e3))), 9) AS p FROM fx"))
def sigmoid(spark, sf_dir):
    return wide(spark, sf_dir).select("id", F.round(S.sigmoid(F.col("bal_14") / 1e3), 9).alias("p"))


@query(
    over_fx("SELECT id, ROUND(1 / (1 + EXP(-LEAST(GREATEST(bal_14, -35e0), 35e0))), 9) AS p FROM fx")
)
def sigmoid_clip(spark, sf_dir):
    return wide(spark, sf_dir).select("id", F.round(S.sigmoid_clip("bal_14"), 9).alias("p"))


@query(
    over_fx(
        """
SELECT id, ROUND(CASE WHEN target = 1 THEN -LN(p) ELSE -LN(1e0 - p) END, 6) AS loss
FROM (SELECT id, target, GREATEST(LEAST(1 / (1 + EXP(-LEAST(GREATEST(bal_14 / 1e2, -35e0), 35e0))), 1e0 - 1e-14), 1e-14) AS p
      FROM fx WHERE is_test = 0)"""
    )
)
def logloss_row(spark, sf_dir):
    p = S.sigmoid_clip(F.col("bal_14") / 1e2)
    train = split_origin(wide(spark, sf_dir))[0]
    return train.select("id", F.round(S.logloss(p, "target"), 6).alias("loss"))


def _bucket(key: str) -> str:
    return f"CAST(CAST(('0x' || SUBSTR(MD5({key}), 1, 8)) AS BIGINT) % 16777216 AS INT)"


@query(
    over_fx(
        "SELECT id, "
        + ", ".join(_bucket(f"'{c}_' || CAST({c} AS VARCHAR)") + f" AS {c}_bucket" for c in ["prio_cat", "cust_cat", "n_lines"])
        + " FROM fx"
    )
)
def hash_bucket(spark, sf_dir):
    cols = ["prio_cat", "cust_cat", "n_lines"]
    return wide(spark, sf_dir).select("id", *[S.hash_bucket(c, c).alias(f"{c}_bucket") for c in cols])


@query(
    over_fx(
        f"""
SELECT a.id, a.bucket AS low, b.bucket AS high,
       {_bucket("CAST(a.bucket AS VARCHAR) || '_' || CAST(b.bucket AS VARCHAR)")} AS pair_bucket
FROM placed a JOIN placed b ON a.id = b.id AND a.place < b.place""",
        "cells AS ("
        + " UNION ALL ".join(
            "SELECT id, " + _bucket(f"'{c}_' || CAST({c} AS VARCHAR)") + " AS bucket FROM fx"
            for c in ["prio_cat", "nation_cat", "ret_bin", "n_lines"]
        )
        + ")",
        "placed AS (SELECT id, bucket, ROW_NUMBER() OVER (PARTITION BY id ORDER BY bucket) AS place FROM cells)",
    )
)
def hash_interactions(spark, sf_dir):
    cols = ["prio_cat", "nation_cat", "ret_bin", "n_lines"]
    cells = F.sort_array(F.array(*[S.hash_bucket(c, c) for c in cols]))
    rows = wide(spark, sf_dir).select("id", cells.alias("x"))
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    low = F.array(*[F.col("x")[i] for i, _ in pairs])
    high = F.array(*[F.col("x")[j] for _, j in pairs])
    zipped = F.arrays_zip(low.alias("low"), high.alias("high"), S.hash_interactions(F.col("x")).alias("pair_bucket"))
    return rows.select("id", F.inline(zipped).alias("low", "high", "pair_bucket"))


@query(
    over_fx(
        "SELECT id, is_test, "
        + ", ".join(f"CAST({c} - lo_{c} AS DOUBLE) / (hi_{c} - lo_{c}) AS {c}" for c in ["n_lines", *BINNED])
        + " FROM fx, span",
        "span AS (SELECT "
        + ", ".join(f"MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in ["n_lines", *BINNED])
        + " FROM fx WHERE is_test = 0)",
    )
)
def minmax_scale(spark, sf_dir):
    df = wide_stored(spark, sf_dir)
    cols = ["n_lines", *BINNED]
    return MinMax(cols).fit(df.where("is_test = 0")).transform(df).select("id", "is_test", *cols)


@query(
    over_fx(
        """
SELECT id, CASE WHEN target = 1 THEN 1e0 / (2e0 * r) ELSE 1e0 / (2e0 * (1e0 - r)) END AS weight
FROM fx, (SELECT AVG(target) AS r FROM fx WHERE is_test = 0) WHERE is_test = 0"""
    )
)
def class_weight_ratio(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    rate = train.agg(F.avg("target")).first()[0]
    return train.select("id", S.class_weight("target", rate).alias("weight"))
