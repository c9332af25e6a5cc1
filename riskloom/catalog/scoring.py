"""Metrics over prediction tables, with deterministic scores made from the wide table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import folded, over_folds, query
from riskloom.operators import encoders, metrics
from riskloom.plans.materialize import materialize

# two scores per row: one without ties, one with many
SCORED = """
sc AS (
  SELECT id, target, fold, price_13 / (1e0 + ABS(bal_14)) AS smooth,
         CAST(prio_cat * 3 + nation_cat % 4 + ret_bin * 2 AS DOUBLE) AS stepped FROM tr)"""


def scored(spark, sf_dir):
    return folded(spark, sf_dir).select(
        "id",
        "target",
        "fold",
        (F.col("price_13") / (1.0 + F.abs("bal_14"))).alias("smooth"),
        (F.col("prio_cat") * 3 + F.col("nation_cat") % 4 + F.col("ret_bin") * 2).cast("double").alias("stepped"),
    )


def gini_sql(source: str, label: str, score: str, by: str = "") -> str:
    """Mid-rank Gini by distinct score."""
    part = f"PARTITION BY {by}" if by else ""
    head = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {head}CAST(SUM(pos + neg) AS BIGINT) AS n_rows, CAST(SUM(pos) AS BIGINT) AS n_pos,
       CAST(SUM(CAST(pos AS HUGEINT) * (2 * cum - neg)) AS DOUBLE) / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) - 1e0 AS gini
FROM (SELECT *, SUM(neg) OVER ({part} ORDER BY score) AS cum FROM (
        SELECT {head}{score} AS score, SUM({label}) AS pos, COUNT(*) - SUM({label}) AS neg
        FROM {source} GROUP BY {head}{score})) {tail}"""


@query(over_folds("SELECT 'smooth' AS score_name, * FROM (" + gini_sql("sc", "target", "smooth") + ") UNION ALL "
                  "SELECT 'stepped' AS score_name, * FROM (" + gini_sql("sc", "target", "stepped") + ")", SCORED))
def gini_rank(spark, sf_dir):
    long = scored(spark, sf_dir).unpivot(["target"], ["smooth", "stepped"], "score_name", "score")
    return metrics.gini(long, "target", "score", ["score_name"])


@query(over_folds(
    """
SELECT ROUND(g / n, 9) AS gini_raw, ROUND(g / b, 9) AS gini_normalized FROM (
  SELECT COUNT(*) AS n, CAST(SUM(cum) AS DOUBLE) / MAX(p) - (COUNT(*) + 1) / 2e0 AS g,
         CAST(SUM(best) AS DOUBLE) / MAX(p) - (COUNT(*) + 1) / 2e0 AS b
  FROM (SELECT SUM(target) OVER (ORDER BY stepped DESC, id ROWS UNBOUNDED PRECEDING) AS cum,
               SUM(target) OVER (ORDER BY target DESC, id ROWS UNBOUNDED PRECEDING) AS best,
               SUM(target) OVER () AS p FROM sc))""",
    SCORED,
))
def gini_norm(spark, sf_dir):
    found = metrics.gini_normalized(scored(spark, sf_dir), "target", "stepped")
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query(over_folds("SELECT n_rows, n_pos, (gini + 1e0) / 2e0 AS auc FROM (" + gini_sql("sc", "target", "smooth") + ")", SCORED))
def roc_auc(spark, sf_dir):
    return metrics.auc(scored(spark, sf_dir), "target", "smooth")


@query(over_folds(
    """
SELECT fold, ROUND(AVG(CASE WHEN target = 1 THEN -LN(p) ELSE -LN(1e0 - p) END), 9) AS log_loss
FROM (SELECT fold, target, GREATEST(LEAST((stepped + 3) / 4e1, 1e0 - 1e-14), 1e-14) AS p FROM sc) GROUP BY fold""",
    SCORED,
))
def log_loss(spark, sf_dir):
    df = scored(spark, sf_dir).withColumn("p", (F.col("stepped") + 3) / 40.0)
    return metrics.log_loss(df, "target", "p", ["fold"]).select("fold", F.round("log_loss", 9).alias("log_loss"))


BY_FOLD = (
    gini_sql("sc", "target", "stepped", "fold")
    + " UNION ALL SELECT -1 AS fold, * FROM ("
    + gini_sql("sc", "target", "stepped")
    + ")"
)


@query(over_folds(BY_FOLD, SCORED))
def gini_by_fold(spark, sf_dir):
    return metrics.gini_by_fold(scored(spark, sf_dir), "target", "stepped")


@query(over_folds(
    """
SELECT ROUND(AVG(gini), 9) AS mean_score, ROUND(STDDEV_POP(gini), 9) AS std_score, COUNT(*) AS folds
FROM (""" + gini_sql("sc", "target", "stepped", "fold") + ")",
    SCORED,
))
def fold_summary(spark, sf_dir):
    per_fold = metrics.gini(scored(spark, sf_dir), "target", "stepped", ["fold"])
    found = metrics.fold_summary(per_fold, "gini")
    return found.select(F.round("mean_score", 9).alias("mean_score"), F.round("std_score", 9).alias("std_score"), "folds")


@query(over_folds(
    gini_sql("enc", "target", "e", "fold"),
    "m AS (SELECT j, prio_cat, SUM(target) AS pos, COUNT(*) AS n FROM tr JOIN (SELECT UNNEST(RANGE(5)) AS j) ON fold <> j "
    "GROUP BY j, prio_cat)",
    "pr AS (SELECT j, CAST(SUM(pos) AS DOUBLE) / SUM(n) AS prior FROM m GROUP BY j)",
    "enc AS (SELECT tr.fold, target, ROUND((CAST(pos AS DOUBLE) / n * n + 2e2 * prior) / (n + 2e2), 12) AS e "
    "FROM tr JOIN m ON tr.fold = m.j AND tr.prio_cat = m.prio_cat JOIN pr ON pr.j = tr.fold)",
))
def target_mean_gini(spark, sf_dir):
    train = materialize(folded(spark, sf_dir).select("id", "target", "fold", "prio_cat"), "folded")
    enc = encoders.TargetMean(["prio_cat"]).fit(train, fold="fold").transform(train, "own")
    return metrics.gini(enc.withColumn("e", F.round("prio_cat_avg", 12)), "target", "e", ["fold"])
