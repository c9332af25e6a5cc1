"""Skewed keys, size limits and plan shapes."""

from conftest import final_plan
from pyspark.sql import functions as F

from riskloom.operators.folds import assign_folds
from riskloom.operators.lookup import lookup_join
from riskloom.operators.metrics import gini, gini_normalized
from riskloom.plans.ordering import global_rank, running_totals


def skewed(spark, n=3000):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(400)) + 1)
    return spark.range(n).select("id", key.cast("long").alias("k"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) == 0).cast("int").alias("target"))


def test_rank_within_groups_keeps_null_groups(spark):
    df = skewed(spark).withColumn("g", F.when(F.col("k") == 0, "hot").when(F.col("k") % 2 == 0, "even"))
    rows = global_rank(df, [F.col("k").desc(), F.col("id")], ["g"]).collect()
    assert len(rows) == 3000
    for g in ("hot", "even", None):
        part = sorted((r for r in rows if r.g == g), key=lambda r: (-r.k, r.id))
        assert [r["rank"] for r in part] == list(range(len(part)))


def test_running_totals_match_a_plain_loop(spark):
    df = skewed(spark).withColumn("g", F.when(F.col("k") % 2 == 0, 1))
    rows = running_totals(df, [F.col("k"), F.col("id")], ["target"], ["g"]).collect()
    assert len(rows) == 3000
    for g in (1, None):
        total = 0
        for r in sorted((r for r in rows if r.g == g), key=lambda r: (r.k, r.id)):
            total += r.target
            assert r.cum_target == total


def test_lookup_beyond_the_broadcast_limit_gives_the_same_rows(spark):
    df = skewed(spark).withColumn("k", F.when(F.col("id") % 7 != 1, F.col("k")))
    table = df.where("k IS NOT NULL AND k <> 17").groupBy(F.col("k").alias("key_")).agg(
        F.count(F.lit(1)).alias("weight_"), F.sum("target").alias("pos"))
    n, total = table.count(), table.agg(F.sum("weight_")).first()[0]
    outputs = {"pos": ("pos", F.lit(-5).cast("long"))}
    small = lookup_join(df, table, "k", outputs, n, total)
    large = lookup_join(df, table, "k", outputs, n, total, limit=10)
    assert large.count() == 3000
    assert small.exceptAll(large).count() == 0
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_folds_are_even_per_class_and_cover_every_row(spark):
    rows = assign_folds(skewed(spark)).groupBy("target", "fold").count().collect()
    assert sum(r["count"] for r in rows) == 3000
    for y in (0, 1):
        sizes = [r["count"] for r in rows if r.target == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_folds_and_gini_never_gather_rows_in_one_task(spark):
    df = skewed(spark).withColumn("score", F.xxhash64("id", F.lit(2)).cast("double"))
    for made in (assign_folds(df), gini(df, "target", "score", ["k"]), assign_folds(df, exact=False)):
        assert "SinglePartition" not in final_plan(made)
    assert "Exchange" not in final_plan(assign_folds(df.select("id", "target"), exact=False))


def test_gini_equals_pair_counting_and_is_antisymmetric(spark):
    df = skewed(spark, 600).withColumn("score", (F.col("k") % 13).cast("double"))
    rows = [(r.target, r.score) for r in df.collect()]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    wins = sum((p > q) - (p < q) for p in pos for q in neg) / (len(pos) * len(neg))
    up = gini(df, "target", "score").first().gini
    down = gini(df.withColumn("score", -F.col("score")), "target", "score").first().gini
    curved = gini(df.withColumn("score", F.exp("score")), "target", "score").first().gini
    assert abs(up - wins) < 1e-12 and abs(up + down) < 1e-12 and abs(up - curved) < 1e-12


def test_normalized_gini_without_ties_equals_gini(spark):
    df = skewed(spark, 500).withColumn("score", F.xxhash64("id", F.lit(3)).cast("double"))
    a = gini(df, "target", "score").first().gini
    b = gini_normalized(df, "target", "score").first().gini_normalized
    assert abs(a - b) < 1e-9


def test_scan_reads_only_needed_columns(spark):
    from conftest import SMALL
    from riskloom.sources.order_risk import order_risk

    plan = final_plan(order_risk(spark, SMALL).select("id", "n_lines"))
    assert "l_extendedprice" not in plan and "c_mktsegment" not in plan


def test_queries_stay_in_the_jvm(spark):
    from __spark_entry__ import queries
    from conftest import SMALL

    for name in ("target_mean_fold", "pair_screen", "gini_by_fold", "fe_full", "libffm_lines", "hash_interactions"):
        plan = final_plan(queries()[name](spark, SMALL))
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_folds_shuffle_the_rows_once(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(assign_folds(tables[0].drop("fold")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the rows once, by class and slice; the slices' counts by the same, by class for their sums, and back for the join
    assert plan.count("Exchange hashpartitioning") == 4
