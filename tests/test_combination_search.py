"""Combination search by refits: a planted pair is found, a restart goes on where the log ends."""

import pytest
from pyspark.sql import functions as F

from riskloom.operators import learners
from riskloom.operators.combination_search import combination_means, keep_if_improves, read_log
from riskloom.plans.materialize import new_path

CANDIDATES = [("c", "d"), ("a", "b"), ("a", "c", "d")]


@pytest.fixture(scope="module")
def planted(spark):
    """The target is the parity of a and b, with noise; neither column says anything alone."""
    h = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n))
    rows = spark.range(3000).select("id", h("f", 5).cast("int").alias("fold"), *[h(c, 4).cast("int").alias(c) for c in "abcd"])
    noisy = (F.col("a") + F.col("b") + (h("noise", 10) == 0).cast("int")) % 2
    return combination_means(rows.withColumn("target", noisy.cast("int")), ["a", "c"], CANDIDATES)


def test_means_leave_the_fold_out(planted):
    rows = planted.rows.collect()
    at = {r.id: r for r in planted.rows.select("id", "a_plus_b").collect()}
    prior = [[r.target for r in rows if r.fold != j] for j in range(5)]
    key = {tuple(r.a_plus_b): [] for r in rows}
    for r in rows:
        key[tuple(r.a_plus_b)].append(r)
    assert len(key) == 16  # one array per pair of values
    for means, own in list(key.items())[:4]:
        for j in range(5):
            outside = [r.target for r in own if r.fold != j]
            expected = (sum(outside) + 200 * sum(prior[j]) / len(prior[j])) / (len(outside) + 200)
            assert means[j] == pytest.approx(expected)
    assert len(at) == 3000


def test_planted_pair_is_kept_and_the_log_resumes(spark, planted):
    forest = learners.random_forest(trees=5, depth=4)
    path = new_path(spark, "trials")
    whole = sorted(keep_if_improves(planted, forest, path, min_gain=0.02).collect(), key=lambda r: r.step)
    assert [(r.step, r.combination) for r in whole] == [(-1, None), (0, "c_plus_d"), (1, "a_plus_b"), (2, "a_plus_c_plus_d")]
    assert [r.kept for r in whole] == [1, 0, 1, 0] and whole[2].score > whole[0].score + 0.5
    assert [r.best_before for r in whole] == [None, whole[0].score, whole[0].score, whole[2].score]

    part = new_path(spark, "trials")
    read_log(spark, path).where("step <= 1").write.parquet(part)
    resumed = sorted(keep_if_improves(planted, forest, part, min_gain=0.02).collect(), key=lambda r: r.step)
    assert [(r.step, r.kept) for r in resumed] == [(r.step, r.kept) for r in whole]
    assert resumed[3].score == pytest.approx(whole[3].score, abs=0.02) and resumed[:3] == whole[:3]
    with pytest.raises(ValueError):
        keep_if_improves(planted, forest, part, min_gain=0.5)


def test_candidates_are_checked(planted):
    with pytest.raises(ValueError):
        combination_means(planted.rows, ["a"], [("a", "a")])
