"""Forests on distinct rows: the bags of rows, the limits of the trees, the scores of the forests on rows; fits that do not grow with the rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import combination_search, counted_forest, learners
from riskloom.operators.metrics import POOLED, gini_by_fold
from riskloom.operators.oof import oof_predict
from riskloom.plans.materialize import new_path

KEYS = ["target", "fold", "a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n)).cast("int")
    df = spark.range(8000).select("id", h("f", 5).alias("fold"), *[h(c, 4).alias(c) for c in "abc"])
    return df.withColumn("target", (h("y", 100) < 30 + 35 * (F.col("a") == F.col("b")).cast("int") + 8 * F.col("c")).cast("int")).cache()


def features(df, j):
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)


def test_bags_hold_rows_and_not_cells(rows):
    cells = counted_forest.count_cells(rows, KEYS)
    assert cells.agg(F.sum("_n")).first()[0] == 8000
    drawn = counted_forest.draw_bags(cells, KEYS, 40, 0.632)
    n, bags = (np.array(x) for x in zip(*[(r["_n"], r["_bag"]) for r in drawn.collect()]))
    assert bags.sum(axis=0).mean() == pytest.approx(0.632 * 8000, rel=0.02)
    spread = ((bags - 0.632 * n[:, None]) ** 2).sum(axis=0).mean()  # a Poisson number of rows; whole cells taken or left would spread as the squares of n
    assert spread == pytest.approx(0.632 * 8000, rel=0.1)
    again = counted_forest.draw_bags(cells.repartition(3), KEYS, 40, 0.632)
    assert sorted(map(str, again.collect())) == sorted(map(str, drawn.collect()))


def test_scores_are_those_of_the_forest_on_rows(rows):
    forest = learners.random_forest(trees=5, depth=6, columns="all")
    counted = counted_forest.counted_rows(rows, KEYS, forest, count_from=1)
    scored = counted.scored(features)
    assert {tuple(r) for r in scored.groupBy("fold", "target").count().collect()} == {tuple(r) for r in rows.groupBy("fold", "target").count().collect()}
    mine = {r.fold: r for r in gini_by_fold(scored, "target", "prediction").collect()}
    plain = {r.fold: r for r in oof_predict(rows, forest, prepare=features).scores().collect()}
    assert {k: (r.n_rows, r.n_pos) for k, r in mine.items()} == {k: (r.n_rows, r.n_pos) for k, r in plain.items()}
    assert mine[POOLED].gini == pytest.approx(plain[POOLED].gini, abs=0.03) and plain[POOLED].gini > 0.2


def test_leaves_hold_their_least_rows(rows):
    """The limit counts rows, not cells: no leaf under it, and splits down to it."""
    forest = learners.random_forest(trees=1, depth=10, min_rows=400)
    cells = counted_forest.count_cells(rows, KEYS).withColumns({learners.LABEL: F.col("target").cast("double"), learners.WEIGHT: F.col("_n").cast("double")})
    model = forest.counted.build(8000.0, 0).fit(features(cells, 0))
    leaves = model.setLeafCol("leaf").transform(features(rows, 0)).groupBy("leaf").count().collect()
    assert len(leaves) > 5 and min(r["count"] for r in leaves) >= 400
    assert forest.counted.build(700.0, 0).getMaxDepth() == 0


def test_fits_do_not_grow_with_the_rows(spark, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(combination_search, "oof_predict", lambda *a, **k: pytest.fail("fitted on rows"))
    count = counted_forest.count_cells
    monkeypatch.setattr(counted_forest, "count_cells", lambda *a: seen.append(count(*a)) or seen[-1])
    for copies in (1, 3):
        more = rows.crossJoin(spark.range(copies).withColumnRenamed("id", "k")).withColumn("id", F.col("id") + 8000 * F.col("k")).drop("k")
        tables = combination_search.combination_means(more, ["a", "c"], [("a", "b")])
        log = combination_search.keep_if_improves(tables, learners.random_forest(trees=2, depth=4), new_path(spark, "trials"), 0.02, count_from=1)
        assert [(r.step, r.kept) for r in sorted(log.collect(), key=lambda r: r.step)] == [(-1, 1), (0, 1)]
    assert seen[0].count() == seen[1].count() <= 5 * 2 * 64


def test_small_or_many_valued_tables_are_fitted_on_rows(rows):
    forest = learners.random_forest(trees=2)
    assert counted_forest.counted_rows(rows, KEYS, forest) is None
    assert counted_forest.counted_rows(rows, [*KEYS, "id"], forest, count_from=1) is None
    assert counted_forest.counted_rows(rows, KEYS, learners.boosted_trees(5), count_from=1) is None
    assert counted_forest.counted_rows(rows.withColumn("target", F.lit(0)), KEYS, forest, count_from=1) is None
