"""Boosted trees of all folds, grown in the same passes or each model in a task."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.operators import learners, shared_trees
from riskloom.operators.metrics import auc
from riskloom.operators.oof import oof_predict, round_margins
from riskloom.operators.shared_trees import GrownTrees, Trees, _edges, share_of


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(600, 3)), 3)
    y = (x[:, 0] - x[:, 1] * (x[:, 2] > 0) + rng.normal(size=600) > 0.8).astype(int)
    made = spark.createDataFrame([(i, int(y[i]), i % 3, *map(float, x[i])) for i in range(600)], "id long, target int, fold int, a double, b double, c double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(made)


@pytest.fixture(params=["alone", "passes"])
def way(request, monkeypatch):
    if request.param == "passes":
        monkeypatch.setattr(shared_trees, "ALONE", 0)
        monkeypatch.setattr(shared_trees, "BLOCK", 64)
        monkeypatch.setattr(shared_trees, "CHECKPOINT_EVERY", 2)
    return request.param


def plain_tree(bins, target, weight, depth, rows, out, least=1):
    """Leaf values of `rows` in `out`, from the best split of each node by brute force."""
    out[rows] = np.average(target[rows], weights=weight[rows])
    best = (1e-9, None)
    for f in range(bins.shape[1]):
        for cut in range(31):
            left = rows[bins[rows, f] <= cut]
            right = rows[bins[rows, f] > cut]
            if depth and min(len(left), len(right)) >= least:
                part = lambda r: (weight[r] * target[r]).sum() ** 2 / weight[r].sum()
                gain = part(left) + part(right) - part(rows)
                if gain > best[0] + 1e-9:
                    best = (gain, (left, right))
    if best[1]:
        for side in best[1]:
            plain_tree(bins, target, weight, depth - 1, side, out, least)


@pytest.mark.parametrize("least", [1, 40])
def test_boosting_equals_brute_force_and_counts_every_row(rows, way, least):
    result = oof_predict(rows, learners.boosted_trees(7, 3, 0.3, 1.0, "all", least))
    got = {r.id: r.prediction for r in result.oof.collect()}
    data = rows.orderBy("id").collect()
    x, y, fold = np.array([r.features.toArray() for r in data]), np.array([r.target for r in data]), np.array([r.fold for r in data])
    sign, w = 2.0 * y - 1, np.where(y == 1, 1.6, 1.0)
    bins = np.stack([np.searchsorted(_edges(x[:, f]), x[:, f]) for f in range(3)], axis=1)
    seen, margin = np.flatnonzero(fold != 0), np.zeros(len(y))
    for t in range(7):
        target = sign if t == 0 else 4 * sign / (1 + np.exp(2 * sign * margin))
        out = np.zeros(len(y))
        plain_tree(bins, target, w, 3, seen, out, least)
        margin += out * (1.0 if t == 0 else 0.3)
    assert isinstance(result.models[0][0], GrownTrees)
    told = {r.id: r.probability[1] for r in result.models[0][0].transform(rows).collect()}
    assert np.allclose([told[i] for i in seen], 1 / (1 + np.exp(-2 * margin[seen])), atol=1e-9)
    assert all(abs(got[i] - told[i]) < 1e-12 for i in np.flatnonzero(fold == 0)) and len(got) == 600


def test_both_ways_and_all_partitions_give_the_same_trees(rows, monkeypatch):
    learner = learners.boosted_trees(5, 3, 0.3, min_rows=5)
    alone = {r.id: r.prediction for r in oof_predict(rows, learner).oof.collect()}
    for name, value in (("ALONE", 0), ("MOST_CELLS", 500), ("BLOCK", 64)):
        monkeypatch.setattr(shared_trees, name, value)
    passes = {r.id: r.prediction for r in oof_predict(rows.repartition(5, "a"), learner).oof.collect()}
    assert len(alone) == 600 and len(set(alone.values())) > 20
    assert max(abs(alone[i] - passes[i]) for i in alone) < 1e-9


def test_passes_and_jobs_do_not_grow_with_folds_and_trees(rows, monkeypatch):
    seen, old = [], shared_trees._pass
    monkeypatch.setattr(shared_trees, "_pass", lambda *a: seen.append(1) or old(*a))
    oof_predict(rows, learners.boosted_trees(30, 2, 0.3))
    assert not seen  # few rows: a task per model and no pass
    monkeypatch.setattr(shared_trees, "ALONE", 0)
    oof_predict(rows, learners.boosted_trees(3, 2, 0.3))
    assert len(seen) == 6  # trees x levels, once for all folds


def test_the_margin_after_the_last_round_is_that_of_the_prediction(rows, way):
    result = oof_predict(rows, learners.boosted_trees(6, 2, 0.3))
    last = {r.id: r.margin for r in round_margins(result, rows, 6).collect()}
    assert all(abs(1 / (1 + np.exp(-2 * last[r.id])) - r.prediction) < 1e-12 for r in result.oof.collect())
    assert all(r["auc"] > 0.6 for r in auc(result.oof, "target", "prediction", ["fold"]).collect())


def test_features_of_a_fold_are_read_by_its_own_model(rows, way):
    few = rows.drop("features").withColumns({"first": 2 * F.signum("a") + F.signum("c"), "second": F.signum("b")})

    def features(df, c):
        return VectorAssembler(inputCols=[c], outputCol="features").transform(df)

    learner = learners.boosted_trees(4, 2, 0.3)
    result = oof_predict(few, learner, prepare=lambda df, j: features(df, "first" if j == 1 else "second"))
    for j, c in ((0, "second"), (1, "first")):
        wanted = {r.id: r.prediction for r in oof_predict(features(few, c), learner).oof.where(f"fold = {j}").collect()}
        got = {r.id: r.prediction for r in result.oof.where(f"fold = {j}").collect()}
        assert got.keys() == wanted.keys() and max(abs(got[i] - wanted[i]) for i in got) < 1e-9


def test_importances_are_shares_of_the_gain(rows):
    found = oof_predict(rows, learners.boosted_trees(6, 2, 0.3)).models[0][0].featureImportances.toArray()
    assert abs(found.sum() - 1) < 1e-12 and found.argmax() == 0


def test_labels_that_are_unknown_and_other_strategies_are_left_to_the_estimator(rows):
    assert share_of("0.8") == 0.8 and share_of("all") == 1.0 and share_of("sqrt") is None and share_of("3") is None
    assert learners.boosted_trees(2, columns="sqrt").grown is None
    assert learners.boosted_trees(2).grown == Trees(2, 4, 0.8, 1, 0.9, 0.07, 1.6)
    odd = rows.withColumn("target", F.when(F.col("id") > 0, F.col("target")))
    with pytest.raises(Exception):
        oof_predict(odd, learners.boosted_trees(2)).oof.collect()
