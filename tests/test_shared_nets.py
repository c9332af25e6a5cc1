"""Nets of all folds and bags in the same passes: the estimator's loss, gradient and first weights, about its fits, and passes that do not grow with the nets."""

import numpy as np
import pytest
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import learners, oof, shared_nets
from riskloom.operators.metrics import POOLED

SIZES = [9, 5, 3, 2]


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n)).cast("int")
    df = spark.range(1500).select("id", h("f", 3).alias("fold"), h("a", 4).alias("a"), h("b", 4).alias("b"), (h("x", 100) / 50.0).alias("x"))
    hot = [(F.col(c) == v).cast("double") for c in "ab" for v in range(4)]
    target = (h("y", 100) < 10 + 60 * (F.col("a") % 2 == F.col("b") % 2).cast("int") + 10 * F.col("x")).cast("int").alias("target")
    return df.select("id", "fold", target, array_to_vector(F.array(*hot, F.col("x"))).alias("features")).cache()


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    x = np.concatenate((np.ones((40, 1)), rng.normal(size=(40, 9))), axis=1)
    y, w = rng.integers(0, 2, 40), rng.normal(size=(3, sum((a + 1) * b for a, b in zip(SIZES, SIZES[1:]))))
    loss, found = shared_nets._gradient(x, y, shared_nets._layers(w, SIZES))
    flat = shared_nets._flat(found)
    for k in range(0, w.shape[1], 5):
        step = np.zeros_like(w)
        step[:, k] = 1e-6
        up, down = (shared_nets._gradient(x, y, shared_nets._layers(w + s, SIZES))[0] for s in (step, -step))
        np.testing.assert_allclose(flat[:, k], (up - down) / 2e-6, rtol=1e-4, atol=1e-5)
    np.testing.assert_array_equal(shared_nets._flat(shared_nets._layers(w, SIZES)), w)


def test_models_score_as_their_weights_say_and_fit_like_the_estimator(rows, monkeypatch):
    passes = []
    sums = shared_nets._sums
    monkeypatch.setattr(shared_nets, "_sums", lambda *a: passes.append(len(a[1])) or sums(*a))
    learner = learners.feed_forward(9, (5, 3), iterations=40, bags=2)
    result = oof.oof_predict(rows, learner, rows.select("id", "features"))
    assert passes[0] == 8 and len(passes) < 110 and {k: len(v) for k, v in result.models.items()} == {0: 2, 1: 2, 2: 2} and len(result.refit) == 2
    data = [(r.fold, r.target, r.features.toArray()) for r in rows.collect()]
    x, y, fold = np.array([[1.0, *f] for _, _, f in data]), np.array([t for _, t, _ in data]), np.array([f for f, _, _ in data])

    def loss(model, use):
        return shared_nets._gradient(x[use], y[use], shared_nets._layers(model.weights.toArray()[None], SIZES))[0][0] / use.sum()

    for j in (0, 2):
        alone = MultilayerPerceptronClassifier(labelCol="target", layers=SIZES, maxIter=40, blockSize=512, seed=1).fit(rows.where(F.col("fold") != j))
        assert loss(result.models[j][1], fold != j) < loss(alone, fold != j) + 0.03
    # a net's probabilities are those that the pass works with
    model = result.models[0][0]
    p = np.array([r.probability[1] for r in model.transform(rows).orderBy("id").collect()])
    told = -np.log(np.where(np.array([r.target for r in rows.orderBy("id").collect()]) == 1, p, 1 - p)).mean()
    assert told == pytest.approx(loss(model, fold >= 0), abs=1e-9)
    assert next(r.gini for r in result.scores().collect() if r.fold == POOLED) > 0.4
    assert result.oof.count() == 1500 == result.test.count()


def test_bags_start_where_the_estimator_starts(rows, monkeypatch):
    begun = []
    monkeypatch.setattr(oof, "fit_nets", lambda sparse, sizes, starts, outside, n, most: begun.append((starts, outside, n)) or starts)
    models = oof.oof_predict(rows, learners.feed_forward(9, (5, 3), bags=2)).models
    starts, outside, n = begun[0]
    own = [learners.feed_forward(9, (5, 3)).build(None, s).setMaxIter(0).setLabelCol("target").fit(rows).weights.toArray() for s in (0, 1)]
    np.testing.assert_array_equal(starts, np.stack(own * 3))
    assert outside == [0, 0, 1, 1, 2, 2] and n == [1500 - rows.where(F.col("fold") == j).count() for j in outside]
    np.testing.assert_array_equal(models[2][1].weights.toArray(), own[1])


def test_one_class_is_left_to_the_estimator(rows):
    learner = learners.feed_forward(9, (5, 3))
    assert oof._nets_together(rows.withColumn("target", F.lit(0)), learner, [0, 1, 2], "target", "fold") is None
    assert oof._nets_together(rows, learners.ridge(), [0, 1, 2], "target", "fold") is None
