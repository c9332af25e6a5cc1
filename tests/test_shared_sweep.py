"""Settings fitted in the same passes: the optimum that the estimator finds, the same rows, and passes that do not grow with the settings."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import learners, oof, shared_sweep


@pytest.fixture(scope="module")
def rows(spark):
    """Three one-hot blocks of 4, some rows without the last, and one number; an input of zeros only."""
    h = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n)).cast("int")
    df = spark.range(2000).select("id", h("f", 5).alias("fold"), h("a", 4).alias("a"), h("b", 4).alias("b"), h("c", 6).alias("c"), (h("x", 100) / 50.0).alias("x"))
    hot = [(F.col(c) == v).cast("double") for c in "abc" for v in range(4)]
    target = (h("y", 100) < 10 + 15 * (F.col("a") == 1).cast("int") + 10 * F.col("b") + 8 * F.col("x")).cast("int").alias("target")
    return df.select("id", "fold", target, array_to_vector(F.array(*hot, F.col("x"), F.lit(0.0))).alias("features")).cache()


def test_weights_are_the_optimum_of_the_estimator(rows):
    settings = [learners.sgd_logistic(0.01), learners.sgd_logistic(0.001, positive_weight=4.0)]
    facts = {j: (f.rows, f.positives) for j, f in oof.fold_facts(rows, "target", "fold").items()}
    sparse = shared_sweep.sparse_rows(rows, ["id"], "target", "fold")
    found = shared_sweep.fit_settings(sparse, [s.convex for s in settings], facts, 15, tolerance=1e-7)
    for i, s in enumerate(settings):
        for j in (0, 3):
            part = rows.where(F.col("fold") != j)
            n, p = part.count(), part.where("target = 1").count()
            weighted = part.withColumn("w", s.weight(learners.Facts(n, p), "target"))
            model = LogisticRegression(labelCol="target", weightCol="w", regParam=s.convex.alpha, standardization=False, maxIter=300, tol=1e-13).fit(weighted)
            np.testing.assert_allclose(found[:, 5 * i + j], [model.intercept, *model.coefficients.toArray()], atol=2e-4)


def test_sweep_scores_every_row_once_per_setting(rows, monkeypatch):
    passes = []
    sums = shared_sweep._sums
    monkeypatch.setattr(shared_sweep, "_sums", lambda *a: passes.append(1) or sums(*a))
    mean = lambda df, y, score: df.groupBy("fold").agg(F.count("id").alias("n"), F.countDistinct("id").alias("ids"), F.avg(score).alias("mean"))
    one = {"0.01": learners.sgd_logistic(0.01)}
    few = oof.sweep(rows, one, metric=mean).collect()
    alone = len(passes)
    many = oof.sweep(rows, {**one, **{str(a): learners.sgd_logistic(a) for a in (0.1, 0.05, 0.02, 0.2)}}, metric=mean).collect()
    assert alone and len(passes) - alone <= alone + 2 and len(many) == 25
    told = {r.fold: r for r in many if r.setting == "0.01"}
    plain = oof.oof_predict(rows, one["0.01"]).scores(mean).collect()
    for r, p in zip(sorted(few, key=lambda r: r.fold), sorted(plain, key=lambda r: r.fold)):
        assert (r.fold, r.n, r.ids) == (p.fold, p.n, p.ids) and r.mean == pytest.approx(p.mean, abs=1e-3) == told[r.fold].mean


def test_one_class_or_another_learner_is_fitted_one_by_one(rows):
    assert oof._sweep_together(rows.withColumn("target", F.lit(0)), {"a": learners.sgd_logistic()}, "target", "fold") is None
    assert oof._sweep_together(rows, {"a": learners.sgd_logistic(), "b": learners.ridge()}, "target", "fold") is None
