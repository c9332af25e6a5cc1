"""Model jobs: coverage, ranges, repeatability, agreement with plain numpy."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskloom.functions.scalars import hash_row
from riskloom.operators import learners
from riskloom.operators.encoders import OneHot, TargetMean
from riskloom.operators.ftrl import FTRL, ftrl_oof
from riskloom.operators.metrics import auc, gini_by_fold
from riskloom.operators.oof import auc_of_bins, best_rounds, oof_predict, round_cells, round_margins, round_scores
from riskloom.plans.materialize import materialize
from riskloom.operators.stacking import _candidate_ginis, exact_values, fit_blend, tuple_counts

COLS = ["prio_cat", "nation_cat", "ret_bin", "n_lines"]


@pytest.fixture(scope="module")
def coded(tables):
    train, test = tables
    hot = OneHot(COLS).fit(train, test)
    return hot.transform(train).select("id", "target", "fold", "features"), hot.transform(test).select("id", "features"), hot


def check(oof, train):
    rows = oof.collect()
    assert sorted(r.id for r in rows) == sorted(r.id for r in train.select("id").collect())
    assert all(0.0 <= r.prediction <= 1.0 for r in rows)


@pytest.mark.parametrize("mode", ["refit", "mean"])
def test_every_row_gets_one_prediction(coded, mode):
    train, test, _ = coded
    result = oof_predict(train, learners.sgd_logistic(), test, mode)
    check(result.oof, train)
    check(result.test, test)


def test_ridge_equals_the_normal_equations(coded):
    train, _, hot = coded
    alpha = 30.0
    result = oof_predict(train, learners.ridge(alpha))
    rows = [r for r in train.collect() if r.fold != 2]
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([2 * r.target - 1 for r in rows], dtype=float)
    rate = (y > 0).mean()
    w = np.where(y > 0, 1 / (2 * rate), 1 / (2 * (1 - rate)))
    xm, ym = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    xc, yc = x - xm, y - ym
    beta = np.linalg.solve((xc * w[:, None]).T @ xc + alpha * np.eye(x.shape[1]), (xc * w[:, None]).T @ yc)
    assert np.allclose(result.models[2][0].coefficients.toArray(), beta, atol=1e-6)


def test_same_seed_gives_the_same_forest(coded):
    train, _, _ = coded
    a, b = (oof_predict(train, learners.random_forest(trees=3, min_rows=5)).oof for _ in range(2))
    assert a.exceptAll(b).count() == 0


def test_bagged_net_averages_its_members(coded):
    train, test, hot = coded
    learner = learners.feed_forward(hot.size, (4,), iterations=3, bags=2)
    result = oof_predict(train, learner, test, "refit")
    assert len(result.refit) == 2
    parts = [learners.mean_score(learner, [m], test, "p").select("id", "p") for m in result.refit]
    joined = parts[0].join(parts[1].withColumnRenamed("p", "q"), "id").join(result.test, "id")
    assert joined.where(F.abs((F.col("p") + F.col("q")) / 2 - F.col("prediction")) > 1e-12).count() == 0


def test_rounds_of_a_boosted_model(coded):
    train, _, _ = coded
    result = oof_predict(train, learners.boosted_trees(trees=4, depth=2, subsample=1.0))
    curve = materialize(round_scores(result, train, [1, 2, 4, 9]), "curve")  # there is no ninth round
    assert curve.count() == 15
    for at in (1, 2, 4):
        whole = auc(round_margins(result, train, at), "target", "margin", ["fold"]).withColumnRenamed("auc", "exact")
        rows = curve.where(F.col("round") == at).join(whole, ["fold", "n_rows", "n_pos"]).collect()
        assert len(rows) == 5 and all(abs(r.auc - r.exact) <= r.auc_error + 1e-12 for r in rows)
    full = {r.fold: (r.gini + 1) / 2 for r in result.scores().collect()}
    assert all(abs(r.auc - full[r.fold]) <= r.auc_error + 1e-12 for r in curve.where("round = 4").collect())
    assert best_rounds(curve, 2).count() == 2
    with pytest.raises(ValueError):
        round_margins(result, train, 5)


def test_round_bins_count_every_row_in_every_round(coded):
    train, _, _ = coded
    result = oof_predict(train, learners.boosted_trees(trees=3, depth=2, subsample=1.0))
    rows = train.where("fold = 0")
    few = round_cells(result.models[0][0], rows.repartition(3), [1, 3], 0.0, bins=4).collect()
    assert {r["round"] for r in few} == {1, 3} and all(0 <= r["bin"] < 4 and 0 <= r["pos"] <= r["n"] for r in few)
    for at in (1, 3):
        margins = [(r.margin, r.target) for r in round_margins(result, train, at).where("fold = 0").collect()]
        want: dict[int, list[int]] = {}
        for m, y in margins:
            cell = want.setdefault(min(3, int(4 / (1 + np.exp(-2 * m)))), [0, 0])
            cell[0] += y
            cell[1] += 1
        assert {r["bin"]: [r["pos"], r["n"]] for r in few if r["round"] == at} == want
    assert round_cells(result.models[0][0], rows.where("id < 0"), [1], 0.0).count() == 0


def test_area_of_bins_by_hand(spark):
    cells = spark.createDataFrame([(0, 2, 1, 1), (0, 1, 1, 3), (0, 0, 0, 2), (1, 5, 0, 4)], "fold int, bin int, pos long, n long")
    got = {r.fold: r for r in auc_of_bins(cells, ["fold"]).collect()}
    assert (got[0].n_rows, got[0].n_pos, got[0].auc, got[0].auc_error) == (6, 2, (4 + 3) / 8, 1 / 8)
    assert got[1].auc is None and got[1].auc_error is None


def test_fold_encoding_ignores_the_targets_of_its_fold(tables):
    train, _ = tables
    flipped = train.withColumn("target", F.when(F.col("fold") == 1, 1 - F.col("target")).otherwise(F.col("target")))
    a, b = (TargetMean(["nation_cat"]).fit(t, fold="fold").transform(t, 1).where("fold = 1") for t in (train, flipped))
    assert a.select("id", "nation_cat_avg").exceptAll(b.select("id", "nation_cat_avg")).count() == 0


def test_nested_encoding_leaves_out_both_folds(tables):
    train, _ = tables
    got = TargetMean(["nation_cat"], nested=True).fit(train, fold="fold").transform(train, 1).where("fold = 3")
    rest = train.where("fold NOT IN (1, 3)")
    want = TargetMean(["nation_cat"]).fit(rest).transform(train.where("fold = 3")).select("id", F.col("nation_cat_avg").alias("want"))
    assert got.join(want, "id").where(F.abs(F.col("nation_cat_avg") - F.col("want")) > 1e-12).count() == 0


def test_batches_step_as_plain_loops_do(tables):
    train, _ = tables
    small = train.where("fold < 2")
    model = FTRL(COLS, dim=64, epochs=2, batches=3, interactions=True, fits=(1, None)).fit(small, fold="fold")  # 64 buckets, so cells do collide
    state = {r.bucket: (r.z0, r.n0, r.z1, r.n1) for r in model.state.collect()}
    turns = [F.pmod(F.xxhash64("id", F.lit(model.seed), F.lit(e)), F.lit(3)).alias(f"t{e}") for e in (0, 1)]
    rows = small.select("fold", "target", hash_row(COLS, 64, True).alias("x"), *turns).collect()
    start = {b: int(hashlib.md5(f"{model.seed}:{b}".encode()).hexdigest()[:8], 16) / 2**32 for b in state}
    for k, left_out in enumerate((1, None)):
        z, n = dict(start), dict.fromkeys(start, 0.0)
        for e in (0, 1):
            for part in range(3):
                w = {b: 0.0 if abs(z[b]) <= 1e-5 else (np.sign(z[b]) * 1e-5 - z[b]) / ((1.0 + n[b] ** 0.5) / 0.1 + 1.0) for b in z}
                g = dict.fromkeys(z, 0.0)
                for r in rows:
                    if r[f"t{e}"] == part and r.fold != left_out:
                        error = 1 / (1 + np.exp(-max(min(sum(w[b] for b in r.x), 35.0), -35.0))) - r.target
                        for b in r.x:
                            g[b] += error
                for b in z:
                    z[b] += g[b] - ((n[b] + g[b] ** 2) ** 0.5 - n[b] ** 0.5) / 0.1 * w[b]
                    n[b] += g[b] ** 2
        assert all(abs(z[b] - state[b][2 * k]) < 1e-6 and abs(n[b] - state[b][2 * k + 1]) < 1e-6 for b in state)


def test_more_rows_do_not_learn_less(tables):
    train, _ = tables
    once = ftrl_oof(train, FTRL(COLS))
    check(once, train)
    copies = train.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("id", F.col("id") * 10 + F.col("copy"))
    many = ftrl_oof(copies, FTRL(COLS))
    pooled = lambda oof: gini_by_fold(oof, "target", "prediction").where("fold = -1").first()["gini"]
    assert pooled(many) > pooled(once) - 0.02


def test_assembled_features_need_their_columns(tables):
    train, _ = tables
    with pytest.raises(ValueError):
        oof_predict(train.drop("fold"), learners.logistic())
    rows = VectorAssembler(inputCols=["n_lines"], outputCol="features").transform(train)
    with pytest.raises(ValueError):
        oof_predict(rows, learners.logistic(), mode="other")


def test_blend_bears_outliers_and_scales_but_no_holes(spark):
    rng = np.random.default_rng(4)
    y = (rng.random(3000) < 0.2).astype(int)
    a, b = y + rng.normal(0, 2, 3000), y + rng.normal(0, 3, 3000)
    frame = lambda x, z: spark.createDataFrame([(int(t), i % 3, float(u), float(v)) for i, (t, u, v) in enumerate(zip(y, x, z))], "target int, fold int, a double, b double")
    plain = fit_blend(frame(a, b), ["a", "b"])[-1]
    wild = np.append(a[:-1], 1e9)
    far = fit_blend(frame(wild, b), ["a", "b"])[-1]
    assert np.abs(np.array(plain) - far).max() < 0.1
    both = {j: exact_values(frame(a, b), ["a", "b"], "target", "fold", {-1: w})[-1] for j, w in enumerate((plain, [1.0, 0.0], [0.0, 1.0], [0.5, 0.5]))}
    assert both[0] >= max(both.values())
    assert np.allclose(fit_blend(frame(1000 * a, 1000 * b), ["a", "b"])[-1], plain)
    with pytest.raises(ValueError):
        fit_blend(frame(np.append(a[:-1], np.nan), b), ["a", "b"])


def test_blend_of_few_valued_scores_over_many_rows_rates_exactly(spark):
    rng = np.random.default_rng(11)
    kinds = [(float(a), float(b)) for a, b in zip(rng.normal(0, 1, 50), rng.normal(0, 1, 50))]
    pick = spark.createDataFrame([(i, a, b, float(1 / (1 + np.exp(1.5 - 0.8 * a - 0.5 * b)))) for i, (a, b) in enumerate(kinds)], "k int, a double, b double, p double")
    rows = spark.range(1_000_000).selectExpr("CAST(xxhash64(id) % 1000 AS INT) AS u", "CAST(id % 3 AS INT) AS fold", "rand(5) AS r", "CAST(floor(50 * pow(rand(6), 3)) AS INT) AS k")
    rows = materialize(rows.join(F.broadcast(pick), "k").select((F.col("r") < F.col("p")).cast("int").alias("target"), "fold", "a", "b"), "few")
    cells = tuple_counts(rows, ["a", "b"], "target", "fold")
    assert cells.count() <= 300
    trials = [(t, -1, [np.cos(x), np.sin(x)]) for t, x in enumerate(np.linspace(0, 3, 9))]
    rough = _candidate_ginis(cells, ["a", "b"], "target", "fold", trials)
    for t, _, w in trials:
        assert rough[t] == pytest.approx(exact_values(rows, ["a", "b"], "target", "fold", {-1: w})[-1], abs=1e-12)
    found = fit_blend(rows, ["a", "b"])[-1]
    best = max(exact_values(cells, ["a", "b"], "target", "fold", dict(enumerate([w for _, _, w in trials], 100))).values())
    assert exact_values(cells, ["a", "b"], "target", "fold", {-1: found})[-1] >= best - 1e-4
