"""Logistic fits in shared passes against fits one at a time, and the searches built on them."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from riskloom.operators import search, shared_fits
from riskloom.operators.learners import sgd_logistic
from riskloom.operators.metrics import gini_by_fold
from riskloom.operators.shared_fits import Codes, fit_shared, shared_scores

COLS = ["prio_cat", "seg_cat", "ret_bin"]
PAIRS = [("prio_cat", "seg_cat"), ("seg_cat", "ret_bin")]


@pytest.fixture(scope="module")
def pairs(tables):
    train, test = tables
    return search.pair_tables(train.select("id", "target", "fold", *COLS), test.select("id", *COLS), COLS, PAIRS)


def test_weights_are_those_of_separate_fits(pairs):
    codes = pairs.codes()
    base, one, both = fit_shared(codes, [pairs.blocks([]), pairs.blocks(PAIRS[:1]), pairs.blocks(PAIRS)])
    for found, chosen in ((base, []), (one, PAIRS[:1]), (both, PAIRS)):
        rows = pairs.features(chosen).where("fold != 1").withColumn("y", F.col("target").cast("double"))
        model = LogisticRegression(labelCol="y", regParam=0.0005, elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-14).fit(rows)
        w = found.weights[:, codes.folds.index(1)]
        assert np.abs(w[1:] - model.coefficients.toArray()).max() < 2e-3
        assert abs(w[0] - model.intercept) < 2e-3
    warm = fit_shared(codes, [pairs.blocks(PAIRS)], start=one)[0]
    assert np.abs(warm.weights - both.weights).max() < 2e-3


def test_scores_and_kept_pairs_are_those_of_separate_fits(pairs):
    shared = {(r.f1, r.f2): r for r in search.screen_exact(pairs).collect()}
    separate = {(r.f1, r.f2): r for r in search.screen_exact(pairs, sgd_logistic(0.0005, max_iter=500)).collect()}
    for k, r in separate.items():
        assert abs(shared[k].gini - r.gini) < 1e-3 and abs(shared[k].delta - r.delta) < 1e-3


def test_candidates_ahead_do_not_change_the_greedy_outcome(pairs):
    together = search.forward_select(pairs, min_gain=-1.0, ahead=8).collect()
    single = search.forward_select(pairs, min_gain=-1.0, ahead=1).collect()
    assert [(r.step, r.f1, r.f2, r.kept) for r in together] == [(0, *PAIRS[0], 1), (1, *PAIRS[1], 1)] == [(r.step, r.f1, r.f2, r.kept) for r in single]
    assert all(abs(a.mean_gini - b.mean_gini) < 1e-3 for a, b in zip(together, single))
    assert not any(r.kept for r in search.forward_select(pairs, min_gain=2.0).collect())


def test_pooled_scores_are_ranked_over_all_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(j, [int(a), int(b)], 1, int(rng.random() < 0.2 + 0.15 * a)) for j in range(3) for a, b in zip(rng.integers(0, 4, 300), rng.integers(0, 3, 300))]
    cells = spark.createDataFrame(rows, "fold int, codes array<int>, n long, pos long")
    codes = Codes(cells, [3, 3], [0, 1, 2])  # code 3 of block 0 is unknown
    (fits,) = fit_shared(codes, [[0, 1]])
    (got,) = shared_scores(codes, [fits])
    scored = [(j, y, float(fits.weights[0, j] + (fits.weights[1 + c[0], j] if c[0] < 3 else 0) + fits.weights[4 + c[1], j])) for j, c, _, y in rows]
    want = gini_by_fold(spark.createDataFrame(scored, "fold int, y int, s double").withColumn("s", F.round("s", 9)), "y", "s")
    assert {r.fold: round(r.gini, 12) for r in want.collect()} == {k: round(v, 12) for k, v in got.items()}


def test_refuses_folds_without_both_labels(spark):
    cells = spark.createDataFrame([(0, [0], 5, 0), (1, [0], 5, 0)], "fold int, codes array<int>, n long, pos long")
    with pytest.raises(ValueError):
        fit_shared(Codes(cells, [1], [0, 1]), [[0]])


def test_blocks_that_repeat_others_take_few_passes(spark, monkeypatch):
    """Seven columns and all their pairs on 800 rows: the fits remember enough steps to converge. Sums are worked out here, not in tasks, to be quick."""
    rng = np.random.default_rng(5)
    raw = [rng.integers(0, w, 800) for w in (5, 3, 5, 25, 3, 3, 8)]
    pairs = [raw[a] * 25 + raw[b] for a in range(7) for b in range(a)]
    x = np.column_stack([np.unique(c, return_inverse=True)[1] for c in [*raw, *pairs]])
    fold, pos = np.arange(800) % 2, (rng.random(800) < np.where(raw[0] == 1, 0.3, 0.08)).astype(int)
    widths = [int(w) + 1 for w in x.max(axis=0)]
    passes = 0

    def sums(codes, fits, positive_weight, curvature):
        nonlocal passes
        passes += 1
        out = {}
        for k, f in enumerate(fits):
            z = shared_fits._margins(x, f.blocks, widths, f.weights)
            apart, p = fold[:, None] != np.array([0, 1]), 1 / (1 + np.exp(-z))
            each = apart * (p * (1 - p) if curvature else p - pos[:, None])
            loss = (apart * np.logaddexp(0, np.where(pos[:, None] == 1, -z, z))).sum(axis=0)
            blocks = [[np.bincount(x[:, b], each[:, j], widths[b]) for j in (0, 1)] for b in f.blocks]
            out[k] = np.concatenate([loss[None], each.sum(axis=0)[None], *[np.stack(b, axis=1) for b in blocks]])
        return out

    monkeypatch.setattr(shared_fits, "_sums", sums)
    cells = spark.createDataFrame([(int(f), 1, int(p)) for f, p in zip(fold, pos)], "fold int, n long, pos long")
    fit, = shared_fits.fit_shared(shared_fits.Codes(cells, widths, [0, 1]), [range(len(widths))])
    gradient = sums(None, [fit], 1.0, False)[0][2:] / 400 + 0.0005 * fit.weights[1:]
    assert abs(gradient).max() < 1e-6 and passes < 200
