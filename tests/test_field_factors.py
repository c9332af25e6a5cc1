"""Field-aware factors against plain loops."""

from itertools import combinations

import numpy as np
import pytest

from riskloom.operators.field_factors import FieldFactors, field_factors_oof
from riskloom.operators.metrics import gini_by_fold
from riskloom.plans.materialize import materialize

ROWS = "id long, target int, fold int, a string, b int, c string, pair string"


def _rows(spark, n=240, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a, b, c = str(rng.choice(["u", "v", "w"])), int(rng.integers(0, 4)), [None, "p", "q"][rng.integers(0, 3)]
        odds = 0.85 if (a == "u") == (b < 2) else 0.15
        out.append((i, int(rng.random() < odds), i % 2, "only0" if i == 4 else a, b, c, "clash"))
    return spark.createDataFrame(out, ROWS)


def _plain(rows, codes, state, model, fits):
    """(weights, squares) after the model's epochs: {(code, field): [fit][factor]}."""
    m, f = len(model.cols), model.factors
    x = [[codes.get((c, str(r[c]))) if r[c] is not None else None for c in model.cols] for r in rows]
    v = {s: np.array(w).reshape(len(fits), f) for s, w in state.items()}
    h = {s: np.ones((len(fits), f)) for s in v}
    for _ in range(model.epochs):
        g = {s: np.zeros((len(fits), f)) for s in v}
        for k, left_out in enumerate(fits):
            for r, codes_of_row in zip(rows, x):
                if r.fold == left_out:
                    continue
                sides = [((p * m + j), (q * m + i)) for (i, p), (j, q) in combinations(enumerate(codes_of_row), 2) if p is not None and q is not None]
                z = sum(v[s][k] @ v[t][k] for s, t in sides) / m
                e = 1 / (1 + np.exp(-z)) - r.target
                for s, t in sides:
                    g[s][k] += e * v[t][k] / m + model.penalty * v[s][k]
                    g[t][k] += e * v[s][k] / m + model.penalty * v[t][k]
        for s in v:
            h[s] = h[s] + g[s] ** 2
            v[s] = v[s] - model.rate * g[s] / np.sqrt(h[s])
    return v, x


def test_steps_and_predictions_equal_plain_loops(spark):
    train = materialize(_rows(spark), "factors-test")
    fits = [0, None]
    start = FieldFactors(["a", "b", "c"], factors=2, epochs=0, fits=fits).fit(train, fold="fold")
    model = FieldFactors(["a", "b", "c"], factors=2, epochs=3, rate=0.1, penalty=0.01, fits=fits).fit(train, fold="fold")
    codes = {(r.feature, r.value): r.code for r in model.codes.table.collect()}
    first = {r.slot: r.v for r in start.state.collect()}
    rows = train.orderBy("id").collect()
    v, x = _plain(rows, codes, first, model, fits)
    got = {r.slot: np.array(r.v).reshape(2, 2) for r in model.state.collect()}
    assert set(got) == set(v) and all(np.allclose(got[s], v[s], atol=1e-9) for s in v)
    lone = codes[("a", "only0")] * 3 + 1
    assert (got[lone][0] == 0).all() and (got[lone][1] != 0).all()  # no row outside fold 0
    scores = {r.id: (r.p0, r.p1) for r in model.predictions(train).collect()}
    assert len(scores) == len(rows)
    for r, row in zip(rows, x):
        for k in (0, 1):
            z = sum(v[p * 3 + j][k] @ v[q * 3 + i][k] for (i, p), (j, q) in combinations(enumerate(row), 2) if p is not None and q is not None) / 3
            assert scores[r.id][k] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_new_values_nulls_and_no_rows(spark):
    train = _rows(spark)
    model = FieldFactors(["a", "b", "c"], epochs=1).fit(train)
    odd = spark.createDataFrame([(1, 0, 0, "new", 77, "newer", ""), (2, 0, 0, None, None, None, ""), (3, 0, 0, "u", 1, None, "")], ROWS)
    got = {r.id: r.p0 for r in model.predictions(odd).collect()}
    assert got[1] == got[2] == 0.5 and got[3] != 0.5
    assert model.predictions(odd.where("id > 9")).count() == 0
    empty = FieldFactors(["a", "b", "c"], epochs=1).fit(train.where("id < 0"))
    assert [r.p0 for r in empty.predictions(odd.where("id = 1")).collect()] == [0.5]


def test_finds_what_only_a_pair_tells(spark):
    train = materialize(_rows(spark, 2000), "factors-test")
    oof = materialize(field_factors_oof(train, FieldFactors(["a", "b", "c"], epochs=11)), "oof")
    assert oof.count() == 2000 and oof.where("prediction IS NULL").count() == 0
    assert gini_by_fold(oof, "target", "prediction").where("fold = -1").first()["gini"] > 0.4


def test_a_second_lookup_path_gives_the_same(spark, monkeypatch):
    """Slots and pairs beyond the broadcast limit are shuffled by key."""
    train = materialize(_rows(spark), "factors-test")
    near = {r.id: r.p0 for r in FieldFactors(["a", "b"], epochs=2).fit(train).predictions(train).collect()}
    from riskloom.operators import field_factors

    plain = field_factors.lookup_join
    monkeypatch.setattr(field_factors, "lookup_join", lambda *a: plain(*a, *["id"] * (7 - len(a)), 0))
    far = {r.id: r.p0 for r in FieldFactors(["a", "b"], epochs=2).fit(train).predictions(train).collect()}
    assert near.keys() == far.keys() and all(abs(near[i] - far[i]) < 1e-9 for i in near)


def test_steps_do_not_unfold_rows_while_pairs_are_few(spark, monkeypatch):
    """Products go to the tasks and errors come back per pair; the unfolded form beyond the limit gives the same, repeated rows included."""
    train = _rows(spark)
    train = materialize(train.unionByName(train.where("id % 7 = 0")), "factors-test")
    far = FieldFactors(["a", "b", "c"], epochs=2, fits=[0, 1], most_pairs=0).fit(train, fold="fold")
    wanted = {r.id: (r.p0, r.p1) for r in far.predictions(train).collect()}
    monkeypatch.delattr(FieldFactors, "_margins")
    near = FieldFactors(["a", "b", "c"], epochs=2, fits=[0, 1]).fit(train, fold="fold")
    got = {r.id: (r.p0, r.p1) for r in near.predictions(train).collect()}
    assert got.keys() == wanted.keys() and all(np.allclose(got[i], wanted[i], atol=1e-9) for i in wanted)
