"""Search for useful two-way feature combinations."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import combine
from riskloom.operators.encoders import MEAN_WEIGHT, OneHot, smoothed_mean
from riskloom.operators.folds import assign_folds
from riskloom.operators.learners import Learner
from riskloom.operators.lookup import lookup_join
from riskloom.operators.metrics import GINI, Metric, gini_of_cells
from riskloom.operators.oof import oof_predict
from riskloom.operators.shared_fits import Codes, FoldFits, fit_shared, shared_scores
from riskloom.plans.materialize import materialize
from riskloom.plans.vocabulary import real_text, value_kind

# fixed values: least gain of a screened and of a greedily added pair, penalty of the refitted model
SCREEN_GAIN = 1e-5
FORWARD_GAIN = 1e-6
SCREEN_ALPHA = 0.0005


def pair_candidates(cols: Sequence[str]) -> list[tuple[str, str]]:
    """All unordered column pairs (metadata only)."""
    return list(combinations(cols, 2))


def pair_cells(df: DataFrame, cols: Sequence[str], label: str, fold: str, k: int) -> DataFrame:
    """Rows and positives per fold of every value pair of every column pair, in one pass over the rows.

    (f1, f2, v1, v2, n0..n(k-1), p0..p(k-1)). Everything else in the screen works on these cells. Values are long if all
    columns are integral, else exact text. The per-row list of pairs is aggregated in the same task, before the shuffle; the row's
    values are one array and pairs are pairs of places in it, so the generated code does not grow with the number of pairs.
    """
    kinds = {c: value_kind(df, c) for c in cols}
    as_text = any(kind != "num" for kind in kinds.values())
    kind_of = "STRING" if as_text else "BIGINT"
    values = [real_text(c) if kinds[c] == "real" else f"CAST(`{c}` AS {kind_of})" for c in cols]
    places = ", ".join(f"struct({cols.index(a)} AS i, {cols.index(b)} AS j)" for a, b in pair_candidates(cols))
    names = ", ".join(f"'{c}'" for c in cols)
    listed = f"transform(array({places}), x -> struct(array({names})[x.i] AS f1, array({names})[x.j] AS f2, _v[x.i] AS v1, _v[x.j] AS v2))"
    flags = [f"CAST({fold} = {j} AS BIGINT) AS _n{j}" for j in range(k)]
    hits = [f"IF({fold} = {j}, CAST({label} AS BIGINT), 0L) AS _p{j}" for j in range(k)]
    rows = df.selectExpr(*flags, *hits, f"array({', '.join(values)}) AS _v").selectExpr("* EXCEPT (_v)", f"inline({listed})")
    sums = [F.expr(f"sum(_{s}{j}) AS {s}{j}") for s in "np" for j in range(k)]
    return rows.groupBy("f1", "f2", "v1", "v2").agg(*sums)


def _outside(names: Sequence[str], j: int) -> str:
    return f"CAST({' + '.join(n for i, n in enumerate(names) if i != j)} AS DOUBLE)"


def _single_key(feature: str, value: str) -> str:
    return f"concat_ws('=', {feature}, CAST({value} AS STRING))"


def _screen_scores(df: DataFrame, cols: Sequence[str], label: str, fold: str, k: int, m: float) -> DataFrame:
    """(f1, f2, fold, kind, score, pos, n): validation rows per score of the pair (kind 1) and of its columns (kind 0)."""
    cols = list(cols)
    cells = materialize(pair_cells(df, cols, label, fold, k), "cells")
    n, p = [f"n{j}" for j in range(k)], [f"p{j}" for j in range(k)]

    # single-column statistics are margins of one chosen pair per column, so they need no pass of their own
    first_pair = f"(f1 = '{cols[0]}' AND f2 = '{cols[1]}')"
    anchor = f"(f1 = '{cols[0]}' AND side = 2) OR ({first_pair} AND side = 1)"
    sides = ", ".join(f"struct({s} AS side, {_single_key(f'f{s}', f'v{s}')} AS key_)" for s in (1, 2))
    singles = cells.selectExpr("f1", "f2", *n, *p, f"inline(array({sides}))").groupBy("key_").agg(
        F.count(F.lit(1)).alias("weight_"), *[F.expr(f"sum(IF({anchor}, {c}, 0L)) AS {c}") for c in [*n, *p]]
    )
    totals = cells.where(first_pair).agg(*[F.sum(c).alias(c) for c in [*n, *p]]).first()
    prior = [
        (sum(totals[x] for x in p) - totals[p[j]]) / (sum(totals[x] for x in n) - totals[n[j]]) for j in range(k)
    ]
    encoded = [smoothed_mean(_outside(p, j), _outside(n, j), prior[j], m) for j in range(k)]
    odds = ", ".join(f"ln(({e}) / (1D - ({e})))" for e in encoded)
    singles = materialize(singles.selectExpr("key_", "weight_", f"array({odds}) AS odds"), "singles")
    size = singles.agg(F.count(F.lit(1)).alias("n"), F.sum("weight_").alias("w")).first()

    rated = cells.selectExpr(
        "f1", "f2", "xxhash64(f1, f2, v1, v2) AS _cell", f"array({', '.join(encoded)}) AS enc",
        f"array({', '.join(n)}) AS n", f"array({', '.join(p)}) AS p",
        f"{_single_key('f1', 'v1')} AS k1", f"{_single_key('f2', 'v2')} AS k2",
    )
    for s in (1, 2):
        outputs = {f"o{s}": ("odds", F.lit(None).cast("array<double>"))}
        rated = lookup_join(rated, singles, f"k{s}", outputs, size["n"], size["w"], spread="_cell")
    scores = [
        f"struct({kind} AS kind, {j} AS fold, {score} AS score, p[{j}] AS pos, n[{j}] AS n)"
        for j in range(k)
        for kind, score in ((1, f"round(enc[{j}], 12)"), (0, f"round(o1[{j}] + o2[{j}], 9)"))
    ]
    return rated.selectExpr("f1", "f2", f"inline(array({', '.join(scores)}))").where("n > 0")


def _screen_gains(scores: DataFrame, by: Sequence[str]) -> DataFrame:
    cells = scores.groupBy(*by, "kind", "score").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    rating = gini_of_cells(cells, [*by, "kind"])
    pick = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("gini")))
    both = rating.groupBy(*by).agg(pick(1).alias("gini"), pick(0).alias("base_gini"))
    return both.withColumn("gain", F.col("gini") - F.col("base_gini"))


def screen_pairs(df: DataFrame, cols: Sequence[str], label: str = "target", fold: str = "fold", k: int = 5, m: float = MEAN_WEIGHT) -> DataFrame:
    """Rate every column pair from one pass over the rows: (f1, f2, gini, base_gini, gain).

    gini: out-of-fold Gini of the pair's smoothed target mean. base_gini: the same for the sum of the two columns'
    own log-odds. gain is the difference: what only the combination knows.
    """
    return _screen_gains(_screen_scores(df, cols, label, fold, k, m), ["f1", "f2"])


def screen_deltas(df: DataFrame, cols: Sequence[str], label: str = "target", fold: str = "fold", k: int = 5, m: float = MEAN_WEIGHT) -> DataFrame:
    """The gains of `screen_pairs` per fold: (f1, f2, fold, delta)."""
    found = _screen_gains(_screen_scores(df, cols, label, fold, k, m), ["f1", "f2", "fold"])
    return found.select("f1", "f2", "fold", F.col("gain").alias("delta"))


def top_pairs(screen: DataFrame, top: int = 30, by: str = "gain") -> DataFrame:
    return screen.orderBy(F.desc(by), "f1", "f2").limit(top)


@dataclass
class PairTables:
    """Rows with the single columns (block 0 to len(cols) - 1) and every candidate pair encoded by one vocabulary."""

    encoder: OneHot
    combined: DataFrame
    cols: list[str]
    pairs: list[tuple[str, str]]
    made: list[str]
    _rows: DataFrame | None = None
    _codes: Codes | None = None

    def codes(self) -> Codes:
        """Positions per block, rows with equal positions and fold put together; written once."""
        if self._codes is None:
            columns = [*self.cols, *self.made]
            df, spots = self.encoder.spots(self.combined)
            code = F.array(*[F.col(spots[c]).cast("int") if c in spots else F.lit(0) for c in columns])
            cells = df.groupBy("fold", code.alias("codes")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("target").cast("long")).alias("pos"))
            cells = materialize(cells.withColumn("fold", F.col("fold").cast("int")), "pair-codes")
            folds = sorted(r["fold"] for r in cells.select("fold").distinct().collect())
            self._codes = Codes(cells, [self.encoder.width.get(c, 0) for c in columns], folds)
        return self._codes

    def blocks(self, chosen: Sequence[tuple[str, str]]) -> list[int]:
        return [*range(len(self.cols)), *[len(self.cols) + self.pairs.index(p) for p in chosen]]

    def features(self, chosen: Sequence[tuple[str, str]]) -> DataFrame:
        """The same as one vector per row, for learners that fit one model at a time."""
        if self._rows is None:
            groups = {"base": self.cols, **{f"pair{i}": [c] for i, c in enumerate(self.made)}}
            rows = self.encoder.blocks(self.combined, groups).select("id", "target", "fold", *groups)
            self._rows = materialize(rows, "pairs", ["fold"])
        blocks = ["base", *[f"pair{self.pairs.index(p)}" for p in chosen]]
        return VectorAssembler(inputCols=blocks, outputCol="features").transform(self._rows).select("id", "target", "fold", "features")


def pair_tables(train: DataFrame, test: DataFrame | None, cols: Sequence[str], pairs: Sequence[tuple[str, str]], label: str = "target") -> PairTables:
    """Encode the single columns and all candidate pairs once; candidates then only select blocks.

    One vocabulary serves all of them, so neither the passes over the rows nor the plan's depth grow with the number of pairs.
    """
    name = "{a}_plus_{b}"
    df = combine(train, pairs, name=name)
    other = combine(test, pairs, name=name) if test is not None else None
    made = [name.format(a=a, b=b) for a, b in pairs]
    encoder = OneHot([*cols, *made]).fit(df, other)
    return PairTables(encoder, df.withColumn("target", F.col(label)), list(cols), list(pairs), made)


class _Fits:
    """Fold scores of the model with some pairs added: by shared passes for all choices at once or, with a learner, one model after the other."""

    def __init__(self, tables: PairTables, alpha: float, learner: Learner | None, metric: Metric):
        self.tables, self.alpha, self.learner, self.metric = tables, alpha, learner, metric
        self.models: dict[tuple[tuple[str, str], ...], FoldFits] = {}

    def scores(self, choices: Sequence[Sequence[tuple[str, str]]], start: Sequence[tuple[str, str]] | None = None) -> list[dict[int, float]]:
        """Metric per fold and pooled (-1) of each choice: a handful of numbers. `start` names a fitted choice to begin from."""
        if self.learner is not None:
            results = [oof_predict(self.tables.features(c), self.learner, store=False) for c in choices]
            return [{r["fold"]: r[self.metric.name] for r in x.scores(self.metric.by_fold).collect()} for x in results]
        codes = self.tables.codes()
        fits = fit_shared(codes, [self.tables.blocks(c) for c in choices], self.alpha, start=self.models[tuple(start)] if start is not None else None)
        self.models = {k: v for k, v in self.models.items() if start is not None and k == tuple(start)} | {tuple(c): f for c, f in zip(choices, fits)}
        return shared_scores(codes, fits, self.metric)


def screen_exact(tables: PairTables, learner: Learner | None = None, min_gain: float = SCREEN_GAIN, alpha: float = SCREEN_ALPHA, metric: Metric = GINI) -> DataFrame:
    """Refit the linear model once per candidate pair: (f1, f2, gini, delta, kept), against the model without pairs.

    `delta` is positive where the pair helps, also for a loss; with another `metric` its value stands under its own name.

    The logistic models of all candidates and folds (penalty `alpha`) are fitted in shared passes, beginning at the model without pairs; another `learner` is fitted one
    model at a time.
    """
    fits = _Fits(tables, alpha, learner, metric)
    base = fits.scores([[]])[0][-1]
    found = fits.scores([[p] for p in tables.pairs], start=[])
    rated = [(pair, s[-1], metric.sign * (s[-1] - base)) for pair, s in zip(tables.pairs, found)]
    rows = [(a, b, value, delta, int(delta > min_gain)) for (a, b), value, delta in rated]
    return tables.combined.sparkSession.createDataFrame(rows, f"f1 string, f2 string, {metric.name} double, delta double, kept int")


def forward_select(
    tables: PairTables, learner: Learner | None = None, min_gain: float = FORWARD_GAIN, all_folds: bool = False, alpha: float = SCREEN_ALPHA, ahead: int = 8,
    metric: Metric = GINI,
) -> DataFrame:
    """Greedy pass over the candidates in their order: a pair stays if the mean fold score grows by more than
    `min_gain` or, with all_folds, if the score of every fold grows. One row per step.

    The next `ahead` candidates are fitted together against the pairs kept so far; those after the first one that stays are fitted again
    with it, so the outcome is that of one candidate at a time.
    """
    fits = _Fits(tables, alpha, learner, metric)
    chosen: list[tuple[str, str]] = []
    best = fits.scores([chosen])[0]
    rows, step = [], 0
    while step < len(tables.pairs):
        window = tables.pairs[step : step + (ahead if learner is None else 1)]
        for (a, b), found in zip(window, fits.scores([[*chosen, p] for p in window], start=list(chosen))):
            gains = [metric.sign * (found[j] - best[j]) for j in best if j >= 0]
            # mean AUC grows by half of what mean Gini grows
            kept = min(gains) > 0 if all_folds else sum(gains) / len(gains) * metric.gain > min_gain
            rows.append((step, a, b, sum(found[j] for j in found if j >= 0) / len(gains), min(gains), int(kept)))
            step += 1
            if kept:
                chosen.append((a, b))
                best = found
                break
    schema = f"step int, f1 string, f2 string, mean_{metric.name} double, min_gain double, kept int"
    return tables.combined.sparkSession.createDataFrame(rows, schema)


def improves_everywhere(deltas: DataFrame, by: Sequence[str] = ("f1", "f2"), delta: str = "delta") -> DataFrame:
    """The stricter rule on a (pair, fold, delta) table: keep pairs whose every fold improves."""
    return deltas.groupBy(*by).agg(F.min(delta).alias("min_delta"), F.avg(delta).alias("mean_delta")).withColumn(
        "kept", (F.col("min_delta") > 0).cast("int")
    )


def search_pairs(train: DataFrame, test: DataFrame | None, cols: Sequence[str], top_k: int = 30, exact: bool = False,
                 label: str = "target", learner: Learner | None = None) -> DataFrame:
    """Screen all pairs in one pass, then (exact) run the greedy selection over the best `top_k`."""
    folded = train if "fold" in train.columns else materialize(assign_folds(train, stratify=label), "folded")
    ranked = top_pairs(screen_pairs(folded, cols, label), top_k)
    if not exact:
        return ranked
    pairs = [(r["f1"], r["f2"]) for r in ranked.collect()]
    return forward_select(pair_tables(folded, test, cols, pairs, label), learner)
