"""Queries of the combination search."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.catalog.base import over_folds, query, wide
from riskloom.catalog.scoring import gini_sql
from riskloom.operators import learners, search
from riskloom.operators.combination_search import combination_means, keep_if_improves
from riskloom.operators.folds import assign_folds
from riskloom.operators.profile import pair_usage as usage_of
from riskloom.plans.materialize import materialize, new_path
from riskloom.sources.order_risk import split_origin

COLS = ["prio_cat", "status_cat", "seg_cat", "nation_cat", "ret_bin", "fstat_bin", "n_lines"]
PAIRS = search.pair_candidates(COLS)
MIXED = ["calc_disc", "root_15", "prio_cat"]


def _folded(spark, sf_dir):
    train, test = split_origin(wide(spark, sf_dir))
    return materialize(assign_folds(train.select("id", "target", *COLS)), "folded"), test.select("id", *COLS)


def _screen_ctes() -> list[str]:
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, CAST({a} AS BIGINT) AS v1, CAST({b} AS BIGINT) AS v2, fold, target FROM tr" for a, b in PAIRS
    )
    ones = " UNION ALL ".join(f"SELECT '{c}' AS f, CAST({c} AS BIGINT) AS v, fold, target FROM tr" for c in COLS)
    enc = "(CAST(pos AS DOUBLE) / n * n + 2e2 * prior) / (n + 2e2)"
    return [
        f"cells AS (SELECT f1, f2, v1, v2, fold, COUNT(*) AS n, SUM(target) AS pos FROM ({cells}) GROUP BY ALL)",
        f"ones AS (SELECT f, v, fold, COUNT(*) AS n, SUM(target) AS pos FROM ({ones}) GROUP BY ALL)",
        "j AS (SELECT UNNEST(RANGE(5)) AS j)",
        "pr AS (SELECT j, CAST(SUM(target) AS DOUBLE) / COUNT(*) AS prior FROM tr JOIN j ON fold <> j GROUP BY j)",
        "outside AS (SELECT f1, f2, v1, v2, j, SUM(n) AS n, SUM(pos) AS pos FROM cells JOIN j ON fold <> j GROUP BY ALL)",
        "out1 AS (SELECT f, v, j, SUM(n) AS n, SUM(pos) AS pos FROM ones JOIN j ON fold <> j GROUP BY ALL)",
        f"e2 AS (SELECT f1, f2, v1, v2, j, {enc} AS e FROM outside JOIN pr USING (j))",
        f"e1 AS (SELECT f, v, j, LN(e / (1 - e)) AS o FROM (SELECT f, v, j, {enc} AS e FROM out1 JOIN pr USING (j)))",
        "alls AS (SELECT DISTINCT f1, f2, v1, v2, fold AS j FROM cells)",
        "sc AS (SELECT c.f1, c.f2, c.fold, c.n, c.pos, ROUND(COALESCE(e2.e, pr.prior), 12) AS pair_score, "
        "ROUND(COALESCE(a.o, LN(pr.prior / (1 - pr.prior))) + COALESCE(b.o, LN(pr.prior / (1 - pr.prior))), 9) AS base_score "
        "FROM cells c JOIN pr ON pr.j = c.fold "
        "LEFT JOIN e2 ON e2.f1 = c.f1 AND e2.f2 = c.f2 AND e2.v1 = c.v1 AND e2.v2 = c.v2 AND e2.j = c.fold "
        "LEFT JOIN e1 a ON a.f = c.f1 AND a.v = c.v1 AND a.j = c.fold "
        "LEFT JOIN e1 b ON b.f = c.f2 AND b.v = c.v2 AND b.j = c.fold)",
        "g2 AS (" + _cell_gini("pair_score") + ")",
        "g1 AS (" + _cell_gini("base_score") + ")",
        "screen AS (SELECT f1, f2, ROUND(g2.gini, 9) AS gini, ROUND(g1.gini, 9) AS base_gini, ROUND(g2.gini - g1.gini, 9) AS gain "
        "FROM g2 JOIN g1 USING (f1, f2))",
    ]


def _cell_gini(score: str) -> str:
    return (
        gini_sql("sc", "pos", score, "f1, f2")
        .replace("SUM(pos) AS pos, COUNT(*) - SUM(pos) AS neg", "SUM(pos) AS pos, SUM(n) - SUM(pos) AS neg")
    )


def _rounded(screen):
    return screen.select("f1", "f2", *[F.round(c, 9).alias(c) for c in ("gini", "base_gini", "gain")])


@query(over_folds("SELECT f1, f2, gini, base_gini, gain FROM screen", *_screen_ctes()))
def pair_screen(spark, sf_dir):
    return _rounded(search.screen_pairs(_folded(spark, sf_dir)[0], COLS))


@query(over_folds("SELECT f1, f2, gini, base_gini, gain FROM screen ORDER BY gain DESC, f1, f2 LIMIT 5", *_screen_ctes()))
def pair_top(spark, sf_dir):
    return search.top_pairs(_rounded(search.screen_pairs(_folded(spark, sf_dir)[0], COLS)), 5)


@query(over_folds(
    "SELECT feature, COUNT(*) AS n_pairs FROM (SELECT f1 AS feature FROM screen WHERE gain > 0 UNION ALL "
    "SELECT f2 FROM screen WHERE gain > 0) GROUP BY feature",
    *_screen_ctes(),
))
def pair_usage(spark, sf_dir):
    screen = _rounded(search.screen_pairs(_folded(spark, sf_dir)[0], COLS))
    return usage_of(screen.where("gain > 0"))


@query(over_folds(
    "SELECT f1, f2, COUNT(*) AS n_cells, CAST(SUM(n) AS BIGINT) AS n_rows, CAST(SUM(pos) AS BIGINT) AS n_pos FROM (SELECT f1, f2, v1, v2, "
    "SUM(n) AS n, SUM(pos) AS pos FROM cells GROUP BY ALL) GROUP BY f1, f2",
    *_screen_ctes()[:1],
))
def pair_candidates(spark, sf_dir):
    """Every unordered column pair with its number of value pairs and rows."""
    cells = search.pair_cells(_folded(spark, sf_dir)[0], COLS, "target", "fold", 5)
    n, p = (sum((F.col(f"{s}{j}") for j in range(1, 5)), F.col(f"{s}0")) for s in "np")
    return cells.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("n_cells"), F.sum(n).alias("n_rows"), F.sum(p).alias("n_pos"))


@query(over_folds(
    "SELECT f1, f2, COUNT(*) AS n_cells, CAST(SUM(n) AS BIGINT) AS n_rows, CAST(SUM(pos) AS BIGINT) AS n_pos FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, COUNT(*) AS n, SUM(target) AS pos FROM tr GROUP BY {a}, {b}" for a, b in search.pair_candidates(MIXED)
    ) + ") GROUP BY f1, f2"
))
def pair_screen_double(spark, sf_dir):
    """Value pairs of fractional and integral columns, by exact value."""
    train, _ = split_origin(wide(spark, sf_dir))
    cells = search.pair_cells(assign_folds(train.select("id", "target", *MIXED)), MIXED, "target", "fold", 5)
    n, p = (sum((F.col(f"{s}{j}") for j in range(1, 5)), F.col(f"{s}0")) for s in "np")
    return cells.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("n_cells"), F.sum(n).alias("n_rows"), F.sum(p).alias("n_pos"))


@query(over_folds(
    "SELECT f1, f2, ROUND(MIN(d), 9) AS min_delta, ROUND(AVG(d), 9) AS mean_delta, CASE WHEN ROUND(MIN(d), 9) > 0 THEN 1 ELSE 0 END AS kept FROM ("
    "SELECT a.f1, a.f2, a.fold, a.gini - b.gini AS d FROM ga a JOIN gb b USING (f1, f2, fold)) GROUP BY f1, f2",
    *_screen_ctes(),
    "ga AS (" + _cell_gini("pair_score").replace("f1, f2", "f1, f2, fold") + ")",
    "gb AS (" + _cell_gini("base_score").replace("f1, f2", "f1, f2, fold") + ")",
))
def pair_all_folds(spark, sf_dir):
    """Pairs whose encoding beats the sum of its two columns in every fold."""
    found = search.improves_everywhere(search.screen_deltas(_folded(spark, sf_dir)[0], COLS))
    return found.select("f1", "f2", F.round("min_delta", 9).alias("min_delta"), F.round("mean_delta", 9).alias("mean_delta"),
                        (F.round("min_delta", 9) > 0).cast("int").alias("kept"))


def _tables(spark, sf_dir):
    """All candidate pairs, the best of the screen first."""
    folded, test = _folded(spark, sf_dir)
    best = search.top_pairs(search.screen_pairs(folded, COLS), len(PAIRS)).collect()
    return search.pair_tables(folded, test, COLS, [(r["f1"], r["f2"]) for r in best])


PAIRS_SQL = "SELECT f1, f2, TRUE AS {flag} FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in PAIRS) + ") p(f1, f2)"


@query(PAIRS_SQL.format(flag="kept_by_its_gain"))
def pair_screen_exact(spark, sf_dir):
    """One refit per candidate pair; a pair is kept if and only if its gain passes the limit."""
    found = search.screen_exact(_tables(spark, sf_dir))
    gained = (F.col("delta") > search.SCREEN_GAIN).cast("int") == F.col("kept")
    return found.select("f1", "f2", (gained & (F.abs("gini") <= 1)).alias("kept_by_its_gain"))


@query(PAIRS_SQL.format(flag="never_worse"))
def pair_forward(spark, sf_dir):
    """Greedy pass over all candidate pairs; the mean Gini of the kept model never falls."""
    found = search.forward_select(_tables(spark, sf_dir))
    kept = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # one row per candidate pair
    before = F.max(F.when(F.col("kept") == 1, F.col("mean_gini"))).over(kept)
    fine = (F.col("kept") == 0) | before.isNull() | (F.col("mean_gini") > before)
    return found.select("f1", "f2", fine.alias("never_worse"))


TRIALS = [("prio_cat", "nation_cat"), ("seg_cat", "status_cat"), ("prio_cat", "seg_cat", "ret_bin")]
TRIAL_NAMES = ["_plus_".join(c) for c in TRIALS]


@query(
    "SELECT step, combination, TRUE AS kept_by_its_gain, TRUE AS best_is_carried FROM (VALUES (-1, NULL), "
    + ", ".join(f"({i}, '{c}')" for i, c in enumerate(TRIAL_NAMES)) + ") t(step, combination)"
)
def forest_combinations(spark, sf_dir):
    """Combinations of two and three columns, each tried by a forest on target means; the log of all trials."""
    folded, _ = _folded(spark, sf_dir)
    tables = combination_means(folded, COLS, TRIALS)
    log = keep_if_improves(tables, learners.random_forest(trees=20), new_path(spark, "trials"))
    before = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # one row per candidate
    best = F.max(F.when(F.col("kept") == 1, F.col("score"))).over(before)
    by_gain = (F.col("step") == -1) | ((F.col("score") > F.col("best_before")) == (F.col("kept") == 1))
    return log.select("step", "combination", by_gain.alias("kept_by_its_gain"), F.col("best_before").eqNullSafe(best).alias("best_is_carried"))
