"""Prediction stores, submissions, blending and the full feature set."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import facts_sql, folded, hidden_labels, over_folds, over_fx, query, train_test, wide, with_facts
from riskloom.catalog.encoding import SIGMOID
from riskloom.catalog.scoring import gini_sql
from riskloom.functions.scalars import fixed_text, linear_blend
from riskloom.operators import encoders, learners, metrics
from riskloom.operators.folds import assign_folds
from riskloom.operators.stacking import fit_blend, stack
from riskloom.plans.materialize import materialize, new_path
from riskloom.plans.recipes import Recipe, full_features
from riskloom.sources import predictions as P

MODELS = ["by_bal", "by_lines", "by_prio"]

# three scores per row; the middle one exists only for orders with lines
STORE = """
store AS (
  SELECT id, 'by_prio' AS model, 1e0 / (1e0 + prio_cat) AS prediction FROM fx
  UNION ALL SELECT id, 'by_lines', n_lines / 8e0 FROM fx WHERE n_lines > 0
  UNION ALL SELECT id, 'by_bal', (bal_14 + 1e3) / 2e4 FROM fx)"""


def store(spark, sf_dir):
    df = wide(spark, sf_dir)
    cells = F.array(
        F.struct(F.lit("by_prio").alias("model"), (1.0 / (1.0 + F.col("prio_cat"))).alias("prediction")),
        F.struct(F.lit("by_lines").alias("model"), F.when(F.col("n_lines") > 0, F.col("n_lines") / 8.0).alias("prediction")),
        F.struct(F.lit("by_bal").alias("model"), ((F.col("bal_14") + 1e3) / 2e4).alias("prediction")),
    )
    return df.select("id", F.inline(cells)).where("prediction IS NOT NULL")


@query(over_fx(
    "SELECT id, MAX(prediction) FILTER (model = 'by_bal') AS by_bal, MAX(prediction) FILTER (model = 'by_lines') AS by_lines, "
    "MAX(prediction) FILTER (model = 'by_prio') AS by_prio FROM store GROUP BY id",
    STORE,
))
def pred_store_wide(spark, sf_dir):
    """Through the partitioned store on disk: written per model, read back, made wide."""
    path = new_path(spark, "store")
    store(spark, sf_dir).write.partitionBy("model").parquet(path)
    return P.prediction_wide(P.read_store(spark, path), MODELS)


@query(over_fx("SELECT id, ROUND(AVG(prediction), 9) AS prediction FROM store GROUP BY id", STORE))
def mean_submission(spark, sf_dir):
    found = P.mean_predictions(store(spark, sf_dir))
    return found.select("id", F.round("prediction", 9).alias("prediction"))


@query(over_fx("SELECT fx.id, store.prediction AS target FROM fx LEFT JOIN store ON fx.id = store.id AND store.model = 'by_lines' WHERE is_test = 1", STORE))
def submission_fill(spark, sf_dir):
    template = wide(spark, sf_dir).where("is_test = 1").select("id", F.lit(0.0).alias("target"))
    return P.fill_submission(template, store(spark, sf_dir).where("model = 'by_lines'"))


@query(over_fx("SELECT id, model, PRINTF('%.9f', prediction) AS prediction FROM store", STORE))
def pred_format(spark, sf_dir):
    return store(spark, sf_dir).select("id", "model", fixed_text("prediction").alias("prediction"))


@query(over_fx(
    "SELECT id, 0e0 + 6e-1 * by_prio + -1e-1 * by_lines + 3e-1 * by_bal AS blend FROM ("
    "SELECT id, 1e0 / (1e0 + prio_cat) AS by_prio, n_lines / 8e0 AS by_lines, (bal_14 + 1e3) / 2e4 AS by_bal FROM fx)"
))
def linear_blend_rows(spark, sf_dir):
    df = wide(spark, sf_dir).select(
        "id", (1.0 / (1.0 + F.col("prio_cat"))).alias("by_prio"), (F.col("n_lines") / 8.0).alias("by_lines"),
        ((F.col("bal_14") + 1e3) / 2e4).alias("by_bal"),
    )
    return df.select("id", linear_blend({"by_prio": 0.6, "by_lines": -0.1, "by_bal": 0.3}).alias("blend"))


@query(over_folds(
    "SELECT model, ROUND(gini, 9) AS gini, CAST(TRUNC(gini * 1000000) AS BIGINT) AS score_code, "
    "model || '_' || CAST(CAST(TRUNC(gini * 1000000) AS BIGINT) AS VARCHAR) || '_2024_02_03_04h05' AS file_stem FROM g",
    STORE,
    "sc AS (SELECT tr.target, store.model, store.prediction AS score FROM tr JOIN store ON tr.id = store.id)",
    "g AS (" + gini_sql("sc", "target", "score", "model") + ")",
))
def run_catalog(spark, sf_dir):
    """Every score column as a run: its Gini over the labelled rows, its score code, and its name at a given time."""
    runs = store(spark, sf_dir).join(folded(spark, sf_dir).select("id", "target"), "id")
    found = P.run_catalog(metrics.gini(runs, "target", "prediction", ["model"]), at=F.lit("2024-02-03 04:05:00").cast("timestamp"))
    return found.withColumn("gini", F.round("gini", 9))


@query(over_fx(
    "SELECT id, MAX(prediction) FILTER (model = 'by_bal') AS by_bal, MAX(prediction) FILTER (model = 'by_lines') AS by_lines, "
    "MAX(prediction) FILTER (model = 'by_prio') AS by_prio, MAX(target) AS target FROM (SELECT id, model, CAST(PRINTF('%.9f', prediction) AS DOUBLE) AS prediction, "
    "CASE WHEN model = 'by_bal' THEN NULL ELSE target END AS target FROM store JOIN (SELECT id, target FROM fx) USING (id)) GROUP BY id",
    STORE,
))
def csv_store_wide(spark, sf_dir):
    """Through CSV files of different writers (id, target, score; id, score, target; id, score), read back by their headers."""
    folder = new_path(spark, "csv")
    rows = store(spark, sf_dir).join(wide(spark, sf_dir).select("id", "target"), "id")
    orders = {"by_prio": ["id", "target", "by_prio"], "by_lines": ["id", "by_lines", "target"], "by_bal": ["id", "by_bal"]}
    for model, columns in orders.items():
        text = rows.where(F.col("model") == model).withColumn(model, fixed_text("prediction")).select(*columns)
        text.write.csv(f"{folder}/{model}", header=True)
    return P.csv_wide(P.read_csv_store(spark, folder, mark="", models_from="folder"), MODELS)


@query(over_folds("SELECT id, fold, CAST(PRINTF('%.9f', 1e0 / (1e0 + prio_cat)) AS DOUBLE) AS prediction FROM tr"))
def fold_files_read(spark, sf_dir):
    """Through headerless prediction files, one folder per fold."""
    folder = new_path(spark, "folds")
    P.write_fold_predictions(folded(spark, sf_dir).select("id", "fold", (1.0 / (1.0 + F.col("prio_cat"))).alias("prediction")), folder)
    return P.read_fold_predictions(spark, folder)


RATED = ["prio_cat", "ret_bin", "n_lines", "price_13"]


@query(over_folds(
    "SELECT feature, ROUND(ABS(gini), 9) AS importance FROM g",
    "sc AS (" + " UNION ALL ".join(f"SELECT target, '{c}' AS feature, CAST({c} AS DOUBLE) AS score FROM tr" for c in RATED) + ")",
    "g AS (" + gini_sql("sc", "target", "score", "feature") + ")",
))
def importances_file(spark, sf_dir):
    """How well each column alone ranks the rows, through the importances file."""
    path = new_path(spark, "importances")
    rows = folded(spark, sf_dir).select("target", *[F.col(c).cast("double").alias(c) for c in RATED])
    rated = metrics.gini(rows.unpivot(["target"], RATED, "feature", "score"), "target", "score", ["feature"])
    P.write_importances(rated.select("feature", F.abs("gini").alias("importance")), path)
    return P.read_importances(spark, path).select("feature", F.round("importance", 9).alias("importance"))


LOSSES = ["by_bal", "by_prio", "by_qty"]
LOSS_ROWS = """
lr AS (SELECT fold, target, (bal_14 + 1e3) / 2e4 AS by_bal, 1e0 / (1e0 + prio_cat) AS by_prio, (qty_12 + 2e0) / 1e3 AS by_qty FROM tr)"""


@query(over_folds(
    "SELECT f.fold, model, ROUND(-AVG(CASE WHEN target = 1 THEN LN(p) ELSE LN(1e0 - p) END), 9) AS log_loss, TRUE AS weights_sum_to_one, TRUE AS beats_every_model "
    "FROM (SELECT UNNEST(RANGE(5)) AS fold) f JOIN (SELECT fold, target, model, GREATEST(LEAST(p, 1e0 - 1e-14), 1e-14) AS p FROM ll) ll ON ll.fold <> f.fold GROUP BY f.fold, model",
    LOSS_ROWS,
    "ll AS (" + " UNION ALL ".join(f"SELECT fold, target, '{m}' AS model, {m} AS p FROM lr" for m in LOSSES) + ")",
))
def blend_log_loss(spark, sf_dir):
    """Weights per fold of the blend with the least log loss, beside the loss of each score alone over the same rows."""
    scores = [((F.col("bal_14") + 1e3) / 2e4).alias("by_bal"), (1.0 / (1.0 + F.col("prio_cat"))).alias("by_prio"), ((F.col("qty_12") + 2.0) / 1e3).alias("by_qty")]
    train = materialize(folded(spark, sf_dir).select("target", "fold", *scores), "blend")
    weights = fit_blend(train, LOSSES, fits=range(5), negative=False, metric=metrics.LOG_LOSS)
    rows = []
    for j, w in weights.items():
        outside = train.where(F.col("fold") != j).withColumn("blend", linear_blend(dict(zip(LOSSES, w))))
        cells = metrics.score_cells(outside.unpivot(["target"], ["blend", *LOSSES], "model", "score"), "target", "score", ["model"])
        rated = {r["model"]: r["log_loss"] for r in metrics.LOG_LOSS.rate(cells, ["model"]).collect()}
        best = rated["blend"] <= min(rated[m] for m in LOSSES) + 1e-12
        rows += [(j, m, rated[m], abs(sum(map(abs, w)) - 1) < 1e-9, best) for m in LOSSES]
    found = spark.createDataFrame(rows, "fold int, model string, log_loss double, weights_sum_to_one boolean, beats_every_model boolean")
    return found.withColumn("log_loss", F.round("log_loss", 9))


FIRST_LEVEL = ["prio_cat", "nation_cat", "seg_cat", "ret_bin", "prio_nation"]


def first_level(spark, sf_dir):
    """Out-of-fold and test target means of single columns and of one pair, as first-level predictions (wide)."""
    pair = F.concat_ws("_", "prio_cat", "nation_cat").alias("prio_nation")
    keep = [c for c in FIRST_LEVEL if c != "prio_nation"]
    train, test = train_test(spark, sf_dir)
    train = materialize(assign_folds(train.select("id", "target", *keep, pair)), "folded")
    enc = encoders.TargetMean(FIRST_LEVEL, suffix="").fit(train, fold="fold")
    return enc.transform(train, "own"), enc.transform(test.select("id", *keep, pair))


@query("SELECT fold, model, TRUE AS weights_sum_to_one, TRUE AS beats_every_model FROM (SELECT UNNEST(RANGE(5)) AS fold), (SELECT UNNEST(" + str(FIRST_LEVEL) + ") AS model)")
def blend_fit(spark, sf_dir):
    """Weights per fold of the blend that maximises Gini: their sizes add up to one, and no single model is better."""
    train, _ = first_level(spark, sf_dir)
    train = materialize(train.select("target", "fold", *FIRST_LEVEL), "blend")
    weights = fit_blend(train, FIRST_LEVEL, fits=range(5))
    rows = []
    for j, w in weights.items():
        outside = train.where(F.col("fold") != j).withColumn("blend", linear_blend(dict(zip(FIRST_LEVEL, w))))
        long = outside.unpivot(["target"], ["blend", *FIRST_LEVEL], "model", "score")
        rated = {r["model"]: r["gini"] for r in metrics.gini(long, "target", "score", ["model"]).collect()}
        best = rated["blend"] >= max(rated[m] for m in FIRST_LEVEL) - 1e-9
        rows += [(j, m, abs(sum(map(abs, w)) - 1) < 1e-9, best) for m in FIRST_LEVEL]
    return spark.createDataFrame(rows, "fold int, model string, weights_sum_to_one boolean, beats_every_model boolean")


@query(facts_sql(where="fx WHERE is_test = 1", columns="id"))
def blend_calibrate(spark, sf_dir):
    """Test predictions: the calibrated blend of every fold, averaged."""
    train, test = first_level(spark, sf_dir)
    return with_facts(stack(train, FIRST_LEVEL, test).test, 0.05, hidden_labels(spark, sf_dir))


@query(facts_sql())
def stack_oof(spark, sf_dir):
    train, test = first_level(spark, sf_dir)
    return with_facts(stack(train, FIRST_LEVEL, test).oof, 0.05)


@query(over_folds(
    "SELECT model, ROUND(AVG(gini), 9) AS coef FROM g GROUP BY model",
    STORE,
    "sc AS (SELECT tr.target, tr.fold, store.model, store.prediction AS score FROM tr JOIN store ON tr.id = store.id)",
    "g AS (SELECT model, fold, CAST(SUM(CAST(pos AS HUGEINT) * (2 * cum - neg)) AS DOUBLE) / (CAST(SUM(pos) AS DOUBLE) * CAST(SUM(neg) AS DOUBLE)) - 1e0 AS gini "
    "FROM (SELECT *, SUM(neg) OVER (PARTITION BY model, fold ORDER BY score) AS cum FROM ("
    "SELECT model, fold, score, SUM(target) AS pos, COUNT(*) - SUM(target) AS neg FROM sc GROUP BY model, fold, score)) GROUP BY model, fold)",
))
def blend_coef_mean(spark, sf_dir):
    """Mean over the folds of one figure per model and fold (here its Gini)."""
    rows = store(spark, sf_dir).join(folded(spark, sf_dir).select("id", "target", "fold"), "id")
    per_fold = metrics.gini(rows, "target", "prediction", ["model", "fold"])
    return per_fold.groupBy("model").agg(F.round(F.avg("gini"), 9).alias("coef"))


RECIPE = Recipe(
    ["prio_cat", "status_cat", "seg_cat", "nation_cat", "ret_bin", "fstat_bin", "n_lines", "reg_03", "qty_12", "price_13"],
    ["reg_03", "qty_12", "price_13"],
    [("prio_cat", "nation_cat"), ("seg_cat", "ret_bin")],
)


def _full_sql() -> str:
    def cut(c):
        return " + ".join(f"(CASE WHEN {c} > lo_{c} + {i} * ((hi_{c} - lo_{c}) / 50) THEN 1 ELSE 0 END)" for i in range(1, 50)) + f" AS {c}"

    coded = ["prio_cat", "status_cat", "seg_cat", "nation_cat", "ret_bin", "fstat_bin"]
    combos = [f"{a}_{b}_cmb" for a, b in RECIPE.pairs]
    span = "span AS (SELECT " + ", ".join(f"MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in RECIPE.binned) + " FROM fx)"
    base = (
        "base AS (SELECT id, is_test, target, " + ", ".join([*coded, "n_lines"]) + ", " + ", ".join(cut(c) for c in RECIPE.binned) + ", "
        + ", ".join(f"CAST({a} AS VARCHAR) || '|' || CAST({b} AS VARCHAR) AS {a}_{b}_cmb" for a, b in RECIPE.pairs) + " FROM fx, span)"
    )
    pr = "pr AS (SELECT CAST(SUM(target) AS DOUBLE) / COUNT(*) AS prior, COUNT(*) AS total FROM fx WHERE is_test = 0)"
    ctes, picks, joins = [span, base, pr], [], []
    for i, c in enumerate([*coded, *combos]):
        ctes.append(
            f"v{i} AS (SELECT v, n / CAST(total AS DOUBLE) AS freq, {SIGMOID} AS enc FROM "
            f"(SELECT {c} AS v, SUM(target) AS pos, COUNT(*) AS n FROM base WHERE is_test = 0 GROUP BY {c}), pr)"
        )
        name = c if c in combos else f"{c}_freq"
        picks += [f"ROUND(COALESCE(v{i}.freq, 0), 9) AS {name}", f"ROUND(COALESCE(v{i}.enc, prior), 9) AS {c}_avg"]
        joins.append(f"LEFT JOIN v{i} ON base.{c} = v{i}.v")
    values = {"prio_cat": range(1, 6), "status_cat": (70, 79, 80), "ret_bin": (-1, 0, 1), "fstat_bin": (-1, 0, 1), "nation_cat": range(25)}
    dummies = [f"CASE WHEN base.{c} = {v} THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in values.items() for v in vs]
    dummies += [f"CASE WHEN base.seg_cat = {v} THEN 1 ELSE 0 END AS \"seg_cat_{v}\"" for v in SEGMENTS]
    plain = ["id", "is_test", *[f"base.{c}" for c in [*coded, "n_lines", *RECIPE.binned]]]
    return over_fx(f"SELECT {', '.join([*plain, *picks, *dummies])} FROM base CROSS JOIN pr {' '.join(joins)}", *ctes)


# first letters of the five market segments, as character codes
SEGMENTS = (65, 66, 70, 72, 77)


@query(_full_sql())
def fe_full(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    left, right, names = full_features(train, test, RECIPE)
    both = left.select("id", F.lit(0).alias("is_test"), *names).unionByName(right.select("id", F.lit(1).alias("is_test"), *names))
    round_these = [c for c in names if c.endswith(("_freq", "_avg", "_cmb"))]
    return both.select("id", "is_test", *[F.round(c, 9).alias(c) if c in round_these else F.col(c) for c in names])


@query(facts_sql())
def oof_full_features(spark, sf_dir):
    """The full feature set with boosted trees."""
    from pyspark.ml.feature import VectorAssembler

    from riskloom.operators.oof import oof_predict

    train, test = train_test(spark, sf_dir)
    left, _, names = full_features(assign_folds(train), test, RECIPE)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(left)
    return with_facts(oof_predict(rows.select("id", "target", "fold", "features"), learners.boosted_leaves(), parallel=5).oof, 0.05)
