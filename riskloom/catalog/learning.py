"""Out-of-fold model jobs over the whole labelled table."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.catalog.base import facts_sql, hidden_labels, over_folds, over_fx, query, train_test, with_facts
from riskloom.catalog.scoring import gini_sql
from riskloom.functions.scalars import combine, product, sigmoid, signed_flag
from riskloom.operators import encoders, learners, metrics
from riskloom.operators.field_factors import FieldFactors, field_factors_oof
from riskloom.operators.folds import assign_folds
from riskloom.operators.ftrl import FTRL, ftrl_oof
from riskloom.operators.oof import best_rounds as top_rounds
from riskloom.operators.oof import attach_predictions, coefficient_audit, largest_gradient, oof_predict, round_margins, round_scores, sweep, training_scores
from riskloom.operators.scaling import EqualWidthBinner
from riskloom.plans import first_level
from riskloom.plans.materialize import materialize

ONE_HOT = ["prio_cat", "status_cat", "seg_cat", "nation_cat", "ret_bin", "fstat_bin", "n_lines"]
BINNED = ["qty_12", "price_13", "bal_14"]
PAIRS = [("prio_cat", "nation_cat")]


def one_hot_tables(spark, sf_dir):
    """Binned, combined and one-hot encoded train table (with folds), the encoder, and a maker of the test table."""
    train, test = train_test(spark, sf_dir)
    binner = EqualWidthBinner(BINNED, 20).fit(train, test)
    train, test = (combine(binner.transform(t), PAIRS) for t in (train, test))
    cols = [*ONE_HOT, *BINNED, *[f"{a}_plus_{b}" for a, b in PAIRS]]
    hot = encoders.OneHot(cols).fit(train, test)
    coded = hot.transform(assign_folds(train)).select("id", "target", "fold", "features")
    return coded, hot, lambda: hot.transform(test).select("id", "features")


def _oof(spark, sf_dir, make, floor=0.05):
    train, hot, _ = one_hot_tables(spark, sf_dir)
    return with_facts(oof_predict(train, make(hot), parallel=5).oof, floor)


def _linear(spark, sf_dir, learner, penalty, floor=0.05):
    """Out-of-fold scores of a convex model, and whether every fold's fit is where its gradient vanishes."""
    train, _, _ = one_hot_tables(spark, sf_dir)
    train = materialize(train, "linear", ["fold"])
    result = oof_predict(train, learner, parallel=5)
    steepest = max(largest_gradient(train.where(F.col("fold") != j), learner, models[0], penalty) for j, models in result.models.items())
    return with_facts(result.oof, floor, flags={"stationary": steepest < 1e-3})


@query(facts_sql("stationary"))
def oof_logreg(spark, sf_dir):
    return _linear(spark, sf_dir, learners.logistic(), lambda facts: 1.0 / (0.1 * facts.rows))


@query(over_folds("SELECT COALESCE(fold, -1) AS fold, COUNT(*) AS n_rows, CAST(SUM(target) AS BIGINT) AS n_pos, TRUE AS above_floor FROM tr GROUP BY ROLLUP (fold)"))
def oof_logreg_scores(spark, sf_dir):
    """Rows and positives per fold and pooled, and whether the Gini (pooled) is over 0.05."""
    train, _, _ = one_hot_tables(spark, sf_dir)
    scores = oof_predict(train, learners.logistic(), parallel=5).scores()
    return scores.select("fold", "n_rows", "n_pos", ((F.col("fold") >= 0) | (F.col("gini") > 0.05)).alias("above_floor"))


@query(facts_sql("stationary"))
def oof_sgd_onehot(spark, sf_dir):
    return _linear(spark, sf_dir, learners.sgd_logistic(), lambda facts: 0.002)


@query(facts_sql("stationary"))
def oof_ridge(spark, sf_dir):
    return _linear(spark, sf_dir, learners.ridge(300.0), lambda facts: 300.0 / facts.rows)


@query(facts_sql())
def oof_fm(spark, sf_dir):
    return _oof(spark, sf_dir, lambda hot: learners.factorization(), floor=-0.2)


@query(facts_sql())
def oof_field_factors(spark, sf_dir):
    """Field-aware factors on the coded columns, all folds in the same passes."""
    train, test = train_test(spark, sf_dir)
    binner = EqualWidthBinner(BINNED, 20).fit(train, test)
    rows = assign_folds(binner.transform(train)).select("id", "target", "fold", *ONE_HOT, *BINNED)
    return with_facts(field_factors_oof(rows, FieldFactors([*ONE_HOT, *BINNED])), 0.05)


@query(facts_sql())
def oof_mlp_bag(spark, sf_dir):
    """Five bags of the two-layer net per fold."""
    return _oof(spark, sf_dir, lambda hot: learners.feed_forward(hot.size, (50, 25)))


DENSE = ["n_lines", "qty_12", "price_13", "bal_14", "root_15", "reg_03", "ret_bin", "fstat_bin"]
# few-valued columns only: the mean of a value with a handful of rows gives their own targets away
MEANS = ["prio_cat", "status_cat", "seg_cat", "nation_cat", "prio_cat_plus_nation_cat"]


def mean_encoded(spark, sf_dir, m=None):
    """Train with target means outside every fold, plus the step that assembles the features of one fold."""
    train, test = (combine(t, PAIRS) for t in train_test(spark, sf_dir))
    train = materialize(assign_folds(train), "folded")
    enc = encoders.TargetMean(MEANS, m).fit(train, fold="fold")
    names = [f"{c}_avg" for c in MEANS]
    each = enc.transform(train, "each").select("id", "target", "fold", *DENSE, *names)

    def prepare(df, j):
        at = {n: F.col(n if n in df.columns else f"{n}_{j}") for n in names}
        return VectorAssembler(inputCols=[*DENSE, *names], outputCol="features").transform(df.withColumns(at))

    return encoders.by_fold(each, names, len(enc.vocabulary.fold_n)), enc, test, prepare


def _trees(spark, sf_dir, learner, m=None):
    train, _, _, prepare = mean_encoded(spark, sf_dir, m)
    return with_facts(oof_predict(train, learner, prepare=prepare, parallel=5).oof, 0.05)


@query(facts_sql())
def oof_gbt(spark, sf_dir):
    return _trees(spark, sf_dir, learners.boosted_trees())


@query(facts_sql())
def oof_boosted_leaves(spark, sf_dir):
    return _trees(spark, sf_dir, learners.boosted_leaves(trees=5))


@query(facts_sql())
def oof_regularized_forest(spark, sf_dir):
    return _trees(spark, sf_dir, learners.regularized_forest(trees=5))


@query(facts_sql())
def oof_rf(spark, sf_dir):
    return _trees(spark, sf_dir, learners.random_forest(), encoders.MEAN_WEIGHT)


#: Rounds of `round_curve`, as its SQL has them.
ROUND_TREES = 40


def _boosted_rounds(spark, sf_dir, learner):
    """Fold models of boosted trees, their validation scores after every round, and the rows and the step that they need."""
    train, _, _, prepare = mean_encoded(spark, sf_dir)
    train = materialize(train, "rounds", ["fold"])
    result = oof_predict(train, learner, prepare=prepare, parallel=5, store=False)
    return result, train, prepare, materialize(round_scores(result, train, range(1, learner.trees + 1), prepare), "curve")


@query(over_folds(
    "SELECT fold, round, COUNT(*) AS n_rows, CAST(SUM(target) AS BIGINT) AS n_pos, TRUE AS in_range, TRUE AS learns, TRUE AS ends_at_the_model "
    f"FROM tr, (SELECT UNNEST(RANGE(1, {ROUND_TREES + 1})) AS round) GROUP BY fold, round"
))
def round_curve(spark, sf_dir):
    """Validation AUC after every boosting round; after the last one over one half in the mean, and that of the whole model's own predictions."""
    result, train, prepare, curve = _boosted_rounds(spark, sf_dir, learners.boosted_trees(trees=ROUND_TREES))
    margins = round_margins(result, train, ROUND_TREES, prepare).join(result.oof.select("id", "prediction"), "id")
    apart = margins.agg(F.max(F.abs(sigmoid(2 * F.col("margin")) - F.col("prediction")))).first()[0]
    whole = metrics.auc(result.oof, "target", "prediction", ["fold"]).select("fold", F.col("auc").alias("exact"))
    last = curve.where(F.col("round") == ROUND_TREES).join(whole, "fold")
    off = last.agg(F.max(F.abs(F.col("auc") - F.col("exact")) - F.col("auc_error")).alias("off"), F.avg("auc").alias("auc")).first()
    ends = F.lit(apart < 1e-9 and off["off"] < 1e-9)
    return curve.select("fold", "round", "n_rows", "n_pos", F.col("auc").between(0, 1).alias("in_range"), F.lit(off["auc"] > 0.5).alias("learns"), ends.alias("ends_at_the_model"))


@query("SELECT UNNEST([1, 2, 3]) AS place, TRUE AS in_order, TRUE AS confirmed")
def boosted_best_rounds(spark, sf_dir):
    """The three best of all published rounds of boosted trees by mean validation AUC, each confirmed by the unbinned AUC of the model cut there."""
    result, train, prepare, curve = _boosted_rounds(spark, sf_dir, learners.boosted_trees())
    best = top_rounds(curve).collect()  # three rows
    margins = [round_margins(result, train, r["round"], prepare).withColumn("round", F.lit(r["round"])) for r in best]
    exact = metrics.auc(reduce(DataFrame.unionByName, margins), "target", "margin", ["round", "fold"]).withColumnRenamed("auc", "exact")
    both = curve.join(exact.select("round", "fold", "exact"), ["round", "fold"])
    off = both.groupBy("round").agg((F.max(F.abs(F.col("auc") - F.col("exact")) - F.col("auc_error")) < 1e-9).alias("near"), F.count("*").alias("folds"))
    near = {r["round"]: r["near"] and r["folds"] == 5 for r in off.collect()}
    sorted_right = all(a["mean_score"] >= b["mean_score"] for a, b in zip(best, best[1:]))
    return spark.createDataFrame([(i + 1, sorted_right, near.get(r["round"], False)) for i, r in enumerate(best)], "place int, in_order boolean, confirmed boolean")


@query(over_folds(
    "SELECT j AS fold, COUNT(*) FILTER (fold <> j) AS n_train, COUNT(*) FILTER (fold = j) AS n_val, TRUE AS fits_its_rows_better "
    "FROM tr, (SELECT UNNEST(RANGE(5)) AS j) GROUP BY j"
))
def train_val_summary(spark, sf_dir):
    """Training Gini next to the validation Gini of every fold's model; means over the folds are compared."""
    train, _, _ = one_hot_tables(spark, sf_dir)
    train = materialize(train, "both", ["fold"])
    result = oof_predict(train, learners.logistic(), parallel=5, store=False)
    seen = training_scores(result, train).select("fold", F.col("n_rows").alias("n_train"), F.col("gini").alias("train_gini"))
    both = materialize(seen.join(result.scores().select("fold", F.col("n_rows").alias("n_val"), F.col("gini").alias("val_gini")), "fold"), "summary")
    mean = both.agg(F.avg("train_gini").alias("t"), F.avg("val_gini").alias("v")).first()
    return both.select("fold", "n_train", "n_val", F.lit(mean["t"] > mean["v"]).alias("fits_its_rows_better"))


FEATURES = [*DENSE, *[f"{c}_avg" for c in MEANS]]


@query("SELECT fold, feature, TRUE AS is_share, TRUE AS sums_to_one FROM (SELECT UNNEST(RANGE(5)) AS fold), (SELECT UNNEST(" + str(FEATURES) + ") AS feature)")
def importances(spark, sf_dir):
    """Importance of every feature in every fold's model: shares of one."""
    train, _, _, prepare = mean_encoded(spark, sf_dir)
    found = oof_predict(train, learners.boosted_trees(trees=5), prepare=prepare, parallel=5).importances()
    total = F.sum("importance").over(Window.partitionBy("fold"))  # one row per feature and fold
    share = (F.col("importance") >= 0) & (F.col("importance") <= 1)
    return found.select("fold", F.lit(FEATURES)[F.col("position")].alias("feature"), share.alias("is_share"), (F.abs(total - 1) < 1e-6).alias("sums_to_one"))


def _audit_sql() -> str:
    """Every value of the audited columns with its support in both tables."""
    parts = [f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, is_test FROM cut" for c in [*ONE_HOT, *BINNED]]
    parts += [f"SELECT '{a}_plus_{b}' AS feature, CAST({a} AS VARCHAR) || '_' || CAST({b} AS VARCHAR) AS value, is_test FROM cut" for a, b in PAIRS]
    edges = {c: " + ".join(f"(CASE WHEN {c} > lo_{c} + {i} * ((hi_{c} - lo_{c}) / 20) THEN 1 ELSE 0 END)" for i in range(1, 20)) for c in BINNED}
    span = "span AS (SELECT " + ", ".join(f"MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in BINNED) + " FROM fx)"
    cut = f"cut AS (SELECT id, is_test, {', '.join([*ONE_HOT, *[f'{e} AS {c}' for c, e in edges.items()]])} FROM fx, span)"
    body = (
        "SELECT feature, value, n_train, n_test, CASE WHEN n_train <= 100 OR n_test <= 100 THEN 1 ELSE 0 END AS low_support, TRUE AS is_finite FROM ("
        "SELECT feature, value, COUNT(*) FILTER (is_test = 0) AS n_train, COUNT(*) FILTER (is_test = 1) AS n_test FROM long GROUP BY feature, value) WHERE n_train > 0"
    )
    return over_fx(body, span, cut, "long AS (" + " UNION ALL ".join(parts) + ")")


@query(_audit_sql())
def coef_audit(spark, sf_dir):
    """Support of every one-hot column in both tables next to its coefficient (here: whether that is a finite number)."""
    train, hot, _ = one_hot_tables(spark, sf_dir)
    result = oof_predict(train, learners.ridge(300.0), parallel=5)
    found = coefficient_audit(result.importances(), hot.names())
    return found.select("feature", "value", "n_train", "n_test", "low_support", (F.abs("coefficient") < 1e6).alias("is_finite"))


def _submission(spark, sf_dir, mode):
    """The result of a fit on labelled rows with predictions of the test rows, and the test rows with their features."""
    train, _, test = one_hot_tables(spark, sf_dir)
    rows = materialize(test(), "test")
    return oof_predict(train, learners.logistic(), rows, mode, parallel=5), rows


TEST_FACTS = facts_sql(where="fx WHERE is_test = 1", columns="id")


@query(TEST_FACTS)
def submission_refit(spark, sf_dir):
    """The labels of test rows are known here, but not to the model."""
    return with_facts(_submission(spark, sf_dir, "refit")[0].test, 0.05, hidden_labels(spark, sf_dir))


@query(over_folds("SELECT id, TRUE AS in_range, TRUE AS is_mean FROM fx WHERE is_test = 1"))
def submission_mean(spark, sf_dir):
    """Each test prediction is the mean of what the five fold models, asked one by one, say of the row."""
    result, rows = _submission(spark, sf_dir, "mean")
    single = [result.learner.score(models[0], rows, "one").select("id", "one") for models in result.models.values()]
    asked = reduce(DataFrame.unionByName, single).groupBy("id").agg(F.avg("one").alias("wanted"), F.count("one").alias("n"))
    told = result.test.join(asked, "id")
    close = (F.abs(F.col("prediction") - F.col("wanted")) < 1e-12) & (F.col("n") == 5)
    return told.select("id", F.col("prediction").between(0, 1).alias("in_range"), close.alias("is_mean"))


#: Penalties of the sweep.
ALPHAS = (0.05, 0.02, 0.0075, 0.005, 0.002, 0.001, 0.0005)


@query(over_folds(
    f"SELECT 'alpha=' || a AS setting, COALESCE(fold, -1) AS fold, COUNT(*) AS n_rows, CAST(SUM(target) AS BIGINT) AS n_pos, TRUE AS above_floor "
    f"FROM tr, (SELECT UNNEST({[str(a) for a in ALPHAS]}) AS a) GROUP BY GROUPING SETS ((a, fold), (a))"
))
def sweep_alpha(spark, sf_dir):
    train, _, _ = one_hot_tables(spark, sf_dir)
    found = sweep(train, {f"alpha={a}": learners.sgd_logistic(a) for a in ALPHAS})
    return found.select("setting", "fold", "n_rows", "n_pos", ((F.col("fold") >= 0) | (F.col("gini") > 0.05)).alias("above_floor"))


#: Shares of positives that the class weights of the sweep pretend to even out.
SHARES = (0.5, 0.2, 0.1, 0.05)


@query(over_folds(
    "SELECT w AS share, fold, COUNT(*) AS n_rows, CAST(SUM(target) AS BIGINT) AS n_pos, TRUE AS in_range, TRUE AS leans "
    f"FROM tr, (SELECT UNNEST({[str(w) for w in SHARES]}) AS w) GROUP BY w, fold"
))
def sweep_weight(spark, sf_dir):
    """Class weights 1 / 2w of positives and 1 / 2(1 - w) of negatives; the smaller w, the higher every fold's mean score."""
    train, _, _ = one_hot_tables(spark, sf_dir)

    def scores(df, label, score):
        return metrics.gini(df, label, score, ["fold"]).join(df.groupBy("fold").agg(F.avg(score).alias("mean")), "fold")

    found = sweep(train, {str(w): learners.sgd_logistic(positive_weight=(1 - w) / w) for w in SHARES}, metric=scores)
    found = materialize(found, "swept")  # a row per setting and fold
    above = F.lag("mean").over(Window.partitionBy("fold").orderBy(F.col("setting").cast("double").desc()))
    leans = F.coalesce(F.col("mean") > above, F.lit(True))
    return found.select(F.col("setting").alias("share"), "fold", "n_rows", "n_pos", F.col("gini").between(-1, 1).alias("in_range"), leans.alias("leans"))


HASHED = [*ONE_HOT, *BINNED, "prio_cat_plus_nation_cat"]


@query(facts_sql())
def oof_ftrl(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    binner = EqualWidthBinner(BINNED, 20).fit(train, test)
    rows = assign_folds(combine(binner.transform(train), PAIRS)).select("id", "target", "fold", *HASHED)
    return with_facts(ftrl_oof(rows, FTRL(HASHED)), 0.05)


ROUNDS = ["prio_cat", "ret_bin", "nation_cat", "seg_cat", "status_cat"]


def _rounds_sql() -> str:
    ctes = [
        "f AS (SELECT UNNEST(RANGE(5)) AS j)",
        "pr AS (SELECT j, CAST(SUM(target) AS DOUBLE) / COUNT(*) AS prior FROM tr JOIN f ON tr.fold <> f.j GROUP BY j)",
    ]
    joins, terms, cuts = [], [], []
    for i, c in enumerate(ROUNDS):
        ctes.append(
            f"e{i} AS (SELECT j, v, (CAST(pos AS DOUBLE) / n * n + 2e2 * prior) / (n + 2e2) AS e FROM "
            f"(SELECT j, {c} AS v, SUM(target) AS pos, COUNT(*) AS n FROM tr JOIN f ON tr.fold <> f.j GROUP BY j, {c}) JOIN pr USING (j))"
        )
        joins.append(f"JOIN e{i} ON e{i}.j = tr.fold AND e{i}.v = tr.{c}")
        terms.append(f"e{i}.e")
        cuts.append(f"SELECT {i + 1} AS round, tr.fold, target, ROUND({' + '.join(terms)}, 9) AS score FROM tr {' '.join(joins)}")
    ctes.append("sc AS (" + " UNION ALL ".join(cuts) + ")")
    ctes.append("g AS (" + gini_sql("sc", "target", "score", "round, fold") + ")")
    body = (
        "SELECT round, ROUND(AVG((gini + 1) / 2), 9) AS mean_score, ROUND(STDDEV_POP((gini + 1) / 2), 9) AS std_score "
        "FROM g GROUP BY round ORDER BY 2 DESC, 1 LIMIT 3"
    )
    return over_folds(body, *ctes)


@query(_rounds_sql())
def best_rounds(spark, sf_dir):
    """Additive model grown one encoded feature per round; the three best rounds by mean validation AUC."""
    train, _ = train_test(spark, sf_dir)
    train = materialize(assign_folds(train.select("id", "target", *ROUNDS)), "folded")
    enc = encoders.TargetMean(ROUNDS).fit(train, fold="fold").transform(train, "own")
    total, cuts = None, []
    for i, c in enumerate(ROUNDS):
        total = F.col(f"{c}_avg") if total is None else total + F.col(f"{c}_avg")
        cuts.append(F.struct(F.lit(i + 1).alias("round"), F.round(total, 9).alias("score")))
    curve = metrics.auc(enc.select("fold", "target", F.inline(F.array(*cuts))), "target", "score", ["round", "fold"])
    found = top_rounds(curve)
    return found.select("round", *[F.round(c, 9).alias(c) for c in ("mean_score", "std_score")])


@query(over_folds(
    "SELECT id, fold, target, ROUND((CAST(pos - own_pos AS DOUBLE) / (n - own_n) * (n - own_n) + 2e2 * prior) / (n - own_n + 2e2), 9) AS prediction FROM ("
    "SELECT tr.id, tr.fold, tr.target, SUM(target) OVER (PARTITION BY nation_cat) AS pos, COUNT(*) OVER (PARTITION BY nation_cat) AS n, "
    "SUM(target) OVER (PARTITION BY nation_cat, fold) AS own_pos, COUNT(*) OVER (PARTITION BY nation_cat, fold) AS own_n, "
    "CAST(SUM(target) OVER () - SUM(target) OVER (PARTITION BY fold) AS DOUBLE) / (COUNT(*) OVER () - COUNT(*) OVER (PARTITION BY fold)) AS prior FROM tr)"
))
def oof_assemble(spark, sf_dir):
    """Fold predictions attached to the labelled rows by id; here those of a target mean fitted outside every fold."""
    train, _ = train_test(spark, sf_dir)
    train = materialize(assign_folds(train.select("id", "target", "nation_cat")), "folded")
    enc = encoders.TargetMean(["nation_cat"]).fit(train, fold="fold")
    parts = None
    for j in range(5):
        held = enc.transform(train.where(F.col("fold") == j), j).select("id", F.round("nation_cat_avg", 9).alias("prediction"))
        parts = held if parts is None else parts.unionByName(held)
    return attach_predictions(train.select("id", "fold", "target"), parts)


@query(facts_sql())
def level1_means(spark, sf_dir):
    """Boosted trees on raw columns, decoded region, a coded pair and per-fold target means."""
    train, test = train_test(spark, sf_dir)
    kept = ["prio_cat", "status_cat", "seg_cat", "ret_bin", "n_lines", "qty_12", "price_13"]
    result = first_level.mean_encoded_model(
        train, test, learners.boosted_trees(trees=5), kept, [("prio_cat", "nation_cat")], ("reg_03", "reg")
    )
    return with_facts(result.oof, 0.05)


@query(TEST_FACTS)
def level1_forest(spark, sf_dir):
    """Random forest whose few-valued categories are replaced by their weighted target means."""
    train, test = train_test(spark, sf_dir)
    kept = ["prio_cat", "status_cat", "seg_cat", "nation_cat", "ret_bin", "n_lines", "price_13"]
    result = first_level.mean_encoded_model(
        train, test, learners.random_forest(trees=10), kept, [("prio_cat", "ret_bin")], m=encoders.MEAN_WEIGHT, in_place=True,
        between=(2, 20), mode="mean",
    )
    # ten trees and, at the smallest scale, thirty positives: the Gini's own error is about 0.1 there
    return with_facts(result.test, -0.25, hidden_labels(spark, sf_dir))


@query(facts_sql())
def level1_onehot(spark, sf_dir):
    """Logistic model on binned one-hot columns and pairs with enough support in train and test."""
    train, test = train_test(spark, sf_dir)
    result = first_level.one_hot_model(
        train, test.drop("target"), lambda width: learners.sgd_logistic(),
        without="calc_", binned=BINNED, pairs=[("prio_cat", "nation_cat"), ("prio_cat", "price_13")], skip_binned_pairs=True, min_train=20, pair_min_test=10,
    )
    return with_facts(result.oof, 0.05)


@query(facts_sql())
def level1_ridge(spark, sf_dir):
    """Ridge model with columns routed by their number of values."""
    train, test = train_test(spark, sf_dir)
    kept = [*ONE_HOT, "cust_cat", *BINNED]
    return with_facts(first_level.one_hot_model(train, test, lambda width: learners.ridge(300.0), kept, binned=BINNED, routed=True).oof, 0.05)


@query(facts_sql())
def level1_scaled(spark, sf_dir):
    """Logistic model on flags, decoded region, products and bins scaled to [0, 1]."""
    train, test = train_test(spark, sf_dir)
    products = {
        "lines_prio": product(["n_lines", F.col("prio_cat") + 1]),
        "price_miss_reg": product(["price_13", signed_flag("reg_03")]),
    }
    result = first_level.scaled_model(train, test, learners.logistic(), products, ("reg_03", "reg"), BINNED)
    return with_facts(result.oof, 0.05)
