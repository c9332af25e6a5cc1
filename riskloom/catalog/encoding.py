"""Encoders, lookups, support filters and text export."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import folded, long_sql, over_folds, over_fx, query, train_test
from riskloom.functions.scalars import combine, square_trunc
from riskloom.operators import encoders
from riskloom.operators.folds import assign_folds
from riskloom.operators.scaling import EqualWidthBinner
from riskloom.plans.materialize import materialize, new_path
from riskloom.plans.vocabulary import fit_vocabulary
from riskloom.sources.ffm_text import ffm_lines, fit_field_codes, fit_fold_codes, fold_lines, read_keyed, write_keyed

CODED = ["prio_cat", "seg_cat", "nation_cat", "cust_cat"]
PAIR = "seg_cat_plus_nation_cat"
PAIR_SQL = "CAST(seg_cat AS VARCHAR) || '_' || CAST(nation_cat AS VARCHAR)"


def _paired(df):
    return combine(df, [("seg_cat", "nation_cat")])


FX_PAIR = f"fxp AS (SELECT *, {PAIR_SQL} AS {PAIR} FROM fx)"


def _codes_sql(order: str, scope: str, unknown: str = "-1") -> str:
    """Codes of CODED and the pair column joined to every row."""
    ctes, picks, joins = [FX_PAIR], [], []
    for i, c in enumerate([*CODED, PAIR]):
        key = {"sorted": f"ORDER BY {c}", "first": "ORDER BY first_id"}[order]
        ctes.append(
            f"d{i} AS (SELECT {c} AS v, ROW_NUMBER() OVER ({key}) - 1 AS code FROM "
            f"(SELECT {c}, MIN(id) AS first_id FROM fxp WHERE {scope} GROUP BY {c}))"
        )
        picks.append(f"COALESCE(d{i}.code, {unknown}) AS {c}")
        joins.append(f"LEFT JOIN d{i} ON fxp.{c} = d{i}.v")
    return over_fx(f"SELECT fxp.id, fxp.is_test, {', '.join(picks)} FROM fxp {' '.join(joins)}", *ctes)


def _coded(spark, sf_dir, order, on_both):
    train, test = (_paired(t) for t in train_test(spark, sf_dir))
    cols = [*CODED, PAIR]
    codes = encoders.CategoryCodes(cols, order).fit(train, test if on_both else None)
    out = [codes.transform(t).select("id", F.lit(i).alias("is_test"), *cols) for i, t in enumerate((train, test))]
    return out[0].unionByName(out[1])


@query(_codes_sql("sorted", "TRUE"))
def label_encode(spark, sf_dir):
    return _coded(spark, sf_dir, "sorted", True)


@query(_codes_sql("sorted", "is_test = 0"))
def factorize_sorted(spark, sf_dir):
    return _coded(spark, sf_dir, "sorted", False)


@query(_codes_sql("first", "is_test = 0"))
def factorize_first(spark, sf_dir):
    return _coded(spark, sf_dir, "first", False)


@query(
    over_fx(
        """
, vocab AS (SELECT feature, num, value, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY num) - 1 AS code,
                   COUNT(*) OVER (PARTITION BY feature) AS width
            FROM long WHERE is_test = 0 GROUP BY feature, num, value)
SELECT long.id, (CASE WHEN long.feature = 'prio_cat' THEN 0
                      WHEN long.feature = 'seg_cat' THEN (SELECT MAX(width) FROM vocab WHERE feature = 'prio_cat')
                      ELSE (SELECT MAX(width) FROM vocab WHERE feature = 'prio_cat')
                         + (SELECT MAX(width) FROM vocab WHERE feature = 'seg_cat') END) + code AS position
FROM long JOIN vocab USING (feature, num)""".lstrip(),
        "long AS (" + long_sql(["prio_cat", "seg_cat", "cust_cat"], "fx", "id, is_test") + ")",
    ).replace(")\n, vocab", "),\nvocab")
)
def one_hot_long(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    hot = encoders.OneHot(["prio_cat", "seg_cat", "cust_cat"]).fit(train)
    return hot.positions(train.drop("target").unionByName(test))


@query(
    over_fx(
        """
SELECT feature, value, n_train, n_test FROM (
  SELECT feature, value, COUNT(*) FILTER (is_test = 0) AS n_train, COUNT(*) FILTER (is_test = 1) AS n_test
  FROM long GROUP BY feature, value)
WHERE n_train >= 50 AND n_test >= 20""",
        "long AS ("
        + long_sql(CODED, "fx", "is_test")
        + f" UNION ALL SELECT '{PAIR}', NULL, {PAIR_SQL}, is_test FROM fx)",
    )
)
def support_filter(spark, sf_dir):
    train, test = (_paired(t) for t in train_test(spark, sf_dir))
    table = fit_vocabulary(train, test, [*CODED, PAIR]).table
    kept = encoders.supported_values(table, min_train=50, min_test=20)
    return kept.select("feature", "value", "n_train", "n_test")


@query(
    over_fx(
        "SELECT fx.id, "
        + ", ".join(
            f"COALESCE((SELECT CAST(COUNT(*) AS DOUBLE) FROM fx x WHERE x.is_test = 0 AND x.{c} = fx.{c}), 0) / CAST(n.n AS DOUBLE) AS {c}_freq"
            for c in ["prio_cat", "cust_cat"]
        )
        + " FROM fx, (SELECT COUNT(*) AS n FROM fx WHERE is_test = 0) n"
    )
)
def freq_encode(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    cols = ["prio_cat", "cust_cat"]
    freq = encoders.Frequency(cols).fit(train)
    both = train.drop("target").unionByName(test)
    return freq.transform(both).select("id", *[f"{c}_freq" for c in cols])


MEANS = ["nation_cat", "cust_cat", "ret_bin"]
WEIGHTED = "(CAST(pos AS DOUBLE) / n * n + 2e2 * prior) / (n + 2e2)"
SIGMOID = "prior * (1e0 - 1e0 / (1e0 + EXP(-(n - 200) / 1e1))) + CAST(pos AS DOUBLE) / n * (1e0 / (1e0 + EXP(-(n - 200) / 1e1)))"


def _means_sql(formula: str, digits: int = 9) -> str:
    ctes = ["pr AS (SELECT CAST(SUM(target) AS DOUBLE) / COUNT(*) AS prior FROM fx WHERE is_test = 0)"]
    picks, joins = [], []
    for i, c in enumerate(MEANS):
        ctes.append(f"m{i} AS (SELECT {c} AS v, SUM(target) AS pos, COUNT(*) AS n FROM fx WHERE is_test = 0 GROUP BY {c})")
        ctes.append(f"e{i} AS (SELECT v, {formula} AS enc FROM m{i}, pr)")
        picks.append(f"ROUND(COALESCE(e{i}.enc, pr.prior), {digits}) AS {c}_avg")
        joins.append(f"LEFT JOIN e{i} ON fx.{c} = e{i}.v")
    return over_fx(f"SELECT fx.id, {', '.join(picks)} FROM fx {' '.join(joins)} CROSS JOIN pr", *ctes)


def _means(spark, sf_dir, m):
    train, test = train_test(spark, sf_dir)
    enc = encoders.TargetMean(MEANS, m).fit(train)
    both = train.drop("target").unionByName(test)
    return enc.transform(both).select("id", *[F.round(f"{c}_avg", 9).alias(f"{c}_avg") for c in MEANS])


@query(_means_sql(WEIGHTED))
def target_mean_m(spark, sf_dir):
    return _means(spark, sf_dir, encoders.MEAN_WEIGHT)


@query(_means_sql(SIGMOID))
def target_mean_sigmoid(spark, sf_dir):
    return _means(spark, sf_dir, None)


def _fold_means_sql() -> str:
    ctes = [
        "f AS (SELECT UNNEST(RANGE(5)) AS j)",
        "pr AS (SELECT j, CAST(SUM(target) AS DOUBLE) / COUNT(*) AS prior FROM tr JOIN f ON tr.fold <> f.j GROUP BY j)",
    ]
    picks, joins = [], []
    for i, c in enumerate(MEANS):
        ctes.append(
            f"m{i} AS (SELECT j, {c} AS v, SUM(target) AS pos, COUNT(*) AS n FROM tr JOIN f ON tr.fold <> f.j GROUP BY j, {c})"
        )
        ctes.append(f"e{i} AS (SELECT j, v, {WEIGHTED} AS enc FROM m{i} JOIN pr USING (j))")
        picks.append(f"ROUND(COALESCE(e{i}.enc, pr.prior), 9) AS {c}_avg")
        joins.append(f"LEFT JOIN e{i} ON tr.{c} = e{i}.v AND tr.fold = e{i}.j")
    body = f"SELECT tr.id, tr.fold, {', '.join(picks)} FROM tr JOIN pr ON tr.fold = pr.j {' '.join(joins)}"
    return over_folds(body, *ctes)


@query(_fold_means_sql())
def target_mean_fold(spark, sf_dir):
    train = materialize(folded(spark, sf_dir).select("id", "target", "fold", *MEANS), "folded")
    enc = encoders.TargetMean(MEANS).fit(train, fold="fold").transform(train, "own")
    return enc.select("id", "fold", *[F.round(f"{c}_avg", 9).alias(f"{c}_avg") for c in MEANS])


@query(
    over_fx(
        "SELECT id, is_test, " + ", ".join(f"CASE WHEN {c} = {v} THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in
        {"prio_cat": range(1, 6), "status_cat": (70, 79, 80), "ret_bin": (-1, 0, 1)}.items() for v in vs) + " FROM fx"
    )
)
def dummy_shared(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    dummies = encoders.Dummies(["prio_cat", "status_cat", "ret_bin"]).fit(train, test)
    both = train.drop("target").withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))
    made = dummies.transform(both)
    return made.select("id", "is_test", *[c for c in made.columns if c not in both.columns])


FIELDS = ["prio_cat", "seg_cat", "cust_cat", "ret_bin", "root_15", "qty_12"]


def _ffm_sql() -> str:
    cut = " + ".join(f"(CASE WHEN qty_12 > lo + {i} * ((hi - lo) / 50) THEN 1 ELSE 0 END)" for i in range(1, 50))
    coded = (
        "coded AS (SELECT id, is_test, CASE WHEN is_test = 1 THEN 0 ELSE target END AS label, prio_cat, seg_cat, cust_cat, ret_bin, "
        f"CAST(TRUNC(root_15 * root_15) AS INT) AS root_15, {cut} AS qty_12 "
        "FROM fx, (SELECT MIN(qty_12) AS lo, MAX(qty_12) AS hi FROM fx))"
    )
    cells = "cells AS (" + " UNION ALL ".join(
        f"SELECT id, is_test, label, {i} AS field, CAST({c} AS BIGINT) AS num FROM coded" for i, c in enumerate(FIELDS)
    ) + ")"
    codes = (
        "codes AS (SELECT field, num, ROW_NUMBER() OVER (ORDER BY a NULLS LAST, t, field) AS code FROM ("
        "SELECT field, num, MIN(id) FILTER (is_test = 0) AS a, "
        "CASE WHEN MIN(id) FILTER (is_test = 0) IS NULL THEN MIN(id) END AS t FROM cells GROUP BY field, num))"
    )
    body = (
        "SELECT id, is_test, CAST(label AS VARCHAR) || ' ' || STRING_AGG(field || ':' || code || ':1', ' ' ORDER BY field) AS value "
        "FROM cells JOIN codes USING (field, num) GROUP BY id, is_test, label"
    )
    return over_fx(body, coded, cells, codes)


def _field_coded(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    binner = EqualWidthBinner(["qty_12"], 50).fit(train, test)
    train, test = (binner.transform(t).withColumn("root_15", square_trunc("root_15")) for t in (train, test))
    return train, test, fit_field_codes(train, test, FIELDS)


@query(f"SELECT id, CAST(LENGTH(value) AS DOUBLE) AS prediction FROM ({_ffm_sql()}) WHERE is_test = 0")
def ffm_round_trip(spark, sf_dir):
    """Lines written without keys, scored by a reader that sees the text alone, and the scores brought back to the ids."""
    train, test, codes = _field_coded(spark, sf_dir)
    lines = ffm_lines(train, codes, "target")
    text, scored = new_path(spark, "ffm-text"), new_path(spark, "ffm-scores")
    keys = write_keyed(lines, text, rows_per_file=5_000)
    files = spark.read.text(text, wholetext=True)
    lengths = F.transform(F.split(F.regexp_replace("value", "\n$", ""), "\n"), lambda x: F.length(x).cast("string"))
    files.select(F.array_join(lengths, "\n").alias("value"), "part").write.partitionBy("part").text(scored)
    return read_keyed(spark, scored, keys)


@query(_ffm_sql())
def libffm_lines(spark, sf_dir):
    train, test, codes = _field_coded(spark, sf_dir)
    left = ffm_lines(train, codes, "target").withColumn("is_test", F.lit(0))
    right = ffm_lines(test.withColumn("target", F.lit(0)), codes, "target").withColumn("is_test", F.lit(1))
    return left.unionByName(right)


def _ffm_fold_sql() -> str:
    cut = " + ".join(f"(CASE WHEN qty_12 > lo + {i} * ((hi - lo) / 50) THEN 1 ELSE 0 END)" for i in range(1, 50))
    coded = (
        "coded AS (SELECT id, fold, target, prio_cat, seg_cat, cust_cat, ret_bin, "
        f"CAST(TRUNC(root_15 * root_15) AS INT) AS root_15, {cut} AS qty_12 FROM tr, (SELECT MIN(qty_12) AS lo, MAX(qty_12) AS hi FROM fx))"
    )
    cells = "cells AS (" + " UNION ALL ".join(
        f"SELECT id, fold AS own, target, {i} AS field, CAST({c} AS BIGINT) AS num FROM coded" for i, c in enumerate(FIELDS)
    ) + ")"
    codes = (
        "codes AS (SELECT j, field, num, ROW_NUMBER() OVER (PARTITION BY j ORDER BY a NULLS LAST, CASE WHEN a IS NULL THEN t END, field) AS code FROM ("
        "SELECT j, field, num, MIN(id) FILTER (own <> j) AS a, MIN(id) AS t FROM cells, (SELECT UNNEST(RANGE(5)) AS j) GROUP BY j, field, num))"
    )
    body = (
        "SELECT CAST(j AS INT) AS fold, CASE WHEN j = own THEN 'val' ELSE 'train' END AS part, id, "
        "CAST(target AS VARCHAR) || ' ' || STRING_AGG(field || ':' || code || ':1', ' ' ORDER BY field) AS value "
        "FROM cells JOIN codes USING (field, num) GROUP BY j, own, id, target"
    )
    return over_folds(body, coded, cells, codes)


@query(_ffm_fold_sql())
def libffm_fold_lines(spark, sf_dir):
    """Train and validation lines of every fold, each fold with a code space of its own."""
    train, test = train_test(spark, sf_dir)
    binner = EqualWidthBinner(["qty_12"], 50).fit(train, test)
    train = materialize(assign_folds(binner.transform(train).withColumn("root_15", square_trunc("root_15"))), "folded")
    return fold_lines(train, fit_fold_codes(train, FIELDS), "target")


REAL = ["reg_03", "root_15", "calc_disc"]


@query(over_fx(
    "SELECT id, is_test, " + ", ".join(f"DENSE_RANK() OVER (ORDER BY {c}) - 1 AS {c}" for c in REAL) + " FROM fx"
))
def label_encode_double(spark, sf_dir):
    """Codes of fractional columns, by exact value in numeric order."""
    train, test = train_test(spark, sf_dir)
    codes = encoders.CategoryCodes(REAL).fit(train, test)
    out = [codes.transform(t).select("id", F.lit(i).alias("is_test"), *REAL) for i, t in enumerate((train, test))]
    return out[0].unionByName(out[1])


@query(over_fx(
    "SELECT id, a.code AS position FROM fx JOIN (SELECT root_15, ROW_NUMBER() OVER (ORDER BY root_15) - 1 AS code FROM fx WHERE is_test = 0 GROUP BY root_15) a USING (root_15) "
    "UNION ALL SELECT id, b.code + (SELECT COUNT(DISTINCT root_15) FROM fx WHERE is_test = 0) FROM fx JOIN "
    "(SELECT calc_disc, ROW_NUMBER() OVER (ORDER BY calc_disc) - 1 AS code FROM fx WHERE is_test = 0 GROUP BY calc_disc) b USING (calc_disc)"
))
def one_hot_double(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    hot = encoders.OneHot(["root_15", "calc_disc"]).fit(train)
    return hot.positions(train.drop("target").unionByName(test))


@query(over_fx(
    "SELECT COUNT(*) AS n_columns, COUNT(*) FILTER (a = 0) AS empty_in_train, COUNT(*) FILTER (b = 0) AS empty_in_test FROM ("
    "SELECT feature, num, COUNT(*) FILTER (is_test = 0) AS a, COUNT(*) FILTER (is_test = 1) AS b FROM long GROUP BY feature, num)",
    "long AS (" + long_sql(["prio_cat", "nation_cat", "cust_cat"], "fx", "is_test") + ")",
))
def one_hot_empty(spark, sf_dir):
    """Matrix columns without a row in train or in test."""
    train, test = train_test(spark, sf_dir)
    return encoders.OneHot(["prio_cat", "nation_cat", "cust_cat"], min_train=0).fit(train, test).empty_columns()
