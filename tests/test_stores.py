"""Many prediction files in a few jobs, matrices under a fingerprint, stored sketches, metrics as cells."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import columns, metrics, search, sketches
from riskloom.operators.shared_fits import fit_shared, shared_scores
from riskloom.operators.stacking import exact_values, fit_blend
from riskloom.plans import matrix_store as M
from riskloom.sources import predictions as P


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_headers_of_many_files_take_a_fixed_number_of_jobs(spark, tmp_path):
    made = {}
    for size in (150, 1000):  # Spark lists over 32 paths of one scan by a job
        folder = tmp_path / f"store {size}%"
        folder.mkdir()
        for i in range(size):
            head, line = [(f"id,m{i}", "1,0.5"), (f"id,target,m{i}", "1,1,0.5"), (f"m{i},id,target", "0.5,1,1")][i % 3]
            (folder / f"m{i}_oof.csv").write_text(("﻿" if i == 3 else "\n" if i == 4 else "") + head + "\n" + line + "\n")
        (folder / "empty_oof.csv").write_text("")
        store, made[size] = jobs_of(spark, f"headers{size}", lambda: P.read_csv_store(spark, str(folder)))
        rows = store.collect()
        assert {r.model for r in rows} == {f"m{i}" for i in range(size)}
        assert {(r.id, r.prediction) for r in rows} == {(1, 0.5)}
        assert all((r.target is None) == (int(r.model[1:]) % 3 == 0) for r in rows)
    assert made[1000] == made[150] <= 2 + 3  # three column orders


def test_importances_and_fold_files_come_back(spark, tmp_path):
    rows = spark.createDataFrame([("a;b", 0.5), ("c", 0.0)], "feature string, importance double")
    P.write_importances(rows, str(tmp_path / "i"))
    assert sorted(map(tuple, P.read_importances(spark, str(tmp_path / "i")).collect())) == [("a;b", 0.5), ("c", 0.0)]
    oof = spark.createDataFrame([(1, 0, 0.25), (2, 1, 0.125)], "id long, fold int, prediction double")
    P.write_fold_predictions(oof, str(tmp_path / "f"))
    assert sorted(map(tuple, P.read_fold_predictions(spark, str(tmp_path / "f")).collect())) == [(1, 0.25, 0), (2, 0.125, 1)]


def test_digest_sees_values_and_nulls_but_no_order(spark):
    rows = [(1, None, "x"), (2, 5, "y"), (2, 5, "y"), (3, None, None)]
    schema = "a int, b int, c string"
    table = lambda r, s=schema: M.table_digest(spark.createDataFrame(r, s))
    assert table(rows) == M.table_digest(spark.createDataFrame(rows[::-1], schema).repartition(3))
    assert len({table(rows), table(rows[:2] + rows[3:]), table([(None, 1, "x"), *rows[1:]]), table(rows, "a int, b long, c string"), table(rows[:0])}) == 5


def test_matrix_is_found_again_and_others_are_refused(spark, tmp_path):
    source = spark.range(50).withColumn("x", F.col("id") * 2)
    made = []

    def build():
        made.append(1)
        return source.select("id", (F.col("x") + 1).alias("y"))

    want = sorted(map(tuple, build().collect()))
    made.clear()
    for _ in range(2):
        assert sorted(map(tuple, M.matrix(build, str(tmp_path), "m", {"s": source}, settings={"k": 1}).collect())) == want
    assert len(made) == 1
    parts = M.fingerprint({"s": source}, settings={"k": 1})
    path = M.matrix_path(str(tmp_path), "m", parts)
    with pytest.raises(M.StaleMatrix, match="settings"):
        M.load_matrix(spark, path, M.fingerprint({"s": source}, settings={"k": 2}))
    with pytest.raises(M.StaleMatrix, match="source s"):
        M.load_matrix(spark, path, M.fingerprint({"s": source.where("id > 0")}, settings={"k": 1}))
    with pytest.raises(M.StaleMatrix, match="vocabulary"):
        M.load_matrix(spark, path, M.fingerprint({"s": source}, source, {"k": 1}))
    assert M.load_matrix(spark, path, parts, verify=True).count() == 50
    spark.range(1).select("id", F.lit(7).cast("long").alias("y")).write.mode("append").parquet(f"{path}/{M.ROWS}")
    with pytest.raises(M.StaleMatrix, match="not those"):
        M.load_matrix(spark, path, parts, verify=True)


def test_half_written_matrix_is_refused_and_made_anew(spark, tmp_path):
    source = spark.range(5)
    parts = M.fingerprint({"s": source})
    path = M.matrix_path(str(tmp_path), "m", parts)
    source.write.parquet(f"{path}/{M.ROWS}")
    with pytest.raises(M.StaleMatrix, match="no complete"):
        M.load_matrix(spark, path, parts)
    assert M.matrix(lambda: source, str(tmp_path), "m", {"s": source}).count() == 5


def test_file_digest_changes_with_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    first = M.fingerprint({"s": spark.read.parquet(path)}, by_files=True)
    assert first == M.fingerprint({"s": spark.read.parquet(path)}, by_files=True)
    spark.range(1).write.mode("append").parquet(path)
    assert first != M.fingerprint({"s": spark.read.parquet(path)}, by_files=True)


def test_merged_sketches_bound_exact_counts(spark):
    wide = spark.range(60_000).select(
        F.when(F.col("id") < 40_000, "train").otherwise("test").alias("part"), F.col("id").alias("key"), (F.col("id") % 2).cast("int").alias("two"),
        F.concat(F.lit("v"), F.col("id") % 3000).alias("text"), F.when(F.col("id") < 40_000, F.col("id") % 109).otherwise(F.col("id") % 111).alias("near"),
        F.lit(None).cast("double").alias("none"),
    )
    cols, groups = ["key", "two", "text", "near", "none"], {"train": ["train"], "test": ["test"], "both": ["train", "test"]}
    stored = sketches.value_sketches(wide, cols).cache()
    later = sketches.value_sketches(wide.where("part = 'train'"), cols).unionByName(sketches.value_sketches(wide.where("part = 'test'"), cols))
    rated = {(r.feature, r.group): r for r in sketches.merged(stored, groups).collect()}
    assert rated == {(r.feature, r.group): r for r in sketches.merged(later, groups).collect()}
    counts = {}
    for name, parts in groups.items():
        row = wide.where(F.col("part").isin(parts)).agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
        counts |= {(c, name): row[c] for c in cols if row[c]}
    assert set(rated) == set(counts) and all(r.low <= counts[k] <= r.high for k, r in rated.items())
    routed = {(r.feature, r.group): r.route for r in sketches.route_by_sketches(wide, stored, groups).collect()}
    assert routed == {k: columns.route(n) for k, n in counts.items()}
    assert routed["near", "train"] == "onehot" and routed["near", "both"] == "drop"


def loss(p, y):
    return -np.mean(np.where(y == 1, np.log(p), np.log(1 - p)))


def test_blend_by_log_loss_is_the_optimum_of_a_grid(spark):
    rng = np.random.default_rng(5)
    z = rng.normal(size=(600, 3))
    y = (rng.random(600) < 1 / (1 + np.exp(-z @ [1.0, 0.7, 0.0]))).astype(int)
    p = 1 / (1 + np.exp(-2 * z))
    rows = [(int(t), i % 3, *map(float, q)) for i, (t, q) in enumerate(zip(y, p))]
    df = spark.createDataFrame(rows, "target int, fold int, a double, b double, c double")
    found = fit_blend(df, ["a", "b", "c"], fits=[0, -1], negative=False, metric=metrics.LOG_LOSS)
    for j, w in found.items():
        use = np.arange(600) % 3 != j
        grid = [(i / 50, k / 50, 1 - (i + k) / 50) for i, k in itertools.product(range(51), repeat=2) if i + k <= 50]
        best = min(loss(np.clip(p[use] @ g, 1e-14, 1 - 1e-14), y[use]) for g in grid)
        assert loss(p[use] @ w, y[use]) <= best + 2e-4
        assert exact_values(df, ["a", "b", "c"], "target", "fold", {j: w}, metrics.LOG_LOSS)[j] == pytest.approx(-loss(p[use] @ w, y[use]))


def test_auc_and_gini_choose_the_same_blend(spark):
    rows = [(i % 4 == 0, i % 2, (i * 37 % 101) / 101, (i % 4 == 0) * 0.1 + (i * 53 % 89) / 89) for i in range(400)]
    df = spark.createDataFrame([(int(a), b, c, d) for a, b, c, d in rows], "target int, fold int, a double, b double")
    assert fit_blend(df, ["a", "b"], metric=metrics.AUC) == fit_blend(df, ["a", "b"])


def test_metrics_of_folds_agree_with_plain_figures(spark):
    rows = [(i % 3 == 0, i % 2, (1 + i % 7) / 9) for i in range(90)]
    df = spark.createDataFrame([(int(a), b, c) for a, b, c in rows], "target int, fold int, p double")
    y, f, p = (np.array(c) for c in zip(*rows))
    for j in (-1, 0, 1):
        use = np.ones(90, bool) if j < 0 else f == j
        wins = (p[use & y][:, None] > p[use & ~y]) + 0.5 * (p[use & y][:, None] == p[use & ~y])
        want = {"auc": wins.mean(), "gini": 2 * wins.mean() - 1, "log_loss": loss(p[use], y[use])}
        for metric in (metrics.AUC, metrics.GINI, metrics.LOG_LOSS):
            got = {r["fold"]: r[metric.name] for r in metric.by_fold(df, "target", "p").collect()}
            assert got[j] == pytest.approx(want[metric.name])


def test_pair_search_by_log_loss(spark, tables):
    train, test = tables
    cols, pairs = ["prio_cat", "ret_bin"], [("prio_cat", "ret_bin")]
    made = search.pair_tables(train.select("id", "target", "fold", *cols), test.select("id", *cols), cols, pairs)
    row = search.screen_exact(made, metric=metrics.LOG_LOSS).first()
    codes = made.codes()
    base, pair = shared_scores(codes, fit_shared(codes, [made.blocks([]), made.blocks(pairs)]), metrics.LOG_LOSS)
    assert 0 < base[-1] < 1 and row.log_loss == pytest.approx(pair[-1], abs=1e-4)
    assert row.delta == pytest.approx(base[-1] - pair[-1], abs=1e-4) and row.kept == int(row.delta > search.SCREEN_GAIN)
