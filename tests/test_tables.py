"""Sources, sinks, stores, search and stacking."""

import pathlib
import tempfile

import pytest
from pyspark.sql import functions as F

from riskloom.operators import columns, search
from riskloom.operators.encoders import CategoryCodes, Dummies
from riskloom.operators.metrics import gini
from riskloom.operators.scaling import EqualWidthBinner
from riskloom.operators.stacking import fit_blend, stack
from riskloom.functions.scalars import linear_blend
from riskloom.plans.materialize import materialize
from riskloom.sources import predictions as P
from riskloom.sources.ffm_text import ffm_lines, fit_field_codes, fit_fold_codes, fold_files, fold_lines, write_ffm


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="riskloom-test-")


def test_csv_round_trip_and_store_discovery(spark, folder):
    df = spark.range(20).select("id", (F.col("id") / 7).alias("prediction"))
    for model in ("net", "forest"):
        P.write_csv(df, f"{folder}/{model}_oof_run.csv", name=model)
    P.write_csv(df, f"{folder}/net_sub_run.csv")
    back = spark.read.csv(f"{folder}/net_oof_run.csv", header=True)
    assert back.columns == ["id", "net"] and back.where("id = 1").first()["net"] == "0.142857143"


def test_csv_store_takes_files_of_one_mark(spark, folder):
    for model, tail in (("net", ",target"), ("forest", "")):
        with open(f"{folder}/{model}_27_oof.csv", "w") as f:
            f.write(f"id,{model}{tail}\n1,0.5{',1' if tail else ''}\n2,0.25{',0' if tail else ''}\n")
    with open(f"{folder}/old_oof.7z", "w") as f:
        f.write("archive")
    store = P.read_csv_store(spark, folder)
    wide = P.prediction_wide(store)
    assert wide.columns == ["id", "forest_27", "net_27"]
    assert [tuple(r) for r in wide.orderBy("id").collect()] == [(1, 0.5, 0.5), (2, 0.25, 0.25)]
    assert {r.target for r in store.where("model = 'net_27'").collect()} == {0, 1}


def test_parquet_store_prunes_models(spark, folder):
    df = spark.range(5).select("id", F.lit(0.5).alias("prediction"))
    for m in ("a", "b"):
        P.write_store(df, f"{folder}/store", m)
    read = P.read_store(spark, f"{folder}/store", ["b"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 5 and "= b)], PushedFilters: []" in plan  # a partition filter, not a row filter


def test_fold_files_list_every_line_once_per_fold(spark, tables, folder):
    train, test = tables
    codes = fit_field_codes(train, test, ["prio_cat", "ret_bin"])
    files = fold_files(train, codes, "target", 5)
    n = train.count()
    assert files.count() == 5 * n
    assert files.where("part = 'val'").count() == n
    write_ffm(files, f"{folder}/ffm", ["fold", "part"])
    assert spark.read.text(f"{folder}/ffm/fold=0/part=train").count() == files.where("fold = 0 AND part = 'train'").count()
    line = ffm_lines(train, codes, "target").first().value.split(" ")
    assert line[0] in "01" and line[1].startswith("0:") and line[2].startswith("1:") and line[2].endswith(":1")


def test_roles_and_routing(tables):
    train, _ = tables
    roles = columns.column_roles(["a_cat", "b_bin", "c", "a_cat_plus_c", "id"])
    assert roles.categorical == ["a_cat", "a_cat_plus_c"] and roles.binary == ["b_bin"] and roles.numeric == ["c"]
    assert columns.route_by_cardinality(train, ["status_cat", "cust_cat"]) == {"status_cat": "onehot", "cust_cat": "drop"}
    assert columns.route(2) == "passthrough"
    assert columns.noise_columns(["id", "a", "b"], ["a"]) == ["b"]
    with pytest.raises(ValueError):
        columns.align_columns(train, train.drop("n_lines"))


@pytest.fixture(scope="module")
def larger(spark):
    """The next scale up: the smallest has too few rows for the planted pair to stand out."""
    from riskloom.sources.order_risk import order_risk, split_origin

    return split_origin(materialize(order_risk(spark, "/root/testdata/sf0.01"), "wide"))


def test_planted_pair_is_ranked_first(larger):
    cols = ["prio_cat", "status_cat", "seg_cat", "nation_cat", "ret_bin", "n_lines"]
    best = search.search_pairs(larger[0], None, cols, 3).first()
    assert (best.f1, best.f2) == ("prio_cat", "nation_cat")


def test_forward_selection_keeps_the_planted_pair(larger):
    train, test = larger
    steps = search.search_pairs(train, test, ["prio_cat", "seg_cat", "nation_cat"], 1, exact=True).collect()
    assert len(steps) == 1 and (steps[0].f1, steps[0].f2, steps[0].kept) == ("prio_cat", "nation_cat", 1)


def test_blend_is_no_worse_than_its_best_part(spark, tables):
    train, _ = tables
    names = ["a", "b", "c"]
    wide = train.select(
        "id", "target", "fold", (F.col("prio_cat") == 1).cast("double").alias("a"), F.col("ret_bin").cast("double").alias("b"),
        (-F.col("n_lines")).cast("double").alias("c"),
    )
    weights = fit_blend(wide, names)[-1]
    assert abs(sum(abs(w) for w in weights) - 1) < 1e-9
    blended = wide.withColumn("z", linear_blend(dict(zip(names, weights))))
    single = [gini(wide, "target", m).first().gini for m in names]
    assert gini(blended, "target", "z").first().gini >= max(single) - 1e-9
    result = stack(wide, names, wide.select("id", *names), max_iter=5)
    assert result.oof.count() == train.count() == result.test.count()
    assert result.weights.count() == 15 and result.mean_weights().count() == 3


def test_bins_may_be_fitted_on_one_or_both_tables(tables):
    train, test = tables
    alone, both = EqualWidthBinner(["price_13"]).fit(train), EqualWidthBinner(["price_13"]).fit(train, test)
    assert both.edges["price_13"][0] <= alone.edges["price_13"][0]


def test_release_deletes_written_tables(spark):
    import os

    from riskloom.plans import materialize as M

    held, M._written[:] = list(M._written), []
    path = M.new_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert M.release(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
    M._written[:] = held


def test_csv_store_reads_columns_by_name(spark, tmp_path):
    texts = {"a_oof_1.csv": "id,target,ftrl\n1,1,0.25\n2,0,0.5\n", "b_oof.csv": "id,net,target\n1,0.75,1\n", "c_oof.csv": "id,score\n2,0.125\n", "d_sub.csv": "id,target\n1,0.5\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    got = sorted((r.model, r.id, r.prediction, r.target) for r in P.read_csv_store(spark, str(tmp_path)).collect())
    assert got == [("a", 1, 0.25, 1), ("a", 2, 0.5, 0), ("b", 1, 0.75, 1), ("c", 2, 0.125, None)]
    assert [tuple(r) for r in P.read_csv_store(spark, str(tmp_path), "_sub").collect()] == [(1, 0.5, None, "d")]
    with pytest.raises(ValueError):
        P.value_columns(["id", "x", "y"])


def test_text_columns_bear_sentinels_and_flags(spark):
    df = spark.createDataFrame([("-1", -1, -1.0, 1), ("red", 2, 0.5, 2), (None, None, None, 3)], "c string, i int, d double, id long")
    left = columns.add_missing_flags(df, cols=["c", "i", "d"])[0].orderBy("id").collect()
    assert [(r.c_miss, r.i_miss, r.d_miss) for r in left] == [(1, 1, 1), (0, 0, 0), (None, None, None)]
    swapped = columns.replace_sentinel(df, 99, ["c", "i", "d"]).orderBy("id").collect()
    assert [(r.c, r.i, r.d) for r in swapped] == [("99", 99, 99.0), ("red", 2, 0.5), (None, None, None)]


def test_fractional_values_are_encoded_exactly(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.7), (3, -0.0), (4, 0.0), (5, None), (6, 0.1)], "id long, x double")
    codes = CategoryCodes(["x"]).fit(df).transform(df, "_code").orderBy("id").collect()
    assert [r.x_code for r in codes] == [1, 2, 0, 0, -1, 1]
    assert {tuple(r) for r in Dummies(["x"]).fit(df, df).transform(df).where("id = 2").select("`x_0.1`", "`x_0.7`").collect()} == {(0, 1)}
    with pytest.raises(TypeError):
        CategoryCodes(["x"]).fit(df.withColumn("x", F.array("x")))


def test_pair_cells_compile_with_many_columns(spark):
    cols = [f"c{i}" for i in range(37)]
    df = spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("target"), (F.col("id") % 5).cast("int").alias("fold"), *[(F.col("id") % (i + 2)).cast("int").alias(c) for i, c in enumerate(cols)])
    cells = search.pair_cells(df, cols, "target", "fold", 5)
    assert cells.select("f1", "f2").distinct().count() == 37 * 36 // 2
    assert cells.select(F.sum(F.col("n0") + F.col("n1") + F.col("n2") + F.col("n3") + F.col("n4"))).first()[0] == 200 * 37 * 36 // 2


def test_discard_deletes_only_what_was_written(spark, tmp_path):
    from riskloom.plans import materialize as m

    own = str(tmp_path / "own")
    spark.range(3).write.parquet(own)
    m.discard(spark.read.parquet(own))
    assert spark.read.parquet(own).count() == 3
    table = m.materialize(spark.range(5), "gone")
    (folder,) = {f.rsplit("/", 1)[0].split(":", 1)[-1] for f in table.inputFiles()}
    folder = "/" + folder.lstrip("/")
    assert pathlib.Path(folder).exists()
    m.discard(table)
    assert not pathlib.Path(folder).exists()


def test_code_spaces_of_folds_follow_their_own_reading_order(spark):
    kinds = [(3, 1, 0, "x", 7), (5, 0, 1, "y", None), (8, 0, 0, None, 7), (9, 1, 1, "z", 4), (12, 0, 2, "x", 9), (13, 1, 2, "y", 7)]
    train = spark.createDataFrame(kinds, "id long, target int, fold int, a string, b int")
    got = {(r.fold, r.id): (r.part, r.value) for r in fold_lines(train, fit_fold_codes(train, ["a", "b"], k=3), "target", k=3).collect()}
    want = {}
    for j in range(3):
        codes: dict[tuple[int, object], int] = {}
        for id_, y, fold, *values in sorted(kinds, key=lambda r: (r[2] == j, r[0])):
            cells = [f"{i}:{codes.setdefault((i, v), len(codes) + 1)}:1" for i, v in enumerate(values) if v is not None]
            want[j, id_] = ("val" if fold == j else "train", " ".join([str(y), *cells]))
    assert got == want
    assert fold_lines(train.where("id < 0"), fit_fold_codes(train.where("id < 0"), ["a", "b"], k=3), "target", k=3).count() == 0
