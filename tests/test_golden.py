"""Small cases with known answers."""

import math

from pyspark.sql import functions as F

from riskloom.functions import scalars as S
from riskloom.operators.encoders import CategoryCodes, OneHot, TargetMean
from riskloom.operators.scaling import EqualWidthBinner, MinMax, bin_edges


def one(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_cut_is_right_closed_and_lowest_value_is_in_bin_zero(spark):
    df = one(spark, [(i, float(x)) for i, x in enumerate([0, 1, 2, 3, 4, 5, 10])], "id long, x double")
    got = EqualWidthBinner(["x"], 5).fit(df).transform(df).orderBy("id")
    assert [r.x for r in got.collect()] == [0, 0, 0, 1, 1, 2, 4]


def test_cut_of_a_constant_column(spark):
    df = one(spark, [(0, 3.0), (1, 3.0)], "id long, x double")
    assert [r.x for r in EqualWidthBinner(["x"], 4).fit(df).transform(df).collect()] == [1, 1]


def test_cut_agrees_with_comparing_every_edge(spark):
    df = spark.range(20000).select("id", (F.round(F.pmod(F.xxhash64("id"), F.lit(100000)) / 100.0, 2) - 300).alias("x"))
    binner = EqualWidthBinner(["x"], 50).fit(df)
    edges = binner.edges["x"]
    slow = sum((F.col("x") > e).cast("int") for e in edges[1:-1])
    both = df.select("x", slow.alias("slow"))
    fast = EqualWidthBinner(["x"], 50, binner.edges).transform(both)
    assert fast.where("x <> slow").count() == 0


def test_edges_end_at_the_maximum():
    edges = bin_edges(0.0, 0.7, 7)
    assert len(edges) == 8 and edges[-1] == 0.7


def test_minmax_of_a_constant_column_is_zero(spark):
    df = one(spark, [(0, 3.0), (1, 3.0)], "id long, x double")
    assert [r.x for r in MinMax(["x"]).fit(df).transform(df).collect()] == [0.0, 0.0]


def test_codes_by_first_appearance_and_unknown(spark):
    train = one(spark, [(0, "b"), (1, "a"), (2, "b"), (3, "c")], "id long, v string")
    test = one(spark, [(9, "z"), (10, "a")], "id long, v string")
    codes = CategoryCodes(["v"], "first").fit(train)
    assert [r.v for r in codes.transform(train).orderBy("id").collect()] == [0, 1, 0, 2]
    assert [r.v for r in codes.transform(test).orderBy("id").collect()] == [-1, 1]


def test_one_hot_unknown_and_null_are_zeros(spark):
    train = one(spark, [(0, "b"), (1, "a"), (2, "b"), (3, "c")], "id long, v string")
    test = one(spark, [(4, "a"), (5, "z"), (6, None)], "id long, v string")
    rows = OneHot(["v"]).fit(train).transform(test).orderBy("id").collect()
    assert [r.features.toArray().tolist() for r in rows] == [[1, 0, 0], [0, 0, 0], [0, 0, 0]]


def test_square_then_truncate(spark):
    rows = spark.range(15).select("id", S.square_trunc(F.sqrt(F.col("id").cast("double"))).alias("q")).collect()
    got = {r.id: r.q for r in rows}
    assert {k: got[k] for k in (3, 6, 12, 13)} == {3: 2, 6: 5, 12: 11, 13: 12}
    assert [got[k] for k in (0, 1, 2, 4, 5, 7, 11, 14)] == [0, 1, 2, 4, 5, 7, 11, 14]


def test_region_decode_closed_form(spark):
    reg = F.sqrt(F.col("id").cast("double")) / 40
    rows = spark.range(5000).select("id", S.region_decode(reg).alias("r")).collect()
    for r in rows:
        k, best = r.id, max(f for f in range(28) if (r.id - f) % 27 == 0)
        assert (r.r.federal, r.r.municipality) == (best, (k - best) // 27)
    missing = spark.range(1).select(S.region_decode(F.lit(-1.0)).alias("r")).first().r
    assert (missing.federal, missing.municipality) == (7, 59)


def test_target_mean_with_weight_200(spark):
    rows = [(i, i % 3, int((7 * i) % 5 == 0)) for i in range(100)]
    train = one(spark, rows, "id long, c int, target int")
    enc = TargetMean(["c"]).fit(train)
    test = one(spark, [(i, i) for i in range(4)], "id long, c int")
    got = [r.c_avg for r in enc.transform(test).orderBy("id").collect()]
    assert [round(x, 9) for x in got] == [0.200854701, 0.197424893, 0.201716738, 0.2]


def test_hash_prefix_and_half_even(spark):
    r = spark.range(1).select(
        F.conv(F.substring(F.md5(F.lit("x")), 1, 8), 16, 10).alias("h"), F.rint(F.lit(2.5)).alias("e")
    ).first()
    assert int(r.h) == 2647975009 and r.e == 2.0


def test_bounded_log_loss(spark):
    r = spark.range(1).select(S.logloss(F.lit(0.0), F.lit(1)).alias("a"), S.logloss(F.lit(0.25), F.lit(0)).alias("b")).first()
    assert math.isclose(r.a, -math.log(1e-14)) and math.isclose(r.b, -math.log(0.75))
