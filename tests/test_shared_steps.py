"""Steps that all model queries share: exact sums without decimals, and fits that read only their own fold's means."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.encoders import TargetMean, by_fold
from riskloom.plans.materialize import materialize
from riskloom.sources.order_risk import exact_sum, exact_total


def test_exact_sum_equals_the_decimal_sum(spark):
    groups = [
        [0.1, 0.2, 0.3], [1.005, 2.675], [-1.005, 0.015, 4.0], [1e7, 12345678.9, 0.07], [9e13, 1e12, 0.01], [None, 3.25], [None, None], [0.0, -0.0],
        [9999999999999.99, -9999999999999.99], [99999.99] * 50, [7e15] * 40 + [0.01],
    ]
    rows = [(g, x) for g, values in enumerate(groups) for x in values]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("g", T.IntegerType()), T.StructField("x", T.DoubleType())]))
    found = df.groupBy("g").agg(F.sum(F.col("x").cast("decimal(18,2)")).cast("double").alias("wanted"), *exact_sum("x")).withColumn("told", exact_total())
    assert [r for r in found.collect() if r.wanted != r.told] == [] and found.count() == len(groups)
    assert found.where("wanted IS NULL").select("g").collect() == [(6,)]


def test_a_fit_reads_only_the_means_of_its_own_fold(spark):
    rows = spark.range(400).select("id", F.pmod("id", F.lit(5)).cast("int").alias("fold"), F.pmod(F.col("id") * 7, F.lit(3)).cast("int").alias("c"),
                                   (F.pmod("id", F.lit(4)) == 0).cast("int").alias("target"))
    means = TargetMean(["c"]).fit(rows, fold="fold")
    arrays = means.transform(rows, "each")
    stored = materialize(by_fold(arrays, ["c_avg"], 5), "means", ["fold"])
    plan = stored.where("fold != 2").select("target", "c_avg_2")._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema"):]
    assert "c_avg_2" in read and "c_avg_1" not in read
    apart = stored.select("id", F.array(*[f"c_avg_{j}" for j in range(5)]).alias("c_avg"))
    assert apart.exceptAll(arrays.select("id", "c_avg")).count() == 0 and apart.count() == 400


def test_mean_encoded_fits_read_no_arrays(spark):
    from conftest import SMALL
    from riskloom.catalog.learning import mean_encoded

    train, _, _, prepare = mean_encoded(spark, SMALL)
    assert not [f.name for f in train.schema if f.dataType.typeName() == "array"]
    assert {len(r.features) for r in prepare(train, 3).select("features").limit(5).collect()} == {13}
