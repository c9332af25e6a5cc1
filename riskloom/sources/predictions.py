"""Prediction tables: files per model, a store partitioned by model, wide form, submissions, run catalog."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalars import fixed_text

# fixed values: marks in file names and number formats
OOF_MARK, TEST_MARK = "_oof", "_sub"
SCORE_SCALE = 1_000_000
STAMP = "yyyy_MM_dd_HH'h'mm"
STORE = "id long, prediction double, model string"


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A parquet folder or a CSV file with header. Give the schema for big CSVs: inferring it reads them twice."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True)
        return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def write_csv(df: DataFrame, path: str, value: str = "prediction", id: str = "id", name: str | None = None, digits: int = 9) -> None:
    """Key and score with a fixed number of digits, with header."""
    df.select(id, fixed_text(value, digits).alias(name or value)).write.csv(path, header=True)


def write_store(df: DataFrame, path: str, model: str) -> None:
    """Add one model's predictions to a parquet store partitioned by model."""
    df.withColumn("model", F.lit(model)).write.mode("append").partitionBy("model").parquet(path)


def read_store(spark: SparkSession, path: str, models: Sequence[str] | None = None) -> DataFrame:
    """(…, model) rows; a model list prunes partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("model").isin(list(models))) if models else df


def model_of_file(name: Column, mark: str) -> Column:
    return F.substring_index(name, mark, 1)


def value_columns(header: Sequence[str], id: str = "id", target: str = "target") -> tuple[str, str | None]:
    """Names of the prediction and of the target column of a prediction file, by its header.

    Files of unlabelled rows have one value column, whatever its name; with two, the one named `target` is the target.
    """
    values = [c for c in header if c != id]
    scores = [c for c in values if c != target] if len(values) > 1 else values
    if id not in header or len(scores) != 1:
        raise ValueError(f"a prediction file has {id}, one prediction and perhaps {target}, not {list(header)}")
    return scores[0], target if len(values) > 1 else None


def read_csv_store(spark: SparkSession, folder: str, mark: str = OOF_MARK, models_from: str = "file") -> DataFrame:
    """All `<model>_oof*.csv` (or `_sub`) files below a folder: (id, prediction, target, model).

    With models_from="folder" the model is the name of the folder a file stands in, as Spark's own writer leaves it. Columns are taken by name, since
    their order differs from writer to writer: one job reads the header lines of all files, and files whose columns stand in the same order are one scan,
    whatever their score columns are called. So neither jobs nor scans grow with the number of files. Files without any line and archives are left out.
    """
    by_layout: dict[tuple[str, ...], list[str]] = {}
    for path, header in _headers(spark, folder, f"*{mark}*.csv"):
        score, target = value_columns(header)
        names = {"id": "id", score: "prediction", target: "target"}
        by_layout.setdefault(tuple(names[c] for c in header), []).append(path)
    out = spark.createDataFrame([], "id long, prediction double, target int, model string")
    kind = {"id": "long", "prediction": "double", "target": "int"}
    for layout, paths in sorted(by_layout.items()):
        schema = ", ".join(f"{c} {kind[c]}" for c in layout)
        label = F.col("target") if "target" in layout else F.lit(None).cast("int")
        path = F.col("_metadata.file_path")
        model = model_of_file(F.col("_metadata.file_name"), mark) if models_from == "file" else F.element_at(F.split(path, "/"), -2)
        rows = spark.read.schema(schema).option("header", True).csv(paths)
        out = out.unionByName(rows.select("id", "prediction", label.alias("target"), model.alias("model")))
    return out


def _headers(spark: SparkSession, folder: str, glob: str) -> list[tuple[str, list[str]]]:
    """(path, column names) of every file, from one text scan: the first line that is not blank, which stands in the file's first split."""
    lines = spark.read.options(pathGlobFilter=glob, recursiveFileLookup=True).text(folder)
    began = lines.where("_metadata.file_block_start = 0 AND trim(value) != ''")
    first = began.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.first("value").alias("line"))  # a split is read by one task, in order
    found = first.collect()  # one short row per file
    return sorted((unquote(r["path"]), next(csv.reader([r["line"].lstrip("\ufeff")]))) for r in found)


def read_fold_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Headerless (id, prediction) lines of one folder per fold (`fold=0`, `fold=1`, ...), with the fold. The key travels with the score: Spark rows have no position."""
    return spark.read.schema("id long, prediction double, fold int").csv(path)


def write_fold_predictions(oof: DataFrame, path: str, digits: int = 9) -> None:
    """(id, prediction) lines without header, one folder per fold."""
    oof.select("id", fixed_text("prediction", digits).alias("prediction"), "fold").write.partitionBy("fold").csv(path)


def prediction_wide(store: DataFrame, models: Sequence[str] | None = None, id: str = "id") -> DataFrame:
    """One column per model, one row per id present in any model (an outer join in a single aggregation)."""
    if models is None:
        models = sorted(r[0] for r in store.select("model").distinct().collect())
    picks = [F.max(F.when(F.col("model") == m, F.col("prediction"))).alias(m) for m in models]
    return store.groupBy(id).agg(*picks)


def csv_wide(store: DataFrame, models: Sequence[str], id: str = "id") -> DataFrame:
    """Wide predictions with the target, where any file has it."""
    labels = store.groupBy(id).agg(F.max("target").alias("target"))
    return prediction_wide(store, models, id).join(labels, id)


def mean_predictions(store: DataFrame, id: str = "id") -> DataFrame:
    """Mean of the folds' or bags' predictions per row."""
    return store.groupBy(id).agg(F.avg("prediction").alias("prediction"))


def fill_submission(template: DataFrame, predictions: DataFrame, id: str = "id", target: str = "target") -> DataFrame:
    """Template rows with the target replaced by the prediction of the same id."""
    return template.drop(target).join(predictions.select(id, F.col("prediction").alias(target)), id, "left")


def run_catalog(scores: DataFrame, scale: int = SCORE_SCALE, at: Column | None = None) -> DataFrame:
    """(model, gini, score_code, file_stem): what the file names of a run carry, as columns. `at` is the time of the run."""
    code = (F.col("gini") * scale).cast("long")
    stamp = F.date_format(F.current_timestamp() if at is None else at, STAMP)
    return scores.select("model", "gini", code.alias("score_code"), F.concat_ws("_", "model", code.cast("string"), stamp).alias("file_stem"))


def write_importances(importances: DataFrame, path: str) -> None:
    importances.write.csv(path, sep=";", header=True)


def read_importances(spark: SparkSession, path: str) -> DataFrame:
    """(feature, importance) as `write_importances` left them."""
    return spark.read.schema("feature string, importance double").csv(path, sep=";", header=True)
