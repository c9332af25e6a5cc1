"""Field-aware text format: `label field:code:1 ...`, one line per row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.materialize import materialize
from riskloom.plans.ordering import global_rank
from riskloom.plans.vocabulary import VALUE_COLUMNS, Vocabulary, fit_vocabulary, long_values


@dataclass
class FieldCodes:
    fields: list[str]
    vocabulary: Vocabulary
    table: DataFrame


def fit_field_codes(train: DataFrame, test: DataFrame | None, fields: Sequence[str], id: str = "id") -> FieldCodes:
    """One running code from 1 over all (field, value) pairs in the order in which reading the train rows, then the
    test rows, meets them: by the row's id, then by the field's place in the row."""
    fields = list(fields)
    vocabulary = fit_vocabulary(train, test, fields, id=id)
    place = F.array_position(F.lit(fields), F.col("feature"))
    seen_in_test = F.when(F.col("first_train").isNull(), F.col("first_test"))
    keys = [F.col("first_train").asc_nulls_last(), seen_in_test, place]
    table = global_rank(vocabulary.table, keys, name="code").withColumn("code", F.col("code") + 1)
    return FieldCodes(fields, vocabulary, materialize(table, "codes"))


def ffm_lines(df: DataFrame, codes: FieldCodes, label: str, id: str = "id") -> DataFrame:
    """(id, value) with one text line per row; values without a code are left out of the line."""
    spots = {c: f"_code{i}" for i, c in enumerate(codes.fields)}
    for c, spot in spots.items():
        df = codes.vocabulary.attach(df, codes.table, c, {spot: ("code", F.lit(None).cast("long"))}, spread=id)
    cells = [
        F.when(F.col(spot).isNotNull(), F.concat(F.lit(f"{i}:"), F.col(spot).cast("string"), F.lit(":1")))
        for i, spot in enumerate(spots.values())
    ]
    return df.select(id, F.concat_ws(" ", F.col(label).cast("int").cast("string"), *cells).alias("value"))


def write_ffm(lines: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write the lines as text, optionally one folder per fold or part."""
    writer = lines.select("value", *partition_by).write
    (writer.partitionBy(*partition_by) if partition_by else writer).text(path)


def write_keyed(lines: DataFrame, path: str, id: str = "id", rows_per_file: int = 100_000) -> DataFrame:
    """Write the lines in the order of their ids, one folder `part=k` with one file each of about `rows_per_file` lines.

    Returns (part, line, id): which row stands where. A program that reads the files writes one score per line without a key;
    `read_keyed` brings these back to the ids.
    """
    n = max(1, -(-lines.count() // rows_per_file))
    place = F.monotonically_increasing_id()
    ordered = lines.select(id, "value").repartitionByRange(n, id).sortWithinPartitions(id).withColumn("_place", place)
    ordered = materialize(ordered, "ffm")  # fixes the ranges
    placed = ordered.select(id, "value", F.shiftright("_place", 33).cast("int").alias("part"), F.col("_place").bitwiseAND((1 << 33) - 1).alias("line"))
    placed.repartition(n, "part").sortWithinPartitions("part", "line").select("value", "part").write.partitionBy("part").text(path)
    return placed.select("part", "line", id)


def read_keyed(spark: SparkSession, path: str, keys: DataFrame, id: str = "id") -> DataFrame:
    """(id, prediction) from score files in the layout of `write_keyed`: line i of `part=k` belongs to the row in that place.

    A file is read whole, since lines have no numbers of their own; `rows_per_file` bounds it.
    """
    files = spark.read.text(path, wholetext=True)
    scores = files.select("part", F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("line", "text"))
    scores = scores.select(F.col("part").cast("int").alias("part"), F.col("line").cast("long").alias("line"), F.col("text").cast("double").alias("prediction"))
    return keys.join(scores, ["part", "line"], "left").select(id, "prediction")


def fit_fold_codes(train: DataFrame, fields: Sequence[str], fold: str = "fold", k: int = 5, id: str = "id") -> FieldCodes:
    """A code space from 1 for each held-out fold: its table has `codes`, an array over the folds, for every (field, value).

    Space j holds the pairs in the order in which reading the rows outside fold j, then those of fold j, meets them. The smallest
    id of every fold is found in one aggregation of the rows; all spaces are ranked at once.
    """
    fields = list(fields)
    vocabulary = fit_vocabulary(train, None, fields, id=id)
    firsts = [F.min(F.when(F.col(fold) == j, F.col(id))) for j in range(k)]
    met = long_values(train, fields, [id, fold]).groupBy(*VALUE_COLUMNS).agg(F.count(F.lit(1)).alias("n_train"), F.array(*firsts).alias("first"))
    met = materialize(met, "firsts")
    spaces = [
        F.struct(F.lit(j).alias("space"), F.array_min(F.array(*[F.col("first")[i] for i in range(k) if i != j])).alias("outside"), F.col("first")[j].alias("inside"))
        for j in range(k)
    ]
    listed = met.select(*VALUE_COLUMNS, "n_train", F.inline(F.array(*spaces)))
    late = F.when(F.col("outside").isNull(), F.col("inside"))
    keys = [F.col("outside").asc_nulls_last(), late, F.array_position(F.lit(fields), F.col("feature"))]
    ranked = global_rank(listed, keys, ["space"], "code")
    codes = F.array(*[F.max(F.when(F.col("space") == j, F.col("code") + 1)) for j in range(k)])
    table = ranked.groupBy(*VALUE_COLUMNS, "n_train").agg(codes.alias("codes")).withColumn("n_test", F.lit(0))
    return FieldCodes(fields, vocabulary, materialize(table, "codes"))


def fold_lines(train: DataFrame, codes: FieldCodes, label: str, fold: str = "fold", k: int = 5, id: str = "id") -> DataFrame:
    """(fold, part, id, value): for every fold the lines of the rows outside it (`train`) and of its own (`val`), in its own code space.

    A column is looked up once for all folds; null values are left out of the line.
    """
    spots = {c: f"_codes{i}" for i, c in enumerate(codes.fields)}
    df = train
    for c, spot in spots.items():
        df = codes.vocabulary.attach(df, codes.table, c, {spot: ("codes", F.lit(None))}, spread=id)
    listed = df.select(id, label, F.col(fold).alias("_own"), *spots.values(), F.explode(F.lit(list(range(k)))).alias("_space"))
    cells = [F.concat(F.lit(f"{i}:"), F.col(spot)[F.col("_space")].cast("string"), F.lit(":1")) for i, spot in enumerate(spots.values())]
    part = F.when(F.col("_space") == F.col("_own"), "val").otherwise("train")
    line = F.concat_ws(" ", F.col(label).cast("int").cast("string"), *cells)
    return listed.select(F.col("_space").alias(fold), part.alias("part"), id, line.alias("value"))


def fold_files(train: DataFrame, codes: FieldCodes, label: str, k: int, fold: str = "fold") -> DataFrame:
    """(fold, part, id, value): for every fold the train and validation lines of the k-fold export.

    Each line is built once and then listed k times, instead of once per fold and part.
    """
    lines = ffm_lines(train, codes, label).join(train.select("id", F.col(fold).alias("_own")), "id")
    listed = lines.select("id", "value", "_own", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold))
    part = F.when(F.col(fold) == F.col("_own"), "val").otherwise("train")
    return listed.select(fold, part.alias("part"), "id", "value")
