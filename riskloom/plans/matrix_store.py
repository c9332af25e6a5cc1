"""A feature matrix kept on disk under a fingerprint of all it was made from: found again, trusted, or refused."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.materialize import delete, exists

ROWS, MANIFEST = "rows", "manifest"


class StaleMatrix(ValueError):
    """The stored matrix was made from something else than what is asked for now."""


def table_digest(df: DataFrame) -> str:
    """Digest of names, types and rows of a table, whatever the order of the rows and the partitions.

    Two 64-bit hashes a row are summed exactly, so repeated rows count and one aggregation row per task is shuffled. Nulls are part of the
    hash; columns of map type have none and are an error.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    holes = [c.isNull() for c in cols]
    total = [F.sum(F.xxhash64(F.lit(seed), *cols, *holes).cast("decimal(20,0)")).alias(f"h{seed}") for seed in (1, 2)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *total).first()
    return _digest([df.dtypes, row["n"], str(row["h1"]), str(row["h2"])])


def file_digest(df: DataFrame) -> str:
    """Digest of the files behind a table that was read from files: paths, sizes and times of change. No column is read.

    Cheaper than `table_digest`, and stricter: files written anew are other files, whatever they hold.
    """
    meta = [F.col(f"_metadata.{c}") for c in ("file_path", "file_size", "file_modification_time")]
    return table_digest(df.select(*meta).distinct())


def fingerprint(
    sources: Mapping[str, DataFrame], vocabulary: DataFrame | None = None, settings: Mapping[str, object] | None = None, by_files: bool = False
) -> dict[str, str]:
    """What a matrix depends on, part by part: every source, the fitted vocabulary, and the settings of the encoders."""
    digest = file_digest if by_files else table_digest
    parts = {f"source {name}": digest(df) for name, df in sorted(sources.items())}
    parts["vocabulary"] = table_digest(vocabulary) if vocabulary is not None else ""
    parts["settings"] = _digest(sorted((settings or {}).items()))
    return parts


def matrix_path(folder: str, name: str, parts: Mapping[str, str]) -> str:
    """Where a matrix of this name and fingerprint is kept, so that a later run finds it without a catalog."""
    return f"{folder}/{name}-{_digest(sorted(parts.items()))[:16]}"


def save_matrix(matrix: DataFrame, path: str, parts: Mapping[str, str]) -> DataFrame:
    """Write the matrix, then its manifest, and read it back. A run that dies in between leaves no manifest, and such a matrix is not loaded."""
    spark = matrix.sparkSession
    delete(spark, f"{path}/{MANIFEST}")  # no old manifest beside new rows
    matrix.write.mode("overwrite").parquet(f"{path}/{ROWS}")
    stored = spark.read.parquet(f"{path}/{ROWS}")
    manifest = {"parts": dict(parts), "schema": json.loads(matrix.schema.json()), "rows": table_digest(stored)}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{MANIFEST}")
    return load_matrix(spark, path, parts)


def load_matrix(spark: SparkSession, path: str, parts: Mapping[str, str], verify: bool = False) -> DataFrame:
    """The stored matrix, if it was made from `parts`; otherwise StaleMatrix, naming what differs. `verify` also compares the stored rows with their digest."""
    if not exists(spark, f"{path}/{MANIFEST}/_SUCCESS"):
        raise StaleMatrix(f"no complete matrix at {path}")
    manifest = json.loads(spark.read.text(f"{path}/{MANIFEST}", wholetext=True).first()["value"])
    other = sorted(k for k in {*parts, *manifest["parts"]} if parts.get(k) != manifest["parts"].get(k))
    if other:
        raise StaleMatrix(f"the matrix at {path} was made with another {', '.join(other)}")
    rows = spark.read.parquet(f"{path}/{ROWS}")
    fields = [(f["name"], f["type"]) for f in manifest["schema"]["fields"]]
    if fields != [(f["name"], f["type"]) for f in json.loads(rows.schema.json())["fields"]]:
        raise StaleMatrix(f"the rows at {path} have other columns than their manifest says")
    if verify and table_digest(rows) != manifest["rows"]:
        raise StaleMatrix(f"the rows at {path} are not those that were written")
    return rows


def matrix(build, folder: str, name: str, sources: Mapping[str, DataFrame], vocabulary: DataFrame | None = None,
           settings: Mapping[str, object] | None = None, by_files: bool = False) -> DataFrame:
    """The matrix of this fingerprint: loaded if it is stored, else made by `build()` and stored."""
    spark = next(iter(sources.values())).sparkSession
    parts = fingerprint(sources, vocabulary, settings, by_files)
    path = matrix_path(folder, name, parts)
    if exists(spark, f"{path}/{MANIFEST}/_SUCCESS"):
        return load_matrix(spark, path, parts)
    return save_matrix(build(), path, parts)


def _digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, default=str).encode()).hexdigest()
