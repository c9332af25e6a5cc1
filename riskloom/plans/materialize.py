"""Written intermediate tables: computed once, read many times, safe when executors are lost."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import shared_dir

_written: list[str] = []


def materialize(df: DataFrame, tag: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write `df` to parquet in the shared folder and read it back.

    Compared with caching this cuts the lineage, survives lost executors, keeps column pruning and
    file statistics, and freezes the outcome of range partitioning so later jobs agree on it.
    """
    spark = df.sparkSession
    path = new_path(spark, tag)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*[_quoted(c) for c in df.columns])


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/riskloom-{tag}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables this process has written. Call it once results are saved: DataFrames built on them stop working."""
    gone = 0
    while _written:
        gone += delete(spark, _written.pop())
    return gone


def discard(table: DataFrame) -> None:
    """Delete the files of a table that `materialize` returned, once nothing will read it any more; tables it did not write are left alone."""
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        mine = next((path for path in _written if folder.rstrip("/").endswith(path.split(":", 1)[-1])), None)
        if mine:
            _written.remove(mine)
            delete(table.sparkSession, mine)


def exists(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def delete(spark: SparkSession, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _quoted(name: str) -> str:
    return f"`{name}`"
