"""Registry of this subpackage's queries and small helpers its operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with SQL over the same tables where SQL can express it."""

    def add(fn: Query) -> Query:
        REGISTRY[fn.__name__] = (fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Partitions for a shuffle whose rows are dealt out by number."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """`mapInArrow` with batches of about 8 MB: Spark's own 64 MB, held several times over, are much beside a small executor.

    The bound is a setting of the session. One that the user has set already stays.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) in (None, "67108864b", "64m", "64MB"):  # as Spark comes
        conf.set(BATCH_BYTES, "8m")
    return df.mapInArrow(run, schema)


def most_frequent(counts: DataFrame, n: str, most: int) -> DataFrame:
    """Rows of the highest classes of `n` (eighths of an octave) that fit whole into `most` rows.

    Only the sizes of the classes, a few hundred rows, are looked at on the driver, so no task sends more than its share. The class
    at the border is left out as a whole; equal counts are treated alike. Give a written table: it is read twice.
    """
    grade = F.floor(F.log2(F.col(n)) * 8)
    least, held = None, 0
    for r in sorted(counts.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["grade"]):
        held += r["n"]
        if held > most:
            break
        least = r["grade"]
    return counts.where(grade >= least if least is not None else F.lit(False))


def blobs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary Arrow column and the n + 1 bounds of its rows; nulls are empty."""
    if column.null_count:
        column = column.fill_null(b"")
    width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i+1]] for each i, exact for empty ranges."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20, max_rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a text column has about `max_bytes` a slice; a longer row is a slice of its own, and none is lost."""
    sizes = np.diff(blobs(batch.column(column))[1])
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and (held + size > max_bytes or i - start == max_rows):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)
