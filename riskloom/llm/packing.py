"""Best-fit packing of documents into token sequences, by rounds over a tree of partitions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import map_batches, slices
from riskloom.llm.chunks import ChunkEncoder
from riskloom.plans.materialize import materialize

_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One per Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder.from_json(path)
    return _encoders[path]


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end: int = 0, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of at most `capacity` tokens of every document and its end id: doc_id, piece, start, length, ids_crc32.

    Null texts are empty, so they are the end id alone. Only documents of over `capacity` tokens are cut. The last pieces are
    full and the first one takes what is left over; pieces are counted from 0 in the order of the text.
    """
    narrow = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    schema = narrow.drop("text").schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                rows, piece, start, length, crc = [], [], [], [], []
                texts = [b.decode("utf-8", "replace") for b in part.column("text").to_pylist()]
                for k, raw in enumerate(enc.encode(texts)):
                    raw += tail
                    n = len(raw) // 4
                    at = 0
                    for p, stop in enumerate(range((n - 1) % capacity + 1, n + 1, capacity)):
                        rows.append(k)
                        piece.append(p)
                        start.append(at)
                        length.append(stop - at)
                        crc.append(zlib.crc32(raw[4 * at : 4 * stop]))
                        at = stop
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return map_batches(narrow, run, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each item, taken from the largest down; an item goes into the fullest bin that still holds it."""
    order = np.argsort(-sizes, kind="stable")
    bins, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit r is set if a bin has r tokens of room
    used: list[int] = []
    for k, size in zip(order.tolist(), sizes[order].tolist()):
        fits = open_ >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_ ^= 1 << r
        else:
            b, r = len(used), capacity
            used.append(0)
        bins[k], offset[k] = b, used[b]
        used[b] += size
        if r > size:
            room[r - size].append(b)
            open_ |= 1 << (r - size)
    return bins, offset


def pack(pieces: DataFrame, capacity: int = 2048, group: int = 16384, fan_in: int = 8, slack: int = 8) -> DataFrame:
    """Add sequence_id and offset to pieces (columns doc_id, piece, length and any others).

    Round 0 deals the pieces by a hash into partitions of about `group` pieces and packs each by best fit. Bins with at most
    `slack` tokens of room are final. The underfull bins are the items of the next round, in which `fan_in` times fewer
    partitions pack them by best fit again, until one partition is left. A bin over half full can only take a bin of at most
    half, and best fit leaves at most one such bin a partition; so a partition passes on its smaller bins and as many of its
    emptiest others as there can be small bins in a merge, which bounds what one task of the last round reads by the number of
    partitions and not by the number of pieces.
    """
    spark = pieces.sparkSession
    n = max(1, -(-pieces.count() // group))
    names = [f.name for f in pieces.schema]
    packed = pieces.schema.add("_bin", "long").add("_at", "long").add("_used", "long")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([("length", "descending"), *[(c, "ascending") for c in names if c != "length"]])
        bins, at = best_fit(rows.column("length").to_numpy(), capacity)
        used = np.bincount(bins, rows.column("length").to_numpy()).astype(np.int64)[bins]
        bins = bins + (TaskContext.get().partitionId() << 32)
        for c, v in (("_bin", bins), ("_at", at), ("_used", used)):
            rows = rows.append_column(c, pa.array(v))
        yield from rows.to_batches()

    dealt = pieces.repartition(n, *[F.col(c) for c in ("doc_id", "piece")])
    rows = materialize(map_batches(dealt, first, packed), "packed")

    open_ = rows.where(F.col("_used") < capacity - slack).groupBy("_bin").agg(F.first("_used").alias("used"))
    open_ = open_.select(F.col("_bin").alias("bin"), "used", F.shiftright("_bin", 32).alias("part"))
    moves = None  # bin, to, shift: a bin of round 0 stands in bin `to` behind `shift` tokens
    level = 0
    while n > 1:
        level += 1
        n = -(-n // fan_in)
        near = open_.withColumn("part", F.floor(F.col("part") / fan_in)).groupBy("part")
        merged = materialize(near.applyInArrow(_merge(capacity, fan_in, slack), "part long, bin long, to long, shift long, used long, open boolean"), "merged")
        step = merged.select("bin", "to", "shift")
        if moves is None:
            moves = step
        else:
            onward = step.select(F.col("bin").alias("to"), F.col("to").alias("_to"), F.col("shift").alias("_shift"))
            moves = materialize(moves.join(onward, "to", "left").select("bin", F.coalesce("_to", "to").alias("to"), (F.col("shift") + F.coalesce("_shift", F.lit(0))).alias("shift")), "moves")
        open_ = merged.where("open AND bin = to").select("bin", "used", "part")
    out = [F.col(c) for c in names]
    if moves is None:
        return rows.select(*out, F.col("_bin").alias("sequence_id"), F.col("_at").alias("offset"))
    final = rows.where(F.col("_used") >= capacity - slack).select(*out, F.col("_bin").alias("sequence_id"), F.col("_at").alias("offset"))
    moved = moves.where("bin != to OR shift != 0")
    rest = rows.where(F.col("_used") < capacity - slack).join(moved.withColumnRenamed("bin", "_bin"), "_bin", "left")
    rest = rest.select(*out, F.coalesce("to", "_bin").alias("sequence_id"), (F.col("_at") + F.coalesce("shift", F.lit(0))).alias("offset"))
    return final.unionAll(rest)


def _merge(capacity: int, fan_in: int, slack: int):
    """Best fit over the open bins of one merged partition; `open` marks the bins that go on to the next round."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by([("used", "descending"), ("bin", "ascending")])
        size, name = group.column("used").to_numpy(), group.column("bin").to_numpy()
        bins, at = best_fit(size, capacity)
        total = np.bincount(bins, size).astype(np.int64)
        head = np.zeros(len(total), np.int64)
        head[bins[at == 0]] = name[at == 0]
        # bins of at most half go on, and the emptiest of the others, as many as small bins can meet in the next merge
        wanted = np.zeros(len(total), bool)
        wanted[np.argsort(total, kind="stable")[: 2 * fan_in]] = True
        wanted &= total < capacity - slack
        return pa.table({
            "part": pa.array(np.full(len(size), key[0].as_py())), "bin": pa.array(name), "to": pa.array(head[bins]),
            "shift": pa.array(at), "used": pa.array(total[bins]), "open": pa.array(wanted[bins]),
        })

    return run


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, end: int = 0, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Tokenize, cut and pack whole documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Repeated rows are packed each by itself; an empty table gives no row.
    """
    pieces = materialize(token_pieces(docs, vocabulary, capacity, end, id, text), "pieces")
    return pack(pieces, capacity, **options)
