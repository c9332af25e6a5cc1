"""Exact top-k inner products by an impact-ordered, score-at-a-time index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.base import map_batches
from riskloom.plans.materialize import materialize


class BlockIndex:
    """Postings of a block of integer vectors: per component, places in the order of values, cut into quantised segments."""

    def __init__(self, vectors: np.ndarray, levels: int = 32):
        self.vectors = vectors
        n, width = vectors.shape
        low, high = vectors.min(axis=0), vectors.max(axis=0)
        level = (vectors - low) * levels // (high - low + 1)
        self.order = np.argsort(level, axis=0, kind="stable").T.astype(np.int32)
        self.component, self.start, self.stop, self.low, self.high = [], [], [], [], []
        for d in range(width):
            ranked, values = level[self.order[d], d], vectors[self.order[d], d]
            cuts = np.flatnonzero(np.diff(ranked, prepend=-1))
            self.component.append(np.full(len(cuts), d))
            self.start.append(cuts)
            self.stop.append(np.append(cuts[1:], n))
            self.low.append(np.minimum.reduceat(values, cuts))
            self.high.append(np.maximum.reduceat(values, cuts))
        self.component, self.start, self.stop, self.low, self.high = map(np.concatenate, (self.component, self.start, self.stop, self.low, self.high))

    def candidates(self, query: np.ndarray, k: int, out: np.ndarray, enough: int = 64, tiers: int = 8) -> np.ndarray:
        """Places that may be among the k best, of which `out` are no candidates: a proven superset.

        A segment's impact is the most that it can add above the least value of its component. Segments are taken by descending
        impact. A place's sum so far is a lower bound; per component it can still gain the largest impact not yet taken, or the
        width of a segment already taken. Taking segments stops once the places whose upper bound reaches the k-th best lower
        bound are few, or when no segment is left; either way everything else is proven to be outside.
        """
        weight = query[self.component]
        least = np.minimum(weight * self.low, weight * self.high)
        most = np.maximum(weight * self.low, weight * self.high)
        floor = np.full(len(query), np.iinfo(np.int64).max)
        np.minimum.at(floor, self.component, least)
        gain, impact = least - floor[self.component], most - floor[self.component]
        turn = np.argsort(-impact, kind="stable")
        n = len(self.vectors)
        total, width = np.zeros(n), np.zeros(len(query), np.int64)
        allowed = np.ones(n, bool)
        allowed[out] = False
        if allowed.sum() <= k:
            return np.flatnonzero(allowed)
        for tier in np.array_split(turn, tiers) if len(turn) else []:
            if len(tier):
                places = np.concatenate([self.order[d, a:b] for d, a, b in zip(self.component[tier].tolist(), self.start[tier].tolist(), self.stop[tier].tolist())])
                total += np.bincount(places, np.repeat(gain[tier], self.stop[tier] - self.start[tier]), n)
                np.maximum.at(width, self.component[tier], (most - least)[tier])
                turn = turn[len(tier) :]
            rest = np.zeros(len(query), np.int64)
            np.maximum.at(rest, self.component[turn], impact[turn])
            kth = np.partition(total[allowed], -k)[-k]
            found = np.flatnonzero(allowed & (total + np.maximum(rest, width).sum() >= kth))
            if len(found) <= enough:
                break
        return found

    def top(self, query: np.ndarray, k: int, out: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k best ids and scores, by exact products over the candidates; ties go to the smaller id."""
        found = self.candidates(query, k, out)
        score = self.vectors[found] @ query
        best = np.lexsort((ids[found], -score))[:k]
        return ids[found[best]], score[best]


def quantised(vectors: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """Rows (vec_id, v) that take part, with floor(scale * x) of every component as a double."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    rows = vectors.where(F.col(id).isNotNull() & x.isNotNull()).where(finite)
    return rows.select(F.col(id).cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("v"))


def packed(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows dealt evenly into blocks of about `size`: a number from 0, ids and vectors as bytes; and how many blocks there are."""
    n = max(1, -(-rows.count() // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held).sort_by([("vec_id", "ascending")])
            ids, lists = whole.column("vec_id").to_numpy(), whole.column("v").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            sizes = np.diff(lists.offsets.to_numpy())
            body = np.zeros((len(ids), max(int(sizes.max()), 1)), np.int64)  # shorter vectors end in zeros
            body[np.arange(body.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
            least, most = int(body.min()), int(body.max())
            kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= least and most <= np.iinfo(k).max)  # the narrowest that holds them
            row = [[TaskContext.get().partitionId()], [kind], [ids.tobytes()], [body.astype(kind).tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.string(), pa.binary(), pa.binary()))], names=[name, f"{name}_kind", f"{name}_ids", f"{name}_body"])

    blocks = map_batches(rows.repartition(n), run, f"{name} int, {name}_kind string, {name}_ids binary, {name}_body binary")
    return materialize(blocks, f"topk-{name}"), n


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: int = 1024, block: int = 4096, query_block: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each query by the inner product of floor(scale * x), exactly.

    `queries` has the columns of `vectors`. Every block of queries meets every block of vectors once, by number, so the work is
    spread evenly and no task holds more than two blocks. Rows with the query's own id are no candidates. Rows with a null id, a
    null vector, or null or non-finite components take no part; a shorter vector counts as ending in zeros; of repeated query ids
    the smallest vector stands; repeated candidate rows each have a rank. Empty tables give an empty result.
    """
    rows = quantised(vectors, id, vector, scale)
    asked = quantised(queries, id, vector, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    left, n_left = packed(rows, block, "block")
    right, n_right = packed(asked, query_block, "asked")
    pairs = left.withColumn("asked", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1)))).join(
        right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1)))), ["block", "asked"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, number = None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids, asked_ids = np.frombuffer(row["block_ids"], np.int64), np.frombuffer(row["asked_ids"], np.int64)
                body = np.frombuffer(row["block_body"], row["block_kind"]).reshape(len(ids), -1).astype(np.int64)
                wanted = np.frombuffer(row["asked_body"], row["asked_kind"]).reshape(len(asked_ids), -1).astype(np.int64)
                width = min(body.shape[1], wanted.shape[1])
                if number != (row["block"], width):
                    index, number = BlockIndex(body[:, :width]), (row["block"], width)
                for q, vector in zip(asked_ids.tolist(), wanted[:, :width]):
                    own = np.arange(*np.searchsorted(ids, [q, q + 1]))
                    found, score = index.top(vector, k, own, ids)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), q)), pa.array(found), pa.array(score)], names=["query_id", "vec_id", "score"])

    found = map_batches(pairs, run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
