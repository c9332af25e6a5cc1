"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import blobs, map_batches, slices

TERMS = 2048
GRAMS, GAPS = 1024, 16  # terms of the byte runs, and of the distances between equal words; words and word pairs share the rest
VIEWS = (slice(0, GRAMS), slice(GRAMS, TERMS - GAPS), slice(TERMS - GAPS, TERMS))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
GRID = 4096.0  # latent components are whole multiples of 1 / GRID, so products are exact in any order


def _powers(of: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, of, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _spread(h: np.ndarray, size: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(33)) % np.uint64(size)).astype(np.int64)


def term_counts(body: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts of terms (texts x TERMS): hashed runs of three bytes, hashed words between white space and pairs of words that follow each other, and
    for every word the distance in words to its last occurrence, in octaves (the first term: none before).

    Bytes are taken as they are, so letters, scripts, capitals and marks all tell; no run, word or pair crosses two texts.
    """
    n = len(bounds) - 1
    out = np.zeros((n, TERMS), np.float32)
    if not len(body):
        return out
    owner = np.repeat(np.arange(n), np.diff(bounds))
    if len(body) > 2:
        b = body.astype(np.uint64)
        run = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
        inside = owner[:-2] == owner[2:]
        at = owner[:-2][inside] * GRAMS + _spread(run[inside] * BASE, GRAMS)
        out[:, :GRAMS] = np.bincount(at, minlength=n * GRAMS).reshape(n, GRAMS)
    dark = ~SPACE[body]
    cut = np.zeros(len(body), bool)
    cut[bounds[:-1][bounds[:-1] < len(body)]] = True
    starts = np.flatnonzero(dark & (cut | ~np.r_[False, dark[:-1]]))
    ends = np.flatnonzero(dark & np.r_[cut[1:] | ~dark[1:], True]) + 1
    if len(starts):
        sums = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(body)), out=sums[1:])
        word = (sums[ends] - sums[starts]) * _powers(BACK, len(body))[starts]  # the same wherever the word stands
        held, rest = owner[starts], TERMS - GRAMS - GAPS
        pair = word[:-1] * np.uint64(31) + word[1:]
        beside = held[:-1] == held[1:]
        at = np.concatenate([held * rest + _spread(word, rest), held[:-1][beside] * rest + _spread(pair[beside], rest)])
        out[:, GRAMS : TERMS - GAPS] = np.bincount(at, minlength=n * rest).reshape(n, rest)
        order = np.lexsort((word, held))  # stable: equal words of a text stand in their order
        again = (word[order[1:]] == word[order[:-1]]) & (held[order[1:]] == held[order[:-1]])
        gap = np.zeros(len(word), np.int64)
        gap[order[1:][again]] = np.minimum(np.log2(order[1:][again] - order[:-1][again]).astype(np.int64) + 1, GAPS - 1)
        out[:, TERMS - GAPS :] = np.bincount(held * GAPS + gap, minlength=n * GAPS).reshape(n, GAPS)
    return out


@dataclass
class LabelledSpace:
    """idf and axes lead from term counts to unit latent vectors; vectors and labels are the labelled sample's."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        weighed = np.log1p(counts.astype(np.float64)) * self.idf
        for view in VIEWS:  # each kind of term has the same say
            weighed[:, view] /= np.maximum(np.linalg.norm(weighed[:, view], axis=1, keepdims=True), 1e-12)
        return weighed

    def place(self, counts: np.ndarray) -> np.ndarray:
        """Unit latent vectors on the grid; texts without terms are the zero vector."""
        latent = self.weigh(counts) @ self.axes
        return np.rint(latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12) * GRID) / GRID

    def votes(self, counts: np.ndarray, k: int, power: float, block: int = 256) -> np.ndarray:
        """Share of label 1 among the k nearest labelled vectors, each weighted by its cosine to `power`; equally near ones by their place in the sample."""
        out = np.full(len(counts), float(self.labels.mean()))
        latent, k, size = self.place(counts), min(k, len(self.labels)), len(self.labels)
        for a in range(0, len(counts), block):
            key = (latent[a : a + block] @ self.vectors.T) * (GRID * GRID * size) - np.arange(size)  # whole numbers, no two alike
            near = np.argpartition(-key, k - 1, axis=1)[:, :k]
            near = np.take_along_axis(near, np.argsort(-np.take_along_axis(key, near, axis=1), axis=1), axis=1)
            cosine = (np.take_along_axis(key, near, axis=1) + near) / (GRID * GRID * size)
            weight = np.maximum(cosine, 0) ** power
            mass = weight.sum(axis=1)
            share = (weight * self.labels[near]).sum(axis=1) / np.maximum(mass, 1e-12)
            out[a : a + block] = np.where(mass > 1e-12, share, out[a : a + block])
        return out.clip(0, 1)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Number of texts, and of those with each term, over all rows. A task sends TERMS + 1 numbers, which Spark adds up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                seen[:TERMS] += (term_counts(*blobs(part.column("_text"))) > 0).sum(axis=0)
                seen[TERMS] += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(seen)], names=["term", "n"])

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    summed = map_batches(texts, run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(TERMS + 1, np.int64)
    for r in summed.collect():  # TERMS + 1 rows
        out[r["term"]] = r["n"]
    return int(out[TERMS]), out[:TERMS]


def fit(docs: DataFrame, labels: DataFrame, where: Column, id: str = "doc_id", text: str = "text", label: str = "quality", max_labelled: int = 6000, rank: int = 48) -> LabelledSpace | None:
    """Latent space and labelled vectors from at most `max_labelled` labelled rows, chosen by a hash of their id.

    `where` (over the id) says which labels may be used. Null labels are left out; of repeated labels the largest counts. The
    sample's term counts are gathered on the driver (at most max_labelled x TERMS numbers); the axes are the leading
    eigenvectors of their Gram matrix. The weights of the terms come from all texts. None if nothing is labelled. A row of `docs` that is there twice with a
    label counts twice; an id's rows with different texts all bear its label.
    """
    usable = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).where(where)
    order = F.xxhash64(F.lit("votes"), F.col(id))
    share = max_labelled / max(usable.count(), 1)  # about so many pass the hash; the order and the limit make the bound strict
    picked = usable.where(F.pmod(order, F.lit(1 << 20)) < share * (1 << 20))
    chosen = picked.groupBy(id).agg(F.max(label).cast("int").alias("_label")).orderBy(order, id).limit(max_labelled)
    rows = docs.select(id, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text")).join(F.broadcast(chosen), id)  # chosen: at most max_labelled rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                counts = term_counts(*blobs(part.column("_text")))
                yield pa.RecordBatch.from_arrays([part.column(id), part.column("_label"), pa.array([zlib.compress(c.tobytes(), 1) for c in counts], pa.binary())], names=["_id", "_label", "_counts"])

    kind = docs.schema[id].dataType
    found = map_batches(rows, run, f"_id {kind.simpleString()}, _label int, _counts binary")
    got = found.orderBy(F.xxhash64(F.lit("votes"), F.col("_id")), "_id", "_counts").limit(max_labelled).toArrow()
    if not got.num_rows:
        return None
    y = got.column("_label").to_numpy().astype(np.float64)
    total, having = document_frequencies(docs, text)
    space = LabelledSpace(np.log((1 + total) / (1 + having)) + 1, np.zeros((TERMS, 0)), np.zeros((0, rank)), y)

    def blocks(size: int = 512) -> Iterator[np.ndarray]:
        for a in range(0, got.num_rows, size):
            packed = got.column("_counts").slice(a, size).to_pylist()
            yield np.frombuffer(b"".join(map(zlib.decompress, packed)), np.float32).reshape(-1, TERMS)

    gram = np.zeros((TERMS, TERMS))
    for counts in blocks():
        weighed = space.weigh(counts)
        gram += weighed.T @ weighed
    _, axes = np.linalg.eigh(gram)
    space.axes = np.ascontiguousarray(axes[:, ::-1][:, :rank])
    space.vectors = np.concatenate([space.place(counts) for counts in blocks()])
    return space


def score(docs: DataFrame, space: LabelledSpace | None, id: str = "doc_id", text: str = "text", k: int = 24, power: float = 32.0, cut: float = 0.3) -> DataFrame:
    """`id`, score and predicted of every row, from the whole text alone.

    Null, empty and blank texts of under three bytes have no direction and get the share of label 1 in the sample; 0.5 if nothing is labelled. Repeated rows
    get equal scores, an empty table gives no rows. Neighbours that are equally near (repeated labelled texts are) count by their place in the sample, which
    is ordered by a hash of the id, the id and the term counts; products are exact, so no score depends on how rows are dealt out. The labelled vectors
    are broadcast: at most max_labelled x rank numbers. A task needs about 60 bytes for each byte of its longest text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(space)
    narrow = docs.select(id, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    schema = narrow.drop("_text").schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                got = np.full(part.num_rows, 0.5) if model is None else model.votes(term_counts(*blobs(part.column("_text"))), k, power)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got)], names=schema.names)

    return map_batches(narrow, run, schema).withColumn("predicted", (F.col("score") >= cut).cast("int"))
