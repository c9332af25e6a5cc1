"""SimHash fingerprints, exact linking by tiles, and the components of the links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import blobs, map_batches, parallelism, slices
from riskloom.llm.components import component_labels, spanning_edges
from riskloom.plans.materialize import materialize

SEED = 42


def shingle_hashes(text: bytes, size: int = 4, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of `size` words, joined by one space; fewer words make one shingle, no word makes none."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= size:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[: n - size])).tolist()
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())], np.uint64)


def fold(hashes: list[np.ndarray], step: int = 1 << 17) -> np.ndarray:
    """Fingerprint of each list of hashes: a bit is 1 if it is set in over half of them."""
    out = np.zeros(len(hashes), np.uint64)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for k, h in enumerate(hashes):
        if not len(h):
            continue
        ones = np.zeros(64, np.int64)
        for a in range(0, len(h), step):
            bits = np.unpackbits(h[a : a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int32)
        out[k] = weights[ones * 2 > len(h)].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = 4) -> DataFrame:
    """Columns `keep` and `fp` (64 bits as a signed long) of every row. Null, empty and wordless texts have fingerprint 0."""
    narrow = docs.select(*keep, F.col(text).cast("binary").alias("_text"))
    schema = narrow.drop("_text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                body, at = blobs(part.column("_text"))
                raw = body.tobytes()
                fp = fold([shingle_hashes(raw[a:b], shingle) for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
                columns = [part.column(c) for c in part.schema.names[:-1]] + [pa.array(fp.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], "fp"])

    return map_batches(narrow, run, schema)


def quarters(fp: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit quarters, one row each."""
    return np.bitwise_count(fp.view(np.uint16).reshape(-1, 4)).astype(np.int8)


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool, cell: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) with a[i] and b[j] within `radius` bits, in pieces; with `same`, i < j only.

    Two words differ in at least as many bits as the population counts of their quarters differ in sum. Both sides are put
    in the order of these counts and cut into cells; only cell pairs whose boxes of counts come within the radius are compared.
    """

    def cells(x):
        q = quarters(x)
        order = np.lexsort((q[:, 3], q[:, 2], q[:, 1], q[:, 0], q.sum(axis=1)))
        cuts = np.arange(0, len(x), cell)
        q = q[order]
        return order, cuts, np.minimum.reduceat(q, cuts), np.maximum.reduceat(q, cuts)

    if not len(a) or not len(b):
        return
    ao, ac, alo, ahi = cells(a)
    bo, bc, blo, bhi = (ao, ac, alo, ahi) if same else cells(b)
    sa, sb = a[ao], b[bo]
    for k, start in enumerate(ac.tolist()):
        gap = np.maximum(np.maximum(alo[k] - bhi, blo - ahi[k]), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        if same:
            near = near[near >= k]
        left = sa[start : start + cell]
        for m in near.tolist():
            right = sb[bc[m] : bc[m] + cell]
            i, j = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
            if same and m == k:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield ao[i + start], bo[j + bc[m]]


def tiles(distinct: DataFrame, tile: int) -> DataFrame:
    """Distinct fingerprints packed into tiles of about `tile` words with close population counts of their 16-bit quarters.

    Words with equal counts are a cell. There are at most 17**4 cells, whatever the number of words, so their sizes may be listed
    on the driver and their tiles broadcast. Cells are put into tiles in the order of (sum, first, second, third count); a cell of
    more than `tile` words is cut into even parts by a hash. Columns: tile (0, 1, ...), lo and hi (least and greatest sum), box
    (least and greatest count of each quarter), words (binary, little-endian).
    """
    spark = distinct.sparkSession
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).alias(f"q{k}") for k in range(4)]
    key = ["q0", "q1", "q2", "q3"]
    counted = distinct.select("fp", *quarter)
    sizes = counted.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 17**4 rows
    plan, number, held = [], -1, tile
    for r in sorted(sizes, key=lambda r: (sum(r[k] for k in key), *(r[k] for k in key))):
        cuts = -(-r["n"] // tile)
        if held + r["n"] > tile:
            number, held = number + 1, 0
        plan.append((*(r[k] for k in key), number, cuts))
        number, held = number + cuts - 1, held + r["n"]
    where = spark.createDataFrame(plan, ", ".join(f"{k} int" for k in key) + ", first int, cuts int")
    dealt = counted.join(F.broadcast(where), key).select(
        "fp", (F.col("first") + F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int")).alias("tile")
    )
    packed = dealt.groupBy("tile").applyInArrow(_pack, "tile int, lo int, hi int, box array<int>, words binary")
    return materialize(packed, "simhash-tiles")


def _pack(group: pa.Table) -> pa.Table:
    words = np.sort(group.column("fp").to_numpy().astype(np.int64))
    q = quarters(words.view(np.uint64)).astype(int)
    box = [*q.min(axis=0).tolist(), *q.max(axis=0).tolist()]
    return pa.table({
        "tile": pa.array([group.column("tile")[0].as_py()], pa.int32()), "lo": pa.array([int(q.sum(axis=1).min())], pa.int32()),
        "hi": pa.array([int(q.sum(axis=1).max())], pa.int32()), "box": pa.array([box], pa.list_(pa.int32())),
        "words": pa.array([words.tobytes()], pa.binary()),
    })


def box_gap(a: str, b: str) -> Column:
    """Least sum of differences between counts in two boxes, so the fewest bits in which words of the two tiles can differ."""
    apart = [
        F.greatest(F.col(a)[k] - F.col(b)[4 + k], F.col(b)[k] - F.col(a)[4 + k], F.lit(0)) for k in range(4)
    ]
    return apart[0] + apart[1] + apart[2] + apart[3]


def links(fps: DataFrame, radius: int = 4, tile: int = 16384) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all words within `radius` bits of each other.

    Exact: every pair of tiles whose population counts, in sum and by quarters, come within the radius is compared in full. Each pair of
    tiles gives a spanning forest of its links, so a large group of near copies gives as many edges as it has members.
    """
    distinct = fps.select("fp").distinct()
    packed = tiles(distinct, tile)
    left = packed.select(*[F.col(c).alias(f"{c}_a") for c in packed.columns])
    # pairs of tile numbers come first, from the ranges alone; the words are then fetched by number
    reach = left.select("tile_a", "box_a", F.explode(F.sequence(F.col("lo_a") - radius, F.col("hi_a") + radius)).alias("pop"))
    counts = packed.select("tile", "box", F.explode(F.sequence("lo", "hi")).alias("pop"))
    pairs = reach.join(counts, "pop").where("tile_a <= tile").where(box_gap("box_a", "box") <= radius).select("tile_a", "tile").distinct()
    n = max(parallelism(packed.sparkSession), 1)
    work = (
        pairs.join(left.select("tile_a", "words_a"), "tile_a")
        .join(packed.select("tile", "words"), "tile")
        .repartition(n, "tile_a", "tile")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ta, tb = batch.column("tile_a")[row].as_py(), batch.column("tile")[row].as_py()
                a = np.frombuffer(batch.column("words_a")[row].as_py(), np.uint64)
                b = np.frombuffer(batch.column("words")[row].as_py(), np.uint64)
                same = ta == tb
                nodes = a if same else np.concatenate((a, b))
                shift = 0 if same else len(a)
                i, j = spanning_edges(len(nodes), ((x, y + shift) for x, y in tile_links(a, b, radius, same)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[i].view(np.int64)), pa.array(nodes[j].view(np.int64))], names=["a", "b"]
                )

    return map_batches(work, run, "a long, b long")


def simhash_components(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = 4, shingle: int = 4, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: its id, columns `keep`, fp, component (a fingerprint of the class) and component_id.

    component_id is the smallest id reachable over links of at most `radius` differing bits; rows with equal fingerprints are
    linked. Null ids are ignored by that minimum (a class of null ids only has a null one). Repeated rows each give a row.
    An empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, text, tuple(dict.fromkeys((id, *keep))), shingle), "simhash-rows")
    labels = component_labels(links(rows, radius), rows.sparkSession)
    known = rows.groupBy("fp").agg(F.min(id).alias("_first"))
    named = known.join(labels.select(F.col("node").alias("fp"), "label"), "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("component"), "_first"
    )
    classes = named.groupBy("component").agg(F.min("_first").alias("component_id"))
    classes = materialize(named.select("fp", "component").join(classes, "component"), "simhash-classes")
    return rows.join(classes, "fp")
