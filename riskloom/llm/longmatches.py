"""Removal of long repeated passages: segments that share a rare-most gram meet in one bucket, whose run-length index marks the matches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from riskloom.llm.base import blobs, map_batches, parallelism, slices
from riskloom.llm.runindex import RunIndex
from riskloom.plans.materialize import discard, materialize

#: Bytes of the grams whose least hash in a window decides where the window is compared. At most the shortest match.
GRAM = 32
#: Windows of one segment; a longer stretch with one least hash (a periodic text) is cut, which loses no window.
MOST_WINDOWS = 4096
#: Bytes of new text that a bucket indexes at once (sorting it costs less than reading it through another index), and of text in a bucket on average.
CHUNK_BYTES, BUCKET_BYTES = 2 << 20, 2 << 20
#: A gram with more occurrences is compared window by window instead of in one bucket.
HOT = 20_000
SPAN = ArrayType(StructType().add("start", "long").add("end", "long"))


def _hashes(body: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of the `size` bytes (a multiple of four, eight at least) at every place where they fit."""
    n = len(body) - size + 1
    word = np.ndarray((len(body) - 7,), "<u8", np.ascontiguousarray(body), 0, (1,)).copy()
    h = np.full(n, 0x9E3779B97F4A7C15 + salt, np.uint64)
    for k in [*range(0, size - 7, 8), *([size - 8] if size % 8 else [])]:
        h = (h ^ word[k : k + n]) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` values in a row."""
    m, have = h, 1
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[: len(m) - step], m[step:])
        have += step
    return m


def segments(body: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first window, windows, key, twice) of the stretches of windows with one least gram hash, for texts body[at[k]:at[k+1]].

    Equal windows have equal keys wherever they stand, so comparing within a key misses no match. `twice` says that the stretch holds its gram
    more than once; only then can it repeat a window of its own.
    """
    total, width = len(body) - window + 1, window - GRAM + 1
    if total <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    gram = _hashes(body, GRAM)
    least = _least(gram, width)
    sizes = np.diff(at)
    owner = np.repeat(np.arange(len(sizes)), sizes)[:total]
    inside = np.arange(total) + window <= at[1:][owner]
    starts = np.flatnonzero(inside & np.concatenate(([True], (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]))))
    edge = np.concatenate((starts, [total]))
    count = np.minimum(edge[1:], np.maximum(at[1:][owner[starts]] - window + 1, 0)) - starts
    pieces = -(-count // MOST_WINDOWS)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(starts, pieces) + part * MOST_WINDOWS
    windows = np.minimum(np.repeat(starts + count, pieces) - first, MOST_WINDOWS)
    # places whose gram is the least of a window around them; those of one stretch with its key follow each other among these
    around = ~_least(~np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64))), width)
    place = np.flatnonzero(gram == around[: len(gram)])
    one = np.searchsorted(place, first)  # the first of them at or after the start of the stretch
    while True:  # grams of the windows before may be least there, so go on to the key
        off = (one < len(place) - 1) & (gram[place[np.minimum(one, len(place) - 1)]] != least[first])
        if not off.any():
            break
        one = one + off
    two = np.minimum(one + 1, len(place) - 1)
    twice = (two > one) & (gram[place[two]] == least[first]) & (place[two] < first + windows + width - 1)
    return owner[first], first - at[owner[first]], windows, least[first], twice


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of consecutive numbers in a sorted array."""
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return places[np.concatenate(([0], cut))], places[np.concatenate((cut, [len(places)])) - 1] + 1


class Bucket:
    """The segments of one bucket in corpus order, streamed through run-length indexes of the texts before them."""

    def __init__(self, window: int):
        self.window, self.indexes, self.seen = window, [], set()
        self.rows: list[tuple[int, int, np.ndarray]] = []  # number of the caller, first window, letters
        self.held = 0

    def add(self, number: int, place: int, body: bytes) -> Iterator[tuple[int, int, int]]:
        """Take the next segment; yields (number, start, end) of repeated windows as they are known."""
        windows = len(body) - self.window + 1
        digest = hashlib.blake2b(body, digest_size=16).digest()
        if digest in self.seen:
            yield number, place, place + windows
            return
        self.seen.add(digest)
        self.rows.append((number, place, np.frombuffer(body, np.uint8) + np.uint8(1)))
        self.held += len(body)
        if self.held >= CHUNK_BYTES:
            yield from self.flush(True)

    def flush(self, more: bool = False) -> Iterator[tuple[int, int, int]]:
        """Mark what the segments taken so far repeat of earlier ones; index their new texts."""
        rows, self.rows, self.held = self.rows, [], 0
        if not rows:
            return
        size = np.array([len(r[2]) for r in rows])
        end = np.cumsum(size)
        start = end - size
        letters = np.concatenate([r[2] for r in rows])
        window = np.zeros(len(letters), bool)
        known = np.zeros(len(letters), bool)
        todo = np.arange(len(rows))
        for a, e in zip(start.tolist(), end.tolist()):
            window[a : e - self.window + 1] = True
        for index in self.indexes:
            if not len(todo):
                break
            s = np.concatenate(([0], np.cumsum(size[todo])))
            part = np.concatenate([letters[start[k] : end[k]] for k in todo.tolist()])
            match = index.matching_statistics(part, s[:-1], s[1:]) >= self.window
            at = np.concatenate([np.arange(start[k], end[k]) for k in todo.tolist()])
            known[at[match]] = True
            left = np.add.reduceat((window & ~known)[at], s[:-1])
            todo = todo[left > 0]  # a segment all of whose windows are known brings no new text
        if len(todo):
            piece = np.zeros(int(size[todo].sum()) + len(todo), np.uint8)
            edge = np.concatenate(([0], np.cumsum(size[todo] + 1)))
            for k, a in zip(todo.tolist(), edge.tolist()):
                piece[a : a + size[k]] = letters[start[k] : end[k]]
            index = RunIndex(piece, self.window)
            repeated = index.repeats()
            for k, a in zip(todo.tolist(), edge.tolist()):
                known[start[k] : end[k]] |= repeated[a : a + size[k]]
            if more:
                index.release()
                self.indexes.append(index)
        hit = np.flatnonzero(known & window)
        if not len(hit):
            return
        owner = np.searchsorted(end, hit, "right")
        cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(owner) != 0)) + 1
        for a, b in zip(np.concatenate(([0], cut)).tolist(), np.concatenate((cut, [len(hit)])).tolist()):
            k = int(owner[a])
            shift = rows[k][1] - int(start[k])
            yield rows[k][0], int(hit[a]) + shift, int(hit[b - 1]) + 1 + shift


def _order(id: str) -> list[Column]:
    return [F.col(id).asc_nulls_last(), F.col("key"), F.col("first")]


def repeated_windows(docs: DataFrame, id: str, window: int, hot: int = HOT) -> DataFrame:
    """(key, start, end): the windows [start, end) of each text that also start earlier, from (id, key, body); equal keys are one text."""
    spark = docs.sparkSession
    texts = docs.where(F.length("body") >= window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body", max_bytes=1 << 18):  # arrays of a size that stays in the processor's cache
                owner, first, windows, gram, twice = segments(*blobs(part.column("body")), window)
                keys = part.column("key").to_numpy()[owner]
                span = first << 13 | twice.astype(np.int64) << 12 | (windows - 1)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(keys), pa.array(span)], names=["gram", "key", "span"])

    cuts = map_batches(texts.select("key", "body"), cut, "gram long, key long, span long")
    often = cuts.groupBy("gram").agg(F.sum(1 + F.shiftright("span", 12).bitwiseAND(1)).alias("n")).where("n > 1")
    shared = cuts.join(often, "gram").groupBy("key").agg(F.collect_set(F.struct("span", "gram", (F.col("n") > hot).alias("hot"))).alias("spans"))
    id_type = texts.schema[id].dataType
    schema = StructType().add("kind", "integer").add(id, id_type).add("key", "long").add("first", "long").add("windows", "long").add("gram", "long").add("more", "long").add("body", "binary")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in unpacked(batch):
                pair = pa.table({"i": part.column(id), "k": part.column("key")})
                part = part.take(pc.sort_indices(pair, sort_keys=[("i", "ascending"), ("k", "ascending")], null_placement="at_end"))
                key = part.column("key").to_numpy()
                once = np.concatenate(([True], key[1:] != key[:-1]))  # a repeated row is the same document
                yield from _emitted(part if once.all() else part.filter(pa.array(once)), id, window, schema)

    parts = materialize(map_batches(packed(texts.select(id, "key", "body")).join(shared, "key"), emit, schema), "segments")
    compared = parts.where("kind = 1")
    bytes_ = compared.agg(F.sum(F.length("body"))).first()[0] or 0
    buckets = max(1, -(-bytes_ // BUCKET_BYTES))
    rows = compared.select(id, "key", "first", "body", F.pmod(F.xxhash64("gram"), F.lit(buckets)).alias("bucket"))
    rows = rows.repartition(max(parallelism(spark), min(buckets, 100_000)), "bucket").sortWithinPartitions("bucket", *_order(id))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last, bucket = None, None, Bucket(window)
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for number, key, first, body in zip(*(batch.column(c).to_pylist() for c in ("bucket", "key", "first", "body"))):
                if number != here:
                    out.extend(bucket.flush())
                    here, bucket = number, Bucket(window)
                if (number, key, first) != last:  # a repeated row is the same document
                    out.extend(bucket.add(key, first, body))
                last = number, key, first
            yield _marks(out)
        yield _marks(list(bucket.flush()))

    found = map_batches(rows, mark, "key long, start long, end long")
    single = parts.where("kind = 2").select(id, "key", "first", "gram", "more")
    earliest = single.groupBy("gram", "more").agg(F.min(F.struct(F.col(id).isNull().alias("late"), id, "key", "first")).alias("e"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = single.join(earliest.select("gram", "more", F.col("e.key").alias("k"), F.col("e.first").alias("f")), ["gram", "more"]).where("key != k OR first != f")
    known = parts.where("kind = 0").select("key", F.col("first").alias("start"), (F.col("first") + F.col("windows")).alias("end"))
    marks = known.unionAll(found).unionAll(later.select("key", F.col("first").alias("start"), (F.col("first") + 1).alias("end")))
    marks = materialize(marks, "marks")
    discard(parts)
    return marks


def packed(texts: DataFrame) -> DataFrame:
    """`texts` with compressed bodies: they cross a shuffle in about half the room."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            at = batch.schema.get_field_index("body")
            yield batch.set_column(at, "body", pa.array([pack(b) for b in batch.column(at).to_pylist()], pa.binary()))

    return map_batches(texts, run, texts.schema)


def unpacked(batch: pa.RecordBatch, at_once: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch of packed texts with their bodies, about `at_once` packed bytes at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    at = batch.schema.get_field_index("body")
    for part in slices(batch, "body", max_bytes=at_once):
        yield part.set_column(at, "body", pa.array([unpack(b) for b in part.column(at).to_pylist()], pa.binary()))


def _marks(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "start", "end"])


def _emitted(part: pa.RecordBatch, id: str, window: int, schema: StructType) -> Iterator[pa.RecordBatch]:
    """What a slice of texts (in corpus order) sends on: kind 1, segments; 2, single windows of hot grams; 0, windows that repeat within the slice."""
    body, at = blobs(part.column("body"))
    spans = part.column("spans")
    flat, owner = spans.flatten(), np.repeat(np.arange(part.num_rows), np.diff(spans.offsets.to_numpy()))
    span, gram, hot = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("span", "gram", "hot"))
    first, windows = span >> 13, (span & 4095) + 1
    order = np.lexsort((first, owner))
    owner, first, windows, gram, hot = owner[order], first[order], windows[order], gram[order], hot[order]
    begin = at[owner] + first
    raw = body.tobytes()
    keys = part.column("key").to_numpy()

    def batch(kind: int, k: np.ndarray, first: np.ndarray, windows: np.ndarray, gram: np.ndarray, more: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        n = len(k)
        columns = [pa.array(np.full(n, kind, np.int32)), part.column(id).take(pa.array(k)), pa.array(keys[k]), pa.array(first), pa.array(windows), pa.array(gram), pa.array(more), texts]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def without(n: int) -> pa.Array:
        return pa.nulls(n, pa.binary())

    cold = np.flatnonzero(~hot)
    texts = [raw[a : a + n + window - 1] for a, n in zip(begin[cold].tolist(), windows[cold].tolist())]
    seen: set[bytes] = set()
    fresh = np.array([not (t in seen or seen.add(t)) for t in texts], bool)
    for kind, rows in ((1, cold[fresh]), (0, cold[~fresh])):
        if len(rows):
            held = pa.array([t for t, f in zip(texts, fresh) if f], pa.binary()) if kind else without(len(rows))
            yield batch(kind, owner[rows], first[rows], windows[rows], gram[rows], np.zeros(len(rows), np.int64), held)
    warm = np.flatnonzero(hot)
    if len(warm):
        n = windows[warm]
        place = np.repeat(begin[warm] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        k = np.repeat(owner[warm], n)
        one, two = (_hashes(body, window, salt)[place].view(np.int64) for salt in (1, 2))
        order = np.lexsort((two, one))  # stable, and the places are in corpus order, so the first of equal windows is the earliest
        new = np.zeros(len(place), bool)
        new[order[np.concatenate(([True], (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)))]] = True
        local = place - at[k]
        yield batch(2, k[new], local[new], np.ones(int(new.sum()), np.int64), one[new], two[new], without(int(new.sum())))
        old = np.flatnonzero(~new)
        yield batch(0, k[old], local[old], np.ones(len(old), np.int64), one[old], two[old], without(len(old)))


def remove_repeats(docs: DataFrame, text: str = "text", id: str = "doc_id", window: int = 100, hot: int = HOT) -> DataFrame:
    """Columns id, n_bytes, spans (start and end of the removed stretches) and kept (the bytes left) of every row.

    Each byte covered by a string of `window` bytes that also starts earlier in the corpus goes: in a text of smaller id (nulls last, then by a hash of the
    text), or at an earlier place of the same text; overlaps count. All is judged on the input, not on what is left. Rows with equal id and text are one
    document: each gives the same row and none repeats the others. Null and empty texts have no bytes, shorter ones no match. Other columns do not matter; an
    empty table gives an empty result.

    Windows are keyed by the least hash of their grams, so equal windows meet. Keys that occur once are dropped before any text moves. Segments of one key
    meet in a bucket, in corpus order: each is read backwards through the run-length indexes of the texts before it, new texts are indexed. Grams
    with over `hot` occurrences, whose bucket would grow with the corpus, are compared by 128-bit hashes of single windows instead, the earliest of each
    being a plain minimum. Texts are told apart by a 64-bit hash of id and text. What repeats within a slice of a task is settled there, so a common passage is one segment per slice.
    """
    if window % 4 or window < GRAM:
        raise ValueError(f"window is a multiple of 4, at least {GRAM}")
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    keyed = docs.select(F.col(id), body.alias("body")).withColumn("key", F.xxhash64(F.col(id).isNull(), id, "body"))
    marks = repeated_windows(keyed, id, window, hot)
    per_text = marks.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    joined = packed(keyed).join(per_text, "key", "left").select(id, "body", "marks")
    schema = joined.select(id).schema.add("n_bytes", "long").add("spans", SPAN).add("kept", "binary")
    arrow_span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in unpacked(batch):
                marks = part.column("marks")
                flat, edge = marks.flatten(), np.cumsum(np.concatenate(([0], pc.fill_null(pc.list_value_length(marks), 0).to_numpy())))
                start, end = (flat.field(c).to_numpy() for c in ("start", "end"))
                sizes, spans, kept = [], [], []
                for k, raw in enumerate(part.column("body").to_pylist()):
                    sizes.append(len(raw))
                    mine = slice(edge[k], edge[k + 1])
                    if edge[k] == edge[k + 1]:
                        spans.append([])
                        kept.append(raw)
                        continue
                    step = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(step, start[mine], 1)
                    np.add.at(step, end[mine] - 1 + window, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    a, b = _stretches(np.flatnonzero(gone))
                    spans.append([{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist())])
                    kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
                yield pa.RecordBatch.from_arrays([part.column(id), pa.array(sizes, pa.int64()), pa.array(spans, arrow_span), pa.array(kept, pa.binary())], names=schema.names)

    return map_batches(joined, finish, schema)
