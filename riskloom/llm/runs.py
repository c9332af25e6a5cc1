"""Periodic runs of words: recursive frequency splitting, then a lag scan of what is left."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from riskloom.llm.base import blobs, map_batches, slices

MIN_LENGTH, MIN_REPEATS = 24, 3
#: Words compared at once at a check point of the lag scan. Every qualifying stretch is at least twice as long.
BLOCK = 8
RUNS = ArrayType(StructType().add("start", "long").add("length", "long").add("period", "long"))


def split_by_frequency(words: np.ndarray, owner: np.ndarray, min_length: int, repeats: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments of `words` (numbers) in which every word occurs at least `repeats` times.

    A run of length >= repeats * period holds each of its words `repeats` times, so a word that is rarer in its segment lies in no run
    and cuts the segment; what is left of it is looked at again, until no segment changes. Segments shorter than `min_length` go.
    `owner` (not decreasing) tells texts apart; no segment crosses texts.
    """
    place, segment = np.arange(len(words)), owner
    kinds = int(words.max(initial=0)) + 1
    starts, ends = [], []
    while len(place):
        cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(segment) != 0)) + 1
        begin, stop = np.concatenate(([0], cut)), np.concatenate((cut, [len(place)]))
        size = stop - begin
        segment = np.repeat(np.arange(len(begin)), size)
        key = segment * kinds + words[place]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], np.diff(key[order]) != 0)))
        times = np.diff(np.concatenate((first, [len(key)])))
        often = np.empty(len(key), bool)
        often[order] = np.repeat(times >= repeats, times)
        whole = np.logical_and.reduceat(often, begin) & (size >= min_length)
        starts.append(place[begin[whole]])
        ends.append(place[stop[whole] - 1] + 1)
        again = often & np.repeat(~whole & (size >= min_length), size)
        place, segment = place[again], segment[again]
    return (np.concatenate(starts), np.concatenate(ends)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def _last_equal(w: np.ndarray, x: int, lag: int, end: int) -> int:
    """First place from x on where w differs from w `lag` later, or end - lag."""
    size = 64
    while x + lag < end:
        m = min(size, end - lag - x)
        apart = w[x : x + m] != w[x + lag : x + lag + m]
        k = int(apart.argmax())
        if apart[k]:
            return x + k
        x, size = x + m, size * 4
    return x


def _first_equal(w: np.ndarray, x: int, lag: int, begin: int) -> int:
    """Least place from `begin` on from which w equals w `lag` later up to x."""
    size = 64
    while x > begin:
        m = min(size, x - begin)
        apart = (w[x - m : x] != w[x - m + lag : x + lag])[::-1]
        k = int(apart.argmax())
        if apart[k]:
            return x - k
        x, size = x - m, size * 4
    return x


def lag_scan(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run within the segments, in terms of places in `words`.

    A run of period q is a stretch of at least max(min_length, repeats * q) - q places whose word comes again q later. For each lag only
    check points are looked at, so far apart that each such stretch holds a whole block of `BLOCK` words at one of them; the steps grow with the
    lag, so all lags together look at about n log n places. Blocks are compared by hash, hits are extended word by word.
    Lags rise, and a run found again by a multiple of its period has the same ends, so the first lag is the smallest period.
    """
    order = np.argsort(starts - ends, kind="stable")  # longest first, so that the segments a lag can matter to are a prefix
    begins, sizes = starts[order], (ends - starts)[order]
    if not len(sizes):
        return []
    edge = np.concatenate(([0], np.cumsum(sizes)))
    at = np.arange(edge[-1]) + np.repeat(begins - edge[:-1], sizes)
    w = words[at]
    stop = np.repeat(edge[1:], sizes)
    mixed, base = _mixed(w), np.uint64(0x100000001B3)
    blocks = len(w) - BLOCK + 1
    if blocks <= 0:
        return []
    h = np.zeros(blocks, np.uint64)
    for t in range(BLOCK):
        h = h * base + mixed[t : t + blocks]
    known_period, known_end = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
    found: dict[tuple[int, int], int] = {}
    active = len(sizes)
    for lag in range(1, int(sizes[0]) // repeats + 1):
        shortest = max(min_length, repeats * lag)
        while active and sizes[active - 1] < shortest:
            active -= 1
        if not active:
            break
        step = shortest - lag - BLOCK + 1
        last = int(edge[active]) - lag - BLOCK + 1
        x = np.flatnonzero(h[:last:step] == h[lag : last + lag : step]) * step
        if not len(x):
            continue
        to = x + lag + BLOCK
        period = known_period[x]
        x = x[(to <= stop[x]) & ((period == 0) | (lag % np.maximum(period, 1) != 0) | (to > known_end[x]))]
        done = -1
        for p in x.tolist():
            if p + BLOCK <= done:
                continue
            end = int(stop[p])
            done = _last_equal(w, p, lag, end)
            if done - p < BLOCK:  # equal hashes of unequal blocks
                done = -1
                continue
            begin = _first_equal(w, p, lag, int(edge[np.searchsorted(edge, p, "right") - 1]))
            if done - begin + lag >= shortest and (begin, done + lag) not in found:
                found[begin, done + lag] = lag
                known_period[begin : done + lag], known_end[begin : done + lag] = lag, done + lag
    return [(int(at[s]), e - s, q) for (s, e), q in found.items()]


def runs_of_texts(texts: list[list[bytes]], min_length: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start, then period."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    sizes = np.array([len(t) for t in texts], np.int64)
    edge = np.concatenate(([0], np.cumsum(sizes)))
    words = np.fromiter((number[w] for t in texts for w in t), np.int64, int(edge[-1]))
    starts, ends = split_by_frequency(words, np.repeat(np.arange(len(texts)), sizes), min_length, repeats)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in lag_scan(words, starts, ends, min_length, repeats):
        k = int(np.searchsorted(edge, start, "right")) - 1
        out[k].append((start - int(edge[k]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def _collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    if not found:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, text: str = "text", returned: tuple[str, ...] = ("doc_id",), min_length: int = MIN_LENGTH, repeats: int = MIN_REPEATS) -> DataFrame:
    """Columns `returned`, n_words, runs (start, length, period in words; by start, then period) and collapsed of every row.

    Words are what ASCII white space parts. A run is a maximal stretch of consecutive words with smallest period q and a length of at least
    max(min_length, repeats * q); `collapsed` leaves out each word that some run holds after its first q words and joins the others by one space.
    Null, empty and blank texts have no word, no run and an empty `collapsed`. Each row is judged by itself, so repeated rows give
    equal results, an empty table gives an empty one, and other columns of the input do not matter. No row is shuffled; a text
    has to fit into one task.
    """
    if min_length < 2 * BLOCK or repeats < 3:
        raise ValueError(f"a run has at least {2 * BLOCK} words and three periods")
    narrow = docs.select(*returned, F.col(text).cast("binary").alias("_text"))
    schema = narrow.drop("_text").schema.add("n_words", "long").add("runs", RUNS).add("collapsed", "string")
    names = list(returned)
    arrow_runs = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", max_bytes=4 << 20):
                body, at = blobs(part.column("_text"))
                raw = body.tobytes()
                texts = [raw[a:b].split() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                found = runs_of_texts(texts, min_length, repeats)
                told = [[{"start": s, "length": n, "period": q} for s, n, q in f] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[part.column(c) for c in names],
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(told, arrow_runs),
                        pa.array([_collapsed(t, f).decode() for t, f in zip(texts, found)], pa.string()),
                    ],
                    names=[*names, "n_words", "runs", "collapsed"],
                )

    return map_batches(narrow, run, schema)


def planted(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`docs` with the text of about a tenth of the rows made periodic from some word on, by the checksum of the id (null ids: left alone).

    With h = crc32 of the decimal id, g = floor(h / 10) and n words: if 10 divides h, word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col(id).cast("string").cast("binary"))
    w = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"))
    periodic = docs.withColumn("_g", F.floor(h / 10)).withColumn("_w", F.when(h % 10 == 0, w))
    n = F.size("_w")
    periodic = periodic.withColumn("_a", F.when(n > 0, F.col("_g") % n)).withColumn(
        "_p", F.lit(1) + F.floor((n - F.col("_a")) / (F.lit(3) + F.col("_g") % 8))
    )
    word = "transform(sequence(0L, size(_w) - 1L), i -> element_at(_w, CAST(1 + IF(i < _a, i, _a + (i - _a) % _p) AS INT)))"
    changed = F.when(F.col("_a").isNotNull(), F.array_join(F.expr(word), " ")).otherwise(F.col(text))
    return periodic.withColumn(text, changed).drop("_g", "_w", "_a", "_p")
