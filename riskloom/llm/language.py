"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.base import blobs, map_batches, slices, sums
from riskloom.plans.materialize import discard, materialize

EDGE = 0xFF  # stands before a text; no UTF-8 text holds it
LETTER = regex.compile(r"\p{L}")
ORDERS = 4  # contexts of 0 to 3 bytes
FEW_LABELS = 100_000  # a table of so many label counts is broadcast, a larger one is not


@dataclass
class ContextTree:
    """Code lengths in bits of every symbol behind every context of one language, computed once from frozen counts.

    symbol: byte -> class (0: bytes the language's texts do not hold, and the edge of a text; they follow one another in no
    tree, so all of them have the same code length everywhere). row: packed last three classes -> the longest context that the
    tree knows. bits: row x class.
    """

    language: str
    symbol: np.ndarray
    row: np.ndarray
    bits: np.ndarray

    @property
    def size(self) -> int:
        return self.symbol.nbytes + self.row.nbytes + self.bits.nbytes

    def lengths(self, edged: np.ndarray, place: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits of each text. `edged`: all bytes with three edges before each text, `place`: where the texts' bytes stand in it."""
        k = self.bits.shape[1]
        at = self.symbol[edged]
        code = (at[:-2] * k + at[1:-1]) * k + at[2:]  # of the three bytes up to a place
        return sums(self.bits.ravel()[self.row[code[place - 3]] * k + at[place]], bounds)


def code_lengths(trees: list[ContextTree], body: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bits of each text (text k is body[bounds[k]:bounds[k + 1]]) in each language."""
    n = len(bounds) - 1
    edged = np.full(len(body) + 3 * n, EDGE, np.uint8)
    place = np.arange(len(body)) + np.repeat(3 * np.arange(1, n + 1), np.diff(bounds))
    edged[place] = body
    return np.stack([t.lengths(edged, place, bounds) for t in trees], axis=1)


def gram_counts(rows: DataFrame, lang: str, text: str) -> DataFrame:
    """Counts of four-byte runs per language, with three edge bytes before each text: lang, gram (first byte highest), n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("lang").to_pylist()
            body, bounds = blobs(batch.column("text"))
            for name in sorted(set(names)):
                grams = []
                for k in [k for k, x in enumerate(names) if x == name]:
                    s = np.concatenate((np.full(3, EDGE, np.uint32), body[bounds[k] : bounds[k + 1]].astype(np.uint32)))
                    grams.append(s[:-3] << 24 | s[1:-2] << 16 | s[2:-1] << 8 | s[3:])
                gram, n = np.unique(np.concatenate(grams), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(gram)), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"]
                )

    narrow = rows.select(F.col(lang).alias("lang"), F.col(text).cast("binary").alias("text"))
    part = map_batches(narrow, run, "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def run_counts(grams: DataFrame) -> DataFrame:
    """Counts of the runs of one to four bytes that end the four-byte runs and hold no edge: lang, size (1 to 4), run, n."""
    byte = lambda back: F.shiftright("gram", 8 * back).bitwiseAND(0xFF)
    whole = F.lit(True)
    listed = []
    for size in range(1, ORDERS + 1):
        whole = whole & (byte(size - 1) != EDGE)
        run = F.col("gram").bitwiseAND((1 << 8 * size) - 1)
        listed.append(F.when(whole, F.struct(F.lit(size).alias("size"), run.alias("run"))))
    each = grams.select("lang", "n", F.explode(F.array_compact(F.array(*listed))).alias("x")).select("lang", "x.size", "x.run", "n")
    return each.groupBy("lang", "size", "run").agg(F.sum("n").alias("n"))


def build_tree(language: str, runs: list[tuple[np.ndarray, np.ndarray]], max_contexts: int) -> ContextTree:
    """A tree of order 0 to 3 from (runs, counts) of one to four bytes.

    In a context seen t times with d different next symbols, a symbol seen c times has probability c / (t + d); the escape
    d / (t + d) is shared out among the other symbols by the next shorter context, whose probabilities for them are scaled to
    sum to one. Below order 0 all 256 bytes are equally likely. Of each order the `max_contexts` most frequent contexts are kept.
    """
    seen = np.unique(runs[0][0])
    symbol = np.zeros(256, np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    k = len(seen) + 1
    uniform = np.full((1, k), 1 / 256)
    uniform[0, 0] = 1 - (k - 1) / 256
    table = _blend(uniform, np.zeros(len(seen), np.int64), symbol[runs[0][0]], runs[0][1])
    row = np.zeros(1, np.int32)
    for order, (run, n) in enumerate(runs[1:], 1):
        packed = np.zeros(len(run), np.int64)
        for back in range(order, 0, -1):
            packed = packed * k + symbol[run >> 8 * back & 0xFF]
        codes, place = np.unique(packed, return_inverse=True)
        if len(codes) > max_contexts:
            often = np.bincount(place, n, minlength=len(codes))
            codes = np.sort(codes[np.lexsort((codes, -often))[:max_contexts]])
        row = np.tile(row, k)  # packed last classes -> longest context known so far
        kept = np.isin(packed, codes)
        made = _blend(table[row[codes]], np.searchsorted(codes, packed[kept]), symbol[run[kept] & 0xFF], n[kept])
        row[codes] = len(table) + np.arange(len(codes), dtype=np.int32)
        table = np.concatenate((table, made))
    table[:, 0] /= max(1, 256 - (k - 1))  # one of the bytes of class 0
    np.maximum(table, 1e-30, out=table)
    return ContextTree(language, symbol, row, np.negative(np.log2(table, out=table), out=table))


def _blend(below: np.ndarray, context: np.ndarray, follows: np.ndarray, n: np.ndarray, block: int = 4096) -> np.ndarray:
    """Probabilities (context x class) from counts, escaping to `below` of the same shape; some contexts at a time."""
    order = np.argsort(context, kind="stable")
    ends = np.searchsorted(context[order], np.arange(0, len(below) + block, block))
    out = np.empty(below.shape, np.float32)
    for k, start in enumerate(range(0, len(below), block)):
        own = order[ends[k] : ends[k + 1]]
        under = below[start : start + block].astype(np.float64)
        count = np.zeros(under.shape)
        np.add.at(count, (context[own] - start, follows[own]), n[own])
        total, kinds, hit = count.sum(axis=1), (count > 0).sum(axis=1), count > 0
        left = np.where(hit, 0.0, under)
        scale = kinds / np.maximum(total + kinds, 1) / left.sum(axis=1)  # class 0 follows nothing, so something is always left
        mixed = np.where(hit, count / np.maximum(total + kinds, 1)[:, None], left * scale[:, None])
        out[start : start + block] = np.where((total > 0)[:, None], mixed, under)
    return out


def fit(
    docs: DataFrame, where: Column, lang: str = "lang", text: str = "text", id: str = "doc_id", max_documents: int = 4000,
    max_contexts: int = 16384, max_grams: int = 262_144,
) -> DataFrame:
    """A written table of context trees, one row a language: language, size (bytes), tree. Its texts are a bounded sample.

    Only rows for which `where` holds and whose language and text are not null are used; about `max_documents` documents per
    language are chosen by a hash of their id. Every language of these rows is learned, however many there are, and has limits
    of its own: `max_contexts` contexts of each order from the `max_grams` most frequent runs of each length (ties: the smaller
    run). A tree is built in one task from at most four times `max_grams` rows. Languages whose texts are all empty have none.
    """
    labelled = docs.where(where & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = labelled.select(F.xxhash64(F.lit("ppm"), F.col(id)).alias("draw"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sizes = materialize(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("labelled")), "labels")
    few = sizes.count() <= FEW_LABELS
    drawn = F.pmod("draw", F.lit(1 << 20)) < F.lit(max_documents) / F.col("labelled") * (1 << 20)
    sample = rows.join(F.broadcast(sizes) if few else sizes, "lang").where(drawn)
    counts = run_counts(gram_counts(sample, "lang", "text"))
    best = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "run")  # a sample's distinct runs
    top = counts.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= max_grams).drop("_r")

    def build(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        size, run, n = (group.column(c).to_numpy() for c in ("size", "run", "n"))
        tree = build_tree(key[0].as_py(), [(run[size == s], n[size == s]) for s in range(1, ORDERS + 1)], max_contexts)
        return pa.table({"language": [tree.language], "size": [tree.size], "tree": pa.array([pickle.dumps(tree, protocol=5)], pa.binary())})

    trees = materialize(top.groupBy("lang").applyInArrow(build, "language string, size long, tree binary"), "trees")
    discard(sizes)
    return trees


def tree_groups(trees: DataFrame, max_bytes: int) -> list[list[str]]:
    """Languages by name, cut into groups whose trees have at most `max_bytes`; a larger tree is a group of its own."""
    groups: list[list[str]] = []
    held = 0
    for r in sorted(trees.select("language", "size").collect()):  # a name and a number per language
        if not groups or held + r["size"] > max_bytes:
            groups.append([])
            held = 0
        groups[-1].append(r["language"])
        held += r["size"]
    return groups


def load(trees: DataFrame, languages: list[str]) -> list[ContextTree]:
    """Trees of some languages, by name."""
    rows = trees.where((F.col("language") >= languages[0]) & (F.col("language") <= languages[-1])).select("tree").collect()
    return sorted((pickle.loads(r["tree"]) for r in rows), key=lambda t: t.language)


def predict(
    docs: DataFrame, trees: DataFrame, text: str = "text", returned: tuple[str, ...] | None = None, prefix: str = "", max_bytes: int = 192 << 20
) -> DataFrame:
    """Columns `returned` (all by default) with lang_pred and score, named with `prefix`, for every row.

    Input columns of the same names are replaced.

    The language with the shortest code for the whole text wins, ties go to the first by name; score is its probability if all
    languages are equally likely beforehand. Null texts, texts without a letter, and all texts if no language was learned, are
    `und` with score 0. Trees are broadcast in groups of at most `max_bytes` (or one tree, whose size the limits of `fit` bound).
    One group is one pass within the plan of `docs`; with more, each further group reads a written table of the rows with
    their shortest code so far, so that a task never holds two groups.
    """
    groups = tree_groups(trees, max_bytes)
    kept = [c for c in (docs.columns if returned is None else returned) if c.lower() not in (f"{prefix}lang_pred", f"{prefix}score")]
    taken = {c.lower() for c in docs.columns}
    own = []
    for name in ("text", "bits", "mass", "lang"):
        while f"_{name}" in taken:
            name = f"_{name}"
        own.append(f"_{name}")
    body_, bits_, mass_, lang_ = own
    # shortest code so far; all codes' probability as a multiple of its own; its language, null if there is none yet
    state = [F.lit(None).cast("double").alias(bits_), F.lit(0.0).alias(mass_), F.lit(None).cast("string").alias(lang_)]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("binary").alias(body_), *state)
    written = None
    for k, languages in enumerate(groups):
        if k:
            rows, done = materialize(rows, "told"), written
            written = rows
            if done is not None:
                discard(done)
        rows = _told(rows, load(trees, languages), own)
    found = F.col(lang_).isNotNull()
    answer = [F.coalesce(F.col(lang_), F.lit("und")).alias(f"{prefix}lang_pred"), F.when(found, 1 / F.col(mass_)).otherwise(F.lit(0.0)).alias(f"{prefix}score")]
    return rows.select(*[F.col(f"`{c}`") for c in kept], *answer)


def _told(rows: DataFrame, trees: list[ContextTree], own: list[str]) -> DataFrame:
    """Rows with their shortest code over the languages so far and those of `trees`, all of which come later by name."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)
    body_, bits_, mass_, lang_ = own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([t.language for t in model], object)
        for batch in batches:
            for part in slices(batch, body_, 2 << 20):
                body, bounds = blobs(part.column(body_))
                raw = body.tobytes()
                ends = zip(bounds[:-1].tolist(), bounds[1:].tolist())
                spoken = np.array([LETTER.search(raw[a:b].decode("utf-8", "replace")) is not None for a, b in ends], bool)
                bits = code_lengths(model, body, bounds)
                here = bits.min(axis=1)
                old = part.column(bits_).to_numpy(zero_copy_only=False).astype(float)
                mass = part.column(mass_).to_numpy(zero_copy_only=False)
                first = np.isnan(old)  # null: no language yet
                least = np.where(first, here, np.fmin(old, here))
                mass = np.where(first, 0.0, mass * np.exp2(least - np.where(first, least, old))) + np.exp2(least[:, None] - bits).sum(axis=1)
                best = np.where(first | (here < old), names[bits.argmin(axis=1)], np.array(part.column(lang_).to_pylist(), object))
                best[~spoken] = None
                new = {bits_: pa.array(least), mass_: pa.array(mass), lang_: pa.array(best, pa.string())}
                yield pa.RecordBatch.from_arrays([new.get(c, part.column(c)) for c in part.schema.names], names=part.schema.names)

    return map_batches(rows, run, rows.schema)
