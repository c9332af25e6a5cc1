"""Spelling variants: words one insertion, deletion or replacement apart, found by an index of variable-length grams."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import map_batches
from riskloom.plans.materialize import materialize

#: Letters a to z in either case and the Latin letters beyond them, in maximal runs; a fixed pattern.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Marks of a word's two ends; no word holds them.
HEAD, TAIL = "^", "$"
LEAST_GRAM, MOST_GRAM = 2, 5
#: A gram is frequent, and so made longer, if more than this share of all words holds it. At most MOST_GRAM - LEAST_GRAM grams start at each of
#: a word's places, so there are at most (mean word length + 1) * 3 / SHARE frequent grams, whatever the number of words.
SHARE = 1 / 2000


def runs_of(text: str) -> Counter[str]:
    return Counter(run.translate(LOWER) for run in RUN.findall(text))


def with_typos(doc_id: str, runs: Counter[str], one_in: int = 199) -> Counter[str]:
    """`runs` where those whose crc32 with the id is divisible by `one_in` lose one letter (and may become empty)."""
    out: Counter[str] = Counter()
    head = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), head)
        if h % one_in == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        out[run] += n
    return out


def word_counts(docs: DataFrame, text: str = "text", id: str = "doc_id", least_length: int = 6, least_count: int = 5, typos: bool = False) -> DataFrame:
    """(word, n): every distinct run of Latin letters with at least `least_length` code points and `least_count` occurrences.

    Only A-Z are lower-cased. Runs are counted within each batch first, so a very common word is one row per batch. With `typos` a
    run loses a letter by the checksum of id and run (`with_typos`). Null texts have no run; a null id counts as empty text.
    """
    narrow = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter[str] = Counter()
            for doc, body in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                runs = runs_of(body) if body else Counter()
                total.update(with_typos(doc, runs) if typos else runs)
            held = [(w, n) for w, n in total.items() if len(w) >= least_length]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in held], pa.string()), pa.array([n for _, n in held], pa.int64())], names=["word", "n"])

    partial = map_batches(narrow, run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _starts(word: Column, length: int) -> Column:
    """Every (place, gram) of that length, from the marked word; one gram for each place at which it fits."""
    marked = F.concat(F.lit(HEAD), word, F.lit(TAIL))
    last = F.char_length(word) + 3 - length
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), last), lambda p: F.struct(p.alias("place"), F.substring(marked, p, F.lit(length)).alias("gram"))))


def gram_dictionary(words: DataFrame, share: float = SHARE) -> DataFrame:
    """(gram): the frequent grams of LEAST_GRAM to MOST_GRAM - 1 letters, those that more than `share` of all words hold.

    Longer grams are counted only below frequent shorter ones, so the dictionary is pruned while it grows. The number of rows has the bound stated
    at SHARE and does not grow with the words, so it may be broadcast.
    """
    most = F.lit(share) * F.lit(words.count())
    known = None
    for length in range(LEAST_GRAM, MOST_GRAM):
        grams = words.select("word", F.explode(_starts(F.col("word"), length)).alias("g")).select("word", F.col("g.gram").alias("gram"))
        if known is not None:
            grams = grams.withColumn("up", F.substring("gram", 1, length - 1)).join(F.broadcast(known.withColumnRenamed("gram", "up")), "up", "left_semi")
        held = grams.distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > most).select("gram")
        held = materialize(held, "grams")
        known = held if known is None else known.unionAll(held)
    return known


def decompose(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, n, size, place, gram) of every word: at each place the shortest gram that is not frequent, MOST_GRAM letters at most.

    A gram is settled by its own letters alone (the end mark included), so an edit affects exactly the grams that span it. A gram inside its
    neighbour is kept: dropping it would make it depend on letters before it and leave short words without a bound.
    """
    size = F.char_length("word")
    grown = words.select("word", "n", size.alias("size"), F.explode(_starts(F.col("word"), LEAST_GRAM)).alias("g")).select("word", "n", "size", "g.place", "g.gram")
    marked = F.concat(F.lit(HEAD), "word", F.lit(TAIL))
    for length in range(LEAST_GRAM, MOST_GRAM):
        frequent = F.broadcast(dictionary.where(F.char_length("gram") == length).withColumn("frequent", F.lit(True)))
        more = F.col("frequent") & (F.col("place") + length <= F.col("size") + 2)
        grown = grown.join(frequent, "gram", "left").select(
            "word", "n", "size", "place", F.when(more, F.substring(marked, F.col("place"), F.lit(length + 1))).otherwise(F.col("gram")).alias("gram")
        )
    return grown


def affected(grams: str = "grams") -> Column:
    """The most grams of a word that one edit can touch, from its array of (held, gram, place): per-word bound of one edit.

    A replaced or deleted letter touches the grams that span it; one inserted between two letters touches those that span both, which are
    among them. A gram that ends at the end mark, or starts at the head mark, spans it. Marks themselves are never edited.
    """
    spans = f"size(filter({grams}, g -> g.place <= i AND i < g.place + char_length(g.gram)))"
    return F.expr(f"array_max(transform(sequence(2, size + 1), i -> {spans}))")


def short_lists(words: DataFrame, share: float = SHARE) -> DataFrame:
    """(word, n, size, place, gram): of every word the rarest affected + 1 grams.

    If two words are one edit apart, all grams of either but the affected ones are common to both, at the same place counted from the front
    or from the back. Ordered by (number of words, gram, place), the first common gram is among the first affected + 1 of either word. So
    only these lists have to be merged; the long lists of common grams are left out on both sides.
    """
    placed = materialize(decompose(words, gram_dictionary(words, share)), "placed")
    held = placed.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    rated = placed.join(held, "gram").groupBy("word", "n", "size").agg(F.array_sort(F.collect_list(F.struct("held", "gram", "place"))).alias("grams"))
    kept = F.slice("grams", F.lit(1), affected() + 1)
    return rated.select("word", "n", "size", F.explode(kept).alias("g")).select("word", "n", "size", "g.place", "g.gram")


def near_words(words: DataFrame, share: float = SHARE) -> DataFrame:
    """(a, n_a, b, n_b): each pair of distinct words that differ by exactly one inserted, deleted or replaced code point, once.

    `words` has unique columns word and n (not null). Lists are merged by equal gram, place and length: the place may be one more and the length
    one more in the longer word. A merged pair is then verified letter by letter.
    """
    lists = materialize(short_lists(words, share), "lists")
    shift = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in ((0, 0), (0, 1), (1, 1))]))
    left = lists.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "gram", F.col("place").alias("at"), F.col("size").alias("length"), shift.alias("m")).select(
        "a", "n_a", "gram", (F.col("at") + F.col("m.p")).alias("place"), (F.col("length") + F.col("m.s")).alias("size"), F.col("m.s").alias("longer")
    )
    right = lists.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "gram", "place", "size")
    merged = left.join(right, ["gram", "place", "size"]).where((F.col("longer") == 1) | (F.col("a") < F.col("b")))
    near = merged.where(F.levenshtein("a", "b", 1) == 1).select("a", "n_a", "b", "n_b")
    return near.distinct()


def spelling_forms(words: DataFrame, factor: int = 5, share: float = SHARE, max_rounds: int = 64) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    n_near counts the near words. The form is the near word of largest n (ties: smallest in code-point order) if that n is at least `factor`
    times the word's own, else null; root follows forms to the last and is the word itself if it has none. Counts rise by `factor` at each step, so chains are
    short, and each round halves what is left of them. An empty table gives an empty result.
    """
    words = materialize(words.select("word", "n"), "words")
    pairs = materialize(near_words(words, share), "near")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    best = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), "b")).alias("best"))
    rated = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    fits = -F.col("best.less") >= factor * F.col("n")
    rated = materialize(
        rated.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.b")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")
        ),
        "forms",
    )
    hops = rated.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max_rounds):
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        hops = materialize(hops.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = hops.where("moved").limit(1).count()
        hops = hops.select("word", "root")
        if not moved:
            return rated.join(hops, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    raise RuntimeError(f"roots still change after {max_rounds} rounds")
