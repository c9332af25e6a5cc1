"""URL verdicts: rules first, then naive Bayes over the words of host and path."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import map_batches
from riskloom.plans.materialize import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = re.compile(r"[^\W_]+")
#: Letters of the keys by which words are looked up in names: shorter words whole, longer ones by their beginnings. No word is left out.
FIRST, PIECE = 5, 24


def host_of(url: Column) -> Column:
    """Behind the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule, nulls if none fits.

    A rule `host/path` fits its host and all subdomains of it if the url's path starts with the rule's. Of two verdicts for one
    rule the first stands.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(reversed(rules), key=lambda r: len(r[0])):  # later ones are asked first
        at = text.index("/")
        own, start = text[:at], text[at:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        name, verdict = F.when(fits, text).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def lexicon(texts: DataFrame, text: str) -> DataFrame:
    """All words of all texts and their counts: word, n. Markup, scripts and styles are left out."""
    plain = F.regexp_replace(F.lower(F.col(text)), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    words = texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word")).where(F.length("word") > 0)
    return materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")


class Segmenter:
    """Splits a concatenated name into its most probable words under a unigram model (Viterbi).

    A word of the lexicon has its share of all counts as its probability; any other run of n characters has 1 / (total * 10^n). Two best
    costs are kept per place, of splits that end in a word and of splits that end in an unknown run, since only the latter can go on
    without a new base cost. Of equal costs a known word, and of those the longest, stands.
    `counts` need only hold the words that are in the name, if `total` gives the sum of all counts.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = max(sum(counts.values()) if total is None else total, 1)
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.lengths = sorted({len(w) for w in counts}, reverse=True)
        self.base, self.per = math.log(total), math.log(10)

    def words(self, name: str) -> tuple[str, ...]:
        cost, none = self.cost, math.inf
        known, unknown = [0.0], [none]
        known_from, unknown_from = [0], [0]  # where the last word, or the last unknown run, starts
        for j in range(1, len(name) + 1):
            best, at = none, 0
            for size in self.lengths:
                i = j - size
                if i >= 0 and (c := cost.get(name[i:j])) is not None and (c := c + min(known[i], unknown[i])) < best:
                    best, at = c, i
            known.append(best)
            known_from.append(at)
            on, new = unknown[j - 1] + self.per, known[j - 1] + self.base + self.per
            unknown.append(min(on, new))
            unknown_from.append(unknown_from[j - 1] if on <= new else j - 1)
        out, j, run = [], len(name), unknown[-1] < known[-1]
        while j:
            i = (unknown_from if run else known_from)[j]
            out.append(name[i:j])
            j, run = i, not run and unknown[i] < known[i]  # an unknown run starts behind a word
        return tuple(reversed(out))


def candidates(names: DataFrame, words: DataFrame) -> DataFrame:
    """(number, word, n): for every name (number, name) the words of the lexicon that can stand in it, by joins on equal keys alone.

    Words under FIRST letters are looked up whole. Places whose first FIRST letters begin no word are dropped; what is left is looked up in
    every length up to PIECE. Longer words are found by their first PIECE letters; the segmenter compares the rest.
    """

    def shorts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, name in zip(batch.column("number").to_pylist(), batch.column("name").to_pylist()):
                held = sorted({name[i : i + k] for k in range(1, FIRST) for i in range(len(name) - k + 1)})
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(held), pa.int64()), pa.array(held, pa.string())], names=["number", "word"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, name in zip(batch.column("number").to_pylist(), batch.column("name").to_pylist()):
                for start in range(0, len(name) - FIRST + 1, 1 << 16):  # a long name goes in parts
                    held = sorted({name[i : i + PIECE] for i in range(start, min(start + (1 << 16), len(name) - FIRST + 1))})
                    yield pa.RecordBatch.from_arrays([pa.array([number] * len(held), pa.int64()), pa.array(held, pa.string())], names=["number", "piece"])

    first = F.substring("word", 1, FIRST).alias("first")
    begun = words.where(F.length("word") >= FIRST).select(first).distinct()
    places = map_batches(names, pieces, "number long, piece string").withColumn("first", F.substring("piece", 1, FIRST))
    places = materialize(places.join(begun, "first", "left_semi").select("number", "piece"), "places")
    lengths = F.sequence(F.lit(FIRST), F.length("piece"))
    middle = places.select("number", F.explode(F.transform(lengths, lambda k: F.substring("piece", F.lit(1), k))).alias("word")).distinct().join(words, "word")
    short = map_batches(names, shorts, "number long, word string").join(words, "word")
    beyond = words.where(F.length("word") > PIECE).withColumn("piece", F.substring("word", 1, PIECE))
    longer = places.where(F.length("piece") == PIECE).join(beyond, "piece").select("number", "word", "n").distinct()
    return short.select("number", "word", "n").unionAll(middle.select("number", "word", "n")).unionAll(longer)


def segments(names: DataFrame, words: DataFrame) -> DataFrame:
    """Columns name and words (array) of every distinct name that is not null, cut by the whole lexicon.

    Names go by number into the joins that find their words (`candidates`), so a long name is never repeated.
    """
    total = words.agg(F.sum("n")).first()[0] or 0
    names = names.select("name").where("name IS NOT NULL").distinct()
    names = materialize(names.select(F.monotonically_increasing_id().alias("number"), "name"), "names")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("name").to_pylist(), batch.column("held").to_pylist())
            split = [Segmenter({r["word"]: r["n"] for r in held or ()}, total).words(name) for name, held in rows]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(split, pa.list_(pa.string()))], names=["name", "words"])

    held = candidates(names, words).groupBy("number").agg(F.collect_list(F.struct("word", "n")).alias("held"))
    return map_batches(names.join(held, "number", "left").select("name", "held"), cut, "name string, words array<string>")


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], id: str = "page_id", url: str = "url", text: str = "html",
    prior_words: dict[str, str] | None = None,
) -> DataFrame:
    """`id`, host, path, rule, verdict and block_odds of every row.

    The longest fitting rule decides. Urls that no rule fits are judged by multinomial naive Bayes, trained on all urls that a
    rule decides: hosts and paths are segmented into words with a lexicon of the pages' own texts, and the log odds of block
    against allow are summed over the words with add-one smoothing; above 0 is block, 0 and below allow. The class odds are taken
    as even, so that the share of urls that rules happen to reach does not decide. `prior_words` (word -> verdict) count as one
    more url each. Without any decided url all are allowed. Null urls and urls without `://` have empty host and path.
    Names are cut and rated once each, by joins with all word counts and all token counts; every row then collects the log odds
    of its names and adds them exactly, whatever their order.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = pages.select(id, host.alias("host"), path.alias("path"))
    ruled = rows.select(id, "host", "path", name.alias("rule"), verdict.alias("ruled"))
    spark = pages.sparkSession
    rows = materialize(ruled.withColumn("_row", F.monotonically_increasing_id()), "urls")
    schema = "_row long, ruled string, mark string, name string"

    def names_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, what, host, path in zip(*(batch.column(c).to_pylist() for c in ("_row", "ruled", "host", "path"))):
                for mark, body in (("h:", host), ("p:", path.lower())):
                    out += [(row, what, mark, None if name.isdigit() else name) for name in TOKEN.findall(body)]  # numbers are one token
            columns = zip(*out) if out else [()] * 4
            types = (pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["_row", "ruled", "mark", "name"])

    named = materialize(map_batches(rows.select("_row", "ruled", "host", "path"), names_of, schema), "names")
    block, allow = F.count_if(F.col("ruled") == "block"), F.count_if(F.col("ruled") == "allow")
    tally = named.groupBy("mark", "name").agg(block.alias("b"), allow.alias("a"))
    split = segments(named, lexicon(pages, text))
    token = F.explode(F.transform(F.coalesce("words", F.array(F.lit("0"))), lambda w: F.concat("mark", w))).alias("token")
    # from here on a name is one row per mark, however frequent; numbers are names of their own (null)
    cut = materialize(tally.join(split, "name", "left").select("mark", "name", "b", "a", token), "tokens")
    seen = cut.select("token", "b", "a").where("b + a > 0")
    for word, what in (prior_words or {}).items():
        seen = seen.unionAll(spark.sql(f"SELECT 'h:{word}' AS token, {int(what == 'block')}L AS b, {int(what == 'allow')}L AS a"))
    counts = materialize(seen.groupBy("token").agg(F.sum("b").alias("tb"), F.sum("a").alias("ta")), "counts")
    total = counts.agg(F.sum("tb").alias("b"), F.sum("ta").alias("a"), F.count(F.lit(1)).alias("n")).first()
    space = total["n"] + 1
    base = math.log(((total["a"] or 0) + space) / ((total["b"] or 0) + space)) if total["n"] else 0.0
    own = F.log((F.coalesce("tb", F.lit(0)) + 1) / (F.coalesce("ta", F.lit(0)) + 1)) + F.lit(base)
    odds = cut.join(counts, "token", "left").groupBy("mark", "name").agg(F.collect_list(own).alias("odds"))
    # a name has one row of odds, so adaptive execution may split the rows of a frequent name over tasks
    rated = named.join(odds, named.mark.eqNullSafe(odds.mark) & named.name.eqNullSafe(odds.name)).select("_row", "odds")
    votes = rated.groupBy("_row").agg(F.flatten(F.collect_list("odds")).alias("odds"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = pa.array([math.fsum(x) for x in batch.column("odds").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), value], names=["_row", "block_odds"])

    rated = rows.join(map_batches(votes, add, "_row long, block_odds double"), "_row", "left")
    rated = rated.withColumn("block_odds", F.coalesce("block_odds", F.lit(0.0)))
    final = F.coalesce("ruled", F.when(F.col("block_odds") > 0, "block").otherwise("allow"))
    return rated.select(id, "host", "path", "rule", final.alias("verdict"), "block_odds")
