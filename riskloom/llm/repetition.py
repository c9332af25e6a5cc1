"""Quality rules on repetition: how much of a text stands in n-grams and lines it has already had."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.base import blobs, map_batches, slices, sums

#: Limits in percent of characters in repeated n-grams, by n, and in repeated lines. They step down by 1 from 5 to 10 words as
#: the published ones do, but stand 10 higher: short clean texts with one repeated line reach 14 in the labelled tables.
GRAM_LIMITS = {5: 25, 6: 24, 7: 23, 8: 22, 9: 21, 10: 20}
LINE_LIMIT = 25

LETTERS = np.zeros(256, bool)  # first bytes of code points that are part of words
LETTERS[[b for b in range(256) if b & 0xC0 != 0x80 and b not in b" \t\n\r\x0b\x0c"]] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
MIX = np.uint64(0x9E3779B97F4A7C15)  # golden ratio, the usual odd multiplier
MULTIPLIER = np.uint64(6364136223846793005)  # of Knuth's generator


def _twice(keys: np.ndarray, first: bool = True) -> np.ndarray:
    """Which keys are found more than once; without `first`, only those that come after an equal one."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    if first:
        out[order[:-1]] |= same
    return out


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of `size` places lie in a window of n that begins at one of `starts`."""
    edge = np.zeros(size + 1, np.int64)
    edge[starts] += 1
    np.subtract.at(edge, starts + n, 1)
    return np.cumsum(edge[:-1]) > 0


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * MIX
    return (x ^ x >> np.uint64(29)) * MULTIPLIER


def measure(text: bytes, lengths: tuple[int, ...]) -> tuple[int, int, int, list[int], int]:
    """n_words, n_repeat_words, n_dup_lines, repeated characters by n-gram length, characters of repeated lines.

    n_repeat_words counts every word of a three-word window found twice or more, first ones included, by exact comparison. The
    other figures leave the first of equal n-grams or lines out: they are the characters a reader has already seen.
    """
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    met: set[bytes] = set()
    again = [line for line in lines if line in met or met.add(line)]
    line_chars = sum(len(b"".join(line.split()).decode("utf-8", "replace")) for line in again)
    if n < 4:
        return n, 0, len(again), [0] * len(lengths), line_chars
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(names.__getitem__, words), np.int64, n)
    pair = ids[:-1] * len(names) + ids[1:]
    if len(names) > 1 << 20:  # keeps the triples' numbers below 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    repeated = _twice(pair[:-1] * len(names) + ids[2:])
    at = np.flatnonzero(repeated)
    if not len(at):
        return n, 0, len(again), [0] * len(lengths), line_chars
    n_repeat = int(_covered(at, 3, n).sum())
    # an n-gram can be a repeat only where the shorter one is, so each length looks at what the last one left
    chars = np.fromiter((len(w.decode("utf-8", "replace")) for w in words), np.int64, n)
    code = _mixed(ids.astype(np.uint64) + np.uint64(1))
    rolled = (code[at] * MULTIPLIER + code[at + 1]) * MULTIPLIER + code[at + 2]
    found = dict.fromkeys(lengths, 0)
    for size in range(4, max(lengths) + 1):
        inside = at + size <= n
        at, rolled = at[inside], rolled[inside]
        rolled = rolled * MULTIPLIER + code[at + size - 1]
        more = _twice(rolled)
        at, rolled = at[more], rolled[more]
        if not len(at):
            break
        if size in found:
            later = at[_twice(rolled, first=False)]
            found[size] = int(chars[_covered(later, size, n)].sum())
    return n, n_repeat, len(again), list(found.values()), line_chars


def rate(
    docs: DataFrame, text: str = "text", gram_limits: dict[int, int] | None = None, line_limit: int = LINE_LIMIT,
    min_words: int = 50, max_repeat_percent: int = 50, returned: tuple[str, ...] | None = None, prefix: str = "",
) -> DataFrame:
    """Columns `returned` (all by default), figures, base_failed and kept, named with `prefix`, of every row.

    Input columns of the same names are replaced.

    Figures: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), gram_chars (array: repeated characters for each
    length of gram_limits), line_chars, base_failed, kept. A text fails the base rules with under `min_words` words or over
    `max_repeat_percent` percent of its words in repeated three-word windows. It is kept if it passes them and no share of
    repeated characters is over its limit. Null and wordless texts have zeros and fail.
    """
    limits = GRAM_LIMITS if gram_limits is None else gram_limits
    lengths = tuple(sorted(limits))
    made = [prefix + c for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    taken = {*made, *[prefix + c for c in ("gram_chars", "line_chars", "base_failed", "kept")]}
    base = [c for c in (docs.columns if returned is None else returned) if c.lower() not in taken]
    whole = docs.select(*base, F.col(text).cast("binary").alias("_text"))
    schema = whole.drop("_text").schema
    for c in made:
        schema = schema.add(c, "long")
    schema = schema.add(f"{prefix}gram_chars", T.ArrayType(T.LongType())).add(f"{prefix}line_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 2 << 20):
                body, at = blobs(part.column("_text"))
                raw = body.tobytes()
                rows = [measure(raw[a:b], lengths) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                n_words, repeat, dup, grams, lines = zip(*rows)
                new = [n_words, sums(LETTERS[body], at), sums(SYMBOLS[body], at), dup, repeat]
                kept = [part.column(c) for c in part.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *[pa.array(x, pa.int64()) for x in new], pa.array(grams, pa.list_(pa.int64())), pa.array(lines, pa.int64())],
                    names=schema.names,
                )

    n_words, word_chars, repeat = (F.col(prefix + c) for c in ("n_words", "word_chars", "n_repeat_words"))
    failed = (n_words < min_words) | (100 * repeat > max_repeat_percent * n_words)
    over = 100 * F.col(f"{prefix}line_chars") > line_limit * word_chars
    for k, n in enumerate(lengths):
        over = over | (100 * F.col(f"{prefix}gram_chars")[k] > limits[n] * word_chars)
    return map_batches(whole, run, schema).withColumns({f"{prefix}base_failed": failed, f"{prefix}kept": ~failed & ~over})
