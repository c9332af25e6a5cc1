"""Spelling variants against a comparison of all words."""

import pathlib
import sys

import numpy as np
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import plain  # noqa: E402
from test_operators import ODD, SMALL  # noqa: E402

from riskloom.llm import variants  # noqa: E402
from riskloom.llm.base import REGISTRY  # noqa: E402


def test_query_matches_plain(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    wanted = plain.forms(plain.word_table([tuple(d) for d in docs]))
    got = [tuple(r) for r in REGISTRY["op11_spelling_variants"][0](spark, SMALL).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted
    assert sum(1 for w in wanted if w[1]) > 3


def spellings(rng, letters, n):
    """Words of few letters, so that nearly all grams are common, and words one edit from others."""
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(list(letters), rng.integers(6, 11)))
        words.add(w)
        k = rng.integers(len(w))
        words |= {w[:k] + w[k + 1 :], w[:k] + letters[0] + w[k:], w + letters[-1], letters[-1] + w[1:]}
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize("letters, share", [("ab", 0.0005), ("abc", 0.05), ("abcdeféÿ", 0.01), ("abcdefgh", 1.0)])
def test_all_near_pairs_are_found(spark, letters, share):
    rng = np.random.default_rng(len(letters))
    words = spellings(rng, letters, 250)
    count = {w: int(n) for w, n in zip(words, rng.choice([5, 6, 30, 31, 900], len(words)))}
    table = spark.createDataFrame(list(count.items()), "word string, n long").repartition(3)
    pairs = [(r.a, r.b) for r in variants.near_words(table, share).collect()]
    found = {tuple(sorted(p)) for p in pairs}
    assert len(pairs) == len(found)
    assert found == {(a, b) for a in words for b in words if a < b and plain.near(a, b)}
    assert {tuple(r) for r in variants.spelling_forms(table, share=share).collect()} == plain.forms(count)


def test_chain_of_forms_and_ties(spark):
    chain = [("aaaaaa", 5), ("aaaaab", 25), ("aaaabb", 125), ("aaabbb", 625), ("aabbbb", 3125), ("abbbbb", 15_625), ("abbbbc", 78_125), ("zzzzzz", 7), ("zzzzzy", 35), ("zzzzzx", 35)]
    got = {r.word: r for r in variants.spelling_forms(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert {got[w].root for w, _ in chain[:7]} == {"abbbbc"} and got["abbbbc"].form is None
    assert (got["zzzzzz"].form, got["zzzzzz"].form_n, got["zzzzzz"].n_near) == ("zzzzzx", 35, 2)
    assert got["zzzzzx"].form is None and got["zzzzzx"].root == "zzzzzx"


def test_odd_rows(spark):
    rows = [(i, t, "w", 1) for i, t, _ in ODD] + [(60 + i, "Straße STRAßE Ärgern ärgern straße", None, None) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(3)
    got = {r.word: r.n for r in variants.word_counts(docs).collect()}
    assert got == {"straße": 9}  # capitals beyond Z stay as they are, so the other two are two words of three
    got = {r.word: r.n for r in variants.word_counts(docs, least_length=1, least_count=1, typos=True).collect()}
    assert got[""] >= 1 if "" in got else True
    assert variants.spelling_forms(variants.word_counts(docs.where("1 = 0"))).count() == 0
