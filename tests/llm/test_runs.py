"""Periodic runs against a scan of every lag at every place."""

import hashlib
import pathlib
import re
import sys
from fractions import Fraction

import numpy as np
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import plain  # noqa: E402
from test_operators import ODD, SMALL  # noqa: E402

from riskloom.llm import runs  # noqa: E402
from riskloom.llm.base import REGISTRY  # noqa: E402


def row_of(doc_id, text):
    words = plain.plant(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = plain.runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(found), *best, best[0] is not None and best[1] * 1000 // best[2] or None,
        digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(plain.collapse(words, found))),
    )


def test_query_matches_plain(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs = [d for d in docs if len(d.text or "") < 20_000]
    got = {r.doc_id: tuple(r) for r in REGISTRY["op12_periodic_runs"][0](spark, SMALL).collect()}
    wanted = [row_of(d.doc_id, d.text) for d in docs]
    assert [got[w[0]] for w in wanted] == wanted
    assert sum(1 for w in wanted if w[1]) > 5


@pytest.mark.parametrize("kinds", [1, 2, 3, 6, 40])
def test_runs_of_random_words(kinds):
    rng = np.random.default_rng(kinds)
    texts = [[]]
    for k in range(60):
        words = [b"%d" % x for x in rng.integers(0, kinds, rng.integers(0, 160))]
        for _ in range(rng.integers(0, 4)):  # repeated stretches, also within each other and next to each other
            period, times = rng.integers(1, 30), rng.integers(2, 9)
            piece = [b"%d" % x for x in rng.integers(0, kinds, period)]
            at = rng.integers(0, len(words) + 1)
            words[at:at] = (piece * times)[: period * times - rng.integers(0, period)]
        texts.append(words)
    got = runs.runs_of_texts(texts)
    assert got == [plain.runs(t) for t in texts]
    assert kinds == 40 or any(got)


def test_words_that_are_rare_in_a_part_cut_it_again():
    tail = [b"x"] * 23
    text = [b"a", b"b", b"a", b"c", b"b", b"a", b"b"] + tail
    starts, ends = runs.split_by_frequency(np.array([ord(w) for w in text]), np.zeros(len(text), np.int64), 24, 3)
    assert len(starts) == 0  # c cuts, then b and a are rare on both sides, and 23 words are too few
    starts, ends = runs.split_by_frequency(np.array([ord(w) for w in text + [b"x"]]), np.zeros(len(text) + 1, np.int64), 24, 3)
    assert (starts.tolist(), ends.tolist()) == ([7], [31])


def test_odd_rows_and_long_texts(spark):
    rows = [(i, t, "r", 1) for i, t, _ in ODD] + [(50, "w " * 400_000, None, None), (51, " ".join(str(i * i % 1009) for i in range(60_000)), "r", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").repartition(3)
    got = {}
    for r in runs.periodic_runs(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert all(got[i][0].runs == [] and got[i][0].collapsed == "" and got[i][0].n_words == 0 for i in (1, 2, 3))
    assert got[4][0] == got[4][1]
    assert [tuple(r) for r in got[9][0].runs] == [(0, 30_000, 1)] and got[9][0].collapsed == "word"
    assert [tuple(r) for r in got[50][0].runs] == [(0, 400_000, 1)]
    assert [tuple(r) for r in got[51][0].runs] == [(0, 60_000, 1009)]
    assert runs.periodic_runs(docs.where("1 = 0")).count() == 0
    kept = {r.doc_id: r.text for r in runs.planted(docs).collect()}
    assert kept[None] == "no id here at all" and kept[1] is None


def test_refuses_limits_the_check_points_cannot_see(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, min_length=10)
