"""Removal of long repeats against a lookup of every window among all earlier ones; the run-length index against plain search."""

import hashlib
import pathlib
import sys

import numpy as np
import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import plain  # noqa: E402
from test_operators import ODD, SMALL  # noqa: E402

from riskloom.llm import longmatches, runindex  # noqa: E402
from riskloom.llm.base import REGISTRY  # noqa: E402


def as_plain(rows):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows), key=lambda r: (r[0] is None, r[0]))


def test_query_matches_plain(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    wanted = [(i, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in plain.without_repeats(docs, 100)]
    got = [tuple(r) for r in REGISTRY["op13_repeat_removal"][0](spark, SMALL).collect()]
    assert sorted(got) == wanted
    assert sum(1 for w in wanted if w[2]) > 10


def repetitive(seed, n):
    """Texts made of passages that recur whole, in part, within one text and with changed bytes."""
    rng = np.random.default_rng(seed)
    letters = list("abcdefgh éß€ ")
    passages = ["".join(rng.choice(letters, rng.integers(20, 200))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.integers(1, 7)):
            p = passages[rng.integers(12)]
            kind = rng.integers(5)
            if kind == 0:
                p = p[rng.integers(len(p)) :]
            elif kind == 1:
                k = rng.integers(len(p))
                p = p[:k] + "x" + p[k + 1 :]
            elif kind == 2:
                p = p[:9] * int(rng.integers(2, 30))
            text += p + "".join(rng.choice(letters, rng.integers(0, 30)))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed, window, hot, chunk", [(1, 40, 10**6, 1 << 20), (2, 40, 10**6, 700), (3, 100, 10**6, 2000), (4, 60, 3, 1 << 20), (5, 32, 12, 1500)])
def test_all_repeats_go(spark, seed, window, hot, chunk, monkeypatch):
    monkeypatch.setattr(longmatches, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(longmatches, "MOST_WINDOWS", 64)
    rows = repetitive(seed, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert as_plain(longmatches.remove_repeats(docs, window=window, hot=hot).collect()) == plain.without_repeats(rows, window)


def test_bucket_streams_later_chunks(monkeypatch):
    monkeypatch.setattr(longmatches, "CHUNK_BYTES", 900)
    rows = repetitive(9, 120)
    bucket, marks = longmatches.Bucket(50), {}
    for i, text in rows:
        raw = text.encode()
        if len(raw) >= 50:
            for k, a, b in bucket.add(i, 0, raw):
                marks.setdefault(k, set()).update(range(a, b))
    assert len(bucket.indexes) > 5 and all(x.sa is None for x in bucket.indexes)
    for k, a, b in bucket.flush():
        marks.setdefault(k, set()).update(range(a, b))
    for i, _, spans, _ in plain.without_repeats(rows, 50):
        covered = {x for s in marks.get(i, ()) for x in range(s, s + 50)}
        assert covered == {x for a, b in spans for x in range(a, b)}


@pytest.mark.parametrize("kinds", [1, 2, 4])
def test_index_against_plain_search(kinds):
    rng = np.random.default_rng(kinds)
    for _ in range(60):
        cap = int(rng.integers(3, 12))
        pieces = [rng.integers(1, 1 + kinds, rng.integers(1, 40)).astype(np.uint8) for _ in range(rng.integers(1, 8))]
        text = np.concatenate([np.concatenate((p, [0])) for p in pieces]).astype(np.uint8)
        raw, index = text.tobytes(), runindex.RunIndex(text, cap)
        assert [raw[i:] for i in index.sa] == sorted(raw[i:] for i in range(len(raw)))
        windows = [raw[i : i + cap] for i in range(len(raw))]
        whole = [len(w) == cap and 0 not in w for w in windows]
        assert index.repeats().tolist() == [whole[i] and windows[i] in windows[:i] for i in range(len(raw))]
        patterns = [rng.integers(1, 2 + kinds, rng.integers(1, 40)).astype(np.uint8) for _ in range(rng.integers(1, 8))]
        letters, ends = np.concatenate(patterns), np.cumsum([len(p) for p in patterns])
        starts = ends - [len(p) for p in patterns]
        index.release()
        got = index.matching_statistics(letters, starts, ends)
        for a, z in zip(starts, ends):
            for i in range(a, z):
                m = 0
                while m < cap and i + m < z and letters[i : i + m + 1].tobytes() in raw:
                    m += 1
                assert got[i] == m


def test_index_is_short_for_a_repetitive_text():
    piece = np.random.default_rng(0).integers(1, 200, 300).astype(np.uint8)
    text = np.concatenate([np.concatenate((piece, [0]))] * 200).astype(np.uint8)
    assert len(runindex.RunIndex(text, 100).row) < 2 * len(piece) < len(text) / 90


def test_odd_rows(spark):
    again = "the same long line of words that stands in two documents of this table and goes from the second one, byte for byte"
    rows = [(i, t, b"k", 1) for i, t, _ in ODD] + [(70, again, None, 1), (71, "before " + again + " after", None, 1), (71, "before " + again + " after", None, 1), (None, again + "!", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key binary, n_bytes int").repartition(4)
    got = longmatches.remove_repeats(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)))
    assert all(by_id[i][0] == (len((t or "").encode()), [], (t or "").encode()) for i, t, _ in ODD if i in (1, 2, 3, 6, 7, 8))
    assert by_id[9] == [(150_000, [(5, 150_000)], b"word ")] and by_id[10] == [(20_000, [(1, 20_000)], b"x")]
    assert by_id[70] == [(len(again), [], again.encode())]
    assert by_id[71] == [(len(again) + 13, [(7, 7 + len(again))], b"before  after")] * 2
    assert sorted(k for _, _, k in by_id[None]) == [b"!", b"no id here at all"]
    assert longmatches.remove_repeats(docs.where("1 = 0")).count() == 0
