"""Stages of the corpus pipeline, one by one and together."""

import pathlib
import sys

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

import plain  # noqa: E402
from test_operators import ODD, SMALL, check_packing  # noqa: E402

import corpus_pipeline  # noqa: E402
from riskloom.llm import repetition  # noqa: E402


def kept_by_rules(text: str) -> bool:
    raw = (text or "").encode()
    n, repeat, _, grams, lines = repetition.measure(raw, tuple(repetition.GRAM_LIMITS))
    chars = int(repetition.LETTERS[np.frombuffer(raw, np.uint8)].sum())
    fine = all(100 * g <= limit * chars for g, limit in zip(grams, repetition.GRAM_LIMITS.values())) and 100 * lines <= repetition.LINE_LIMIT * chars
    return n >= 50 and 100 * repeat <= 50 * n and fine


def test_run_agrees_with_a_plain_pass(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect())
    docs = [d for d in docs if any(c.isalpha() for c in d.text) and kept_by_rules(d.text)]
    roots = plain.components([plain.simhash(d.text) for d in docs], 4)
    stay = {docs[r].doc_id: docs[r].text for r in set(roots)}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(stay)
    check_packing(rows, stay)


def test_stages_keep_columns_and_bear_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(i, t, l, "s", 1, "x") for i, t, l in ODD] + [(20, long, "en", "s", 1, "x")] * 2 + [(21, long, "en", "s", 1, "x"), (None, long + " more", "en", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component string")
    empty = docs.where("1 = 0")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.schema == docs.schema or out.columns == docs.columns, name
        assert stage(spark, empty, SMALL).count() == 0
        docs = spark.createDataFrame(out.collect(), docs.schema)
    assert [(r.doc_id, r.text) for r in docs.collect()] == [(20, long)]
    assert corpus_pipeline.packing_stage(spark, empty, SMALL).count() == 0
    assert corpus_pipeline.packing_stage(spark, docs, SMALL).agg(F.sum("length")).first()[0] > 80
