"""Corpus pipeline: language, repetition rules, near duplicates, packing. Each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm import language, packing, repetition, simhash
from riskloom.plans.materialize import materialize

ORACLE_SQL = None  # trees, fingerprints and token ids are beyond SQL; tests hold run() against a plain version


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or without a letter (`und`) go.

    The trees are learned from the stage's own labelled documents; a table without a language label keeps nothing.
    """
    trees = language.fit(docs, F.lit(True))
    told = language.predict(docs, trees, prefix="_ppm_")
    return told.where("_ppm_lang_pred != 'und'").select(*docs.columns)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.rate(docs, prefix="_rules_").where("_rules_kept").select(*docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id (null ids last, then by text hash).

    Near copies are linked as in `op7`: fingerprints of four-word shingles that differ in at most four bits, directly or over others.
    Exact repetitions of a row, and rows that share id and text, are one document and leave one row.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key")
    marked = docs.withColumns({"_key": key, "_hash": F.xxhash64("text")})
    rows = simhash.simhash_components(marked, radius=4, shingle=4, keep=("_key", "_hash"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "_key", "_hash")).alias("first")
    chosen = rows.groupBy("component").agg(first).select("first._key", "first._hash")
    met = marked.join(chosen, ["_key", "_hash"])
    copy = F.row_number().over(Window.partitionBy("_key", "_hash").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    return met.withColumn("_copy", copy).where("_copy = 1").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language_stage),
    ("repetition rules", rules_stage),
    ("near duplicates", near_duplicates_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, "stage")
    return docs
