"""The numbered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bytebpe, language, licences, longmatches, packing, quality, repetition, runs, simhash, topk, urls, variants, warc
from riskloom.llm.base import query, table

URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def remainder(id: str, of: int) -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % of


@query("""
WITH p AS (SELECT page_id, url, COALESCE(html, '') AS body FROM pages),
d AS (SELECT page_id, url, STRLEN(body) AS payload_bytes, SHA1(body) AS h FROM p),
e AS (SELECT *, MIN(page_id) OVER (PARTITION BY h) AS origin,
             ROW_NUMBER() OVER (PARTITION BY page_id, h ORDER BY url) AS place FROM d)
SELECT page_id, payload_bytes,
       ARRAY_TO_STRING([SUBSTR('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST((CAST('0x' || SUBSTR(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)
         FOR i IN RANGE(32)], '') AS payload_digest,
       CASE WHEN page_id = origin AND place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = origin AND place = 1 THEN NULL ELSE origin END AS refers_to
FROM e""")
def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("binary").alias("payload"))
    resolved = warc.archive_and_resolve(pages)
    return resolved.select(F.col("number").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("""
WITH v AS (
  SELECT vec_id, LIST_TRANSFORM(embedding, lambda x: CAST(FLOOR(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0),
q AS (SELECT vec_id, MIN(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(LIST_INNER_PRODUCT(q.e, v.e) AS BIGINT) AS score FROM q JOIN v ON q.vec_id <> v.vec_id),
r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""")
def op2_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query()
def op3_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    held = remainder("doc_id", 5) == 0
    scored = quality.score(docs, quality.fit(docs, labels, ~held))
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", "predicted")


@query()
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bytebpe.digests(docs, vocabulary, pattern)


@query()
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_language_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    predicted = language.predict(docs.select("doc_id", "text"), language.fit(docs, ~held), returned=("doc_id",))
    return predicted.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query()
def op7_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = simhash.simhash_components(docs)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


WORDS = r"[^\x20\x09-\x0D]+"
GRAMS = ", ".join(f"MAX(CASE WHEN n = {n} THEN chars ELSE 0 END) AS c{n}" for n in repetition.GRAM_LIMITS)
WITHIN = " AND ".join(f"100 * COALESCE(c{n}, 0) <= {limit} * word_chars" for n, limit in repetition.GRAM_LIMITS.items())
# one row per text, word and window, so that the covered words and characters can be counted
REPEATS_SQL = rf"""
WITH t AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, COALESCE(text, '') AS text FROM documents),
a AS (SELECT r, doc_id, text, REGEXP_EXTRACT_ALL(text, '{WORDS}') AS ws,
             LIST_FILTER(STRING_SPLIT(text, CHR(10)), lambda x: REGEXP_MATCHES(x, '{WORDS}')) AS ls FROM t),
w AS (SELECT r, UNNEST(ws) AS word, GENERATE_SUBSCRIPTS(ws, 1) AS i FROM a),
g AS (SELECT r, n, i, ARRAY_TO_STRING(ws[i:i + n - 1], ' ') AS gram
      FROM (SELECT a.r, a.ws, k.n, UNNEST(RANGE(1, LEN(a.ws) - k.n + 2)) AS i FROM a, (VALUES (3), {', '.join(f'({n})' for n in repetition.GRAM_LIMITS)}) k(n))),
c AS (SELECT r, n, i, COUNT(*) OVER (PARTITION BY r, n, gram) AS times, ROW_NUMBER() OVER (PARTITION BY r, n, gram ORDER BY i) AS nth FROM g),
p AS (SELECT DISTINCT r, n, UNNEST(RANGE(i, i + n)) AS i FROM c WHERE times > 1 AND (n = 3 OR nth > 1)),
m AS (SELECT r, n, COUNT(*) AS words, SUM(LENGTH(word)) AS chars FROM p JOIN w USING (r, i) GROUP BY r, n),
v AS (SELECT r, MAX(CASE WHEN n = 3 THEN words ELSE 0 END) AS n_repeat_words,
             {GRAMS} FROM m GROUP BY r),
l AS (SELECT r, SUM(LENGTH(REGEXP_REPLACE(line, '[\x20\x09-\x0D]+', '', 'g'))) AS line_chars FROM (
        SELECT r, line, ROW_NUMBER() OVER (PARTITION BY r, line) AS nth FROM (SELECT r, UNNEST(ls) AS line FROM a)) WHERE nth > 1 GROUP BY r),
f AS (SELECT doc_id, LEN(ws) AS n_words, CAST(LENGTH(ARRAY_TO_STRING(ws, '')) AS BIGINT) AS word_chars,
             CAST(LENGTH(REGEXP_REPLACE(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             LEN(ls) - LEN(LIST_DISTINCT(ls)) AS n_dup_lines, COALESCE(v.n_repeat_words, 0) AS n_repeat_words,
             COALESCE(line_chars, 0) AS line_chars, v.* EXCLUDE (r, n_repeat_words)
      FROM a LEFT JOIN v USING (r) LEFT JOIN l USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {WITHIN} AND 100 * line_chars <= {repetition.LINE_LIMIT} * word_chars AS kept FROM b"""


@query(REPEATS_SQL)
def op8_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = repetition.rate(table(spark, sf_dir, "documents").select("doc_id", "text"), returned=("doc_id",))
    return rated.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op9_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _canonical_sql(text: str) -> str:
    t = f"LOWER(COALESCE({text}, ''))"
    for mark in (licences.COPYRIGHT, licences.RESERVED):
        t = f"REGEXP_REPLACE({t}, '{mark}', '\\1', 'g')"
    t = f"TRIM(REGEXP_REPLACE({t}, '{licences.MARKS}', ' ', 'g'))"
    for one, other in licences.SPELLINGS:
        t = f"REPLACE({t}, '{one}', '{other}')"
    return t


def _values(rows: dict[str, str]) -> str:
    return ", ".join("('{}', '{}')".format(k.replace("'", "''"), v.replace("'", "''")) for k, v in rows.items())


LICENCE_SQL = f"""
WITH l AS (SELECT SHA256({_canonical_sql("text")}) AS digest, MIN(license_id) AS license_id
           FROM (VALUES {_values(licences.LICENCES)}) k(license_id, text) GROUP BY 1),
n AS (SELECT SHA256({_canonical_sql("text")}) AS digest, license_id FROM (VALUES {_values(licences.NOTICES)}) k(text, license_id)),
d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, COALESCE(text, '') AS text, SHA256({_canonical_sql("text")}) AS text_digest FROM documents),
s AS (SELECT r, UNNEST(STRING_SPLIT(text, CHR(10))) AS line FROM d),
h AS (SELECT r, STRING_AGG(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids
      FROM (SELECT r, SHA256({_canonical_sql("line")}) AS digest FROM s WHERE REGEXP_MATCHES(LOWER(line), 'licen[cs]e')) JOIN n USING (digest) GROUP BY r)
SELECT doc_id, text_digest, license_id, COALESCE(notice_ids, '') AS notice_ids
FROM d LEFT JOIN l ON d.text_digest = l.digest LEFT JOIN h USING (r)"""


@query(LICENCE_SQL)
def op10_license_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), licences.known_licences(spark))


@query()
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), typos=True)
    return variants.spelling_forms(words).select("word", "form", "root", "n", "n_near", "form_n")


@query()
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = """aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (b, r) ->
      IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"""  # runs come by start, then period, so ties keep the first
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    told = runs.periodic_runs(docs).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr(best).alias("b"), F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return told.select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period", F.expr("b.length * 1000 div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


@query()
def op13_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = longmatches.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed")
    return cleaned.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
