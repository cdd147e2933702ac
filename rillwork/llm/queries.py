"""Registered queries of this subpackage, with DuckDB equivalents where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillwork.llm import (chunks, credentials, extract, language, lines, mixing, multiindex, quality, ranked,
                          resampling, sentencepieces, simhash, winnowing)
from rillwork.llm.common import WORD, prepared, read


#: A term of ranked search, and the letters that it lower-cases.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def model_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    names = ("n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_lines "
             "n_failed_lines line_chars kept_chars").split()
    return quality.assess(docs).select("doc_id", *[f"quality.{n}" for n in names])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents")
    return chunks.repeated_spans(docs).select("doc_id", "start", "end", "n_chunks", "n_dropped",
                                              "first_doc")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs, to="found")
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"),
                        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
                        F.col("found.entropy").alias("cross_entropy"),
                        F.col("found.rejected").alias("rejected"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    found = credentials.scan(docs).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["kind"] != credentials.FORMAT)
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
              for kind in credentials.KINDS]
    return found.select("doc_id", *counts, F.sha2(credentials.span_text(base), 256).alias("base_sha256"),
                        credentials.span_text(F.col("spans")).alias("spans"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped",
                                          F.sha2("kept", 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def token_digests(df: DataFrame) -> list:
    return [F.size("ids").cast("bigint").alias("n_tokens"),
            F.sha2(sentencepieces.ids_text(F.col("ids")), 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents").select("doc_id", "text")
    ids = sentencepieces.encode_documents(docs, model_path()).select("doc_id", "ids")
    both = sentencepieces.decode_documents(ids, model_path())
    return both.select("doc_id", *token_digests(both))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(prepared(spark), sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.plan(docs).select("doc_id", "source", "size", "source_size", "target",
                                    (F.col("size") * F.col("times")).alias("taken"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(prepared(spark), sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages).select("page_id", "url", "text",
                                         F.length("text").cast("bigint").alias("n_chars"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.neighbours(read(prepared(spark), sf_dir, "embeddings"), every=100)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    return ranked.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_edited(read(prepared(spark), sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    found = resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_substring_dedup, op3_language_id, op4_secret_scan, op5_line_dedup,
    op6_simhash, op7_sentencepiece, op8_mixing, op9_html_extraction, op10_ann, op11_ranked_search,
    op12_fingerprints, op13_importance_resampling)}

ORACLE: dict[str, str] = {
    "op1_quality_rules": f"""
WITH words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows)
  WHERE n >= 2),
repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, regexp_extract_all(line, '{WORD}') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '{WORD}')),
judged AS (
  SELECT doc_id, line,
         NOT regexp_matches(line, '{quality.SENTENCE_END.replace("'", "''")}')
         OR (seps >= 3 AND seps * 5 >= len(w))
         OR len([x FOR x IN w IF regexp_matches(x, '[{quality.SYMBOLS}]')]) * 10 >= len(w) * 3
         OR length(regexp_replace(line, '\\P{{Lu}}+', '', 'g')) * 5 > length(line) * 2
         OR regexp_matches(line, '{quality.BOILERPLATE}') AS fails
  FROM (SELECT *, len([x FOR x IN w IF length(x) = 1 AND contains('{quality.SEPARATORS}', x)]) AS seps
        FROM lines)),
per_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (WHERE fails) AS n_failed_lines, sum(length(line))::BIGINT AS line_chars,
         coalesce(sum(length(line)) FILTER (WHERE NOT fails), 0)::BIGINT AS kept_chars
  FROM judged GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^{quality.SYMBOLS}]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN repeated USING (doc_id)),
joined AS (
  SELECT b.*, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_failed_lines, 0)::BIGINT AS n_failed_lines,
         coalesce(line_chars, 0)::BIGINT AS line_chars, coalesce(kept_chars, 0)::BIGINT AS kept_chars,
         n_words < {quality.LEAST_WORDS} OR n_repeat_words * 100 > n_words * {quality.MOST_REPEATED}
           AS base_failed
  FROM base b LEFT JOIN per_doc USING (doc_id))
SELECT *, NOT base_failed AND kept_chars * 100 >= line_chars * {quality.LEAST_KEPT} AS kept
FROM joined""",
    "op5_line_dedup": """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(regexp_replace(line, '^[\\x20\\x09-\\x0D]+', ''),
                                  '[\\x20\\x09-\\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
frequent AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.doc_id, k.line, k.pos, f.last_doc IS NOT NULL AND f.last_doc <> k.doc_id AS gone
  FROM keyed k LEFT JOIN frequent f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op11_ranked_search": f"""
WITH terms AS (
  SELECT row, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
sizes AS (SELECT row, count(*) AS n FROM terms GROUP BY row),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes),
postings AS (
  SELECT row, doc_id, term, count(*) AS tf, n
  FROM terms JOIN sizes USING (row) GROUP BY row, doc_id, term, n),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, total GROUP BY term),
asked AS (
  SELECT item_id,
         unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), total
  GROUP BY item_id, row, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
       doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10""",
}
