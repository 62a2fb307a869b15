"""The queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import byte_bpe, exact_dedup, language_id, ngram_jaccard, packing, quality_mil, quality_rules, secret_scan, substring_dedup, toxicity


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_docs(spark, sf), public_tokenizers.path("word_bpe_49k.json"))


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(_docs(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return byte_bpe.round_trip(_docs(spark, sf), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.language_id(_docs(spark, sf))


def op5_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_docs(spark, sf))


def op6_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.quality_verdicts(_docs(spark, sf))


def op7_quality_mil(spark: SparkSession, sf: str) -> DataFrame:
    return quality_mil.quality(_docs(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


def op8_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan(_docs(spark, sf), secret_scan.train(spark))


def op9_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(_docs(spark, sf)).select("doc_id", "n_shingles", "component_id")


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.substring_dedup(_docs(spark, sf))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_language_id": op4_language_id,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_mil": op7_quality_mil,
    "op8_secret_scan": op8_secret_scan,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_substring_dedup": op10_substring_dedup,
}

_OP5 = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS k FROM documents),
r AS (
  SELECT doc_id, k, first_value(doc_id) OVER (PARTITION BY k ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY k) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(k) AS text_sha256 FROM r
"""

_OP6 = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS win FROM w, unnest(range(1, greatest(len(ws) - 6, 1))) AS u(i)),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM g),
p AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n FROM d WHERE c > 1),
r AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_excl,
         len(list_filter(ws, lambda x, i: i > 1 AND x = ws[i - 1])) AS n_stut
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
v AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_excl > 3 * n_words OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
            OR word_chars > 15 * n_words OR word_chars < 2 * n_words OR 10 * n_stut > 3 * n_words) AS kept
FROM v
"""

ORACLES = {
    "op5_exact_dedup": _OP5,
    "op6_quality_rules": _OP6,
}
