"""Registered queries of the training-data operators: one per operator, over its whole table.

``ORACLE`` holds DuckDB SQL where SQL can express the result; the other
queries are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clinicflow.llm import (
    bounded_codes,
    dart_minhash,
    html_wrappers,
    learned_partitions,
    line_dedup,
    packing,
    ppm_language,
    quality_classifier,
    quality_rules,
    secret_models,
    sentencepiece_bpe,
    sql,
    va_file,
    warc,
)
from clinicflow.llm.common import table


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sentencepiece_bpe.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(table(spark, sf_dir, "embeddings"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_language.identify(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(cut)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_duplicate_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract_pages(table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_secret_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_models.digest(secret_models.find_secrets(table(spark, sf_dir, "documents")))


def op12_bounded_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded_codes.encode(table(spark, sf_dir, "embeddings"))


def op13_va_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_file.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_learned_partitions": op2_learned_partitions,
    "op3_quality_rules": op3_quality_rules,
    "op4_language": op4_language,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_html_extraction": op9_html_extraction,
    "op10_warc": op10_warc,
    "op11_secret_models": op11_secret_models,
    "op12_bounded_codes": op12_bounded_codes,
    "op13_va_file": op13_va_file,
}

ORACLE: dict[str, str] = {
    "op3_quality_rules": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
        ), w AS (
            SELECT k, unnest(x) AS word, unnest(range(1, len(x) + 1)) AS i
            FROM (SELECT k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS x FROM d)
        ), win AS (
            SELECT k, i, list(word) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS g
            FROM w
        ), twice AS (
            SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM win WHERE len(g) = 8) WHERE n > 1
        ), cov AS (
            SELECT k, sum(least(8, i - coalesce(p, -8))) AS n_repeat_words
            FROM (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS p FROM twice) GROUP BY k
        ), nw AS (
            SELECT k, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY k
        ), l AS (
            SELECT k, unnest(string_split(t, chr(10))) AS line FROM d
        ), lm AS (
            SELECT k, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS lw,
                   coalesce(list_sum(list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: length(x))), 0) AS lc,
                   len(regexp_extract_all(line, '[#*$%&|<>!~^]')) AS marks,
                   len(regexp_extract_all(line, '[ \t][|»›•·>][ \t]')) AS seps,
                   regexp_matches(line, '(?i)(cookie policy|we use cookies|privacy policy|terms of (use|service)|all rights reserved|enable javascript|javascript is disabled|lorem ipsum|subscribe to our newsletter|sign in to continue|log in to continue|skip to (main )?content|back to top)') AS boiler
            FROM l
        ), ls AS (
            SELECT k, count(*) FILTER (lw > 0) - count(DISTINCT line) FILTER (lw > 0) AS n_dup_lines,
                   sum(CASE WHEN marks * 100 > lw * 30 OR seps >= 3 OR (boiler AND lw <= 30) THEN lc ELSE 0 END) AS lost
            FROM lm GROUP BY k
        ), m AS (
            SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
            FROM d LEFT JOIN nw USING (k) LEFT JOIN ls USING (k) LEFT JOIN cov USING (k)
        )
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
               CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost * 100 <= word_chars * 30 AS kept
        FROM m
    """,
    "op10_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p
        ), o AS (
            SELECT digest, max(page_id) AS origin FROM d WHERE n >= 1000 GROUP BY digest
        )
        SELECT d.page_id, CAST(d.n AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
               CASE WHEN o.origin <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN o.origin <> d.page_id THEN o.origin END AS refers_to
        FROM d LEFT JOIN o ON o.digest = d.digest AND d.n >= 1000
    """,
    "op11_secret_models": sql.SECRETS,
    "op12_bounded_codes": sql.CODES,
    "op13_va_file": sql.CENTROIDS,
}
