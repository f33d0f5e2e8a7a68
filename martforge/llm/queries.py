"""Registered queries: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.llm import (
    ann_tree,
    licenses,
    line_dedup,
    merkle,
    mixing,
    packing,
    phrases,
    quality_gbt,
    quality_rules,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
)
from martforge.llm.common import crc_mod, read_table
from martforge.llm.oracles import PHRASES_SQL, manifest_sql

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 0
    index = toxicity.fit(docs.filter(~held), read_table(spark, sf_dir, "labels"), corpus=docs)
    return toxicity.score(docs, index).select("doc_id", held.alias("held_out"), "score", "predicted", "evidence")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = read_table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 4) == 2
    forest = quality_gbt.fit(docs.filter(~held), read_table(spark, sf_dir, "labels"))
    return quality_gbt.score(docs, forest, threshold=0.7).select("doc_id", held.alias("held_out"), "score", "predicted")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_matches", F.array_join("licenses", ",").alias("licenses"), "best_license", F.round("best_dice", 9).alias("best_dice")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_equal", "n_near", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents")).drop("lang")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"), top=2000, least=30)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.fit(pages, url_filter.RULES)).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_quality, op3_packing, op4_mixing, op5_licenses,
        op6_suffix_dedup, op7_quality_rules, op8_simhash, op9_ann, op10_line_dedup,
        op11_merkle, op12_phrases, op13_url_filter,
    )
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licenses_sql(threshold: float = 0.8) -> str:
    """DuckDB SQL of the license scan: every line and whole text against every template."""
    known = {k: licenses.template_bigrams(v) for k, v in licenses.TEMPLATES.items()}
    values = ", ".join(f"({_quoted(k)}, [{', '.join(map(_quoted, b))}])" for k, b in known.items())
    return rf"""
    WITH templates(license, t) AS (VALUES {values}),
    docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, coalesce(text, '') AS text FROM documents),
    units AS (
      SELECT doc_id, unnest(CASE WHEN len(ls) > 1 THEN list_append(ls, text) ELSE ls END) AS u,
             unnest(range(CASE WHEN len(ls) > 1 THEN len(ls) + 1 ELSE len(ls) END)) AS line FROM docs),
    words AS (SELECT doc_id, line, string_split(trim(regexp_replace(lower(u), '[^\p{{L}}\p{{Nd}}]+', ' ', 'g')), ' ') AS w FROM units),
    grams AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM words WHERE len(w) > 1),
    scored AS (
      SELECT doc_id, line, license, 2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice FROM grams, templates
      WHERE len(b) BETWEEN len(t) / 3.0 AND len(t) * 3.0),
    best AS (
      SELECT * FROM scored WHERE dice >= {threshold}
      QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY dice DESC, license) = 1),
    per_doc AS (
      SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS ls,
             first(license ORDER BY dice DESC, license) AS l, max(dice) AS d
      FROM best GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(ls, '') AS licenses, l AS best_license, round(p.d, 9) AS best_dice
    FROM documents d LEFT JOIN per_doc p ON d.doc_id = p.doc_id
    """.replace("coalesce(ls, '')", "coalesce(p.ls, '')")


QUALITY_RULES_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM base),
grams AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM words)),
twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cover AS (
  SELECT doc_id, sum(least(8, gap)) AS n FROM (
    SELECT doc_id, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8) AS gap FROM twice)
  GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, text, len(w) AS n_words, length(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM words w LEFT JOIN cover c ON w.doc_id = c.doc_id),
judged AS (
  SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM counts)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars BETWEEN n_words * 2 AND n_words * 14
       AND n_symbols * 10 <= n_words
       AND n_dup_lines * 100 <= n_lines * 50
       AND (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) * 100 <= word_chars * 40
       AND (length(text) - length(replace(text, '!', ''))) * 10 <= n_words
       AND (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) * 100 <= word_chars * 50
       AND len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(\.\.\.|…)[ \t\r]*$'))) * 100 <= n_lines * 30
       AND len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[ \t]*[-*•]'))) * 100 <= n_lines * 90
       AS kept
FROM judged
"""

ORACLE_SQL = {"op5_licenses": licenses_sql(), "op7_quality_rules": QUALITY_RULES_SQL, "op11_merkle": manifest_sql(), "op12_phrases": PHRASES_SQL}
