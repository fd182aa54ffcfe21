"""Registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from queuelake.llm.bpe import bpe_documents
from queuelake.llm.chat import rotate_perspectives
from queuelake.llm.decontamination import contamination_digest, find_contamination
from queuelake.llm.fingerprints import fingerprint_documents
from queuelake.llm.frames import table
from queuelake.llm.html_density import extract_pages
from queuelake.llm.licences import scan_licences
from queuelake.llm.near_dedup import near_duplicates
from queuelake.llm.oracles import DECONTAMINATION, REPAIR, VARIANTS
from queuelake.llm.packing import pack_documents
from queuelake.llm.quality import quality_decisions
from queuelake.llm.repair import repair_damaged
from queuelake.llm.sharding import regular_tree, shard_documents
from queuelake.llm.toxicity import toxicity_scores
from queuelake.llm.variants import spelling_variants

SHARDS = 24


def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), regular_tree(SHARDS))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(table(spark, sf_dir, "conversations"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_decisions(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licence_scan": op1_licence_scan,
    "op2_sharding": op2_sharding,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_bpe": op4_bpe,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_fingerprints": op6_fingerprints,
    "op7_near_dedup": op7_near_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_decontamination": op11_decontamination,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op11_decontamination": DECONTAMINATION,
    "op12_spelling_variants": VARIANTS,
    "op13_conversation_repair": REPAIR,
    "op3_chat_formatting": """
WITH t AS (
  SELECT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS role, coalesce(text, '') AS text,
         coalesce(CAST(floor(turn / 64.0) AS BIGINT), -4611686018427387904) AS tb
  FROM conversations),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, tb ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM t),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE coalesce(role, '') NOT IN ('', 'system')),
g AS (
  SELECT p.conv_id, s.speaker, p.tb, p.place // 64 AS rb, p.place, p.role = s.speaker AS mine,
         CASE WHEN p.role = s.speaker THEN '<|assistant|>' WHEN p.role = 'system' THEN '<|system|>'
              ELSE '<|user name=' || p.role || '|>' END || chr(10) AS head,
         p.text || '<|end|>' || chr(10) AS body
  FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, tb, rb ORDER BY place) AS upto FROM g),
b AS (
  SELECT conv_id, speaker, tb, rb, count(*) AS n_turns, string_agg(head || body, '' ORDER BY place) AS rendered,
         max(upto) AS size,
         coalesce(string_agg(CASE WHEN mine THEN (upto - length(body)) || '-' || upto END, ',' ORDER BY place), '') AS mask_spans,
         sum(CASE WHEN mine THEN length(body) ELSE 0 END) AS n_masked
  FROM o GROUP BY ALL)
SELECT conv_id, speaker, row_number() OVER w - 1 AS block,
       CAST(coalesce(sum(size) OVER (PARTITION BY conv_id, speaker ORDER BY tb, rb ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_char,
       n_turns, rendered, mask_spans, CAST(n_masked AS BIGINT) AS n_masked
FROM b WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY tb, rb)
""",
    "op10_quality_rules": r"""
WITH w AS (
  SELECT doc_id, lang, source, row_number() OVER () AS row_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
win AS (
  SELECT row_id, i, array_to_string(words[i:i + 4], ' ') AS gram
  FROM w, unnest(range(1, len(words) - 3)) AS t(i)),
hit AS (
  SELECT row_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT row_id, i FROM win QUALIFY count(*) OVER (PARTITION BY row_id, gram) > 1) h, unnest(range(i, i + 5)) AS t(p)
  GROUP BY row_id),
c AS (
  SELECT w.row_id, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN hit USING (row_id)),
d AS (
  SELECT * EXCLUDE (lines), CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         [{'m': 's', 'v': 1000 * n_symbols // greatest(word_chars, 1), 'least': 10},
          {'m': 'd', 'v': 1000 * (len(lines) - len(list_distinct(lines))) // greatest(len(lines), 1), 'least': 50},
          {'m': 'l', 'v': 100 * word_chars // greatest(n_words, 1), 'least': 8}] AS ms
  FROM c),
v AS (SELECT row_id, lang, source, base_failed, u.m.m AS m, u.m.v AS v, u.m.least AS least FROM d, unnest(ms) AS u(m)),
k AS (
  SELECT *, CAST((v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS BIGINT) AS b FROM v),
n AS (SELECT * FROM k WHERE NOT base_failed),
q AS (
  SELECT 2 AS lvl, lang, source, m, count(*) AS t, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM n GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, m, count(*), quantile_disc(b, 0.25), quantile_disc(b, 0.75) FROM n GROUP BY lang, m
  UNION ALL SELECT 0, NULL, NULL, m, count(*), quantile_disc(b, 0.25), quantile_disc(b, 0.75) FROM n GROUP BY m),
f AS (
  SELECT k.row_id, bool_and(coalesce(v BETWEEN q1 - 4 * greatest(q3 - q1, least) AND q3 + 4 * greatest(q3 - q1, least), true)) AS inside
  FROM (SELECT k.*, CASE WHEN a.t >= 100 THEN a.q1 WHEN l.t >= 100 THEN l.q1 ELSE e.q1 END AS q1,
                    CASE WHEN a.t >= 100 THEN a.q3 WHEN l.t >= 100 THEN l.q3 ELSE e.q3 END AS q3
        FROM k LEFT JOIN q a ON a.lvl = 2 AND a.m = k.m AND a.lang IS NOT DISTINCT FROM k.lang AND a.source IS NOT DISTINCT FROM k.source
               LEFT JOIN q l ON l.lvl = 1 AND l.m = k.m AND l.lang IS NOT DISTINCT FROM k.lang
               LEFT JOIN q e ON e.lvl = 0 AND e.m = k.m) k
  GROUP BY k.row_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND inside AS kept
FROM d JOIN f USING (row_id)
""",
}
