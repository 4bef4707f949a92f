"""Registered queries of the training-data operators over the driver's tables.

SQL is given where it can express the whole result on whole tables; the other queries
are tested against brute force, round trips or held-out labels in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tamarind.llm import bpe, conversations, decontaminate, licenses, near_dedup, packing, page_text, quality_rules, resampling, sharding, site_quality, token_counts, toxicity
from tamarind.llm.common import table


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.measured(table(spark, folder, "documents"))


def op2_site_templates(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extracted(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents"))


def op4_weak_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_jump_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.sharded(table(spark, folder, "documents"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op7_greedy_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("text_hash")


def op8_bbit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.linked(table(spark, folder, "documents"), percent=85)


def op9_hierarchical_bayes(spark: SparkSession, folder: str) -> DataFrame:
    return site_quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counted(table(spark, folder, "documents"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"))


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations.conversation_rows(table(spark, folder, "conversations"))
    return conversations.report(conversations.damaged(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_site_templates,
        op3_license_scan,
        op4_weak_toxicity,
        op5_jump_shards,
        op6_best_fit_packing,
        op7_greedy_string_tiling,
        op8_bbit_minhash,
        op9_hierarchical_bayes,
        op10_token_counts,
        op11_byte_bpe,
        op12_importance_resampling,
        op13_conversation_repair,
    )
}
# CRC-32 of each distinct text: a table of what a byte does, then one fold over the bytes.
CRC_SQL = r"""crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1
                  THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
)"""
CRC_OF_HEX = r"""xor(4294967295, list_reduce(list_concat([4294967295],
         list_transform(range(1, length(h), 2), lambda j: ('0x' || substr(h, j, 2))::BIGINT)),
         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""

RESAMPLING_SQL = rf"""
WITH {CRC_SQL},
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
words AS (
  SELECT r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT r, text FROM docs UNION ALL SELECT NULL, text FROM benchmark)
),
counted AS (SELECT r, w, count(*) AS n FROM words GROUP BY r, w),
hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)),
bucketed AS (
  SELECT w, {CRC_OF_HEX} % 10000 AS bucket
  FROM hexed, crc
),
shares AS (
  SELECT bucket, coalesce(sum(n) FILTER (r IS NOT NULL), 0) AS s, coalesce(sum(n) FILTER (r IS NULL), 0) AS t
  FROM counted JOIN bucketed USING (w) GROUP BY bucket
),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM shares),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE)
         / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
  FROM shares, totals
),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
  FROM counted JOIN bucketed USING (w) JOIN gains USING (bucket) WHERE r IS NOT NULL GROUP BY r
),
scored AS (
  SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
         + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weights USING (r)
),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, 10 * count(*) OVER () // 100 AS wanted
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)
"""

# All scripts at once, row by row: for each state the cheapest script, the least in ASCII
# among these, with what it makes of the rows.
REPAIR_SQL = rf"""
WITH RECURSIVE {CRC_SQL},
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h FROM conversations
),
drawn AS (
  SELECT g.*, draw FROM given g JOIN (SELECT h, {CRC_OF_HEX} % 20 AS draw FROM (SELECT DISTINCT h FROM given), crc) USING (h)
),
damaged AS (
  SELECT conv_id, turn, CASE draw WHEN 4 THEN 'user' ELSE role END AS role,
         CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM drawn
),
conv AS (SELECT row_number() OVER () AS g, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
numbered AS (
  SELECT g, turn, role, text, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '' END AS initial
  FROM damaged JOIN conv ON damaged.conv_id IS NOT DISTINCT FROM conv.conv_id
),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
         initial <> '' AND lag(initial) OVER (PARTITION BY g ORDER BY i) || initial IN ('su', 'ua', 'au') AS legal
  FROM numbered
),
inserts(q0, q, cost, script, made) AS (
  SELECT 'n', 'n', 0, '', []::VARCHAR[] UNION ALL SELECT 's', 's', 0, '', [] UNION ALL SELECT 'u', 'u', 0, '', []
  UNION ALL SELECT 'a', 'a', 0, '', [] UNION ALL
  SELECT q0, CASE q WHEN 'u' THEN 'a' ELSE 'u' END, cost + 2, script || 'I',
         list_append(made, CASE q WHEN 'u' THEN 'assistant:' ELSE 'user:' END) FROM inserts WHERE cost < 6
),
edits(q, initial, onward, edit, cost) AS (
  VALUES ('n', 's', 's', 'K', 0), ('n', 'u', 'u', 'K', 0), ('s', 'u', 'u', 'K', 0), ('a', 'u', 'u', 'K', 0), ('u', 'a', 'a', 'K', 0),
         ('n', NULL, 'u', 'R', 2), ('s', NULL, 'u', 'R', 2), ('a', NULL, 'u', 'R', 2), ('u', NULL, 'a', 'R', 2),
         ('n', NULL, 'n', 'D', 3), ('s', NULL, 's', 'D', 3), ('a', NULL, 'a', 'D', 3), ('u', NULL, 'u', 'D', 3)
),
moves AS (
  SELECT q0, initial, onward, edit, inserts.cost + edits.cost AS cost, script || edit AS script, made
  FROM inserts JOIN edits USING (q)
),
dp(g, i, q, best) AS (
  SELECT g, 0::BIGINT, 'n', {{'cost': 0::BIGINT, 'script': '', 'made': []::VARCHAR[]}} FROM conv
  UNION ALL
  SELECT g, i, q, best FROM (
    SELECT d.g, d.i + 1 AS i, m.onward AS q, min({{
      'cost': best.cost + m.cost + CASE WHEN f.fault = 'truncated' AND edit <> 'D' THEN 1 ELSE 0 END,
      'script': best.script || m.script,
      'made': list_concat(best.made, m.made, CASE edit WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
              ELSE [CASE onward WHEN 'a' THEN 'assistant:' ELSE 'user:' END || f.text] END)}}) AS best
    FROM dp d JOIN faulty f ON f.g = d.g AND f.i = d.i + 1
    JOIN moves m ON m.q0 = d.q AND (m.initial IS NULL OR m.initial = f.initial)
         AND (f.fault NOT IN ('blank', 'duplicate') OR m.edit = 'D')
    GROUP BY d.g, d.i, m.onward)
),
ends AS (
  SELECT g, min({{'cost': best.cost + e.cost, 'script': best.script || e.script,
                  'made': list_concat(best.made, e.made)}}) AS best
  FROM dp JOIN inserts e ON e.q0 = dp.q AND e.q IN ('n', 'a')
  WHERE i = coalesce((SELECT max(i) FROM faulty f WHERE f.g = dp.g), 0) GROUP BY g
),
counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND NOT legal) AS illegal
  FROM faulty GROUP BY g
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.cost AS cost, best.script AS audit,
       sha256(array_to_string(best.made, chr(10))) AS repaired_sha256
FROM conv JOIN ends USING (g) LEFT JOIN counts USING (g)
"""

SQL: dict[str, str] = {"op12_importance_resampling": RESAMPLING_SQL, "op13_conversation_repair": REPAIR_SQL}
