"""Query op11."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.llm.conversations import COUNTS, damage, repair_report
from vecforge.llm.registry import register
from vecforge.sources.tables import table

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of no bytes

# Damage, faults, and the least (cost, audit) by state from row to row; states as in the module.
# The checksum is folded byte by byte, from a table made by its rule.
ORACLE = r"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_of),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             list_transform(regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'),
                            lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM conversations),
h AS (SELECT * EXCLUDE (bytes), xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
             lambda c, x: xor(crc_of[(xor(c, x) & 255) + 1], c >> 8))) % 20 AS what FROM k, t),
d AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN what = 1 THEN '' WHEN what = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE what WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
             regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM d),
f AS (SELECT *, CASE WHEN body = '' THEN 'blank'
                     WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                     WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
             lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM o),
c AS (SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
             count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
             max(n) AS rows FROM f GROUP BY conv_id),
i(s, t, letters, price, said) AS (VALUES  -- inserts before a row or at the end: from state, to state
  (0, 0, '', 0, []), (1, 1, '', 0, []), (2, 2, '', 0, []), (3, 3, '', 0, []),
  (0, 2, 'I', 5, ['user:']), (1, 2, 'I', 5, ['user:']), (3, 2, 'I', 5, ['user:']), (2, 3, 'I', 5, ['assistant:']),
  (0, 3, 'II', 10, ['user:', 'assistant:']), (1, 3, 'II', 10, ['user:', 'assistant:']), (2, 2, 'II', 10, ['assistant:', 'user:']),
  (3, 3, 'II', 10, ['user:', 'assistant:'])),
e(initial, letter, s, t, price, role) AS (VALUES  -- what may be done to a row; initial null: any
  (NULL, 'D', 0, 0, 2, NULL), (NULL, 'D', 1, 1, 2, NULL), (NULL, 'D', 2, 2, 2, NULL), (NULL, 'D', 3, 3, 2, NULL),
  ('s', 'K', 0, 1, 0, NULL), ('u', 'K', 0, 2, 0, NULL), ('u', 'K', 1, 2, 0, NULL), ('u', 'K', 3, 2, 0, NULL), ('a', 'K', 2, 3, 0, NULL),
  (NULL, 'R', 0, 2, 1, 'user'), (NULL, 'R', 1, 2, 1, 'user'), (NULL, 'R', 3, 2, 1, 'user'), (NULL, 'R', 2, 3, 1, 'assistant')),
w(conv_id, n, state, cost, audit, said) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, 0, '', CAST([] AS VARCHAR[]) FROM c
  UNION ALL
  SELECT conv_id, n, state, cost, audit, said FROM (
    SELECT w.conv_id, f.n, e.t AS state,
           w.cost + i.price + e.price + CASE WHEN f.fault = 'truncated' AND e.letter <> 'D' THEN 5 ELSE 0 END AS cost,
           w.audit || i.letters || e.letter AS audit,
           list_concat(w.said, list_concat(CAST(i.said AS VARCHAR[]), CASE WHEN e.letter = 'D' THEN CAST([] AS VARCHAR[])
             ELSE [coalesce(e.role, f.role) || ':' || f.text] END)) AS said
    FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1
    JOIN i ON i.s = w.state JOIN e ON e.s = i.t AND (e.initial IS NULL OR e.initial = left(f.role, 1))
         AND (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')))
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
z AS (SELECT w.conv_id, w.cost + i.price AS cost, w.audit || i.letters AS audit, list_concat(w.said, CAST(i.said AS VARCHAR[])) AS said
      FROM w JOIN c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.rows = w.n JOIN i ON i.s = w.state AND i.t IN (0, 3)
      QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + i.price, w.audit || i.letters) = 1)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(list_aggregate(said, 'string_agg', chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM a.conv_id
"""


@register("op11_conversation_repair", ORACLE)
def op11_conversation_repair(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    found = repair_report(damage(rows)).withColumnRenamed("conversation", "of")
    whole = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    return whole.select("conv_id", *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in COUNTS),
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"))
