"""Query op13."""

from __future__ import annotations

from vecforge.llm.registry import register
from vecforge.llm.spelling import DAMAGE_MODULUS, FORM_FACTOR, MIN_COUNT, MIN_LENGTH, RUN, frequent, variants, words_of
from vecforge.sources.tables import table

# Near words share what is left without one code point, at one place (replaced) or as the other word (inserted, deleted).
ORACLE = rf"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_of),
r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{RUN}')) AS run FROM documents),
g AS (SELECT id, run, count(*) AS times FROM r GROUP BY id, run),
h AS (SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295,
             list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
             lambda c, x: xor(crc_of[(xor(c, x) & 255) + 1], c >> 8))) AS h FROM g, t),
d AS (SELECT CASE WHEN h % {DAMAGE_MODULUS} = 0
             THEN substring(run, 1, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, times FROM h),
w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM d WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(times) >= {MIN_COUNT}),
c AS (SELECT word, n, j, substring(word, 1, j) || substring(word, j + 2) AS cut
      FROM (SELECT word, n, unnest(range(length(word))) AS j FROM w)),
p AS (SELECT a.word AS a, b.word AS b FROM c a JOIN c b ON a.j = b.j AND a.cut = b.cut AND a.word <> b.word
      UNION SELECT c.word, w.word FROM c JOIN w ON c.cut = w.word
      UNION SELECT w.word, c.word FROM c JOIN w ON c.cut = w.word),
k AS (SELECT p.a AS word, count(*) AS n_near, max(w.n) AS near_n, arg_min(w.word, (-w.n, encode(w.word))) AS near
      FROM p JOIN w ON w.word = p.b GROUP BY p.a),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {FORM_FACTOR} * w.n THEN near END AS form,
             CASE WHEN near_n >= {FORM_FACTOR} * w.n THEN near_n END AS form_n FROM w LEFT JOIN k USING (word)),
s AS (SELECT word, word AS root, 0 AS steps FROM f
      UNION ALL SELECT s.word, f.form, s.steps + 1 FROM s JOIN f ON f.word = s.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(s.root, s.steps) AS root, f.n, f.n_near, f.form_n
FROM f JOIN s USING (word) GROUP BY f.word, f.form, f.n, f.n_near, f.form_n
"""


@register("op13_spelling_variants", ORACLE)
def op13_spelling_variants(spark, sf_dir):
    return variants(frequent(words_of(table(spark, sf_dir, "documents"))))
