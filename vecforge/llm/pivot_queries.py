"""Query op9."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.llm.pivots import top_k
from vecforge.llm.registry import register
from vecforge.sources.tables import table

# Fixed values of the contract.
TOP, QUERY_MODULUS = 5, 50

ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.vec_id % {QUERY_MODULUS} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {TOP}
"""


@register("op9_exact_top_k", ORACLE)
def op9_exact_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                 F.pmod("vec_id", F.lit(QUERY_MODULUS)) == 0, TOP).select("query_id", "rank", "vec_id", "score")
