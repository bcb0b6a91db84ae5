"""Query op12."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.llm.kmeans_tree import search
from vecforge.llm.registry import register
from vecforge.sources.tables import table

# Fixed values of the contract.
TOP, QUERY_MODULUS = 20, 20


@register("op12_kmeans_tree_search")
def op12_kmeans_tree_search(spark, sf_dir):
    return search(table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                  F.pmod("vec_id", F.lit(QUERY_MODULUS)) == 0, TOP)
