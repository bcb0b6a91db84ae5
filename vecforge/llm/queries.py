"""All queries of this package; importing it fills the registry."""

from vecforge.llm import (conversation_queries, kmeans_tree_queries, language_model_queries, license_queries, minhash_queries, packing_queries,  # noqa: F401
                          pivot_queries, quality_queries, sentence_piece_queries, shard_queries, spelling_queries, suffix_queries,
                          warc_queries)
from vecforge.llm.registry import ORACLES, QUERIES  # noqa: F401
