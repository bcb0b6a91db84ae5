"""Query op3."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.llm.language_model import score_corpus
from vecforge.llm.registry import register
from vecforge.sources.tables import table

FOLDS, HELD_OUT = 5, 1  # fixed values of the contract


@register("op3_pitman_yor_lm")
def op3_pitman_yor_lm(spark, sf_dir):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    return score_corpus(table(spark, sf_dir, "documents"), fold == HELD_OUT)
