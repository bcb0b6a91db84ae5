"""Query op4."""

from __future__ import annotations

from vecforge.llm.registry import register
from vecforge.llm.suffix_dedup import removal_report
from vecforge.sources.tables import table

LENGTH = 400  # fixed value of the contract, in bytes
WORDS = 51    # words of the least passage that is counted beside it: over 50


@register("op4_suffix_array_dedup")
def op4_suffix_array_dedup(spark, sf_dir):
    return removal_report(table(spark, sf_dir, "documents"), length=LENGTH, words=WORDS)
