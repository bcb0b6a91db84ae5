"""Query op6."""

from __future__ import annotations

import public_tokenizers

from vecforge.llm.packing import pack
from vecforge.llm.registry import register
from vecforge.sources.tables import table


@register("op6_harmonic_packing")
def op6_harmonic_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
