"""Query op5."""

from __future__ import annotations

import public_tokenizers

from vecforge.llm.registry import register
from vecforge.llm.sentence_pieces import round_trip
from vecforge.sources.tables import table


@register("op5_sentence_pieces")
def op5_sentence_pieces(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
