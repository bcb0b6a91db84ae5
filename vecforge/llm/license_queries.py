"""Query op8."""

from __future__ import annotations

from vecforge.llm.licenses import license_matches
from vecforge.llm.registry import register
from vecforge.sources.tables import table


@register("op8_license_scan")
def op8_license_scan(spark, sf_dir):
    return license_matches(table(spark, sf_dir, "documents"))
