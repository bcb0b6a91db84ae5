"""Query op2."""

from __future__ import annotations

from vecforge.llm.quality import JUDGE_SQL, judge
from vecforge.llm.registry import register
from vecforge.sources.tables import table


@register("op2_quality_rules", JUDGE_SQL)
def op2_quality_rules(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
