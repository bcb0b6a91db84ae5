"""Query op1."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.llm.registry import register
from vecforge.llm.warc import RFC_32, read_warc, write_warc
from vecforge.session import scratch_path
from vecforge.sources.tables import table


# Base32 of a digest: 40 bits (10 hex digits) give 8 digits, 5 bits each.
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex, max(page_id) OVER (PARTITION BY html) AS top
      FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('{RFC_32}', 1 + CAST(
           (CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to, 'ok' AS status
FROM d
"""


@register("op1_warc", ORACLE)
def op1_warc(spark, sf_dir):
    archives = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), archives, "page_id", "url", "html")
    return read_warc(spark, archives).select(
        F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to_key").cast("long").alias("refers_to"), "status")
