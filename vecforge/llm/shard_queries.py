"""Query op10."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.llm.registry import register
from vecforge.llm.sharding import shard_by_bytes
from vecforge.sources.tables import table

SHARDS = 40  # fixed value of the contract


# Rows in the order of their ids; the checksum is folded byte by byte, from a table made by its rule.
ORACLE = f"""
WITH t AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
             lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_of),
b AS (SELECT doc_id, encode(coalesce(text, '')) AS raw FROM documents),
h AS (SELECT doc_id, octet_length(raw) + 16 AS size,
             list_transform(regexp_extract_all(hex(raw), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bytes FROM b),
c AS (SELECT doc_id, size, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
             lambda c, x: xor(crc_of[(xor(c, x) & 255) + 1], c >> 8))) AS text_crc32 FROM h, t),
o AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER () AS total FROM c),
s AS (SELECT *, least({SHARDS} - 1, (2 * upto - size) * {SHARDS} // (2 * total)) AS shard FROM o)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'bytes' AS law,
       CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""


@register("op10_sharding", ORACLE)
def op10_sharding(spark, sf_dir):
    placed = shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
