"""Contiguous, byte-balanced shards from global prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecforge.session import scratch_path

ROW_OVERHEAD = 16  # fixed value: bytes counted for each row besides its text


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus the overhead of a row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_OVERHEAD)).cast("long")


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard, slot`` for every row of ``docs``; ``slot`` is gapless from 0.

    Rows are put in the order of ``(id, text_crc32, size)``, nulls first. One range shuffle of
    these narrow rows gives ordered partitions; each partition's total goes into a prefix sum
    over partitions, and a running sum inside a partition then gives every row its first byte.
    A row belongs to the shard whose equal byte target holds the row's middle byte, so shards
    are contiguous and a shard's size is off its target by less than one row's size.

    No text is shuffled. A partition's window holds one range partition of narrow rows; a hot id
    is cut over partitions by a row number. Null ids come first, a null text counts as empty,
    repeated rows are separate rows, an empty table gives no rows, more shards than rows leave
    shards empty, and other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = scratch_path(spark, "shard-rows")
    (docs.select(F.col(id_col).alias("id"), text_size(text).alias("size"),
                 F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                 F.monotonically_increasing_id().alias("tie"))
     .write.parquet(rows))
    base = spark.read.parquet(rows)

    # Ordered partitions are written once: their numbers then hold in every later pass.
    order = ["id", "text_crc32", "size", "tie"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = scratch_path(spark, "shard-order")
    (base.repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .withColumn("part", F.spark_partition_id()).write.parquet(ordered))
    base = spark.read.parquet(ordered)

    # One row per partition; this window is over partitions, never over rows.
    totals = base.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(everything).alias("all_bytes"))

    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (base.join(offsets, "part")
              .select("part", "id", "size", "text_crc32", "tie",
                      (F.col("bytes_before") + F.sum("size").over(upto)).alias("end"),
                      (F.col("rows_before") + F.row_number().over(inside)).alias("nth"), "all_bytes")
              .withColumn("shard", F.least(
                  F.lit(shards - 1),
                  F.expr(f"CAST(((2 * CAST(end AS DECIMAL(38, 0)) - size) * {int(shards)}) "
                         "DIV (2 * CAST(all_bytes AS DECIMAL(38, 0))) AS INT)")).cast("int")))
    first = placed.groupBy("shard").agg(F.min("nth").alias("first_nth"))
    return (placed.join(F.broadcast(first), "shard")  # at most one row per shard
            .select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                    (F.col("nth") - F.col("first_nth")).cast("long").alias("slot")))
