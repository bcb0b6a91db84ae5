"""Row identifiers.

* :func:`with_row_id` - unique, increasing, not contiguous (``monotonically_increasing_id``);
  cheap, but only stable while the input partitioning is; :func:`id_counts` tells if they are unique.
* :func:`with_file_order_index` - contiguous ``0 .. n-1`` in file order, for layouts where
  rows of two files are paired by position. It needs no global sort and no single-task
  window over the data: rows are counted per file split, the (small) split table gets
  running offsets and is checkpointed, and each row adds its position inside its split.
  Two passes over the input in all.
* :func:`with_row_index` - contiguous ``0 .. n-1`` in the row order of any frame, filtered, joined
  or sorted ones too. The frame is written once, with partition numbers; offsets are sums over
  partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecforge.session import checkpoint_dir, scratch_path

# The split table is broadcast when it has at most this many rows
# (one row per file split, i.e. input bytes / split size); larger tables are joined normally.
SPLIT_TABLE_BROADCAST_ROWS = 200_000


def with_row_id(frame: DataFrame, name: str = "id") -> DataFrame:
    return frame.withColumn(name, F.monotonically_increasing_id())


def id_counts(frame: DataFrame, name: str = "id") -> DataFrame:
    """``n_rows, n_distinct_ids``, exact. Each task sets a bit per id, so bitmaps are shuffled, not rows; ids are not null."""
    maps = (frame.groupBy(F.bitmap_bucket_number(name).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position(name)).alias("bits")))
    return maps.agg(F.sum("n").alias("n_rows"), F.sum(F.bitmap_count("bits")).alias("n_distinct_ids"))


def file_order(path: Column) -> list[Column]:
    """Sort keys that put a writer's files in the order it numbered them.

    Part numbers have five digits at least and more once there are 100,000 files, so the number
    counts before the name; files of other names go by name.
    """
    name = F.element_at(F.split(path, "/"), -1)
    folder = F.substring(path, F.lit(1), F.length(path) - F.length(name))
    return [folder, F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long"), name]


def with_file_order_index(scan: DataFrame, name: str = "row_index") -> DataFrame:
    """Contiguous index in (file, position in file) order; files go by their part number.

    ``scan`` must be a file-source DataFrame (``spark.read...``) so its hidden ``_metadata``
    column is available; apply before other transformations. Deterministic across task retries:
    split boundaries, partition contents and their order depend only on the file listing.
    """
    tagged = scan.select("*", F.col("_metadata.file_path").alias("_file"),
                         F.col("_metadata.file_block_start").alias("_start"),
                         F.monotonically_increasing_id().alias("_mono"))
    splits = tagged.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
    # one row per split: a running sum over this small table is cheap even in one task
    running = Window.orderBy(*file_order(F.col("_file")), "_start").rowsBetween(Window.unboundedPreceding, -1)
    # materialised once in the shared checkpoint folder: sizing the join and the join itself
    # read this small table instead of re-aggregating the input
    checkpoint_dir(scan.sparkSession)
    offsets = splits.select("_file", "_start", "_first",
                            F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset")
                            ).checkpoint(eager=True)
    n_splits = offsets.count()
    side = F.broadcast(offsets) if n_splits <= SPLIT_TABLE_BROADCAST_ROWS else offsets
    joined = tagged.join(side, ["_file", "_start"])
    return (joined.withColumn(name, F.col("_offset") + F.col("_mono") - F.col("_first"))
            .drop("_file", "_start", "_mono", "_first", "_offset"))


def with_row_index(frame: DataFrame, name: str = "row_index") -> DataFrame:
    """Contiguous index ``0 .. n-1`` in the row order of any frame: partition by partition, as it comes.

    A frame's rows may come in another order when a task is run again (after a shuffle they do), so the
    frame is written to the shared scratch folder with each row's partition and place, and only what was
    written is numbered: whatever task is lost later reads the same numbers. Rows are counted by partition
    and each partition's offset is the sum of the counts before it: one small row a partition is all that
    is ever ordered. A column called ``name`` gives way to the index; an empty frame gives no rows.
    """
    spark = frame.sparkSession
    kept = [c for c in frame.columns if c.lower() != name.lower()]
    path = scratch_path(spark, "row-index")
    # columns travel inside a struct, so that none of theirs can clash with the place
    frame.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.monotonically_increasing_id().alias("place")).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    checkpoint_dir(spark)
    offsets = counts.select("part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")).checkpoint(eager=True)
    side = F.broadcast(offsets) if offsets.count() <= SPLIT_TABLE_BROADCAST_ROWS else offsets
    index = F.col("offset") + F.col("place") - F.col("first")
    return rows.join(side, "part").select("row.*", index.cast("long").alias(name))
