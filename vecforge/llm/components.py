"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.session import scratch_path


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, is linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every node of the edges ``(u, v)``: the least node that it reaches.

    Both steps keep the components and bring every node closer to the least one; they alternate
    until the edges stay the same. Minima are aggregated before they are shuffled and hot nodes
    meet theirs in a join that Spark can split, so no neighbourhood is gathered anywhere. Each
    round is a written table; only a count and a checksum reach the driver. Loops, repeated and
    reversed edges do no harm; edges with a null end are left out.
    """
    now = _written(_tidy(edges.filter("u IS NOT NULL AND v IS NOT NULL")), "cc")
    state = _state(now)
    while state[0]:
        now = _written(_tidy(_small_star(_written(_tidy(_large_star(now)), "cc"))), "cc")
        new = _state(now)
        if new == state:
            break
        state = new
    least = now.select("v").distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        least.select(F.col("v").alias("id"), F.col("v").alias("component")))
