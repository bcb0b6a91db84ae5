"""Pair scores without all-pairs tables.

Pairwise functions (distance, cosine, dot) are evaluated over pairings that grow linearly
with the data - every vector against its class centroid, every row against itself - and the
"all distinct pairs" quantities are computed through linear identities:

* ``sum_{j != i} x_i . x_j = x_i . (S - x_i)`` with ``S`` the column sums;
* ``|test x train| = n_test * n_train`` from one counting pass.

Nothing here materialises ``n^2`` rows, so it holds for any table size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.ml.stat import Summarizer

from vecforge.functions.vectors import dot, norm2, to_array, to_vector
from vecforge.operators.skewjoin import salted_join

# Broadcast the centroid table when it is below this size (bytes, estimated
# from its exact row count and the vector width); otherwise a shuffle join.
CENTROID_BROADCAST_BYTES = 64 << 20


def column_sums(frame: DataFrame, vec: str = "vec") -> list[float]:
    """Element-wise sum of all vectors: ``d`` numbers from one aggregate with a vector buffer."""
    given = frame.filter(F.col(vec).isNotNull()).select(to_vector(vec).alias("v"))
    if not given.head(1):
        return []
    return [float(x) for x in given.select(Summarizer.sum(F.col("v")).alias("s")).first()["s"].toArray()]


def class_centroids(frame: DataFrame, vec: str = "vec", label: str = "label") -> DataFrame:
    """``(label, centroid)``: mean vector per class. One vector buffer a class and task, so a
    dominant class is reduced on the map side before any shuffle."""
    given = frame.filter(F.col(vec).isNotNull()).select(F.col(label).alias("label"), to_vector(vec).alias("v"))
    return (given.groupBy("label").agg(Summarizer.mean(F.col("v")).alias("m"))
            .select("label", to_array("m").alias("centroid")))


def with_centroid(frame: DataFrame, vec: str = "vec", label: str = "label") -> DataFrame:
    """Attach each row's class centroid (equi-join on the label; broadcast when provably small).

    The centroid table (classes x width) is computed once and checkpointed into the shared
    checkpoint folder; its exact size then decides broadcast or shuffle join. The latter deals out
    labels that hold many rows (:mod:`vecforge.operators.skewjoin`).
    """
    from vecforge.session import checkpoint_dir
    checkpoint_dir(frame.sparkSession)
    cents = class_centroids(frame, vec, label).checkpoint(eager=True)
    stats = cents.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("centroid")).alias("d")).first()
    if int(stats["n"]) * max(1, int(stats["d"] or 0)) * 8 <= CENTROID_BROADCAST_BYTES:
        return frame.join(F.broadcast(cents.withColumnRenamed("label", label)), label)
    return salted_join(frame, cents.withColumnRenamed("label", label), label)


def partner_dot_sums(frame: DataFrame, id_col: str = "id", vec: str = "vec") -> DataFrame:
    """``(id, dot_sum)``: each vector's dot products with every *other* row, summed.

    Same value as joining all distinct pairs (self pairs dropped) and summing per row, in
    one pass: ``x . S - x . x``.
    """
    total = F.array(*[F.lit(v) for v in column_sums(frame, vec)])
    return frame.select(F.col(id_col).alias("id"), (dot(vec, total) - norm2(vec)).alias("dot_sum"))


def cross_pair_count(frame: DataFrame, left: Column) -> DataFrame:
    """``(n_left, n_right, n_pairs)`` of the cross product between rows where ``left`` holds and
    the rest, from one aggregate."""
    n_left = F.count_if(left)
    n_right = F.count_if(~left)
    return frame.agg(n_left.alias("n_test"), n_right.alias("n_train")).withColumn(
        "n_pairs", F.col("n_test") * F.col("n_train"))
