"""Sums of numpy arrays over tasks, a few at a time, so that no task holds all of them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.session import scratch_path

FAN_IN = 16  # arrays of one part that one task puts together


def added(arrays: list[np.ndarray]) -> np.ndarray:
    return np.sum(arrays, axis=0)


def by_part(frame: DataFrame, fold: Callable, closing: Callable | None = None) -> DataFrame:
    """``part, values``: what ``fold(batch, held)`` holds of each task's batches, flattened by part.

    ``fold`` gets ``held`` None at first and returns a list of arrays; ``closing`` turns the last one into
    the list that is sent. A task without rows sends nothing.
    """
    def run(batches):
        held = None
        for batch in batches:
            if batch.num_rows:
                held = fold(batch, held)
        if held is not None:
            sent = closing(held) if closing else held
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(range(len(sent))), pa.int32()),
                 pa.array([np.ascontiguousarray(a, dtype=float).tobytes() for a in sent], pa.binary())], ["part", "values"])

    return frame.mapInArrow(run, "part int, values binary")


def reduced(found: DataFrame, together: Callable = added) -> dict[int, np.ndarray]:
    """One flat array a part, from :func:`by_part`: ``together`` is applied to ``FAN_IN`` of them at once, round by round.

    The tasks' arrays are written first, so their number is known and none is computed twice; only the last
    round's, one a part, reach the driver.
    """
    spark = found.sparkSession
    path = scratch_path(spark, "partials")
    found.withColumn("task", F.spark_partition_id()).write.parquet(path)
    held = spark.read.parquet(path)
    most = held.agg(F.max("task")).first()[0]
    if most is None:
        return {}

    def put(table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(v, float) for v in table.column("values").to_pylist()]
        return pa.table({"task": table.column("task").slice(0, 1), "part": table.column("part").slice(0, 1),
                         "values": pa.array([np.ascontiguousarray(together(arrays), dtype=float).tobytes()], pa.binary())})

    while True:
        most //= FAN_IN
        held = (held.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int")).groupBy("task", "part")
                .applyInArrow(put, "task int, part int, values binary"))
        if most == 0:
            break
    return {r["part"]: np.frombuffer(r["values"], float) for r in held.collect()}


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
