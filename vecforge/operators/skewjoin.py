"""Equi-join that deals out heavy keys: found by Misra-Gries summaries, salted on one side, copied on the other.

A hash join sends all rows of a key to one task. Every task of the large side summarises its keys in a
bounded number of counters, and the summaries are merged, so each key above a known share of the rows is
found without counting all keys. Rows of such a key get one of several salts, the small side's row of the
key is copied once a salt, and all other rows are joined plainly, in the same join.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Counters of a summary (a key with over 1 / COUNTERS of the rows is always found), and the
# rows of one key that one task should take.
COUNTERS = 256
ROWS_PER_SALT = 1 << 20


class MisraGries:
    """At most ``size`` counters; a key's counter is at most ``seen / (size + 1)`` under its count, never above it."""

    def __init__(self, size: int):
        self.size, self.held = size, {}

    def add(self, key, n: int = 1) -> None:
        held = self.held
        if key in held or len(held) < self.size:
            held[key] = held.get(key, 0) + n
            return
        least = min(min(held.values()), n)
        self.held = {k: c - least for k, c in held.items() if c > least}
        if n > least:
            self.add(key, n - least)

    def merge(self, counts) -> None:
        """Counters of another summary: all are added, then the largest ``size`` less the next one are kept."""
        for key, n in counts:
            self.held[key] = self.held.get(key, 0) + n
        if len(self.held) > self.size:
            cut = sorted(self.held.values(), reverse=True)[self.size]
            self.held = {k: c - cut for k, c in self.held.items() if c > cut}


def heavy_keys(frame: DataFrame, key: str, counters: int = COUNTERS) -> tuple[dict, int]:
    """``({key: estimated rows}, rows)``: every key with over ``rows / counters`` rows is among them.

    Estimates are never too large. Tasks send at most ``counters`` rows each, summaries are merged in a few
    tasks, then in one; the driver gets at most ``counters`` keys. Null keys match nothing in a join and are
    not counted.
    """
    kind = frame.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("n", T.LongType()), T.StructField("rows", T.LongType()),
                           T.StructField("deal", T.IntegerType())])

    def batch(found, seen, arrow_kind, deal):
        # the first row carries the rows seen, so that a task without any key tells them too
        keys, counts = [None, *found], [0, *found.values()]
        return pa.RecordBatch.from_arrays([pa.array(keys, arrow_kind), pa.array(counts, pa.int64()),
                                           pa.array([seen] + [0] * len(found), pa.int64()), pa.array([deal] * len(keys), pa.int32())],
                                          ["key", "n", "rows", "deal"])

    def summarise(batches):
        from pyspark import TaskContext

        summary, seen, arrow_kind = MisraGries(counters), 0, None
        for b in batches:
            arrow_kind = b.schema.field(0).type
            seen += b.num_rows - b.column(0).null_count
            for pair in b.column(0).drop_null().value_counts().to_pylist():
                summary.add(pair["values"], pair["counts"])
        if arrow_kind is not None:
            yield batch(summary.held, seen, arrow_kind, TaskContext.get().partitionId() % 64)

    def merged(table: pa.Table) -> pa.Table:
        summary = MisraGries(counters)
        summary.merge((k, n) for k, n in zip(table.column("key").to_pylist(), table.column("n").to_pylist()) if k is not None)
        seen = sum(table.column("rows").to_pylist())
        return pa.Table.from_batches([batch(summary.held, seen, table.schema.field("key").type, 0)])

    found = frame.select(F.col(key).alias("key")).mapInArrow(summarise, schema)
    for _ in range(2):
        found = found.groupBy("deal").applyInArrow(merged, schema)
    rows = found.collect()
    return {r["key"]: r["n"] for r in rows if r["key"] is not None}, sum(r["rows"] for r in rows)


def salted_join(left: DataFrame, right: DataFrame, key: str, counters: int = COUNTERS, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``left.join(right, key)`` (inner) where some keys of ``left`` may hold most of its rows.

    A key whose rows are found to be over ``rows_per_salt`` gets a salt for each so many of them (the bound
    that a summary may be short of is added). Rows of ``right`` with such a key are copied once a salt.
    The result has the rows and columns of the plain join, repeated and null keys included.
    """
    found, rows = heavy_keys(left, key, counters)
    short = rows // (counters + 1)
    salts = {k: math.ceil((n + short) / rows_per_salt) for k, n in found.items() if n + short > rows_per_salt}
    salts = {k: n for k, n in salts.items() if n > 1}
    if not salts:
        return left.join(right, key)
    spark = left.sparkSession
    taken = {c.lower() for c in (*left.columns, *right.columns)}
    count, salt = "salts", "salt"
    while {count, salt} & taken:
        count, salt = "_" + count, "_" + salt
    table = spark.createDataFrame(list(salts.items()), T.StructType([left.schema[key], T.StructField(count, T.IntegerType())]))

    def known(frame):  # `counters` rows at most
        return frame.join(F.broadcast(table), key, "left").withColumn(count, F.coalesce(F.col(count), F.lit(1)))

    # a row's salt is of where it was read, so rows that are equal in every column are dealt out too
    salted = known(left).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.col(count)).cast("int")).drop(count)
    copied = known(right).withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(count) - 1))).drop(count)
    return salted.join(copied, [key, salt]).drop(salt)


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
