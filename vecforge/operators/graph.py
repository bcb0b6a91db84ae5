"""kNN graph of one set with itself: every pair of blocks is scored once, for both directions.

Rows get a number of their own and a block by its hash. A cell is an unordered pair of blocks (a triangular
grid), so a row is copied once a block, half of what a grid of the set against itself takes, and a pair's
product serves both its rows. A row never is its own neighbour; that is told by its number, so a row with
an equal vector, or even an equal id, is a neighbour like any other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.operators import knn
from vecforge.operators.blocks import MAX_BLOCK_BYTES, MIN_CELL_WORK, MIN_PARTITIONS_PER_SLOT, PARTITION_BYTES
from vecforge.session import scratch_path


def block_count(n_rows: int, dims: int, parallelism: int, block_rows: int | None = None) -> int:
    """Blocks of bounded size; more if the work is large and there would be fewer cells than task slots need."""
    cap = block_rows or max(16, MAX_BLOCK_BYTES // (8 * max(dims, 1)))
    blocks = max(1, math.ceil(n_rows / cap))
    wanted = min(MIN_PARTITIONS_PER_SLOT * parallelism, math.ceil(n_rows * n_rows * dims / 2 / MIN_CELL_WORK["block"]))
    while blocks * (blocks + 1) // 2 < wanted:
        blocks += 1
    return blocks


def _best(keys: np.ndarray, row_slack: np.ndarray, col_slack: np.ndarray, k: int):
    """Entries of each row that could be among its k least keys, whatever rounding did."""
    m = keys.shape[1]
    if m <= k:
        return np.nonzero(keys < np.inf)
    low, high = keys - col_slack, keys + col_slack
    limit = np.partition(high, k - 1, axis=1)[:, k - 1] + 2 * row_slack
    return np.nonzero((low <= limit[:, None]) & (keys < np.inf))


def _one_way(keys, x, y, x_slack, y_slack, ids, k: int, limit: np.ndarray | None = None):
    """``(row, column, distance)`` of each row's k nearest columns, exact; ties by id, then column number.

    Columns whose key is above the row's ``limit``, less rounding, are left out.
    """
    if limit is not None and np.isfinite(limit).all():
        r, c = np.nonzero(keys - 2 * y_slack <= limit[:, None])
    else:
        r, c = _best(keys, x_slack, y_slack, k)
    score = np.sqrt(knn._fold_sq_diff(x, y, r, c))
    order = np.lexsort((c, ids[c], score, r))
    r, c, score = r[order], c[order], score[order]
    keep = np.arange(len(r)) - np.searchsorted(r, np.arange(len(x)))[r] < k
    return r[keep], c[keep], score[keep]


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _nearest(held: tuple, parts: list[tuple], ids, k: int):
    """Each row's k nearest of those held and those of ``parts``, by row."""
    r, c, s = (np.concatenate(p) for p in zip(held, *parts))
    order = np.lexsort((c, ids[c], s, r))
    r, c, s = r[order], c[order], s[order]
    first = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else np.zeros(0, np.int64)
    place = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
    return r[place < k], c[place < k], s[place < k]


def pair_of_blocks(x, x_ids, y, y_ids, same: bool, k: int):
    """Neighbours ``(row, column, distance)`` of x's rows among y's, and of y's among x's, from one product.

    The key of a pair is half its squared distance, less half the row's square; with ``same`` the two are
    one block, the diagonal is left out and the second direction is empty.
    """
    unit = (4.0 * x.shape[1] + 16.0) * np.finfo(float).eps
    a, b = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
    step = max(1, knn._CHUNK_CELLS // max(1, len(y)))
    forth, back, waiting, bound = [], _NONE, 0, np.full(len(y), np.inf)
    parts: list[tuple] = []
    for begin in range(0, len(x), step):
        part = slice(begin, begin + step)
        product = x[part] @ y.T
        keys = 0.5 * b[None, :] - product
        if same:
            keys[np.arange(len(keys)), np.arange(begin, begin + len(keys))] = np.inf
        r, c, s = _one_way(keys, x[part], y, unit * a[part], unit * b, y_ids, k)
        forth.append((r + begin, c, s))
        if not same:
            keys = 0.5 * a[part][None, :] - product.T
            limit = 0.5 * bound ** 2 * (1 + unit) - 0.5 * b + 2 * unit * b
            r, c, s = _one_way(keys, y, x[part], unit * b, unit * a[part], x_ids[part], k, limit)
            parts.append((r, c + begin, s))
            waiting += len(r)
            if waiting >= len(y) * k // 2:  # chunks of x each send some: only the best k are held
                back, parts, waiting = _nearest(back, parts, x_ids, k), [], 0
                full = np.bincount(back[0], minlength=len(y)) >= k
                bound[full] = back[2][np.searchsorted(back[0], np.flatnonzero(full), side="right") - 1]
    forth = tuple(np.concatenate(p) for p in zip(*forth)) if forth else _NONE
    return [forth, _nearest(back, parts, x_ids, k)]


def self_knn_graph(frame: DataFrame, k: int, *, id_col: str = "id", vec: str = "vec", block_rows: int | None = None) -> DataFrame:
    """``id, neighbor_id, distance, rank``: each row's ``k`` nearest other rows (Euclidean), ties by id.

    Rows without a usable vector (null, or malformed as in :mod:`vecforge.operators.knn`) are not in the
    graph. Repeated rows are nodes of their own, at distance 0; a null id is a node too, behind others in
    ties. Fewer rows than ``k`` other ones give what there is; an empty table gives no rows.
    """
    knn._check(knn.EUCLIDEAN, k)
    k, spark = int(k), frame.sparkSession
    rows = frame.select(F.col(id_col).cast("long").alias("id"), knn._vector(frame, vec).alias("v"))
    path = scratch_path(spark, "graph-rows")  # written: a row's number is the same in all that follows
    rows.filter(knn.usable(F.col("v"), knn.EUCLIDEAN)).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.min(F.size("v")).alias("least")).first()
    if size["least"] != size["d"]:
        raise ValueError("vectors in one kNN input must all have the same length")
    n, dims = int(size["n"]), int(size["d"] or 1)
    blocks = block_count(n, dims, knn._parallelism(rows), block_rows)
    cells = blocks * (blocks + 1) // 2
    own = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    by_bytes = math.ceil(n * blocks * (8 * dims + 24) / PARTITION_BYTES)
    parts = max(1, min(cells, max(by_bytes, MIN_PARTITIONS_PER_SLOT * knn._parallelism(rows))))
    dealt = (rows.withColumn("block", own).withColumn("other", every)
             .select("id", "v", "row", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
             .repartition(parts, "i", "j"))

    def cell(table: pa.Table) -> pa.Table:
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        block, ids = table.column("block").to_numpy(), table.column("id").to_numpy().astype(np.float64)
        order_ids = np.where(np.isnan(ids), np.inf, ids) if table.column("id").null_count else table.column("id").to_numpy()
        vectors = knn._matrix(table.column("v"))
        at_x = np.flatnonzero(block == i)
        at_y = at_x if i == j else np.flatnonzero(block == j)
        taken = []
        if len(at_x) and len(at_y):
            forth, back = pair_of_blocks(vectors[at_x], order_ids[at_x], vectors[at_y], order_ids[at_y], i == j, k)
            taken = [(at_x[forth[0]], at_y[forth[1]], forth[2]), (at_y[back[0]], at_x[back[1]], back[2])]
        r, c, score = (np.concatenate(x) for x in zip(*taken)) if taken else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        r, c = pa.array(r, pa.int64()), pa.array(c, pa.int64())
        return pa.table({"row": table.column("row").take(r), "id": table.column("id").take(r), "other": table.column("row").take(c),
                         "neighbor_id": table.column("id").take(c), "distance": pa.array(score, pa.float64())})

    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("row", "id", "other", "neighbor_id")] + [T.StructField("distance", T.DoubleType())])
    best = Window.partitionBy("row").orderBy(F.col("distance").asc(), F.col("neighbor_id").asc_nulls_last(), F.col("other").asc())
    return (dealt.groupBy("i", "j").applyInArrow(cell, schema).withColumn("rank", F.row_number().over(best).cast("int"))
            .filter(F.col("rank") <= k).select("id", "neighbor_id", "distance", "rank"))


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
