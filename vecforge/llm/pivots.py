"""Exact top-k inner products by pivot-table elimination."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 32
SAMPLE_ROWS = 4096       # rows that pivots are chosen from
BLOCK_BYTES = 8 << 20    # of a cell's vectors and tables, candidates or queries
BOUNDS_AT_ONCE = 1 << 21
FIRST_LOOK = 64          # candidates evaluated at first; then twice as many each time
SLACK = 1e-9             # of the squared scale, for rounding in the bounds
SPAN = 1e-8              # least part of a pivot outside the span of those before it that counts as a direction
EXACT_DOUBLE = 2.0 ** 53
LONG_MAX = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & F.coalesce(~bad, F.lit(False))


def _matrix(column) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.stack([x.values.to_numpy() for x in arr]) if len(arr) else np.zeros((0, 0), np.int64)


def _lifted(rows: np.ndarray, radius2: float) -> np.ndarray:
    """Rows with a coordinate that brings all to one norm: the nearest is then the one of largest inner product."""
    x = rows.astype(np.float64)
    return np.concatenate([x, np.sqrt(np.maximum(radius2 - np.einsum("ij,ij->i", x, x), 0))[:, None]], axis=1)


def _distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points[:, None, :] - pivots[None, :, :]) ** 2).sum(axis=2), 0))


def _far_apart(points: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first choice: each pivot is the point farthest from those before it."""
    chosen = [0]
    gap = ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _scores(rows: np.ndarray, query: np.ndarray, small: bool) -> np.ndarray:
    """Exact inner products; beyond the range of a long they are held at its ends."""
    if small:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = (sum(a * b for a, b in zip(r, query.tolist())) for r in rows.tolist())
    return np.array([max(-LONG_MAX - 1, min(LONG_MAX, s)) for s in exact], np.int64)


def span_of(pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(turn, norm2)``: inner products with the pivots times ``turn`` are coordinates in an orthonormal basis of their span."""
    norm2 = np.einsum("ij,ij->i", pivots, pivots)
    if not len(pivots):
        return np.zeros((0, 0)), norm2
    u, s, _ = np.linalg.svd(pivots, full_matrices=False)
    keep = s > s[0] * SPAN if s[0] > 0 else np.zeros(len(s), bool)
    return u[:, keep] / s[keep], norm2


def coordinates(table: np.ndarray, norms2: np.ndarray, turn: np.ndarray, pivot_norm2: np.ndarray):
    """A row's coordinates in the pivots' span and the length of the rest, all from its distances to the pivots."""
    inner = (norms2[:, None] + pivot_norm2[None, :] - table ** 2) / 2
    inside = inner @ turn
    return inside, np.sqrt(np.maximum(norms2 - np.einsum("ij,ij->i", inside, inside), 0))


def search_cell(queries, query_ids, rows, ids, table, pivots, radius2: float, k: int, floors=None):
    """``(query row, candidate row, score)`` of each query's best ``k`` in a block, then ``(query row, -1, evaluated)``.

    ``table`` has every row's distances to the pivots. ``|d(q, p) - d(x, p)|`` is at most ``d(q, x)`` for
    every pivot ``p``, and so is the distance of their projections on the pivots' span, which the same
    distances tell, with the difference of what is left outside it. The largest of these bounds gives an
    upper bound of the score. Candidates are evaluated by falling bound until the k-th best score, or the
    query's floor (a k-th best of some of all candidates), is above all that is left; an equal bound is
    still evaluated, as its id may be smaller.
    """
    if not len(queries) or not len(rows):
        return
    lifted = np.concatenate([queries.astype(np.float64), np.zeros((len(queries), 1))], axis=1)
    to_pivots = _distances(lifted, pivots) if len(pivots) else np.zeros((len(queries), 0))
    norm2 = np.einsum("ij,ij->i", lifted, lifted)
    turn, pivot_norm2 = span_of(pivots)
    x_in, x_out = coordinates(table, np.full(len(rows), radius2), turn, pivot_norm2) if len(pivots) else (np.zeros((len(rows), 0)), np.full(len(rows), np.sqrt(radius2)))
    q_in, q_out = coordinates(to_pivots, norm2, turn, pivot_norm2) if len(pivots) else (np.zeros((len(queries), 0)), np.sqrt(norm2))
    largest = max((float(np.abs(x.astype(np.float64)).max(initial=0)) for x in (queries, rows)))
    small = largest * largest * max(1, rows.shape[1]) < EXACT_DOUBLE
    step = max(1, BOUNDS_AT_ONCE // len(rows))
    for begin in range(0, len(queries), step):
        part = slice(begin, begin + step)
        bounds = q_in[part] @ x_in.T + q_out[part][:, None] * x_out[None, :]
        for p in range(table.shape[1]):  # the single pivots' bounds, where tighter
            low = to_pivots[part][:, p, None] - table[None, :, p]
            np.minimum(bounds, (norm2[part][:, None] + radius2 - low * low) / 2, out=bounds)
        for i, bound in enumerate(bounds, begin):
            slack = SLACK * (norm2[i] + radius2) + 1
            floor = -np.inf if floors is None else floors[i] - slack
            order = np.flatnonzero((bound >= floor) & (ids != query_ids[i]))
            order = order[np.argsort(-bound[order], kind="stable")]
            best = np.zeros(0, np.int64)
            scores, at, look = np.zeros(0, np.int64), 0, FIRST_LOOK
            while at < len(order):
                if len(best) == k and small and scores[-1] > bound[order[at]] + slack:
                    break
                some = order[at:at + look]
                at, look = at + len(some), 2 * look
                found = np.concatenate([scores, _scores(rows[some], queries[i], small)])
                of = np.concatenate([best, some])
                top = np.lexsort((ids[of], -found.astype(np.float64) if small else ~found))[:k]
                best, scores = of[top], found[top]
            for x, score in zip(best, scores):
                yield i, int(x), int(score)
            yield i, -1, at


def top_k(vectors: DataFrame, id_col: str, vec_col: str, query_where: Column, k: int,
          scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score, evaluated, candidates``: each query's ``k`` largest inner products of all other rows.

    Components are turned into ``floor(scale * x)``. Every usable row is a candidate and rows that
    satisfy ``query_where`` are queries. Vectors are compared with those of their own length.

    Pivots are the far-apart ones of a sample of about ``SAMPLE_ROWS`` rows (only they reach the
    driver); each row's distances to them are computed once. A query's k-th best among the sample is its
    floor everywhere. A grid of query blocks and candidate blocks, sized by bytes, deals the work out
    evenly; a cell sends ``k`` rows a query on, and a window keeps the best. ``evaluated`` is how many
    ``candidates`` were compared with the query; the bounds ruled the others out.

    Rows with a null id, or vectors that are not usable, take no part. A query never meets rows of
    its own id. A query row that is repeated gives one result; rows of one id with different
    vectors are queries of their own. Equal scores go by smaller id; fewer candidates give fewer
    rows; an empty table gives none; other columns are not read.
    """
    spark = vectors.sparkSession
    given = F.col(vec_col).cast("array<double>")
    rows = (vectors.filter(F.col(id_col).isNotNull() & usable(given))
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(given, lambda x: F.floor(scale * x).cast("long")).alias("v"), query_where.alias("is_query")))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    stats = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(squares).alias("radius2"),
                                                     F.count_if("is_query").alias("queries"))
    kinds = {r["d"]: r for r in stats.collect()}  # one row a vector length
    total = sum(r["n"] for r in kinds.values())
    pivots: dict[int, np.ndarray] = {}
    samples: dict[int, tuple] = {}
    if total:
        sample: dict[int, list] = {}
        known: dict[int, list] = {}
        for r in rows.sample(min(1.0, SAMPLE_ROWS / total), 11).select("v", "id").collect():
            sample.setdefault(len(r["v"]), []).append(r["v"])
            known.setdefault(len(r["v"]), []).append(r["id"])
        pivots = {d: _far_apart(_lifted(np.array(x, np.int64).reshape(len(x), d), kinds[d]["radius2"]), PIVOTS)
                  for d, x in sample.items()}
        samples = {d: (np.array(x, np.int64).reshape(len(x), d), np.array(known[d])) for d, x in sample.items()}
    radius2 = {d: float(r["radius2"]) for d, r in kinds.items()}

    def with_table(batches):
        for batch in batches:
            dist = []
            for v in batch.column(1):
                x = v.values.to_numpy()
                p = pivots.get(len(x))
                dist.append(b"" if p is None else _distances(_lifted(x[None, :], radius2[len(x)]), p)[0].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dist, pa.binary())],
                                             ["id", "v", "is_query", "table"])

    tabled = rows.mapInArrow(with_table, "id long, v array<long>, is_query boolean, table binary")
    most = max((r["n"] for r in kinds.values()), default=1)
    most_queries = max((r["queries"] for r in kinds.values()), default=1)
    row_bytes = 8 * (max(kinds, default=1) + PIVOTS + 4)
    held = max(64, BLOCK_BYTES // row_bytes)
    blocks, query_blocks = math.ceil(most / held) or 1, math.ceil(most_queries / held) or 1
    if blocks * query_blocks < 4 * spark.sparkContext.defaultParallelism:  # few cells: more of them, if there is work
        work = math.ceil(most * most_queries * row_bytes / (8 << 27))
        query_blocks = max(query_blocks, min(math.ceil(most_queries / 16) or 1, math.ceil(min(work, 4 * spark.sparkContext.defaultParallelism) / blocks)))
    spread = F.xxhash64("id", "v")
    candidates = (tabled.select("id", "v", "table", F.size("v").alias("d"), F.pmod(spread, F.lit(blocks)).alias("xb"),
                                F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb")))
    def with_floor(batches):
        """Each query's k-th best score among the sample (less, if it has fewer): no true k-th best is below it."""
        for batch in batches:
            floors = []
            for query_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                q = v.values.to_numpy()
                x, known_ids = samples.get(len(q), (np.zeros((0, len(q)), np.int64), np.zeros(0, np.int64)))
                near = (x.astype(np.float64) @ q.astype(np.float64))[known_ids != query_id]
                floors.append(float(np.partition(near, -k)[-k]) if len(near) >= k else -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors, pa.float64())], ["id", "v", "floor"])

    asked = rows.filter("is_query").select("id", "v").distinct().mapInArrow(with_floor, "id long, v array<long>, floor double")
    queries = (asked.select("id", "v", "floor", F.size("v").alias("d"), F.pmod(spread, F.lit(query_blocks)).cast("int").alias("qb"),
                       spread.alias("qkey"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("xb")))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], [], [], []]
        if left.num_rows and right.num_rows:
            q, x = _matrix(left.column("v")), _matrix(right.column("v"))
            d = x.shape[1]
            p = pivots.get(d, np.zeros((0, d + 1)))
            table = np.frombuffer(b"".join(right.column("table").to_pylist())).reshape(len(x), len(p))
            q_ids, ids, keys = left.column("id").to_numpy(), right.column("id").to_numpy(), left.column("qkey").to_numpy()
            floors = left.column("floor").to_numpy()
            for i, j, score in search_cell(q, q_ids, x, ids, table, p, radius2[d], k, floors):
                row = (q_ids[i], keys[i], ids[j], score, 0, 0) if j >= 0 else (q_ids[i], keys[i], None, None, score, int((ids != q_ids[i]).sum()))
                for column, value in zip(out, row):
                    column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query_id", "qkey", "vec_id", "score", "evaluated", "candidates"])

    # as many partitions on both sides: costly cells of few bytes are not folded together
    cells = max(1, min(len(kinds) * blocks * query_blocks, 16 * spark.sparkContext.defaultParallelism + blocks * query_blocks // 16))
    key = ["d", "qb", "xb"]
    best = (queries.repartition(cells, *key).groupBy(*key).cogroup(candidates.repartition(cells, *key).groupBy(*key))
            .applyInArrow(cell, "query_id long, qkey long, vec_id long, score long, evaluated long, candidates long"))
    by_query = Window.partitionBy("query_id", "qkey")
    by_rank = by_query.orderBy(F.desc_nulls_last("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(by_rank)).withColumn("evaluated", F.sum("evaluated").over(by_query))
            .withColumn("candidates", F.sum("candidates").over(by_query)).filter(F.col("vec_id").isNotNull() & (F.col("rank") <= k))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "evaluated", "candidates"))
