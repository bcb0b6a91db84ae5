"""Exact kNN by filter and refine: distances in a reduced space bound those in the full one from below.

Principal axes are orthonormal, so a projection onto the first of them never lengthens a distance. For
each test row the train rows are taken by growing reduced distance and compared in full, until the next
reduced distance is beyond the k-th full distance found (optimal multi-step search): what is left cannot
be nearer. All rows equal those of :func:`vecforge.operators.knn.neighbors`; only the share of pairs that
are compared in full depends on how much of the variance the axes hold.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.operators import knn, pca
from vecforge.operators.blocks import BlockGrid, lay_out, plan_grid

ORTHONORMAL = 1e-9   # axes further from orthonormal than this are refused
FIRST_LOOK = 2       # candidates in the first look, in multiples of k; doubled from look to look


def multi_step(low: np.ndarray, full, k: int, slack: np.ndarray):
    """``(row, column, distance, refined)`` of each row's k nearest columns, and how many were compared in full.

    ``low`` has lower bounds, ``full(rows, columns)`` the distances. A column is left out only if its bound
    is above the row's k-th distance by more than ``slack``; equal bounds are compared, for ties go by id.
    """
    n, m = low.shape
    order = np.argsort(low, axis=1)
    bound = np.take_along_axis(low, order, axis=1)
    best = np.full((n, k), np.inf)             # the k least distances so far
    rows, columns, scores = [], [], []
    refined, at, look = np.zeros(n, np.int64), 0, max(FIRST_LOOK * k, k)
    live = np.arange(n)
    while len(live) and at < m:
        upto = min(m, at + look)
        reach = bound[live, at:upto] <= (best[live, -1] + slack[live])[:, None]
        r, c = np.nonzero(reach)
        r, c = live[r], order[live[r], at + c]
        score = full(r, c)
        rows.append(r)
        columns.append(c)
        scores.append(score)
        np.add.at(refined, r, 1)
        wide = np.full((len(live), upto - at), np.inf)
        wide[reach] = score
        best[live] = np.sort(np.concatenate([best[live], wide], axis=1), axis=1)[:, :k]
        at, look = upto, 2 * look
        if at < m:
            live = live[bound[live, at] <= best[live, -1] + slack[live]]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), refined
    rows, columns, scores = map(np.concatenate, (rows, columns, scores))
    keep = scores <= best[rows, -1]
    return rows[keep], columns[keep], scores[keep], refined


def _cell(k: int, hidden: list[str]):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out_r = out_c = np.zeros(0, np.int64)
        score, rank, refined = np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            q, t = knn._matrix(left.column("qv")), knn._matrix(right.column("tv"))
            qp, tp = knn._matrix(left.column("qp")), knn._matrix(right.column("tp"))
            if q.shape[1] != t.shape[1]:
                raise ValueError("query and reference vectors differ in length")
            ids = right.column("tid").to_numpy()
            parts = []
            step = max(1, knn._CHUNK_CELLS // len(t))
            squares = np.einsum("ij,ij->i", tp, tp)
            longest = float(np.einsum("ij,ij->i", t, t).max())
            for begin in range(0, len(q), step):
                own, part = q[begin:begin + step], qp[begin:begin + step]
                near = np.einsum("ij,ij->i", part, part)[:, None] + squares[None, :] - 2 * part @ tp.T
                scale = np.einsum("ij,ij->i", own, own) + longest
                slack = np.sqrt((16.0 * q.shape[1] + 64.0) * np.finfo(float).eps * scale) + ORTHONORMAL * np.sqrt(scale)
                full = lambda r, c: np.sqrt(knn._fold_sq_diff(own, t, r, c))  # noqa: E731 - used within the step
                r, c, s, seen = multi_step(np.sqrt(np.maximum(near, 0)), full, min(k, len(t)), slack)
                order, ranks = knn._ranked(r, s, ids[c], k, False)
                parts.append((r[order] + begin, c[order], s[order], ranks, seen[r[order]]))
            out_r, out_c, score, rank, refined = (np.concatenate(x) for x in zip(*parts))
        take = pa.array(out_r, pa.int64())
        columns = {"test_id": left.column("qid").take(take)}
        for name in hidden:
            columns[name] = left.column(name).take(take)
        columns["train_id"] = right.column("tid").take(pa.array(out_c, pa.int64()))
        columns["train_label"] = right.column("label").take(pa.array(out_c, pa.int64()))
        columns["distance"] = pa.array(score)
        columns["rank"] = pa.array(rank.astype(np.int32))
        columns["refined"] = pa.array(refined, pa.int64())
        return pa.table(columns)

    return run


def neighbors(test: DataFrame, train: DataFrame, k: int, width: int, *, test_id: str = "id", train_id: str = "id", vec: str = "vec",
              label: str = "label", carry: list[str] | tuple[str, ...] = (), grid: BlockGrid | None = None) -> DataFrame:
    """``test_id, *carry, train_id, train_label, distance, rank, refined``: Euclidean neighbours, exact.

    Axes are fitted on the well formed train rows; ``width`` of them are used. ``refined`` is how many train rows
    the test row was compared with in full, over all cells.

    Vectors are those of :mod:`vecforge.operators.knn`; malformed ones (and nulls) have no neighbours and
    are none here. Equal test rows are searched once and given back as often as they came. An empty side
    gives no rows.
    """
    knn._check(knn.EUCLIDEAN, k)
    carry, k = list(carry), int(k)
    q, r = knn._inputs(test, train, test_id, train_id, vec, label, carry)
    q, r = (side.filter(knn.usable(F.col(v), knn.EUCLIDEAN)) for side, v in ((q, "qv"), (r, "tv")))
    q, hidden = knn._distinct_queries(q, carry), [*carry, *knn.HIDDEN]
    n_q, n_r, dims, _ = knn._side_stats(q, r)
    schema = knn._output_schema(q, r, knn.EUCLIDEAN, hidden).add("refined", T.LongType())
    if not n_r or not n_q:
        return knn._given_back(q.sparkSession.createDataFrame([], schema))
    model = pca.fit(r.select(F.col("tv").alias("vec")), min(width, dims))
    axes = model.pc.toArray()
    if np.abs(axes.T @ axes - np.eye(axes.shape[1])).max() > ORTHONORMAL:
        raise ValueError("the fitted axes are not orthonormal")
    q, r = pca.project(model, q, "qv", "qp"), pca.project(model, r, "tv", "tp")
    grid = grid or plan_grid(n_q, n_r, 2 * dims, knn._parallelism(q))
    left, right = lay_out(q, r, grid, "qid", "tid", grid.partitions(knn._parallelism(q)), (F.col("tv"),))
    cells = left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(_cell(k, hidden), schema)
    if grid.ref_blocks > 1:
        by = Window.partitionBy("test_id", "_query")
        seen = F.sum(F.when(F.col("rank") == 1, F.col("refined")).otherwise(0)).over(by)
        best = by.orderBy(F.col("distance").asc(), F.col("train_id").asc())
        cells = (cells.withColumn("refined", seen).withColumn("rank", F.row_number().over(best).cast("int"))
                 .filter(F.col("rank") <= k).select(*[f.name for f in schema]))
    return knn._given_back(cells)


def share_refined(found: DataFrame, n_train: int) -> DataFrame:
    """``queries, compared, share``: pairs compared in full, and their share of all pairs, from :func:`neighbors`."""
    first = found.filter(F.col("rank") == 1)
    return first.agg(F.count(F.lit(1)).alias("queries"), F.sum("refined").alias("compared")).select(
        "queries", "compared", (F.col("compared") / (F.col("queries") * F.lit(float(n_train)))).alias("share"))


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
