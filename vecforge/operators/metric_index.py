"""A written metric index: pivot cells as files, opened for one query by bound.

``build`` writes the rows as one folder a cell and a small table of the cells: pivot, rows, least and
largest distance to the pivot. ``neighbors`` reads that table, opens the query's nearest cells until they
hold ``k`` rows, and then only the cells whose lower bound is within the k-th distance found. The answer
is exact and equals :func:`vecforge.operators.knn.single_query_neighbors` on the whole table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecforge.operators import knn
from vecforge.operators.cells import CELL_ROWS, Cells, assign, cells_of, distances, fit_cells, placed

MALFORMED = -1  # the cell of rows that have no score with any other; opened only if the others are too few


def build(train: DataFrame, path: str, metric: str = knn.EUCLIDEAN, *, train_id: str = "id", vec: str = "vec",
          label: str = "label", cell_rows: int = CELL_ROWS) -> None:
    """Write the index of ``train`` to ``path`` (shared storage). Rows with a null vector are left out."""
    spark = train.sparkSession
    knn._check(metric, 1)
    _, r = knn._inputs(train, train, train_id, train_id, vec, label, [])
    r = r.filter(F.col("tv").isNotNull())
    good = r.filter(knn.usable(F.col("tv"), metric))
    size = good.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("tv")).alias("d"), F.min(F.size("tv")).alias("least")).first()
    if size["least"] != size["d"]:
        raise ValueError("vectors in one kNN input must all have the same length")
    dims = int(size["d"] or 1)
    pivots = fit_cells(good, metric, int(size["n"]), dims, cell_rows)
    bad = r.filter(~knn.usable(F.col("tv"), metric)).withColumn("cell", F.lit(MALFORMED)).withColumn("away", F.lit(0.0))
    rows = assign(good, pivots, metric).unionByName(bad.select("tid", "tv", "label", "cell", "away"))
    # one task a cell and hash bucket, so that a cell is a few files and a hot one is not written by one task
    parts = max(1, int(size["n"]) // cell_rows)
    (rows.repartition(parts, "cell", F.pmod(F.xxhash64("tid", "tv"), F.lit(1 + parts // 64))).write.partitionBy("cell").parquet(f"{path}/rows"))
    cells = cells_of(spark.read.parquet(f"{path}/rows").filter(F.col("cell") >= 0), pivots, metric)
    table = [(i, metric, [float(x) for x in pivots[i]], int(cells.rows[i]), float(cells.low[i]), float(cells.high[i])) for i in range(len(pivots))]
    (spark.createDataFrame(table, "cell int, metric string, pivot array<double>, rows long, low double, high double")
     .coalesce(1).write.parquet(f"{path}/cells"))


@dataclass
class Found:
    """The neighbours, and how many cells and rows were opened of how many."""

    neighbors: DataFrame
    cells_opened: int
    cells: int
    rows_opened: int
    rows: int


def neighbors(spark: SparkSession, path: str, query: list[float], k: int) -> Found:
    """The ``k`` rows nearest to one vector: ``train_id, train_label, score, rank``, exact."""
    table = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # a row a cell, of which there are few
    metric = table[0]["metric"]
    knn._check(metric, k)
    cells = Cells(metric, np.array([r["pivot"] for r in table]), np.array([r["rows"] for r in table]),
                  np.array([r["low"] for r in table]), np.array([r["high"] for r in table]))
    total = int(cells.rows.sum())
    stored = spark.read.parquet(f"{path}/rows")

    def searched(which):
        part = stored if which is None else stored.filter(F.col("cell").isin([int(c) for c in which]))
        return knn.single_query_neighbors(part, query, k, metric, train_id="tid", vec="tv", label="label")

    point = np.array([query], dtype=float)
    squares = float((point ** 2).sum()) if np.isfinite(point).all() else np.inf
    if total < k or not squares < knn.NORM_LIMIT or (metric == knn.COSINE and squares == 0):
        return Found(searched(None), int((cells.rows > 0).sum()), int((cells.rows > 0).sum()), total, total)
    point = placed(point, metric)
    away = distances(point, cells.pivots)
    first = [int(c) for c in cells.first(away, k)[0]]
    found = searched(first).collect()  # k rows
    score = max(r["distance"] for r in found) if metric == knn.EUCLIDEAN else min(r["similarity"] for r in found)
    theta = score if metric == knn.EUCLIDEAN else float(np.sqrt(max(0.0, 2 - 2 * score) + 1e-12))
    within = cells.bounds(away)[0] <= theta * (1 + 1e-9) + 4 * cells.slack(point)[0]
    opened = sorted(set(np.flatnonzero(within).tolist()) | set(first))
    held = int(cells.rows[opened].sum())
    return Found(searched(opened), len(opened), int((cells.rows > 0).sum()), held, total)


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
