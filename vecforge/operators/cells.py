"""Exact kNN join by pivot cells: a query goes only to the cells that can hold one of its neighbours.

The grid of :mod:`vecforge.operators.blocks` sends every query to every block of train rows. Here train
rows are dealt out by their nearest pivot (a Voronoi cell), and each cell's least and largest distance to
its pivot is known. A query is first searched in its nearest cells, as many as hold ``k`` rows; the k-th
distance found bounds its neighbours, and of the other cells it visits those whose lower bound is no
larger. For the distance of a query q to any row of cell j the bounds are

* ``|q - p_j| - high_j`` and ``low_j - |q - p_j|`` (triangle inequality), and
* ``(|q - p_j|^2 - |q - p_i|^2) / (2 |p_i - p_j|)`` for q's nearest pivot i (a cell lies behind a plane).

Cells are put together to groups of bounded size, and a query is copied once for each group of which it
visits a cell, whatever their number; so where bounds rule nothing out the copies are those of the grid.

Cosine neighbours are those of the vectors at unit length. Scores are computed by the kernel of
:mod:`vecforge.operators.knn` on the vectors as given, so all rows equal those of the other plans.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.operators import knn
from vecforge.operators.blocks import MAX_BLOCK_BYTES, MIN_CELL_WORK, MIN_PARTITIONS_PER_SLOT, plan_grid
from vecforge.session import scratch_path

# Sizes of cells, and what of the train side reaches the driver (a sample for the pivots,
# and one row of statistics a cell).
CELL_ROWS = 8192
MAX_PIVOTS = 1024
SAMPLE_PER_PIVOT = 24
ROUNDS = 6
QUERY_ROWS = 16384      # queries of one group that meet in a task; more are dealt out again
PLACED_AT_ONCE = 1024   # rows whose distances to all pivots a task holds
SEARCHED_AT_ONCE = 2048  # queries that are searched in the cells any of them visits


def placed(rows: np.ndarray, metric: str) -> np.ndarray:
    """The points whose distances order like the metric."""
    if metric == knn.EUCLIDEAN:
        return rows
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", points, points)[:, None] + np.einsum("ij,ij->i", pivots, pivots)[None, :]
    return np.sqrt(np.maximum(squares - 2 * points @ pivots.T, 0))


def choose_pivots(points: np.ndarray, count: int, seed: int = 3) -> np.ndarray:
    """Centres of ``count`` groups of the sample (a few rounds of k-means); fewer if fewer points differ."""
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    pivots = points[rng.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(ROUNDS):
        of = distances(points, pivots).argmin(axis=1)
        sizes = np.bincount(of, minlength=len(pivots))
        total = np.zeros_like(pivots)
        np.add.at(total, of, points)
        filled = sizes > 0
        pivots = np.concatenate([total[filled] / sizes[filled, None], pivots[~filled]])
    return pivots


@dataclass
class Cells:
    """Pivots, and of each cell its rows and the least and largest distance to its pivot."""

    metric: str
    pivots: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def slack(self, points: np.ndarray) -> np.ndarray:
        """What rounding can take from a distance computed as a product, by point."""
        scale = np.einsum("ij,ij->i", points, points) + float(np.einsum("ij,ij->i", self.pivots, self.pivots).max(initial=0))
        return np.sqrt((8.0 * points.shape[1] + 32.0) * np.finfo(float).eps * scale)

    def first(self, away: np.ndarray, k: int) -> list[np.ndarray]:
        """Each query's nearest cells, as many as hold ``k`` rows."""
        order = np.argsort(away, axis=1, kind="stable")
        upto = np.cumsum(self.rows[order], axis=1)
        need = (upto < k).sum(axis=1) + 1
        return [own[:n] for own, n in zip(order, need)]

    def bounds(self, away: np.ndarray) -> np.ndarray:
        """Lower bounds (before rounding) of each query's distances to the rows of each cell; inf for empty cells."""
        nearest = away.argmin(axis=1)
        apart = distances(self.pivots, self.pivots)[nearest]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (away ** 2 - (away[np.arange(len(away)), nearest] ** 2)[:, None]) / (2 * apart)
        bound = np.maximum(np.maximum(away - self.high, self.low - away), 0)
        bound = np.maximum(bound, np.where(apart > 0, plane, 0))
        return np.where(self.rows > 0, bound, np.inf)


def _vectors(column) -> np.ndarray:
    return knn._matrix(column)


def fit_cells(train: DataFrame, metric: str, n_rows: int, dims: int, cell_rows: int = CELL_ROWS) -> np.ndarray:
    """Pivots for ``train`` (column ``tv``, usable rows only), from a bounded sample of it."""
    count = max(1, min(MAX_PIVOTS, math.ceil(n_rows / cell_rows)))
    wanted = SAMPLE_PER_PIVOT * count
    sample = train.select("tv").sample(min(1.0, 1.3 * wanted / max(1, n_rows)), 17).limit(2 * wanted).toArrow()
    points = _vectors(sample.column("tv")) if sample.num_rows else np.zeros((1, dims))
    return choose_pivots(placed(points, metric), count)


def assign(train: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    """``train`` (``tid, tv, label``) with each row's cell and its distance to the cell's pivot."""
    names = ["tid", "tv", "label", "cell", "away"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                points = placed(_vectors(batch.column(1)), metric)
                cell = np.concatenate([distances(points[i:i + PLACED_AT_ONCE], pivots).argmin(axis=1)
                                       for i in range(0, len(points), PLACED_AT_ONCE)])
                away = np.sqrt(((points - pivots[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(away)], names)

    kind = train.schema["label"].dataType.simpleString()
    return train.select("tid", "tv", "label").mapInArrow(run, f"tid long, tv array<double>, label {kind}, cell int, away double")


def cells_of(assigned: DataFrame, pivots: np.ndarray, metric: str) -> Cells:
    """The statistics of all cells: one small row each."""
    found = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.min("away").alias("low"), F.max("away").alias("high")).collect()
    m = len(pivots)
    rows, low, high = np.zeros(m, np.int64), np.zeros(m), np.zeros(m)
    for r in found:
        rows[r["cell"]], low[r["cell"]], high[r["cell"]] = r["rows"], r["low"], r["high"]
    return Cells(metric, pivots, rows, low, high)


def grouped(rows: np.ndarray, group_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each cell's first group and how many it has: small cells share one, a cell above ``group_rows`` has its own."""
    first, blocks = np.zeros(len(rows), np.int64), np.maximum(1, -(-rows // group_rows))
    upto, held = 0, 0
    for cell, (n, cut) in enumerate(zip(rows, blocks)):
        if held and (cut > 1 or held + n > group_rows):
            upto, held = upto + 1, 0
        first[cell] = upto
        if cut > 1:
            upto += int(cut)
        else:
            held += int(n)
    return first, blocks


def _group_function(k: int, metric: str, hidden: list[str], members: dict[int, np.ndarray]):
    """Top k of every query among the rows of a group, of which cells that no query near it visits are left out."""
    name = knn.score_name(metric)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32))]
        if left.num_rows and right.num_rows:
            own = members[left.column("grp")[0].as_py()]
            packed = np.frombuffer(b"".join(left.column("visits").to_pylist()), np.uint8).reshape(left.num_rows, -1)
            visits = np.unpackbits(packed, axis=1, count=len(own)).view(bool)
            queries, vectors, tids = _vectors(left.column("qv")), _vectors(right.column("tv")), right.column("tid").to_numpy()
            at = np.searchsorted(own, right.column("cell").to_numpy())
            ref = None
            order = np.argsort(visits.argmax(axis=1), kind="stable")  # neighbours visit the same cells
            for begin in range(0, len(order), SEARCHED_AT_ONCE):
                part = order[begin:begin + SEARCHED_AT_ONCE]
                rows = np.flatnonzero(visits[part].any(axis=0)[at])
                if not len(rows):
                    continue
                if ref is None or not np.array_equal(rows, held):
                    held, ref = rows, knn.Reference(vectors[rows], tids[rows], metric)
                r, c, score, rank = knn.cell_top_k(queries[part], ref, k, False)
                out.append((part[r], rows[c], score, rank))
        r, c, score, rank = (np.concatenate(x) for x in zip(*out))
        r, c = pa.array(r, pa.int64()), pa.array(c, pa.int64())
        columns = {"test_id": left.column("qid").take(r), **{x: left.column(x).take(r) for x in hidden},
                   "train_id": right.column("tid").take(c), "train_label": right.column("label").take(c),
                   name: pa.array(score, pa.float64(), mask=np.isnan(score)), "rank": pa.array(rank, pa.int32())}
        return pa.table(columns)

    return run


@dataclass
class CellJoin:
    """The neighbours, and the copies of rows that were made to find them (``report``)."""

    neighbors: DataFrame
    report: DataFrame


def join(test: DataFrame, train: DataFrame, k: int, metric: str = knn.EUCLIDEAN, *, test_id: str = "id", train_id: str = "id",
         vec: str = "vec", label: str = "label", carry: list[str] | tuple[str, ...] = (), cell_rows: int = CELL_ROWS,
         group_rows: int | None = None) -> CellJoin:
    """The ``k`` nearest train rows of every test row, as :func:`vecforge.operators.knn.neighbors` gives them.

    ``report`` has one row: ``queries, train_rows, cells, query_copies, train_copies, grid_copies``, the
    last for a grid of blocks of ``cell_rows`` rows. Cells are searched in groups of up to ``group_rows`` rows (a
    block's bytes, unless given). A cell of more rows (equal vectors, say) is cut into groups by hash, and a
    group that very many queries visit is dealt out again by query.

    Malformed train rows come last by id (null scores), so they count only for malformed test rows, and
    where fewer than ``k`` train rows are well formed; then the grid answers.
    """
    knn._check(metric, k)
    carry, k = list(carry), int(k)
    spark = test.sparkSession

    def written(frame, name):
        path = scratch_path(spark, f"cells-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    q, r = knn._inputs(test, train, test_id, train_id, vec, label, carry)
    hidden = [*carry, *knn.HIDDEN]
    queries = written(knn._distinct_queries(q.filter(F.col("qv").isNotNull()), carry).withColumn("good", knn.usable(F.col("qv"), metric)), "queries")
    good = r.filter(knn.usable(F.col("tv"), metric))
    size = good.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("tv")).alias("d"), F.min(F.size("tv")).alias("least")).first()
    n_rows, dims = int(size["n"]), int(size["d"] or 1)
    if size["least"] not in (None, dims):
        raise ValueError("vectors in one kNN input must all have the same length")
    asked = queries.agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good")).first()
    grid = plan_grid(int(asked["n"]), n_rows, dims, 1, cell_rows)
    grid_copies = int(asked["n"]) * grid.ref_blocks + n_rows * grid.query_blocks

    def reported(cells, query_copies, train_copies):
        return spark.createDataFrame([(int(asked["n"]), n_rows, cells, query_copies, train_copies, grid_copies)],
                                     "queries long, train_rows long, cells long, query_copies long, train_copies long, grid_copies long")

    plain = dict(test_id=test_id, train_id=train_id, vec=vec, label=label)
    if n_rows < k or not asked["good"]:
        whole = knn.neighbors(test, train, k, metric, method="block", carry=carry, **plain)
        return CellJoin(whole, reported(0, 0, 0))
    pivots = fit_cells(good, metric, n_rows, dims, cell_rows)
    assigned = written(assign(good, pivots, metric), "train")
    cells = cells_of(assigned, pivots, metric)
    columns = ["qid", "qv", *hidden]
    schema = knn._output_schema(queries.withColumnRenamed("qid", "test_id"), r, metric, hidden)
    group_rows = group_rows or max(1, MAX_BLOCK_BYTES // (8 * dims))
    group, blocks = grouped(cells.rows, group_rows)
    members: dict[int, list[int]] = {}
    for c in np.flatnonzero(cells.rows > 0):
        for g in range(int(group[c]), int(group[c] + blocks[c])):
            members.setdefault(g, []).append(int(c))
    members = {g: np.array(own) for g, own in members.items()}
    places = F.broadcast(spark.createDataFrame([(i, int(g), int(n)) for i, (g, n) in enumerate(zip(group, blocks))],
                                               "cell int, first int, blocks int"))  # MAX_PIVOTS rows at most
    dealt = (assigned.join(places, "cell")
             .withColumn("grp", (F.col("first") + F.pmod(F.xxhash64("tid", "tv"), F.col("blocks"))).cast("int"))
             .select("tid", "tv", "label", "cell", "grp"))

    def visiting(batches, chosen):
        """A row for each query and group that has any of the cells ``chosen(points, thetas)`` says, with a bit a cell."""
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.schema.get_field_index
            points = placed(_vectors(batch.column(at("qv"))), metric)
            if points.shape[1] != dims:
                raise ValueError("query and reference vectors differ in length")
            for begin in range(0, len(points), PLACED_AT_ONCE):
                upto = begin + PLACED_AT_ONCE
                theta = batch.column(at("theta")).to_numpy()[begin:upto] if at("theta") >= 0 else None
                mask = chosen(points[begin:upto], theta)
                for g, own in members.items():
                    row = np.flatnonzero(mask[:, own].any(axis=1))
                    if len(row):
                        bits = np.packbits(mask[row][:, own], axis=1)
                        take = pa.array(begin + row, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(at(c)).take(take) for c in columns]
                            + [pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(np.full(len(row), g, np.int32))],
                            [*columns, "visits", "grp"])

    def nearest(points, _):
        return first_of(distances(points, pivots))

    def first_of(away):
        mask = np.zeros(away.shape, bool)
        for row, own in zip(mask, cells.first(away, k)):
            row[own] = True
        return mask

    def within(points, theta):
        """The cells that the k-th distance found does not rule out, if there are any beyond the first ones."""
        away = distances(points, pivots)
        first = first_of(away)
        possible = cells.bounds(away) <= (theta * (1 + 1e-9) + 4 * cells.slack(points))[:, None]
        return (possible | first) & (possible & ~first).any(axis=1)[:, None]

    visit_schema = T.StructType([*(queries.schema[c] for c in columns), T.StructField("visits", T.BinaryType()),
                                 T.StructField("grp", T.IntegerType())])

    def searched(visits):
        """Top k of every query in each group it visits."""
        load = {r["grp"]: r["n"] for r in visits.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a group
        work = sum(load.values()) * min(n_rows, group_rows) * dims
        slots = spark.sparkContext.defaultParallelism
        wanted = max(1, min(MIN_PARTITIONS_PER_SLOT * slots, math.ceil(work / MIN_CELL_WORK["block"])))
        most = min(QUERY_ROWS, math.ceil(max(1, sum(load.values())) / wanted))
        table = [(g, math.ceil(n / most)) for g, n in sorted(load.items())]
        slices = F.broadcast(spark.createDataFrame(table, "grp int, slices int"))
        left = visits.join(slices, "grp").withColumn("slice", F.pmod(F.col("_query"), F.col("slices")).cast("int"))
        right = dealt.join(slices, "grp").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        parts = max(1, sum(n for _, n in table))
        return (left.select(*columns, "visits", "grp", "slice").repartition(parts, "grp", "slice").groupBy("grp", "slice")
                .cogroup(right.select("tid", "tv", "label", "cell", "grp", "slice").repartition(parts, "grp", "slice").groupBy("grp", "slice"))
                .applyInArrow(_group_function(k, metric, hidden, members), schema))

    start = written(queries.filter("good").select(*columns).mapInArrow(lambda b: visiting(b, nearest), visit_schema), "first")
    found = written(searched(start), "found")
    keys = ["test_id", "_query"]
    best = Window.partitionBy(*keys).orderBy(knn.score_order(metric), F.col("train_id").asc())
    top = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    score = F.col(knn.score_name(metric))
    chord = score if metric == knn.EUCLIDEAN else F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * score) + F.lit(1e-12))
    theta = top.groupBy(*keys).agg(F.max(chord).alias("theta")).withColumnRenamed("test_id", "qid")
    open_ = queries.filter("good").select(*columns).join(theta, ["qid", "_query"])
    more = written(open_.mapInArrow(lambda b: visiting(b, within), visit_schema), "more")
    # a query with more cells is searched in its first ones again, so that its later rows stand for all
    both = top.withColumn("stage", F.lit(0)).unionByName(searched(more).withColumn("stage", F.lit(1)))
    last = both.withColumn("last", F.max("stage").over(Window.partitionBy(*keys))).filter("stage = last")
    ranked = last.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    out = knn._given_back(ranked.select(*[f.name for f in schema]))
    if asked["good"] < asked["n"]:  # malformed test rows: the least ids, of all train rows
        bad = q.filter(F.col("qv").isNotNull() & ~knn.usable(F.col("qv"), metric)).withColumnRenamed("qid", "id").withColumnRenamed("qv", "vec")
        few = r.filter(F.col("tv").isNotNull()).orderBy("tid").limit(k).select(F.col("tid").alias("id"), F.col("tv").alias("vec"), "label")
        out = out.unionByName(knn.neighbors(bad, few, k, metric, method="block", carry=carry))
    copies = start.count() + more.count()
    return CellJoin(out, reported(int((cells.rows > 0).sum()), copies, n_rows))


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
