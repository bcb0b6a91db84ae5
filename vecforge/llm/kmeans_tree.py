"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

Vectors get one more coordinate that brings all to one norm, so that the nearest by distance is the one
of largest inner product. A tree of k-means centres over a sample tells every row its leaf. A query
walks the tree with a priority queue: the nearest unopened centre is opened next, so leaves come in the
order in which they promise neighbours. How many leaves are visited is measured: queries of a
calibration sample are answered exactly, and visits widen until their neighbours are found.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecforge.session import scratch_path

SAMPLE_ROWS = 1 << 15   # rows (about) that a tree is fitted on; they and the tree are all that reaches the driver
BRANCHES = 8            # children of a node
LEAF_SAMPLE = 48        # a node of no more sampled rows is a leaf
ROUNDS = 8              # of k-means at a node
CALIBRATION = 256       # queries (about) that are answered exactly
RECALL = 0.95           # of their neighbours that the visited leaves must hold
GROUP_ROWS = 8192       # rows searched in one cell: small leaves together, a large one in blocks
QUERY_BLOCK = 4096      # queries of one cell
DENSE = 8               # a cell of which queries visit this part or more is searched as one product
EPS = float(np.finfo(np.float64).eps)


def usable(vector: Column) -> Column:
    """Neither null nor zero, nor holding a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(arr):
        return np.zeros((0, 0))
    return arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(arr), -1)


def lifted(rows: np.ndarray, radius2: float) -> np.ndarray:
    return np.concatenate([rows, np.sqrt(np.maximum(radius2 - np.einsum("ij,ij->i", rows, rows), 0))[:, None]], axis=1)


def lifted_queries(rows: np.ndarray, radius2: float) -> np.ndarray:
    """Queries at the rows' norm (their own length does not change an order) with a zero more."""
    scale = math.sqrt(radius2) / np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return np.concatenate([rows * scale[:, None], np.zeros((len(rows), 1))], axis=1)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", centres, centres)[None, :] - 2 * points @ centres.T).argmin(axis=1)


def _k_means(points: np.ndarray, count: int, rng) -> np.ndarray:
    """Centres of ``points``; fewer than ``count`` if so few differ."""
    centres = points[[rng.integers(len(points))]]
    gap = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < count and gap.max() > 0:
        new = points[[rng.choice(len(points), p=gap / gap.sum())]]
        centres = np.concatenate([centres, new])
        gap = np.minimum(gap, ((points - new) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        of = _nearest(points, centres)
        sizes = np.bincount(of, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, of, points)
        filled = sizes > 0
        centres = np.concatenate([total[filled] / sizes[filled, None], centres[~filled]])
    return centres


@dataclass
class KMeansTree:
    """Nodes by number: centres, children, and the number of a leaf among leaves (in order of depth-first visits)."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: np.ndarray  # -1 for inner nodes
    leaves: int

    @staticmethod
    def fit(points: np.ndarray, seed: int = 5) -> "KMeansTree":
        rng = np.random.default_rng(seed)
        centres, children, leaf, leaves = [points.mean(axis=0)], [[]], [-1], 0
        waiting = [(0, points)]
        while waiting:
            node, own = waiting.pop()
            inner = _k_means(own, BRANCHES, rng) if len(own) > LEAF_SAMPLE else own[:1]
            of = _nearest(own, inner)
            parts = [own[of == i] for i in range(len(inner))]
            if sum(map(bool, map(len, parts))) < 2:  # small, or all the same
                leaf[node], leaves = leaves, leaves + 1
                continue
            for centre, part in zip(inner, parts):
                if len(part):
                    children[node].append(len(centres))
                    centres.append(centre)
                    children.append([])
                    leaf.append(-1)
                    waiting.append((len(centres) - 1, part))
        return KMeansTree(np.array(centres), children, np.array(leaf), leaves)

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf that every row falls into, by the nearest child at each node."""
        out, waiting = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            own = self.children[node]
            if not own:
                out[rows] = self.leaf[node]
                continue
            of = _nearest(points[rows], self.centres[own])
            waiting += [(child, rows[of == i]) for i, child in enumerate(own) if (of == i).any()]
        return out

    def visits(self, queries: np.ndarray, count: int) -> list[list[int]]:
        """The first ``count`` leaves of each query, best bin first."""
        far = np.einsum("ij,ij->i", self.centres, self.centres)[None, :] - 2 * queries @ self.centres.T
        out = []
        for row in far.tolist():
            queue, found = [(row[0], 0)], []
            while queue and len(found) < count:
                _, node = heapq.heappop(queue)
                if self.leaf[node] >= 0:
                    found.append(int(self.leaf[node]))
                for child in self.children[node]:
                    heapq.heappush(queue, (row[child], child))
            out.append(found)
        return out


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, summed from the first component on: equal vectors give equal scores anywhere."""
    acc = np.zeros(len(a))
    for j in range(a.shape[1]):
        acc = acc + a[:, j] * b[:, j]
    return acc


def best_of(queries: np.ndarray, query_ids, rows: np.ndarray, ids, k: int, allowed=None, floor=None):
    """``(query row, row, score)`` of the ``k`` largest inner products of other ids, exact to the last bit.

    ``allowed(first, last)`` says which rows these queries may meet; with ``floor`` a query's products below
    its floor are left out.
    """
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    step = max(1, (1 << 22) // max(1, len(rows)))
    longest = np.sqrt(np.einsum("ij,ij->i", rows, rows).max(initial=0))
    for at in range(0, len(queries), step):
        q, own = queries[at:at + step], query_ids[at:at + step]
        near = q @ rows.T
        near[own[:, None] == ids[None, :]] = -np.inf
        if allowed is not None:
            near[~allowed(at, at + len(q))] = -np.inf
        slack = (4 * q.shape[1] + 16) * EPS * np.sqrt(np.einsum("ij,ij->i", q, q)) * longest
        least = np.partition(near, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(q), -np.inf)
        if floor is not None:
            least = np.maximum(least, floor[at:at + len(q)])
        r, c = np.nonzero((near >= (least - 2 * slack)[:, None]) & (near > -np.inf))
        score = _fold(q[r], rows[c])
        order = np.lexsort((ids[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        begin = np.searchsorted(r, np.arange(len(q)))
        keep = np.arange(len(r)) - begin[r] < k
        for held, x in zip(out, (r[keep] + at, c[keep], score[keep])):
            held.append(x)
    return [np.concatenate(x) for x in out]


def _sampled(rows: DataFrame, columns: list[str], total: int, wanted: int, seed: int):
    return rows.select(*columns).sample(min(1.0, 1.2 * wanted / total), seed).limit(2 * wanted).toArrow() if total else None


@dataclass
class Fitted:
    """What tasks need to place rows and queries of one vector length."""

    tree: KMeansTree
    radius2: float
    visits: int
    recall: float                 # of the calibration queries, with that many visits
    first_group: np.ndarray       # by leaf
    blocks: np.ndarray            # groups that a leaf is cut into; 1 for one that shares a group


def _calibrated(tree: KMeansTree, radius2: float, queries: np.ndarray, true_rows: list[np.ndarray], recall: float):
    """``(visits, recall)``: the visits double until the leaves hold that share of the true neighbours."""
    count = 1
    order = tree.visits(lifted_queries(queries, radius2), tree.leaves) if len(queries) else []
    where = []
    for own, rows in zip(order, true_rows):
        place = np.zeros(tree.leaves, np.int64)
        place[own] = np.arange(len(own))
        where.append(place[tree.leaf_of(lifted(rows, radius2))] if len(rows) else np.zeros(0, np.int64))
    where = np.sort(np.concatenate(where)) if where else np.zeros(0, np.int64)
    if not len(where):
        return tree.leaves, 1.0
    while count < tree.leaves and np.mean(where < count) < recall:
        count = min(2 * count, tree.leaves)
    low = count // 2
    while count - low > 1:  # the least that does, between the last two widths
        mid = (low + count) // 2
        low, count = (low, mid) if np.mean(where < mid) >= recall else (mid, count)
    return count, float(np.mean(where < count))


def search(vectors: DataFrame, id_col: str, vec_col: str, query_where: Column, k: int, recall: float = RECALL,
           sample_rows: int = SAMPLE_ROWS, calibration: int = CALIBRATION, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score, visits``: the ``k`` nearest found for each query, nearest first.

    Nearness is the inner product in double precision; ``score`` is exactly that of the two vectors. Rows
    that satisfy ``query_where`` are queries, every other usable row is a candidate (all rows are indexed),
    and a query never meets rows of its own id. Vectors are compared with those of their own length.

    The tree is fitted on about ``sample_rows`` rows, and ``visits`` (leaves a query opens) is the least
    that holds ``recall`` of the exact neighbours of about ``calibration`` queries; with a recall of 1 or
    more all leaves are opened and the result is exact. Leaves are searched in cells of bounded size:
    small leaves share one, a large one (many equal vectors, say) is cut into blocks by hash, and a cell
    that very many queries visit is dealt out again by query. A cell sends ``k`` rows a query on.

    Rows with a null id, or vectors that are null, zero or hold a null or non-finite component, take no
    part. Repeated rows are candidates each; a repeated query row gives one result; rows of one id with
    different vectors are queries of their own. Ties go by smaller id; fewer candidates give fewer rows;
    an empty table gives none; other columns are not read.
    """
    spark = vectors.sparkSession

    def written(frame, name):
        path = scratch_path(spark, f"tree-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    given = F.col(vec_col).cast("array<double>")
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(given)).select(
        F.col(id_col).cast("long").alias("id"), given.alias("v"), F.size(given).alias("d"),
        F.coalesce(query_where, F.lit(False)).alias("is_query"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    kinds = {r["d"]: r for r in rows.groupBy("d").agg(F.count("*").alias("n"), F.max(squares).alias("radius2"),
                                                      F.count_if("is_query").alias("queries")).collect()}  # one a length
    fitted: dict[int, Fitted] = {}
    placed = None
    for d, kind in kinds.items():
        own = rows.filter(F.col("d") == d)
        tree = KMeansTree.fit(lifted(_matrix(_sampled(own, ["v"], kind["n"], sample_rows, 11).column("v")), kind["radius2"])) \
            if kind["n"] else None
        fitted[d] = Fitted(tree, float(kind["radius2"]), tree.leaves, 1.0, None, None)

    def leaves(batches):
        for batch in batches:
            x, of = _matrix_rows(batch.column(1)), np.zeros(batch.num_rows, np.int64)
            widths = batch.column(2).to_numpy()
            for d in np.unique(widths):
                at = np.flatnonzero(widths == d)
                one = fitted[int(d)]
                of[at] = one.tree.leaf_of(lifted(x(at, int(d)), one.radius2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(of)], ["id", "v", "d", "is_query", "leaf"])

    placed = written(rows.mapInArrow(leaves, "id long, v array<double>, d int, is_query boolean, leaf long"), "rows")
    slots = 4 * spark.sparkContext.defaultParallelism
    group_rows = min(group_rows, max(512, math.ceil(sum(r["n"] for r in kinds.values()) / slots)))  # enough cells for all
    counts = {(r["d"], r["leaf"]): r["count"] for r in placed.groupBy("d", "leaf").count().collect()}  # one a leaf
    groups = 0
    for d, one in fitted.items():
        one.first_group, one.blocks = np.zeros(one.tree.leaves, np.int64), np.ones(one.tree.leaves, np.int64)
        held = group_rows
        for leaf in range(one.tree.leaves):
            n = counts.get((d, leaf), 0)
            if held + n > group_rows:
                groups, held = groups + 1, 0
            one.first_group[leaf] = groups - 1
            held += n
            if n > group_rows:
                one.blocks[leaf] = math.ceil(n / group_rows)
                groups, held = groups + int(one.blocks[leaf]) - 1, group_rows
        asked = placed.filter((F.col("d") == d) & F.col("is_query")).select("id", "v").distinct()
        if recall < 1 and one.tree.leaves > 1:
            one.visits, one.recall = _calibrate(placed.filter(F.col("d") == d), asked, one, k, recall, calibration)

    def group_of(batches):
        """A row's group: its leaf's, or one block of it by the row's hash."""
        for batch in batches:
            leaf, widths, spread = (batch.column(i).to_numpy() for i in (2, 3, 4))
            out = np.zeros(batch.num_rows, np.int64)
            for d in np.unique(widths):
                at, one = np.flatnonzero(widths == d), fitted[int(d)]
                out[at] = one.first_group[leaf[at]] + spread[at] % one.blocks[leaf[at]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out)], ["id", "v", "leaf", "group"])

    spread = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40))
    candidates = (placed.select("id", "v", "leaf", "d", spread.alias("spread"))
                  .mapInArrow(group_of, "id long, v array<double>, leaf long, group long"))

    def opened(batches):
        """A row for each query and group that holds leaves it visits."""
        for batch in batches:
            x, widths = _matrix_rows(batch.column(1)), batch.column(2).to_numpy()
            for d in np.unique(widths):
                at, one = np.flatnonzero(widths == d), fitted[int(d)]
                for begin in range(0, len(at), 512):
                    part = at[begin:begin + 512]
                    row, group, wanted = [], [], []
                    for i, own in zip(part, one.tree.visits(lifted_queries(x(part, int(d)), one.radius2), one.visits)):
                        by: dict[int, list] = {}
                        for leaf in own:
                            for block in range(int(one.blocks[leaf])):
                                by.setdefault(int(one.first_group[leaf]) + block, []).append(leaf)
                        row += [i] * len(by)
                        group += by.keys()
                        wanted += by.values()
                    take = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take), batch.column(1).take(take), batch.column(3).take(take), pa.array(group, pa.int64()),
                         pa.array(wanted, pa.list_(pa.int64()))], ["id", "v", "qkey", "group", "leaves"])

    parts = max(1, min(slots, math.ceil(sum(r["queries"] for r in kinds.values()) / 64)))  # few bytes, but much work
    asked = (placed.filter("is_query").select("id", "v", "d").distinct().withColumn("qkey", F.xxhash64("id", "v"))
             .repartition(parts, "qkey"))
    visits = written(asked.mapInArrow(opened, "id long, v array<double>, qkey long, group long, leaves array<long>"), "visits")
    load = written(visits.groupBy("group").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("long").alias("parts")), "load")
    cells = max(1, min(4 * spark.sparkContext.defaultParallelism, groups)) if groups < 4096 else max(4096, groups // 64)
    left = (visits.join(load, "group").withColumn("part", F.pmod(F.col("qkey"), F.col("parts")))
            .select("group", "part", "id", "v", "qkey", "leaves").repartition(cells, "group", "part"))
    right = (candidates.join(load, "group").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
             .select("group", "part", "id", "v", "leaf").repartition(cells, "group", "part"))
    best = left.groupBy("group", "part").cogroup(right.groupBy("group", "part")).applyInArrow(
        _cell(k), "query_id long, qkey long, vec_id long, score double")
    by_rank = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    most = max((one.visits for one in fitted.values()), default=0)
    return (best.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.lit(most).cast("int").alias("visits")))


def _matrix_rows(column):
    """A function that gives chosen rows, all of one length, as a matrix."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column

    def rows(at: np.ndarray, d: int) -> np.ndarray:
        one = arr.take(pa.array(at, pa.int64()))
        return one.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(at), d)

    return rows


def _leaf_by_leaf(q, q_ids, x, ids, k: int, of_row, at, asker):
    """:func:`best_of` of every leaf and its visitors; a query's k-th best so far is its floor in the leaves after."""
    found = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]]
    best = np.full((len(q), k), -np.inf)
    by_leaf, by_asked = np.argsort(of_row, kind="stable"), np.argsort(at, kind="stable")
    for one in np.unique(at):
        rows = by_leaf[slice(*np.searchsorted(of_row[by_leaf], [one, one + 1]))]
        askers = asker[by_asked[slice(*np.searchsorted(at[by_asked], [one, one + 1]))]]
        r, c, score = best_of(q[askers], q_ids[askers], x[rows], ids[rows], k, floor=best[askers].min(axis=1))
        for held, values in zip(found, (askers[r], rows[c], score)):
            held.append(values)
        wide = np.full((len(askers), k), -np.inf)
        wide[r, np.arange(len(r)) - np.searchsorted(r, r)] = score
        best[askers] = -np.sort(-np.concatenate([best[askers], wide], axis=1), axis=1)[:, :k]
    return found


def _cell(k: int):
    """Each query meets the rows of the leaves that it visits."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if left.num_rows and right.num_rows:
            q, x = _matrix(left.column("v")), _matrix(right.column("v"))
            q_ids, keys = left.column("id").to_numpy(), left.column("qkey").to_numpy()
            ids, leaf = right.column("id").to_numpy(), right.column("leaf").to_numpy()
            wanted = left.column("leaves").combine_chunks()
            leaves, asker = wanted.flatten().to_numpy(), np.repeat(np.arange(len(q)), np.diff(wanted.offsets.to_numpy()))
            numbers, of_row = np.unique(leaf, return_inverse=True)
            at = np.minimum(np.searchsorted(numbers, leaves), len(numbers) - 1)
            held_here = numbers[at] == leaves  # a leaf may have no row in this block
            at, asker = at[held_here], asker[held_here]
            sizes = np.bincount(of_row, minlength=len(numbers))
            if sizes[at].sum() * DENSE >= len(q) * len(x):  # many leaves each: one product, and a mask
                visited = np.zeros((len(q), len(numbers)), bool)
                visited[asker, at] = True
                found = [[part] for part in best_of(q, q_ids, x, ids, k, lambda i, j: visited[i:j][:, of_row])]
            else:
                found = _leaf_by_leaf(q, q_ids, x, ids, k, of_row, at, asker)
            r, c, score = (np.concatenate(f) for f in found)
            order = np.lexsort((ids[c], -score, r))
            r, c, score = r[order], c[order], score[order]
            keep = np.arange(len(r)) - np.searchsorted(r, np.arange(len(q)))[r] < k
            r, c = r[keep], c[keep]
            out = [q_ids[r], keys[r], ids[c], score[keep]]
        return pa.table([pa.array(c, pa.float64() if i == 3 else pa.int64()) for i, c in enumerate(out)],
                        ["query_id", "qkey", "vec_id", "score"])

    return run


def _calibrate(own: DataFrame, asked: DataFrame, one: Fitted, k: int, recall: float, calibration: int):
    """Exact neighbours of a sample of queries, over all rows, and the visits that find enough of them."""
    total = asked.count()
    if not total:
        return 1, 1.0
    sample = _sampled(asked, ["id", "v"], total, calibration, 13)
    queries, ids = _matrix(sample.column("v")), sample.column("id").to_numpy()

    def scan(batches):
        held = None
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            r, c, score = best_of(queries, ids, x, batch.column(0).to_numpy(), k)
            new = (r, x[c], batch.column(0).to_numpy()[c], score)
            held = new if held is None else tuple(np.concatenate(p) for p in zip(held, new))
            order = np.lexsort((held[2], -held[3], held[0]))
            held = tuple(h[order] for h in held)
            keep = np.arange(len(order)) - np.searchsorted(held[0], np.arange(len(queries)))[held[0]] < k
            held = tuple(h[keep] for h in held)
        if held is not None:
            r, x, own_ids, score = held
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()), pa.array(own_ids, pa.int64()), pa.array(list(x), pa.list_(pa.float64())),
                                              pa.array(score)], ["q", "id", "v", "score"])

    w = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = (own.select("id", "v").mapInArrow(scan, "q long, id long, v array<double>, score double")
             .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("q", "v").toArrow())  # k a query of the sample
    q, x = found.column("q").to_numpy(), _matrix(found.column("v"))
    return _calibrated(one.tree, one.radius2, queries, [x[q == i] for i in range(len(queries))], recall)
