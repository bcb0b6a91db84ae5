"""Exact k-nearest-neighbour search and classification on DataFrames.

Three plans for the same operator, all exact, none with a cross join or an all-pairs table:

* ``method="broadcast"``: a train side of proven size is shipped to every executor once;
  test partitions are scored where they were read (``mapInArrow``), so the test side is never
  shuffled. Chosen by ``method="auto"`` whenever the size check passes; beyond the bound
  ``method="broadcast"`` takes the grid, so it completes at any size.

* ``method="block"`` (the scale path for any size, on the grid of :mod:`vecforge.operators.blocks`):
  a cogrouped Arrow function per grid cell scores the block pair with matrix products, chunk by
  chunk, keeps the candidates within the float-error slack of each pair, recomputes their
  distances exactly and cuts to ``k`` before the next chunk.
  Only ``n_query * B_ref * k`` rows leave the cells.
* ``method="native"``: a first look at some reference rows bounds each query's k-th distance, compiled
  column arithmetic drops the pairs of a block beyond it, and built-in higher-order functions score and rank
  the others (JVM only).

A global ``row_number`` (or ``rank`` when ties are kept) over ``(score, train_id)`` merges the
per-block candidates; with a single reference block the cell result is already final and that
shuffle is skipped.

Orderings (fixed semantics): Euclidean ascending distance; cosine descending similarity;
null scores last, by ``train_id``; equal scores are broken by ``train_id``. A row without a vector (null) takes no
part. A vector is malformed if its sum of squares is null, NaN or not below ``NORM_LIMIT`` (a null,
NaN or infinite element, or one too large to square), and for cosine if it is zero: its score
with any other is null. The rules hold on every plan, and one such row changes no other score.

Test rows are told apart by id, vector and carried columns; rows equal in all of them are
searched once on the grid and given back as often as they came, as on the broadcast plan.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml.linalg import VectorUDT

from vecforge.functions.vectors import cosine_similarity, euclidean, norm2, squared_euclidean, to_array
from vecforge.operators.blocks import (MAX_BLOCK_BYTES, MAX_NATIVE_ROWS, MIN_CELL_WORK, MIN_PARTITIONS_PER_SLOT, BlockGrid,
                                       block_of, lay_out, plan_grid, replicate)

EUCLIDEAN = "euclidean"
COSINE = "cosine"
METRICS = (EUCLIDEAN, COSINE)

_EPS = float(np.finfo(np.float64).eps)
# The train side is broadcast only below this many bytes of vectors (rows * width * 8
# plus key and label); above it the block grid is used.
BROADCAST_BYTES = 256 << 20
SMALL_TEST_BYTES = 64 << 20  # a test side below this is spread over the task slots before scoring
NORM_LIMIT = 1e300  # sums of squares from here on could overflow in a distance
LEAST_LOOK = 64      # train rows of the native plan's first look; more with more train rows
UNROLLED = 64        # elements of a vector that the native plan compares as columns, two to a column
CODE = 1000          # length of a vector in whole numbers; products of two digits' sums are below 2^20
CODE_BITS = 21
CODE_BASE = 1 << CODE_BITS
_CHUNK_CELLS = 1 << 21  # query rows * reference rows scored at once inside a cell


def score_name(metric: str) -> str:
    return "distance" if metric == EUCLIDEAN else "similarity"


def score_order(metric: str, col: str | None = None) -> Column:
    """Nearest first; a null score (zero vector under cosine, malformed vector) sorts last."""
    c = F.col(col or score_name(metric))
    return c.asc_nulls_last() if metric == EUCLIDEAN else c.desc_nulls_last()


def usable(vec: Column, metric: str) -> Column:
    """Whether a vector has scores at all (see the module's orderings)."""
    squares = norm2(vec)
    ok = squares < NORM_LIMIT
    return F.coalesce(ok if metric == EUCLIDEAN else ok & (squares > 0), F.lit(False))


def _check(metric: str, k: int) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, got {metric!r}")
    if int(k) < 1:
        raise ValueError("k must be at least 1")


# --------------------------------------------------------------------------------------
# numpy kernel for one grid cell
# --------------------------------------------------------------------------------------

def _matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0))
    offsets = np.asarray(arr.offsets)
    lengths = np.diff(offsets)
    d = int(lengths[0])
    if not np.all(lengths == d):
        raise ValueError("vectors in one kNN input must all have the same length")
    values = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(n, d)


def _valid_matrix(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a non-null vector as a matrix, and their positions in the input."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if arr.null_count == 0:
        return _matrix(arr), np.arange(len(arr))
    keep = np.flatnonzero(arr.is_valid().to_numpy(zero_copy_only=False))
    return _matrix(arr.take(pa.array(keep, pa.int64()))), keep


def _fold_sq_diff(Q: np.ndarray, Tm: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """sum_j (q_j - t_j)^2 folded left to right, as the SQL ``aggregate`` does, so exact
    scores are bit-identical across both formulations (ties included)."""
    acc = np.zeros(len(r))
    for j in range(Q.shape[1]):
        diff = Q[r, j] - Tm[c, j]
        acc = acc + diff * diff
    return acc


def _fold_dot(Q: np.ndarray, Tm: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    acc = np.zeros(len(r))
    for j in range(Q.shape[1]):
        acc = acc + Q[r, j] * Tm[c, j]
    return acc


def _fold_sq(M: np.ndarray) -> np.ndarray:
    acc = np.zeros(M.shape[0])
    for j in range(M.shape[1]):
        acc = acc + M[:, j] * M[:, j]
    return acc


_COL_BLOCK = 64  # reference columns per block of the candidate bound


class Reference:
    """The train rows of one block, prepared once: usable rows first class, malformed ones by id."""

    def __init__(self, Tm: np.ndarray, tids: np.ndarray, metric: str):
        self.metric, self.tids = metric, tids
        ok = self.usable(Tm)
        self.good = np.flatnonzero(ok)
        self.by_id = np.argsort(tids, kind="stable")
        self.bad_by_id = self.by_id[~ok[self.by_id]]
        self.M = Tm if ok.all() else Tm[self.good]
        self._product = None

    def usable(self, M: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            squares = _fold_sq(M)
            ok = squares < NORM_LIMIT
            return ok if self.metric == EUCLIDEAN else ok & (squares > 0)

    @property
    def product(self):
        """``(operand, slack by row, largest slack by column block)`` of the matrix product.

        Its result orders each query's row like the metric. Euclidean: ``[-q, 1] . [t, |t|^2 / 2]``
        is ``(d^2 - |q|^2) / 2``; cosine: ``[-q / |q|, 1] . [t / |t|, 0]`` is minus the similarity.
        Padded to whole column blocks with rows scoring +inf. The slack bounds the rounding error
        that a reference row adds, so a row of large norm widens no other row's bound.
        """
        if self._product is None:
            nt, d = self.M.shape
            pad = (-nt) % _COL_BLOCK
            Ta = np.zeros((nt + pad, d + 1))
            slack = np.zeros(nt + pad)
            squares = np.einsum("ij,ij->i", self.M, self.M)
            if self.metric == EUCLIDEAN:
                Ta[:nt, :d] = self.M
                Ta[:nt, d] = 0.5 * squares
                slack[:nt] = _slack(d) * squares
            else:
                Ta[:nt, :d] = self.M / np.sqrt(squares)[:, None]
                slack[:nt] = 4.0 * _slack(d)
            Ta[nt:, d] = np.inf
            self._product = Ta, slack, slack.reshape(-1, _COL_BLOCK).max(axis=1)
        return self._product

    def operand(self, Q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The query side of the product, and its part of the slack by query row."""
        squares = np.einsum("ij,ij->i", Q, Q)
        one = np.ones((len(Q), 1))
        if self.metric == EUCLIDEAN:
            return np.hstack([-Q, one]), _slack(Q.shape[1]) * squares
        return np.hstack([-Q / np.sqrt(squares)[:, None], one]), np.zeros(len(Q))


def _slack(d: int) -> float:
    return (4.0 * d + 16.0) * _EPS


_COL_BLOCK = 64  # reference columns per block of the candidate bound


def _candidates(A: np.ndarray, nt: int, k: int, row_slack: np.ndarray, col_slack: np.ndarray,
                block_slack: np.ndarray):
    """``(row, col)`` of every entry whose lower bound is within an upper bound of the row's k-th key.

    The upper bound is the k-th smallest over column blocks of (minimum + largest slack of the
    block): k blocks each hold an entry at most that large. Only blocks whose minimum, less their
    slack, passes are scanned; a row's true top k are always among the candidates.
    """
    m, width = A.shape
    nb = width // _COL_BLOCK
    if nb <= k:
        real = A[:, :nt]
        lim = np.partition(real + col_slack[:nt], k - 1, axis=1)[:, k - 1] + 2.0 * row_slack
        return np.nonzero(real - col_slack[:nt] <= lim[:, None])
    mins = A.reshape(m, nb, _COL_BLOCK).min(axis=2)
    lim = np.partition(mins + block_slack, k - 1, axis=1)[:, k - 1] + 2.0 * row_slack
    rb, bb = np.nonzero(mins - block_slack <= lim[:, None])
    cols = bb[:, None] * _COL_BLOCK + np.arange(_COL_BLOCK)[None, :]
    keep = (A[rb[:, None], cols] - col_slack[cols] <= lim[rb][:, None]) & (cols < nt)
    return np.broadcast_to(rb[:, None], cols.shape)[keep], cols[keep]


def _ranked(r, key, tids, k: int, keep_ties: bool):
    """``(order, rank)`` of the entries that rank at most ``k`` within their query row ``r``."""
    order = np.lexsort((tids, key, r))
    r, key = r[order], key[order]
    idx = np.arange(len(r))
    new_row = np.ones(len(r), bool)
    new_row[1:] = r[1:] != r[:-1]
    row_start = np.maximum.accumulate(np.where(new_row, idx, 0)) if len(r) else idx
    if keep_ties:
        new_key = new_row.copy()
        new_key[1:] |= (key[1:] != key[:-1]) | np.isinf(key[1:])  # null scores are no ties
        rank = (np.maximum.accumulate(np.where(new_key, idx, 0)) if len(r) else idx) - row_start + 1
    else:
        rank = idx - row_start + 1
    keep = rank <= k
    return order[keep], rank[keep]


def _scored_top_k(Q: np.ndarray, ref: Reference, k: int, keep_ties: bool):
    """Top k among usable rows, chunk by chunk; only ``k`` a row (and ties) outlive a chunk."""
    M, tids = ref.M, ref.tids[ref.good]
    nq, nt = len(Q), len(M)
    euclid = ref.metric == EUCLIDEAN
    if not euclid:
        q_norm, t_norm = np.sqrt(_fold_sq(Q)), np.sqrt(_fold_sq(M))
    step = max(1, _CHUNK_CELLS // nt)
    parts = []
    for s in range(0, nq, step):
        e = min(nq, s + step)
        if nt <= k:
            r, c = np.divmod(np.arange((e - s) * nt), nt)
        else:
            Ta, col_slack, block_slack = ref.product
            Qa, row_slack = ref.operand(Q[s:e])
            r, c = _candidates(Qa @ Ta.T, nt, k, row_slack, col_slack, block_slack)
        r = r + s
        if euclid:
            score = key = np.sqrt(_fold_sq_diff(Q, M, r, c))
        else:
            score = _fold_dot(Q, M, r, c) / (q_norm[r] * t_norm[c])
            key = -score
        order, rank = _ranked(r, key, tids[c], k, keep_ties)
        parts.append((r[order], ref.good[c[order]], score[order], rank))
    return [np.concatenate(x) for x in zip(*parts)]


def cell_top_k(Q: np.ndarray, ref: Reference, k: int, keep_ties: bool):
    """Exact top-k of every query row against one reference block.

    Returns ``(query_index, ref_index, score, rank)`` arrays, a null score as NaN. Candidates come
    from matrix products (approximate keys); every reference row that could be within the top k
    given the rounding bound of the pair is scored exactly with left-to-right folds, so no true
    neighbour is lost at the cut and there is no cap on candidates. Null scores rank after all
    others, one after the other by train id, also when ties are kept: a malformed row is no tie.
    """
    out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)]]

    def add(*columns):
        for held, column in zip(out, columns):
            held.append(column)

    if len(Q) and len(ref.tids):
        ok = ref.usable(Q)
        good, bad = np.flatnonzero(ok), np.flatnonzero(~ok)
        n_good = len(ref.good)
        if len(good) and n_good:
            r, c, score, rank = _scored_top_k(Q if len(good) == len(Q) else Q[good], ref, k, keep_ties)
            add(good[r], c, score, rank)
        for rows, pool, before in ((good, ref.bad_by_id, n_good), (bad, ref.by_id, 0)):
            if before >= k or not len(rows) or not len(pool):
                continue
            fill = pool[:k - before]  # null scores are no ties: never more than k rows
            rank = before + 1 + np.arange(len(fill))
            add(np.repeat(rows, len(fill)), np.tile(fill, len(rows)), np.full(len(rows) * len(fill), np.nan),
                np.tile(rank, len(rows)))
    r, c, score, rank = (np.concatenate(x) for x in out)
    order = np.lexsort((ref.tids[c] if len(c) else c, rank, r))
    return r[order], c[order], score[order], rank[order].astype(np.int32)


class Tiles:
    """Train rows of any number, of which one tile at a time is prepared and scored."""

    def __init__(self, Tm: np.ndarray, tids: np.ndarray, metric: str, tile_rows: int | None = None):
        self.Tm, self.tids, self.metric = Tm, tids, metric
        self.step = tile_rows or max(1, MAX_BLOCK_BYTES // (8 * max(1, Tm.shape[1])))
        self._only = None

    def top_k(self, Q: np.ndarray, k: int, keep_ties: bool):
        """:func:`cell_top_k` against all rows: what the tiles give, merged tile by tile."""
        if len(self.tids) <= self.step:
            if self._only is None:
                self._only = Reference(self.Tm, self.tids, self.metric)  # once a task, not once a batch
            return cell_top_k(Q, self._only, k, keep_ties)
        held = None
        for begin in range(0, len(self.tids), self.step):
            tile = slice(begin, begin + self.step)
            r, c, score, _ = cell_top_k(Q, Reference(self.Tm[tile], self.tids[tile], self.metric), k, keep_ties)
            c = c + begin
            if held is not None:
                r, c, score = (np.concatenate(x) for x in zip(held, (r, c, score)))
            key = np.where(np.isnan(score), np.inf, score if self.metric == EUCLIDEAN else -score)
            order, rank = _ranked(r, key, self.tids[c], k, keep_ties)
            held = r[order], c[order], score[order]
        return *held, rank.astype(np.int32)


def _cell_function(k: int, metric: str, keep_ties: bool, carry: list[str]):
    name = score_name(metric)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            Q, qrows = _valid_matrix(left.column("qv"))
            Tm, trows = _valid_matrix(right.column("tv"))
            if len(qrows) and len(trows) and Q.shape[1] != Tm.shape[1]:
                raise ValueError("query and reference vectors differ in length")
            ref = Reference(Tm, right.column("tid").to_numpy()[trows], metric)
            r, c, score, rank = cell_top_k(Q, ref, k, keep_ties)
            r, c = qrows[r], trows[c]
        else:
            r = c = np.zeros(0, np.int64)
            score = np.zeros(0)
            rank = np.zeros(0, np.int32)
        cols = {"test_id": left.column("qid").take(pa.array(r, pa.int64()))}
        for extra in carry:
            cols[extra] = left.column(extra).take(pa.array(r, pa.int64()))
        cols["train_id"] = right.column("tid").take(pa.array(c, pa.int64()))
        cols["train_label"] = right.column("label").take(pa.array(c, pa.int64()))
        cols[name] = pa.array(score, pa.float64(), mask=np.isnan(score))
        cols["rank"] = pa.array(rank, pa.int32())
        return pa.table(cols)

    return run


# --------------------------------------------------------------------------------------
# DataFrame operators
# --------------------------------------------------------------------------------------

def _vector(frame: DataFrame, vec: str) -> Column:
    """The vector column as ``array<double>``; ML vectors (dense or sparse) are converted here."""
    col = F.col(vec)
    return to_array(col) if isinstance(frame.schema[vec].dataType, VectorUDT) else col.cast("array<double>")


def _inputs(test: DataFrame, train: DataFrame, test_id: str, train_id: str, vec: str,
            label: str, carry: list[str]):
    """Standard column names. Rows with a null vector are skipped inside the Arrow kernels
    (a filter here would be pushed below a derived vector - a PCA projection, a scaling - and
    evaluate it twice per row)."""
    q = test.select(F.col(test_id).cast("long").alias("qid"), _vector(test, vec).alias("qv"), *carry)
    r = train.select(F.col(train_id).cast("long").alias("tid"), _vector(train, vec).alias("tv"),
                     F.col(label).alias("label"))
    return q, r


HIDDEN = ["_query", "_copies"]


def _distinct_queries(q: DataFrame, carry: list[str]) -> DataFrame:
    """Equal test rows as one, with their number and a key that tells rows of one id apart."""
    return (q.groupBy("qid", "qv", *carry).agg(F.count(F.lit(1)).alias("_copies"))
            .withColumn("_query", F.xxhash64("qid", "qv", *carry)))


def _given_back(frame: DataFrame) -> DataFrame:
    """As many rows as equal test rows came in, without the hidden columns."""
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    return frame.withColumn("_copy", copies).drop("_copy", *HIDDEN)


def _output_schema(q: DataFrame, r: DataFrame, metric: str, carry: list[str]) -> T.StructType:
    fields = [T.StructField("test_id", T.LongType())]
    fields += [T.StructField(c, q.schema[c].dataType) for c in carry]
    fields += [T.StructField("train_id", T.LongType()),
               T.StructField("train_label", r.schema["label"].dataType),
               T.StructField(score_name(metric), T.DoubleType()),
               T.StructField("rank", T.IntegerType())]
    return T.StructType(fields)


def _side_stats(q: DataFrame, r: DataFrame, test: DataFrame | None = None,
                train: DataFrame | None = None) -> tuple[int, int, int, int]:
    """Row counts of both sides, the vector width, and the bytes of the train labels.

    Counts come from the raw inputs when given (an upper bound - rows with null vectors are
    dropped later - which is safe for block sizing and for the broadcast bound), so the scan
    reads only key and filter columns: one stage over both inputs and a one-row aggregate.
    The width comes from one row. Callers that know these numbers pass ``sizes`` instead, which
    saves running an input that is not a plain scan.
    """
    fixed = isinstance(r.schema["label"].dataType, _FIXED_WIDTH)
    label = F.lit(8) if fixed else F.coalesce(F.octet_length(F.col("label").cast("string")), F.lit(0)) + 16
    a = (test if test is not None else q).select(F.lit(True).alias("is_q"), F.lit(0).alias("bytes"))
    b = (train if train is not None and fixed else r).select(F.lit(False).alias("is_q"), label.alias("bytes"))
    row = a.unionByName(b).agg(F.count_if(F.col("is_q")).alias("nq"), F.count_if(~F.col("is_q")).alias("nr"),
                               F.sum(F.col("bytes").cast("long")).alias("bytes")).first()
    first = r.filter(F.col("tv").isNotNull()).select(F.size("tv").alias("d")).first()
    return int(row["nq"]), int(row["nr"]), max(1, int(first["d"]) if first else 1), int(row["bytes"] or 0)


def choose_grid(q: DataFrame, r: DataFrame, method: str = "block",
                max_block_rows: int | None = None, test: DataFrame | None = None,
                train: DataFrame | None = None) -> BlockGrid:
    """Block counts from the two row counts and the vector width (two small jobs)."""
    n_q, n_r, dims, _ = _side_stats(q, r, test, train)
    return plan_grid(n_q, n_r, dims, _parallelism(q), max_block_rows, method)


def _parallelism(frame: DataFrame) -> int:
    return frame.sparkSession.sparkContext.defaultParallelism


def _block_cells(q, r, grid, k, metric, keep_ties, carry):
    q2, r2 = lay_out(q, r, grid, "qid", "tid", grid.partitions(_parallelism(q)), (F.col("tv"),))
    schema = _output_schema(q, r, metric, carry)
    fn = _cell_function(k, metric, keep_ties, carry)
    return (q2.groupBy("qb", "rb").cogroup(r2.groupBy("qb", "rb"))
            .applyInArrow(fn, schema=schema))


def vote_rows(rows: np.ndarray, key: np.ndarray, lab: np.ndarray):
    """The majority vote over kept neighbours, inside a task.

    ``rows`` is the query index of each neighbour, ``key`` its score key (smaller is nearer,
    null similarity as +inf) and ``lab`` its numeric label. Same rule as :func:`majority_vote`:
    most votes, then the smallest best key, then the smallest label. Returns
    ``(row, prediction, votes, best_key)``, one entry per query row.
    """
    if len(rows) == 0:
        return rows, lab[:0], np.zeros(0, np.int64), key[:0]
    order = np.lexsort((lab, rows))
    r2, l2, k2 = rows[order], lab[order], key[order]
    new = np.ones(len(r2), bool)
    new[1:] = (r2[1:] != r2[:-1]) | (l2[1:] != l2[:-1])
    starts = np.flatnonzero(new)
    votes = np.diff(np.append(starts, len(r2)))
    best = np.minimum.reduceat(k2, starts)
    gr, gl = r2[starts], l2[starts]
    pick = np.lexsort((gl, best, -votes, gr))
    gr, gl, votes, best = gr[pick], gl[pick], votes[pick], best[pick]
    first = np.ones(len(gr), bool)
    first[1:] = gr[1:] != gr[:-1]
    return gr[first], gl[first], votes[first], best[first]


_FIXED_WIDTH = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType,
                T.DateType, T.TimestampType)
_VOTABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def _broadcast_rows(q, r, k, metric, keep_ties, carry, vote: bool = False,
                    sweep: list[int] | None = None):
    """Train side (size already checked) shipped once to every executor as a broadcast
    variable; each test partition is scored where it was read, Arrow batch by batch.
    Every test row meets every train row in one call, so the result is final.

    With ``vote`` (numeric, non-null labels only) the vote is taken in the same call and the
    output is ``test_id, *carry, prediction, votes, best_<score>``: classification then needs
    no shuffle at all. With ``sweep`` as well (``k`` is then its maximum), one vote per listed
    ``k`` over the neighbours ranked at most ``k``, with a leading ``k`` column.
    Returns ``(frame, voted)``.
    """
    spark = q.sparkSession
    tbl = r.select("tid", "tv", "label").toArrow()
    Tm, trows = _valid_matrix(tbl.column("tv")) if tbl.num_rows else (np.zeros((0, 0)), np.zeros(0, np.int64))
    tbl = tbl.take(pa.array(trows, pa.int64()))
    labels = tbl.column("label").combine_chunks()
    vote = vote and not keep_ties and labels.null_count == 0 and isinstance(
        r.schema["label"].dataType, _VOTABLE)
    shipped = spark.sparkContext.broadcast((Tm, tbl.column("tid").to_numpy(), labels))
    name = score_name(metric)
    euclid = metric == EUCLIDEAN
    if vote:
        schema = T.StructType(([T.StructField("k", T.IntegerType())] if sweep else []) +
                              [T.StructField("test_id", T.LongType())] +
                              [T.StructField(c, q.schema[c].dataType) for c in carry] +
                              [T.StructField("prediction", r.schema["label"].dataType),
                               T.StructField("votes", T.LongType()),
                               T.StructField(f"best_{name}", T.DoubleType())])
    else:
        schema = _output_schema(q, r, metric, carry)

    def run(batches):
        T_all, tids, labs = shipped.value
        tiles = Tiles(T_all, tids, metric)
        lab_np = labs.to_numpy(zero_copy_only=False) if vote else None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            col = batch.schema.get_field_index
            if len(tids):
                Q, qrows = _valid_matrix(batch.column(col("qv")))
                if len(qrows) and Q.shape[1] != T_all.shape[1]:
                    raise ValueError("query and reference vectors differ in length")
                rr, cc, score, rank = tiles.top_k(Q, k, keep_ties)
                rr = qrows[rr]
            else:
                rr = cc = np.zeros(0, np.int64)
                score, rank = np.zeros(0), np.zeros(0, np.int32)
            if vote:
                key = np.where(np.isnan(score), np.inf, score if euclid else -score)
                lab = lab_np[cc]
                for kk in (sweep or [None]):
                    keep = slice(None) if kk is None else rank <= kk
                    gr, gl, votes, best = vote_rows(rr[keep], key[keep], lab[keep])
                    best_score = np.where(np.isinf(best), np.nan, best if euclid else -best)
                    take_r = pa.array(gr, pa.int64())
                    cols = [pa.array(np.full(len(gr), kk, np.int32))] if sweep else []
                    cols += [batch.column(col("qid")).take(take_r)]
                    cols += [batch.column(col(extra)).take(take_r) for extra in carry]
                    cols += [pa.array(gl, labs.type), pa.array(votes, pa.int64()),
                             pa.array(best_score, pa.float64(), mask=np.isnan(best_score))]
                    names = (["k"] if sweep else []) + ["test_id", *carry, "prediction", "votes", f"best_{name}"]
                    yield pa.RecordBatch.from_arrays(cols, names=names)
                continue
            else:
                take_r = pa.array(rr, pa.int64())
                cols = [batch.column(col("qid")).take(take_r)]
                cols += [batch.column(col(extra)).take(take_r) for extra in carry]
                cols += [pa.array(tids[cc], pa.int64()), labs.take(pa.array(cc, pa.int64())),
                         pa.array(score, pa.float64(), mask=np.isnan(score)), pa.array(rank, pa.int32())]
                names = ["test_id", *carry, "train_id", "train_label", name, "rank"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return q.mapInArrow(run, schema), vote


def _looked(q, r, k, metric, rows):
    """``q`` with ``limit``: a bound of the squared distance of its k-th neighbour, from a first look at some train rows.

    Null (no bound) for a malformed row, and where the look found fewer than ``k`` usable rows. Cosine
    distances are those at unit length.
    """
    look = r.filter(usable(F.col("tv"), metric)).limit(rows).agg(F.collect_list("tv").alias("look"))  # a few rows, shipped
    q = q.repartition(MIN_PARTITIONS_PER_SLOT * _parallelism(q), "qid").crossJoin(F.broadcast(look))
    if metric == EUCLIDEAN:
        squares = F.transform("look", lambda t: squared_euclidean(F.col("qv"), t))
    else:
        squares = F.transform("look", lambda t: 2 - 2 * cosine_similarity(F.col("qv"), t) + 1e-9)
    kth = F.get(F.sort_array(F.filter(squares, lambda x: x.isNotNull())), k - 1)
    return q.withColumn("limit", F.when(F.col("q_ok"), kth * (1 + 1e-9))).drop("look")


def _native_cells(q, r, grid, k, metric, keep_ties, carry):
    """Pairs that a first look rules out are dropped by column arithmetic, which Spark compiles; higher-order
    functions, which it does not, score the others and rank them block by block."""
    q = q.filter(F.col("qv").isNotNull()).withColumn("q_ok", usable(F.col("qv"), metric))
    r = r.filter(F.col("tv").isNotNull())
    first = r.select(F.size("tv").alias("d")).first()
    width = min(UNROLLED, int(first["d"])) if first else 0
    q = _looked(q, r, k, metric, min(MAX_NATIVE_ROWS, max(LEAST_LOOK, math.isqrt(k * grid.ref_blocks * MAX_NATIVE_ROWS))))
    r = r.select("tid", "tv", F.col("label").alias("_label"), usable(F.col("tv"), metric).alias("t_ok"))
    qx = q.withColumn("qb", block_of(F.col("qid"), grid.query_blocks)).withColumn("rb", replicate(grid.ref_blocks))
    rx = (r.withColumn("rb", block_of(F.col("tid"), grid.ref_blocks, F.col("tv")))
          .withColumn("qb", replicate(grid.query_blocks)))
    parts = grid.partitions(_parallelism(q))
    count = (width + 1) // 2

    def in_columns(frame, vec, name, ok, half, swapped):
        """What a pair is dropped by, and the row itself as one column: ``half`` of the first elements' squares, what turns their
        products into codes', and their codes, two whole numbers to a column; those of the right side swapped.

        The loop of the join has to stay small: beyond 100 columns Spark does not compile it, and a long one is compiled badly."""
        known = [c for c in frame.columns if c not in ("qb", "rb", "limit")]
        frame = frame.withColumn("cell", F.col("qb").cast("long") * grid.ref_blocks + F.col("rb")).repartition(parts, "cell")
        frame = frame.withColumn("_squares", norm2(F.col(vec))).withColumn("_first", F.sqrt(norm2(F.slice(vec, 1, max(1, width)))))
        by = F.lit(1.0) if metric == EUCLIDEAN else F.when(F.col(ok), F.sqrt("_squares")).otherwise(1.0)
        length = F.when(F.col("_first") > 0, F.col("_first")).otherwise(1.0)
        code = F.transform(F.slice(vec, 1, max(1, width)), lambda x: F.rint(x / F.col("_length") * CODE))
        # a malformed row has codes of nothing, and a half by which no pair of it is dropped
        frame = frame.withColumn("_length", F.when(F.col(ok), length).otherwise(1.0)).withColumn("_code", F.when(F.col(ok), code))
        low, high = (1, 0) if swapped else (0, 1)
        at = lambda j: F.coalesce(F.get("_code", j), F.lit(0.0))
        squares = half(F.col("_first") * F.col("_first") / (by * by) * (1 - 2 * _slack(width)))
        return frame.select("cell", F.struct(*known).alias(f"{name}_row"), F.coalesce(squares, F.lit(float("nan"))).alias(f"{name}_half"),
                            F.coalesce(F.when(F.col(ok), by / F.col("_length")), F.lit(1.0)).alias(f"{name}_scale"),
                            F.coalesce(F.size(vec), F.lit(-1)).alias(f"{name}_size"),
                            *[(at(2 * j + low) + at(2 * j + high) * float(CODE_BASE)).alias(f"{name}{j}") for j in range(count)])

    left = in_columns(qx, "qv", "_q", "q_ok", lambda squares: F.coalesce((F.col("limit") - squares) / 2, F.lit(float("inf"))), False)
    right = in_columns(rx, "tv", "_t", "t_ok", lambda squares: F.when(F.col("t_ok"), squares / 2).otherwise(F.lit(float("-inf"))), True)
    right = right.withColumnRenamed("cell", "t_cell")
    product = [F.col(f"_q{j}") * F.col(f"_t{j}") for j in range(count)] or [F.lit(0.0)]
    while len(product) > 1:  # a flat sum of many terms would nest too deep
        product = [sum(product[i + 1:i + 8], product[i]) for i in range(0, len(product), 8)]
    middle = F.shiftright(F.floor(product[0] + CODE_BASE / 2), CODE_BITS)
    middle = F.shiftright(F.shiftleft(middle, 64 - CODE_BITS), 64 - CODE_BITS)  # the middle digit, with its sign
    # |q - t|^2 = |q|^2 + |t|^2 - 2 q.t over the first elements is never above the distance; codes are off by half a unit each
    least = (F.col("_t_half") - F.col("_q_half")) * F.col("_t_scale") * F.col("_q_scale")
    near = (middle >= least * float(CODE * CODE) - (CODE * math.sqrt(width) + width + 1)) | (F.col("_q_size") != F.col("_t_size"))
    pairs = left.join(right.hint("merge"), (F.col("cell") == F.col("t_cell")) & near)
    pairs = pairs.select("cell", "_q_row", "_t_row").select("cell", "_q_row.*", "_t_row.*")
    if metric == EUCLIDEAN:
        score = F.when(F.col("q_ok") & F.col("t_ok"), euclidean(F.col("qv"), F.col("tv")))
        key = F.coalesce("_score", F.lit(float("inf")))
    else:
        score = F.when(F.col("q_ok") & F.col("t_ok"), cosine_similarity(F.col("qv"), F.col("tv")))
        key = F.coalesce(-F.col("_score"), F.lit(2.0))  # a null similarity sorts after every real one (-1 <= -sim <= 1 < 2)
    entry = F.struct(key.alias("key"), F.col("tid").alias("train_id"), F.col("_label").alias("train_label"),
                     F.col("_score").alias(score_name(metric)))
    joined = (pairs.select("qid", *carry, "cell", "tid", "_label", score.alias("_score"))
              .groupBy("qid", *carry, "cell").agg(F.collect_list(entry).alias("scored")))
    # natural struct order: key, then train_id; a column of its own, so that it is sorted once a row
    joined = joined.withColumn("ranked", F.sort_array("scored"))
    ranked = F.col("ranked")
    if keep_ties:
        joined = joined.withColumn("kth", F.get("ranked", k - 1)["key"])
        kth = F.col("kth")
        name = score_name(metric)
        # beyond the k-th only ties of its score; null scores are no ties
        top = F.when(F.size(ranked) <= k, ranked).otherwise(
            F.filter(ranked, lambda x, i: (i < k) | ((x["key"] <= kth) & x[name].isNotNull())))
    else:
        top = F.slice(ranked, 1, k)
    if keep_ties:
        # rank() inside the cell: 1 + number of kept keys strictly below this one
        exploded = (joined.select("qid", *carry, top.alias("top"))
                    .select("qid", *carry, F.transform("top", lambda x: x["key"]).alias("top_keys"),
                            F.posexplode("top").alias("at", "n")))
        below = F.size(F.filter(F.col("top_keys"), lambda y: y < F.col("n.key")))
        exploded = exploded.withColumn("pos", F.when(F.col(f"n.{name}").isNull(), F.col("at")).otherwise(below))
    else:
        exploded = joined.select("qid", *carry, F.posexplode(top).alias("pos", "n"))
    score = F.col("n.distance") if metric == EUCLIDEAN else F.col("n.similarity")
    return exploded.select(F.col("qid").alias("test_id"), *carry, F.col("n.train_id").alias("train_id"),
                           F.col("n.train_label").alias("train_label"),
                           score.alias(score_name(metric)), (F.col("pos") + 1).cast("int").alias("rank"))


def _resolve(test, train, k, metric, method, test_id, train_id, vec, label, carry, grid,
             max_block_rows, broadcast_bytes, sizes=None):
    """Validate and pick the plan: ``("broadcast", q, r, None)`` or ``("grid", q, r, grid)``."""
    _check(metric, k)
    if method not in ("auto", "broadcast", "block", "native"):
        raise ValueError("method must be 'auto', 'broadcast', 'block' or 'native'")
    q, r = _inputs(test, train, test_id, train_id, vec, label, carry)
    if grid is None:
        n_q, n_r, dims, label_bytes = (*sizes, 8 * sizes[1]) if sizes else _side_stats(q, r, test, train)
        if method in ("auto", "broadcast") and n_r * (8 * dims + 16) + label_bytes <= broadcast_bytes:
            # a test side of few bytes but much work is spread over the task slots first; a large
            # one is split finely by its own scan and is not shuffled
            want = min(2 * _parallelism(q), math.ceil(n_q * n_r * dims / MIN_CELL_WORK["block"]))
            if want > 1 and 8 * n_q * dims <= SMALL_TEST_BYTES:
                q = q.repartition(want, "qid")
            return "broadcast", q, r, None
        grid = plan_grid(n_q, n_r, dims, _parallelism(q), max_block_rows, "native" if method == "native" else "block")
    return "grid", q, r, grid


def _grid_neighbors(q, r, grid, k, metric, method, keep_ties, carry):
    """Neighbours on the grid, with the hidden columns that tell equal ids apart."""
    q, carry = _distinct_queries(q, carry), [*carry, *HIDDEN]
    cells = (_native_cells if method == "native" else _block_cells)(q, r, grid, k, metric, keep_ties, carry)
    if grid.ref_blocks == 1:
        return cells  # every query met every reference row in exactly one cell: already final
    w = Window.partitionBy("test_id", "_query").orderBy(score_order(metric))
    if keep_ties:
        null_order = F.when(F.col(score_name(metric)).isNull(), F.col("train_id"))  # null scores are numbered by id
        w = Window.partitionBy("test_id", "_query").orderBy(score_order(metric), null_order.asc())
        ranked = cells.withColumn("rank", F.rank().over(w))
    else:
        w = Window.partitionBy("test_id", "_query").orderBy(score_order(metric), F.col("train_id").asc())
        ranked = cells.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k)


def neighbors(test: DataFrame, train: DataFrame, k: int, metric: str = EUCLIDEAN, *,
              method: str = "auto", keep_ties: bool = False, test_id: str = "id",
              train_id: str = "id", vec: str = "vec", label: str = "label",
              carry: list[str] | tuple[str, ...] = (), grid: BlockGrid | None = None,
              max_block_rows: int | None = None, broadcast_bytes: int = BROADCAST_BYTES,
              sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """The ``k`` nearest train rows of every test row.

    Output: ``test_id, *carry, train_id, train_label, distance|similarity, rank``.
    Train ids break score ties. ``keep_ties=False`` numbers neighbours 1..k with ``train_id``
    breaking equal scores; ``keep_ties=True`` keeps every row whose ``rank()`` (by score only) is
    at most ``k``; null scores are no ties of each other, and are numbered by ``train_id``. ``k`` above the train size returns every train row. ``carry`` passes test
    columns (e.g. the true label) through, which saves a join later. Vectors are arrays or ML
    vectors; malformed ones and repeated test rows are defined in the module's docstring.

    ``method``: ``"broadcast"`` ships a train side of proven size (vectors, keys and labels below
    ``broadcast_bytes``) to every executor and scores test partitions in place - no test
    shuffle; ``"block"`` is the grid of bounded blocks for any size; ``"native"`` the same grid
    with built-in functions only; ``"auto"`` (default) and ``"broadcast"`` take the grid beyond the
    bound. All give the same rows. ``sizes`` (test rows, train rows, width), if known, saves the
    counting job.
    """
    carry = list(carry)
    plan, q, r, grid = _resolve(test, train, k, metric, method, test_id, train_id, vec, label, carry,
                                grid, max_block_rows, broadcast_bytes, sizes)
    if plan == "broadcast":
        return _broadcast_rows(q, r, int(k), metric, keep_ties, carry)[0]
    return _given_back(_grid_neighbors(q, r, grid, int(k), metric, method, keep_ties, carry))


def majority_vote(nbrs: DataFrame, metric: str = EUCLIDEAN, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One label per ``(test_id, *by)``: most votes, then the better best score, then the smaller label.

    When no label repeats this is the nearest label. ``by`` are extra grouping columns, e.g.
    a carried true label or the ``k`` of a sweep. Partitioning by ``test_id`` from the
    neighbour merge already satisfies both the tally and the pick, so no extra shuffle.
    Output: ``test_id, *by, prediction, votes, best_<score>``.
    """
    name = score_name(metric)
    keys = ["test_id", *by]
    best = F.min(name) if metric == EUCLIDEAN else F.max(name)
    tallies = nbrs.groupBy(*keys, "train_label").agg(F.count(F.lit(1)).alias("votes"),
                                                      best.alias(f"best_{name}"))
    w = Window.partitionBy(*keys).orderBy(F.col("votes").desc(), score_order(metric, f"best_{name}"),
                                          F.col("train_label").asc())
    return (tallies.withColumn("_pick", F.row_number().over(w)).filter(F.col("_pick") == 1)
            .select(*keys, F.col("train_label").alias("prediction"), "votes", f"best_{name}"))


def classify(test: DataFrame, train: DataFrame, k: int, metric: str = EUCLIDEAN, *,
             method: str = "auto", test_id: str = "id", train_id: str = "id", vec: str = "vec",
             label: str = "label", actual: str | None = None, grid: BlockGrid | None = None,
             broadcast_bytes: int = BROADCAST_BYTES,
             sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """kNN classification: ``test_id, [label], prediction``.

    With ``actual`` (a test column, normally the true label) that column is carried through
    the search and returned as ``label`` so evaluation needs no join back to the test set.
    On the broadcast plan the vote is taken inside the scoring task (no shuffle at all);
    otherwise it follows the neighbour merge, reusing its partitioning.
    """
    carry = [actual] if actual else []
    plan, q, r, grid = _resolve(test, train, k, metric, method, test_id, train_id, vec, label, carry,
                                grid, None, broadcast_bytes, sizes)
    hidden = [*carry, *HIDDEN]
    if plan == "grid":
        voted = _given_back(majority_vote(_grid_neighbors(q, r, grid, int(k), metric, method, False, carry),
                                          metric, by=hidden))
    else:
        voted, did_vote = _broadcast_rows(q, r, int(k), metric, False, carry, vote=True)
        if not did_vote:
            frame, _ = _broadcast_rows(_distinct_queries(q, carry), r, int(k), metric, False, hidden)
            voted = _given_back(majority_vote(frame, metric, by=hidden))
    cols = [F.col("test_id")]
    if actual:
        cols.append(F.col(actual).alias("label"))
    return voted.select(*cols, "prediction")


def classify_sweep(test: DataFrame, train: DataFrame, k_values: list[int], metric: str = EUCLIDEAN, *,
                   method: str = "auto", test_id: str = "id", train_id: str = "id", vec: str = "vec",
                   label: str = "label", actual: str | None = None,
                   broadcast_bytes: int = BROADCAST_BYTES,
                   sizes: tuple[int, int, int] | None = None) -> DataFrame:
    """Predictions for several ``k`` from one search at ``max(k_values)``:
    ``k, test_id, [label], prediction``. On the broadcast plan every vote is taken inside
    the scoring task (no shuffle); otherwise :func:`k_sweep_votes` runs on the neighbours."""
    ks = sorted({int(x) for x in k_values})
    carry = [actual] if actual else []
    plan, q, r, grid = _resolve(test, train, max(ks), metric, method, test_id, train_id, vec, label,
                                carry, None, None, broadcast_bytes, sizes)
    hidden = [*carry, *HIDDEN]
    if plan == "grid":
        nbrs = _grid_neighbors(q, r, grid, max(ks), metric, method, False, carry)
        out = _given_back(k_sweep_votes(nbrs, ks, metric, by=hidden))
    else:
        out, voted = _broadcast_rows(q, r, max(ks), metric, False, carry, vote=True, sweep=ks)
        if not voted:
            frame, _ = _broadcast_rows(_distinct_queries(q, carry), r, max(ks), metric, False, hidden)
            out = _given_back(k_sweep_votes(frame, ks, metric, by=hidden))
    cols = [F.col("k"), F.col("test_id")]
    if actual:
        cols.append(F.col(actual).alias("label"))
    return out.select(*cols, "prediction")


def k_sweep_votes(nbrs: DataFrame, k_values: list[int], metric: str = EUCLIDEAN,
                  by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Votes for many ``k`` from one neighbour table computed at ``max(k_values)``.

    Each neighbour row is copied once for every requested ``k >= rank`` (a generator, not a
    join), then voted per ``(test_id, k)``. Output: ``k, test_id, *by, prediction``.
    """
    ks = sorted({int(x) for x in k_values})
    expanded = nbrs.select("*", F.explode(F.filter(F.array(*[F.lit(x) for x in ks]),
                                                   lambda x: x >= F.col("rank"))).alias("k"))
    voted = majority_vote(expanded, metric, by=["k", *by])
    return voted.select("k", "test_id", *by, "prediction")


def single_query_neighbors(train: DataFrame, query: list[float], k: int, metric: str = EUCLIDEAN, *,
                           train_id: str = "id", vec: str = "vec", label: str = "label") -> DataFrame:
    """The ``k`` nearest train rows of one query vector (a parameter, not a table).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps its own top
    ``k`` and only those meet on the driver.
    """
    _check(metric, k)
    qv, tv = F.array(*[F.lit(float(x)) for x in query]), _vector(train, vec)
    score = euclidean(qv, tv) if metric == EUCLIDEAN else cosine_similarity(qv, tv)
    score = F.when(usable(qv, metric) & usable(tv, metric), score)
    name = score_name(metric)
    scored = train.filter(F.col(vec).isNotNull()).select(
        F.col(train_id).cast("long").alias("train_id"), F.col(label).alias("train_label"),
        score.alias(name))
    top = scored.orderBy(score_order(metric), F.col("train_id").asc()).limit(int(k))
    w = Window.orderBy(score_order(metric), F.col("train_id").asc())
    return top.withColumn("rank", F.row_number().over(w).cast("int"))


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
