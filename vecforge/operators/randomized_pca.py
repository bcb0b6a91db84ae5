"""Principal axes by a randomised range finder: no matrix of width x width is ever made.

Rows are multiplied by a thin random matrix; a distributed QR of the product (tall and skinny: a QR a task,
then a QR of all their triangles) gives an orthonormal basis of nearly the span of the first axes, sharpened
by power iterations. The rows' coordinates in that basis, summed over the rows, are a matrix of rank x width,
and its singular values and vectors give the axes. Memory is rows of a batch x rank in a task, and
rank x width on the driver, where :func:`vecforge.operators.pca.fit` has width x width.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.operators import knn, partials

# Extra columns of the random matrix, and power iterations.
OVERSAMPLE = 10
POWERS = 4


@dataclass
class Axes:
    """``components`` (width x k), each axis' variance, and its share of the total variance."""

    components: np.ndarray
    mean: np.ndarray
    variance: np.ndarray
    ratio: np.ndarray
    rows: int


def _folded(frame: DataFrame, column: str, fold) -> DataFrame:
    """:func:`vecforge.operators.partials.by_part` of ``fold(rows, held)`` over batches of rows as matrices."""
    def of_batch(batch, held):
        rows, _ = knn._valid_matrix(batch.column(0))
        return fold(rows, held) if len(rows) else held

    return partials.by_part(frame.select(F.col(column).alias("v")), of_batch)


def _triangle(frame: DataFrame, column: str, basis: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """R of a QR of ``(rows - mean) @ basis``: of each task's rows, then of the triangles, some at a time."""
    rank = basis.shape[1]

    def fold(rows, held):
        return [np.linalg.qr(np.concatenate([*(held or []), (rows - mean) @ basis]), mode="r")]

    def together(arrays):
        return np.linalg.qr(np.concatenate([a.reshape(-1, rank) for a in arrays]), mode="r").ravel()

    return partials.reduced(_folded(frame, column, fold), together)[0].reshape(-1, rank)


def fit(frame: DataFrame, k: int, vec: str = "vec", seed: int = 0, oversample: int = OVERSAMPLE, powers: int = POWERS) -> Axes:
    """The first ``k`` principal axes of the non-null vectors, largest variance first; signs are arbitrary.

    Each power iteration reads the rows twice (a QR, then the product with the rows); fewer rows than ``k``
    give as many axes as there are. Vectors of one length are needed, and two rows at least.
    """
    rows = frame.select(knn._vector(frame, vec).alias("v")).filter(F.col("v").isNotNull())

    def moments(x, total):
        own = [x.sum(axis=0), np.array([float(len(x))]), np.array([float((x * x).sum())])]
        return own if total is None else [a + b for a, b in zip(own, total)]

    found = partials.reduced(_folded(rows, "v", moments))
    if not found or found[1][0] < 2:
        raise ValueError("principal axes need two vectors at least")
    n = int(found[1][0])
    mean = found[0] / n
    width, spread = len(mean), (float(found[2][0]) - n * float(mean @ mean)) / (n - 1)
    rank = min(width, n, int(k) + oversample)
    basis = np.random.default_rng(seed).normal(size=(width, rank))
    for step in range(powers + 1):
        r = _triangle(rows, "v", basis, mean)
        # the orthonormal factor is (rows - mean) @ basis @ inverse; directions without any variance go
        u, s, vt = np.linalg.svd(r)
        keep = s > s[0] * 1e-12 if len(s) and s[0] > 0 else np.zeros(len(s), bool)
        if not keep.any():
            return Axes(np.eye(width)[:, :int(k)], mean, np.zeros(min(int(k), width)), np.zeros(min(int(k), width)), n)
        thin = basis @ (vt[:len(s)][keep].T / s[keep])  # (rows - mean) @ thin has orthonormal columns

        def back(x, total):
            centred = x - mean
            own = [(centred @ thin).T @ centred]
            return own if total is None else [own[0] + total[0]]

        small = partials.reduced(_folded(rows, "v", back))[0].reshape(-1, width)  # rank x width
        if step < powers:
            basis = np.linalg.qr(small.T)[0]
    _, s, vt = np.linalg.svd(small, full_matrices=False)
    variance = s ** 2 / (n - 1)
    count = min(int(k), len(s))
    return Axes(vt[:count].T, mean, variance[:count], variance[:count] / spread if spread > 0 else variance[:count] * 0, n)


def project(axes: Axes, frame: DataFrame, vec: str = "vec", out: str | None = None) -> DataFrame:
    """Replace (or add, with ``out``) the vector column by its products with the axes, not centred, as :func:`vecforge.operators.pca.project`."""
    target = out or vec
    keep = [c for c in frame.columns if c != target]
    columns = [F.array(*[F.lit(float(x)) for x in axes.components[:, j]]) for j in range(axes.components.shape[1])]
    source = knn._vector(frame, vec)
    product = [F.aggregate(F.zip_with(source, c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) for c in columns]
    return frame.select(*keep, F.when(source.isNotNull(), F.array(*product)).alias(target))


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
