"""Vector arithmetic on ``array<double>`` columns, as built-in higher-order functions.

These stay inside the JVM (no Python UDF) and follow one convention: vectors are
``array<double>``; ML ``VectorUDT`` columns are converted only at the ML boundary
(`to_array` / `to_vector`). Sums are left folds, so results are reproducible.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double_array(col: ColumnOrName) -> Column:
    """Cast a numeric array (e.g. ``array<float>``) to ``array<double>`` before arithmetic."""
    return _c(col).cast("array<double>")


def to_array(col: ColumnOrName) -> Column:
    """ML vector (dense or sparse) to ``array<double>``."""
    return vector_to_array(_c(col), "float64")


def to_vector(col: ColumnOrName) -> Column:
    """``array<double>`` to a dense ML vector."""
    return array_to_vector(_c(col))


def vsum(col: ColumnOrName) -> Column:
    return F.aggregate(_c(col), F.lit(0.0), lambda acc, x: acc + x)


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Inner product; null if the lengths differ."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def norm2(a: ColumnOrName) -> Column:
    """Sum of squares."""
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x * x)


def norm(a: ColumnOrName) -> Column:
    return F.sqrt(norm2(a))


def squared_euclidean(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Sum of squared differences, summed left to right."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x - y), F.lit(0.0),
                       lambda acc, d: acc + d * d)


def euclidean(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.sqrt(squared_euclidean(a, b))


def cosine_similarity(a: ColumnOrName, b: ColumnOrName) -> Column:
    """dot / (|a| |b|); higher means nearer. Null when either norm is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def subtract(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x - y)


def add(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def scale(a: ColumnOrName, factor: ColumnOrName | float) -> Column:
    f = factor if isinstance(factor, Column) else (F.col(factor) if isinstance(factor, str) else F.lit(float(factor)))
    return F.transform(_c(a), lambda x: x * f)


def power(a: ColumnOrName, exponent: float) -> Column:
    """Element-wise power of a vector (``pow`` on each element)."""
    return F.transform(_c(a), lambda x: F.pow(x, F.lit(float(exponent))))


def element(a: ColumnOrName, index: int) -> Column:
    """0-based element; null when out of range (``get`` never fails under ANSI mode)."""
    return F.get(_c(a), index)


def truncate(a: ColumnOrName, n: int) -> Column:
    """First ``n`` components."""
    return F.slice(_c(a), 1, int(n))


def round_vector(a: ColumnOrName, digits: int = 6) -> Column:
    return F.transform(_c(a), lambda x: F.round(x, digits))
