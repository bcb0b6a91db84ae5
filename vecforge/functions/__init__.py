"""Column expressions over ``array<double>`` vectors."""

from vecforge.functions.vectors import (
    add, as_double_array, cosine_similarity, dot, element, euclidean, norm, norm2, power,
    round_vector, scale, squared_euclidean, subtract, to_array, to_vector, truncate, vsum,
)

__all__ = [
    "add", "as_double_array", "cosine_similarity", "dot", "element", "euclidean", "norm",
    "norm2", "power", "round_vector", "scale", "squared_euclidean", "subtract", "to_array",
    "to_vector", "truncate", "vsum",
]
