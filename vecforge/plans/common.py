"""Shared inputs and SQL fragments for the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecforge.functions.vectors import scale
from vecforge.sources.tables import labelled_vectors, split_train_test

# The run configuration of the original kNN scripts.
K_DEFAULT = 5
DIGITS = 6
SWEEP_KS = list(range(1, 10))          # k = 1 .. 9
SCALE_MODULUS = 7                      # cosine inputs are scaled by 1 + id % 7


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_vectors(spark, sf_dir)


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return split_train_test(vectors(spark, sf_dir))


def scaled(frame: DataFrame) -> DataFrame:
    """Vectors scaled by ``1 + id % 7`` so that Euclidean and cosine neighbours differ."""
    return frame.withColumn("vec", scale("vec", F.lit(1) + F.pmod(F.col("id"), F.lit(SCALE_MODULUS))))


def r6(col: str, name: str | None = None):
    return F.round(F.col(col), DIGITS).alias(name or col)


def spread(vec: str, width: int, name: str):
    """Columns ``<name>0, <name>1, ...``: the elements of a vector, rounded, so that all of it is compared."""
    return [F.round(F.get(F.col(vec), i), DIGITS).alias(f"{name}{i}") for i in range(width)]


def sql_spread(vec: str, width: int, name: str) -> str:
    return ", ".join(f"round(CAST({vec}[{i + 1}] AS DOUBLE), {DIGITS}) AS {name}{i}" for i in range(width))


VECTOR_WIDTH = 64  # of the embeddings


# ---------------------------------------------------------------------------------------
# DuckDB SQL fragments (tables are views named after the parquet files)
# ---------------------------------------------------------------------------------------

SQL_SPLIT = """
e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings),
te AS (SELECT * FROM e WHERE id % 5 = 0),
tr AS (SELECT * FROM e WHERE id % 5 <> 0)
"""

SQL_SPLIT_SCALED = """
e0 AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings),
e AS (SELECT id, list_transform(vec, lambda x: x * (1 + id % 7)) AS vec, label FROM e0),
te AS (SELECT * FROM e WHERE id % 5 = 0),
tr AS (SELECT * FROM e WHERE id % 5 <> 0)
"""


def sql_cos(a: str, b: str) -> str:
    return (f"(list_dot_product({a}, {b}) / nullif(sqrt(list_dot_product({a}, {a})) * "
            f"sqrt(list_dot_product({b}, {b})), 0))")


def sql_neighbors(k: int, metric: str = "euclidean", test: str = "te", train: str = "tr") -> str:
    """CTEs ``pr`` (all scored pairs - brute force is the oracle's job) and ``nb`` (top k)."""
    if metric == "euclidean":
        score, name, order = "list_distance(q.vec, t.vec)", "distance", "distance ASC, train_id ASC"
    else:
        score, name, order = sql_cos("q.vec", "t.vec"), "similarity", "similarity DESC NULLS LAST, train_id ASC"
    return f"""
pr AS (SELECT q.id AS test_id, q.label AS label, t.id AS train_id, t.label AS train_label,
              {score} AS {name}
       FROM {test} q, {train} t),
nb AS (SELECT *, CAST(row_number() OVER (PARTITION BY test_id ORDER BY {order}) AS INTEGER) AS rnk
       FROM pr QUALIFY rnk <= {k})
"""


def sql_vote(metric: str = "euclidean", source: str = "nb", keys: str = "test_id, label") -> str:
    """CTEs ``vt`` (tallies) and ``pred`` (one label per test row)."""
    if metric == "euclidean":
        best, order = "min(distance)", "best ASC"
    else:
        best, order = "max(similarity)", "best DESC NULLS LAST"
    return f"""
vt AS (SELECT {keys}, train_label, count(*) AS votes, {best} AS best FROM {source}
       GROUP BY {keys}, train_label),
pred AS (SELECT {keys}, train_label AS prediction, votes, best FROM vt
         QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY votes DESC, {order}, train_label ASC) = 1)
"""
