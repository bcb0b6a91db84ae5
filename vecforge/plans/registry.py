"""Registry of named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

A query may come with DuckDB SQL that computes the same rows from the same parquet tables
(the correctness oracle); operators without an exact SQL form register none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return wrap


def load_all() -> None:
    from vecforge.plans import (eval_queries, exact_search_queries, forest_queries, knn_queries, model_queries,  # noqa: F401
                                source_queries, vector_queries)
