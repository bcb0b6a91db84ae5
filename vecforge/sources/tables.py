"""Parquet table loaders and the labelled-vector frame used across the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecforge.functions.vectors import as_double_array

# How the embeddings table is split into test and train rows.
TEST_MODULUS = 5
TEST_REMAINDER = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as ``(id long, vec array<double>, label int)``; float32 widened once at the scan."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"), as_double_array("embedding").alias("vec"),
                      F.col("label"))


def is_test_row(id_col: str = "id"):
    return F.pmod(F.col(id_col), F.lit(TEST_MODULUS)) == TEST_REMAINDER


def split_train_test(frame: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Deterministic split by id: rows with ``id % 5 = 0`` are the test set, the rest train.

    The predicate is on the key itself, evaluated at the scan (of it only the null check reaches the
    file reader), and re-running a lost task reproduces exactly the same rows.
    """
    test = frame.filter(is_test_row(id_col))
    train = frame.filter(~is_test_row(id_col))
    return train, test


def planted_label(vec_col: str = "vec", width: int = 4):
    """A learnable label: index of the largest of the first ``width`` coordinates."""
    head = F.slice(F.col(vec_col), 1, width)
    return (F.array_position(head, F.array_max(head)) - 1).cast("int")
