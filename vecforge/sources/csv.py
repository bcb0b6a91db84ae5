"""Headerless label-first CSV, the split features/labels layout, and report files.

Label-first layout: column ``_c0`` is the class, ``_c1 .. _cd`` the feature values, no header.
Split layout: a features file (``_c0 .. _c{d-1}``) and a labels file (``_c0``), paired by row
position. Reads take an explicit schema (no inference job) unless asked to infer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.operators.rowid import with_file_order_index


def label_first_schema(n_features: int, label_type: T.DataType = T.IntegerType()) -> T.StructType:
    return T.StructType([T.StructField("_c0", label_type)] +
                        [T.StructField(f"_c{i}", T.DoubleType()) for i in range(1, n_features + 1)])


def features_schema(n_features: int) -> T.StructType:
    return T.StructType([T.StructField(f"_c{i}", T.DoubleType()) for i in range(n_features)])


def read_label_first(spark: SparkSession, path: str, n_features: int | None = None,
                     infer_schema: bool = False) -> DataFrame:
    """Wide frame ``_c0 .. _cd``. Give ``n_features`` for a schema-on-read scan."""
    reader = spark.read.option("header", "false")
    if n_features is not None:
        return reader.schema(label_first_schema(n_features)).csv(path)
    return reader.option("inferSchema", str(bool(infer_schema)).lower()).csv(path)


def split_label_features(wide: DataFrame, label_col: str = "_c0", label: str = "label",
                         vec: str = "vec") -> DataFrame:
    """Label column apart and renamed; every other column, in order, assembled into one vector."""
    feats = [c for c in wide.columns if c != label_col]
    return wide.select(F.col(label_col).alias(label),
                       F.array(*[F.col(c).cast("double") for c in feats]).alias(vec))


def vector_width(frame: DataFrame, vec: str = "vec") -> int:
    row = frame.agg(F.max(F.size(vec)).alias("d")).first()
    return int(row["d"] or 0)


def _wide(frame: DataFrame, vec: str, d: int, first: int) -> list:
    return [F.get(F.col(vec), i).alias(f"_c{i + first}") for i in range(d)]


def write_label_first(frame: DataFrame, path: str, label: str = "label", vec: str = "vec",
                      n_features: int | None = None, mode: str = "overwrite") -> int:
    """Write ``label, v0 .. v{d-1}`` without header; returns ``d``."""
    d = n_features or vector_width(frame, vec)
    frame.select(F.col(label).alias("_c0"), *_wide(frame, vec, d, 1)).write.mode(mode).option(
        "header", "false").csv(path)
    return d


def write_split_layout(frame: DataFrame, features_path: str, labels_path: str, order_by: str = "id",
                       label: str = "label", vec: str = "vec", n_features: int | None = None,
                       mode: str = "overwrite", partitions: int | None = None) -> int:
    """Features and labels to two files whose row positions correspond.

    Both writes range-partition and sort by the same unique key, so file-name order is key
    order in each output (the range count is ``partitions`` or ``spark.sql.shuffle.partitions``;
    adaptive execution only merges neighbouring ranges). Row ``i`` of one output pairs with row ``i`` of
    the other whatever the file boundaries.
    """
    d = n_features or vector_width(frame, vec)
    ranged = (frame.repartitionByRange(partitions, order_by) if partitions
              else frame.repartitionByRange(order_by))
    ordered = ranged.sortWithinPartitions(order_by)
    ordered.select(*_wide(ordered, vec, d, 0)).write.mode(mode).option("header", "false").csv(features_path)
    ordered.select(F.col(label).alias("_c0")).write.mode(mode).option("header", "false").csv(labels_path)
    return d


def read_split_layout(spark: SparkSession, features_path: str, labels_path: str, n_features: int,
                      label_type: T.DataType = T.IntegerType(), vec: str = "vec",
                      label: str = "label") -> DataFrame:
    """``(row_index, label, vec)``: both files numbered contiguously in file order, then joined."""
    feats = with_file_order_index(
        spark.read.option("header", "false").schema(features_schema(n_features)).csv(features_path))
    labs = with_file_order_index(
        spark.read.option("header", "false").schema(T.StructType([T.StructField("_c0", label_type)]))
        .csv(labels_path))
    f2 = feats.select("row_index", F.array(*[F.col(f"_c{i}") for i in range(n_features)]).alias(vec))
    l2 = labs.select("row_index", F.col("_c0").alias(label))
    return l2.join(f2, "row_index")


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report (one row per class at most) as a single CSV file with header."""
    report.coalesce(1).write.mode(mode).option("header", "true").csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A score series (e.g. accuracy per k of a sweep) as parquet."""
    scores.write.mode(mode).parquet(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def report_lines(report: DataFrame, sep: str = "\t") -> list[str]:
    """A report as text lines (header, then one line per row), for printing at the edge.

    Reports hold one row per class (or one row overall), so collecting them is bounded.
    """
    rows = report.collect()
    lines = [sep.join(report.columns)]
    lines += [sep.join("" if v is None else str(v) for v in row) for row in rows]
    return lines


def read_four_file_layout(spark: SparkSession, train_features: str, train_labels: str,
                          test_features: str, test_labels: str, n_features: int,
                          label_type: T.DataType = T.IntegerType()) -> tuple[DataFrame, DataFrame]:
    """Train and test sets each stored as a features file and a labels file (four headerless
    files): ``(train, test)`` as ``(id, label, vec)`` with ``id`` the contiguous row position."""
    def one(features: str, labels: str) -> DataFrame:
        both = read_split_layout(spark, features, labels, n_features, label_type)
        return both.select(F.col("row_index").alias("id"), "label", "vec")
    return one(train_features, train_labels), one(test_features, test_labels)
