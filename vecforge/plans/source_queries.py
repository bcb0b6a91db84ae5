"""Source / sink queries: label-first CSV, split layout, report file round trips.

Each writes data derived from the parquet tables to a fresh folder under the session's shared
checkpoint directory, then scans it back with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.operators import knn, metrics
from vecforge.plans import eval_queries, knn_queries
from vecforge.plans.common import (DIGITS, K_DEFAULT, SQL_SPLIT, VECTOR_WIDTH, spread, sql_neighbors, sql_spread, sql_vote,
                                   train_test, vectors)
from vecforge.plans.registry import register
from vecforge.session import scratch_path
from vecforge.sources import csv

WIDTH = VECTOR_WIDTH  # the scans are schema-on-read


def _wide_sql(first: int) -> str:
    return ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), {DIGITS}) AS _c{i + first}" for i in range(WIDTH))


@register("csv_label_first_scan", f"""
SELECT label AS _c0, {_wide_sql(1)} FROM embeddings
""")
def csv_label_first_scan(spark, sf_dir):
    """Headerless label-first CSV written from ``embeddings`` and scanned back (_c0 int, rest double)."""
    path = scratch_path(spark, "label-first-csv")
    csv.write_label_first(vectors(spark, sf_dir), path, n_features=WIDTH)
    wide = csv.read_label_first(spark, path, n_features=WIDTH)
    return wide.select("_c0", *[F.round(f"_c{i}", DIGITS).alias(f"_c{i}") for i in range(1, WIDTH + 1)])


@register("split_label_features", f"""
SELECT label, CAST(len(embedding) AS INTEGER) AS n_features, {sql_spread("embedding", WIDTH, "f")} FROM embeddings
""")
def split_label_features(spark, sf_dir):
    """Label column apart and renamed, the other columns assembled in order."""
    path = scratch_path(spark, "label-first-csv")
    csv.write_label_first(vectors(spark, sf_dir), path, n_features=WIDTH)
    split = csv.split_label_features(csv.read_label_first(spark, path, n_features=WIDTH))
    return split.select("label", F.size("vec").alias("n_features"), *spread("vec", WIDTH, "f"))


@register("csv_split_layout_scan", f"""
SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS row_index, label, {sql_spread("embedding", WIDTH, "f")}
FROM embeddings
""")
def csv_split_layout_scan(spark, sf_dir):
    """Features and labels in two headerless files, re-paired by contiguous row position."""
    feats = scratch_path(spark, "split-features")
    labels = scratch_path(spark, "split-labels")
    csv.write_split_layout(vectors(spark, sf_dir), feats, labels, order_by="id", n_features=WIDTH)
    both = csv.read_split_layout(spark, feats, labels, WIDTH)
    return both.select("row_index", "label", *spread("vec", WIDTH, "f"))


REPORT_SCHEMA = T.StructType([T.StructField("class", T.IntegerType()), T.StructField("precision", T.DoubleType()),
                              T.StructField("recall", T.DoubleType()), T.StructField("f_score", T.DoubleType())])


@register("report_csv_roundtrip", f"""
WITH {SQL_SPLIT}, {sql_neighbors(K_DEFAULT)}, {sql_vote()},
cf AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY label, prediction),
cc AS (SELECT c.class, sum(CASE WHEN cf.label = c.class AND cf.prediction = c.class THEN n ELSE 0 END) AS tp,
              sum(CASE WHEN cf.label = c.class THEN n ELSE 0 END) AS support,
              sum(CASE WHEN cf.prediction = c.class THEN n ELSE 0 END) AS predicted
       FROM (SELECT DISTINCT label AS class FROM pred) c, cf GROUP BY c.class),
p AS (SELECT class, coalesce(tp / nullif(predicted, 0), 0.0) AS precision, coalesce(tp / nullif(support, 0), 0.0) AS recall FROM cc)
SELECT class, round(precision, 3) AS precision, round(recall, 3) AS recall,
       round(coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0), 3) AS f_score FROM p
""")
def report_csv_roundtrip(spark, sf_dir):
    """The per-class report (3 decimals) written as one CSV file with header and read back."""
    train, test = train_test(spark, sf_dir)
    pred = knn.classify(test, train, K_DEFAULT, actual="label")
    path = scratch_path(spark, "class-report")
    csv.write_report(metrics.classification_report(pred, digits=3), path)
    return csv.read_report(spark, path, REPORT_SCHEMA)


@register("score_series_roundtrip", knn_queries.SQL_K_SWEEP)
def score_series_roundtrip(spark, sf_dir):
    """The k-sweep accuracy series saved as parquet and read back."""
    path = scratch_path(spark, "k-sweep-scores")
    csv.write_scores(knn_queries.knn_k_sweep(spark, sf_dir), path)
    return csv.read_scores(spark, path)


@register("csv_pca_knn_report", eval_queries.SQL_OVERALL_REPORT)
def csv_pca_knn_report(spark, sf_dir):
    """The whole classification flow from files: train and test as headerless label-first CSV,
    scanned back (S1), label split off (P2/P3), increasing ids (P4), PCA fitted on train and
    applied to both (R1/R2, full width so the SQL oracle stays exact), kNN (k = 5) and the
    overall report (E3)."""
    from vecforge.operators import pca, rowid
    train, test = train_test(spark, sf_dir)
    base = scratch_path(spark, "labelled-csv")
    csv.write_label_first(train, f"{base}/train", n_features=WIDTH)
    csv.write_label_first(test, f"{base}/test", n_features=WIDTH)
    tr = rowid.with_row_id(csv.split_label_features(csv.read_label_first(spark, f"{base}/train", WIDTH)), "id")
    te = rowid.with_row_id(csv.split_label_features(csv.read_label_first(spark, f"{base}/test", WIDTH)), "id")
    model = pca.fit(tr, WIDTH)
    pred = knn.classify(pca.project(model, te), pca.project(model, tr), K_DEFAULT, actual="label")
    return metrics.overall_report(pred, digits=DIGITS)
