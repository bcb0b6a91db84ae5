"""Evaluation queries: accuracy, error, reports, class lists, counts, orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.operators import knn, metrics
from vecforge.plans.common import DIGITS, K_DEFAULT, SQL_SPLIT, sql_neighbors, sql_vote, train_test
from vecforge.plans.registry import register
from vecforge.sources.tables import table

# Labels table: ``toxic`` plays the prediction, ``quality`` the label (numbers only).
SQL_LABEL_PAIRS = "lp AS (SELECT quality AS label, toxic AS prediction FROM labels)"


def _label_pairs(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("quality").alias("label"),
                                                 F.col("toxic").alias("prediction"))


def _knn_predictions(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    return knn.classify(test, train, K_DEFAULT, actual="label")


SQL_KNN_PRED = f"{SQL_SPLIT}, {sql_neighbors(K_DEFAULT)}, {sql_vote()}"

SQL_CLASS_COUNTS = """
cf AS (SELECT label, prediction, count(*) AS n FROM src GROUP BY label, prediction),
roles AS (SELECT label AS class, n AS support, 0 AS predicted, CASE WHEN label = prediction THEN n ELSE 0 END AS tp FROM cf
          UNION ALL SELECT prediction AS class, 0, n, 0 FROM cf),
cc AS (SELECT class, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted FROM roles GROUP BY class),
prf0 AS (SELECT class, tp, support, predicted,
                coalesce(tp / nullif(predicted, 0), 0.0) AS precision,
                coalesce(tp / nullif(support, 0), 0.0) AS recall FROM cc),
prf AS (SELECT *, coalesce(2.0 * precision * recall / nullif(precision + recall, 0), 0.0) AS f_score FROM prf0)
"""


@register("metric_accuracy", f"""
WITH {SQL_LABEL_PAIRS}
SELECT round(avg(CAST(label = prediction AS DOUBLE)), {DIGITS}) AS accuracy FROM lp
""")
def metric_accuracy(spark, sf_dir):
    """Share of rows whose prediction equals the label."""
    return metrics.accuracy(_label_pairs(spark, sf_dir)).select(F.round("accuracy", DIGITS).alias("accuracy"))


@register("metric_test_error", f"""
WITH {SQL_LABEL_PAIRS}
SELECT round(1.0 - avg(CAST(label = prediction AS DOUBLE)), {DIGITS}) AS test_error FROM lp
""")
def metric_test_error(spark, sf_dir):
    """1 - accuracy."""
    return metrics.test_error(_label_pairs(spark, sf_dir)).select(F.round("test_error", DIGITS).alias("test_error"))


@register("accuracy_by_filter", f"""
WITH {SQL_KNN_PRED}
SELECT count(*) FILTER (WHERE label = prediction) AS n_correct, count(*) AS n_total,
       round(count(*) FILTER (WHERE label = prediction) / count(*), {DIGITS}) AS accuracy FROM pred
""")
def accuracy_by_filter(spark, sf_dir):
    """rows with label = prediction counted against all kNN predictions."""
    out = metrics.correct_count(_knn_predictions(spark, sf_dir))
    return out.select("n_correct", "n_total", F.round("accuracy", DIGITS).alias("accuracy"))


SQL_OVERALL_REPORT = f"""
WITH {SQL_KNN_PRED}, src AS (SELECT label, prediction FROM pred), {SQL_CLASS_COUNTS},
act AS (SELECT * FROM prf WHERE support > 0),
agg AS (SELECT sum(tp) / sum(support) AS accuracy, avg(precision) AS macro_precision, avg(recall) AS macro_recall,
               avg(f_score) AS macro_f_score, sum(precision * support) / sum(support) AS weighted_precision,
               sum(recall * support) / sum(support) AS weighted_recall,
               sum(f_score * support) / sum(support) AS weighted_f_score FROM act)
SELECT round(accuracy, {DIGITS}) AS accuracy, round(accuracy, {DIGITS}) AS micro_precision,
       round(accuracy, {DIGITS}) AS micro_recall, round(accuracy, {DIGITS}) AS micro_f_score,
       round(macro_precision, {DIGITS}) AS macro_precision, round(macro_recall, {DIGITS}) AS macro_recall,
       round(macro_f_score, {DIGITS}) AS macro_f_score, round(weighted_precision, {DIGITS}) AS weighted_precision,
       round(weighted_recall, {DIGITS}) AS weighted_recall, round(weighted_f_score, {DIGITS}) AS weighted_f_score
FROM agg
"""


@register("overall_report", SQL_OVERALL_REPORT)
def overall_report(spark, sf_dir):
    """Accuracy with micro, macro and weighted precision / recall / F of kNN predictions."""
    return metrics.overall_report(_knn_predictions(spark, sf_dir), digits=DIGITS)


@register("classification_report", f"""
WITH {SQL_KNN_PRED}, src AS (SELECT label, prediction FROM pred), {SQL_CLASS_COUNTS}
SELECT class, round(precision, {DIGITS}) AS precision, round(recall, {DIGITS}) AS recall,
       round(f_score, {DIGITS}) AS f_score FROM prf WHERE support > 0
""")
def classification_report(spark, sf_dir):
    """Precision, recall, F per actual class of kNN predictions."""
    return metrics.classification_report(_knn_predictions(spark, sf_dir), digits=DIGITS)


@register("classification_report_full", f"""
WITH {SQL_LABEL_PAIRS}, src AS (SELECT label, prediction FROM lp), {SQL_CLASS_COUNTS},
tot AS (SELECT sum(tp) / sum(support) AS acc, sum(support) AS n, avg(precision) AS mp, avg(recall) AS mr,
               avg(f_score) AS mf, sum(precision * support) / sum(support) AS wp,
               sum(recall * support) / sum(support) AS wr, sum(f_score * support) / sum(support) AS wf FROM prf),
rows AS (SELECT CAST(class AS VARCHAR) AS class, precision, recall, f_score, CAST(support AS BIGINT) AS support FROM prf
         UNION ALL SELECT 'accuracy', NULL, NULL, acc, CAST(n AS BIGINT) FROM tot
         UNION ALL SELECT 'macro avg', mp, mr, mf, CAST(n AS BIGINT) FROM tot
         UNION ALL SELECT 'weighted avg', wp, wr, wf, CAST(n AS BIGINT) FROM tot)
SELECT class, round(precision, {DIGITS}) AS precision, round(recall, {DIGITS}) AS recall,
       round(f_score, {DIGITS}) AS f_score, support FROM rows
""")
def classification_report_full(spark, sf_dir):
    """E5: library-style report with support, accuracy, macro and weighted averages."""
    return metrics.classification_report_full(_label_pairs(spark, sf_dir), digits=DIGITS)


@register("distinct_classes", """
SELECT DISTINCT label AS class FROM embeddings WHERE vec_id % 5 = 0
""")
def distinct_classes(spark, sf_dir):
    """The sorted set of actual test labels."""
    _, test = train_test(spark, sf_dir)
    return metrics.distinct_classes(test)


@register("vote_counts", f"""
WITH {SQL_SPLIT}, {sql_neighbors(K_DEFAULT)}
SELECT test_id, train_label, count(*) AS votes FROM nb GROUP BY test_id, train_label
""")
def vote_counts(spark, sf_dir):
    """A1/A3: label frequency among each test row's k neighbours."""
    train, test = train_test(spark, sf_dir)
    nb = knn.neighbors(test, train, K_DEFAULT)
    return nb.groupBy("test_id", "train_label").agg(F.count(F.lit(1)).alias("votes"))


@register("row_counts", f"""
WITH {SQL_KNN_PRED}
SELECT (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM te) AS n_test,
       (SELECT count(*) FROM pred) AS n_predictions
""")
def row_counts(spark, sf_dir):
    """A4: rows in train, test and the prediction table, as one aggregate over their union."""
    train, test = train_test(spark, sf_dir)
    pred = knn.classify(test, train, K_DEFAULT)
    names = ["n_train", "n_test", "n_predictions"]
    parts = [side.select(F.lit(name).alias("of")) for side, name in zip((train, test, pred), names)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.agg(*[F.count_if(F.col("of") == name).alias(name) for name in names])


@register("predictions_sorted", f"""
WITH {SQL_KNN_PRED}
SELECT test_id, prediction FROM pred ORDER BY test_id
""")
def predictions_sorted(spark, sf_dir):
    """L1: predictions in test-id order (range-partitioned global sort)."""
    return _knn_predictions(spark, sf_dir).select("test_id", "prediction").orderBy("test_id")


@register("first_rows", f"""
WITH {SQL_KNN_PRED}
SELECT test_id, label, prediction FROM pred ORDER BY test_id LIMIT 10
""")
def first_rows(spark, sf_dir):
    """L4: the first 10 predictions by test id (a top-n report: the limit is the feature)."""
    return _knn_predictions(spark, sf_dir).orderBy("test_id").limit(10)


@register("join_actual_prediction", f"""
WITH {SQL_KNN_PRED}
SELECT test_id, label, prediction FROM pred
""")
def join_actual_prediction(spark, sf_dir):
    """Predictions (computed without the label) inner-joined to the actual test rows on
    the test id, giving (label, prediction) pairs for the reports."""
    train, test = train_test(spark, sf_dir)
    pred = knn.classify(test, train, K_DEFAULT)
    actual = test.select(F.col("id").alias("test_id"), "label")
    return actual.join(pred, "test_id").select("test_id", "label", "prediction")
