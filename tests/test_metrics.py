import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from locations import SF_MID
from vecforge.operators import metrics
from vecforge.sources.tables import table

PAIRS = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 0), (2, 0), (2, 0), (1, 3)]  # class 2 never predicted,
# class 3 predicted but never a label


def pairs_df(spark, rows=PAIRS):
    return spark.createDataFrame(rows, "label int, prediction int")


def test_class_report_edge_cases(spark):
    rep = {r["class"]: r for r in metrics.classification_report(pairs_df(spark), digits=6).collect()}
    assert sorted(rep) == [0, 1, 2]                      # predicted-only class 3 has no row
    assert rep[2]["precision"] == 0.0 and rep[2]["f_score"] == 0.0 and rep[2]["recall"] == 0.0
    # class 0: tp=2, predicted=5 (two 0s, 1->0, two 2->0), support=3
    assert rep[0]["precision"] == pytest.approx(0.4) and rep[0]["recall"] == pytest.approx(2 / 3)
    assert rep[0]["f_score"] == pytest.approx(2 * 0.4 * (2 / 3) / (0.4 + 2 / 3), abs=1e-6)


def test_overall_report_micro_is_accuracy(spark):
    row = metrics.overall_report(pairs_df(spark)).first()
    acc = sum(a == b for a, b in PAIRS) / len(PAIRS)
    assert row["accuracy"] == pytest.approx(acc)
    assert row["micro_precision"] == row["micro_recall"] == row["micro_f_score"] == row["accuracy"]
    assert row["weighted_recall"] == pytest.approx(acc)


def test_weighted_metrics_match_spark_evaluator(spark):
    labels = table(spark, SF_MID, "labels").selectExpr("cast(quality as double) label",
                                                       "cast(toxic as double) prediction")
    row = metrics.overall_report(labels).first()
    for metric, col in [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                        ("weightedRecall", "weighted_recall"), ("f1", "weighted_f_score")]:
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert row[col] == pytest.approx(ev.evaluate(labels), abs=1e-12), metric


def test_full_report_rows(spark):
    rows = {r["class"]: r for r in metrics.classification_report_full(pairs_df(spark)).collect()}
    assert set(rows) == {"0", "1", "2", "3", "accuracy", "macro avg", "weighted avg"}
    assert rows["3"]["support"] == 0 and rows["3"]["recall"] == 0.0
    assert rows["accuracy"]["precision"] is None and rows["accuracy"]["support"] == len(PAIRS)


def test_accuracy_and_error(spark):
    df = pairs_df(spark)
    acc = metrics.accuracy(df).first()["accuracy"]
    err = metrics.test_error(df).first()["test_error"]
    assert acc + err == pytest.approx(1.0)
    cc = metrics.correct_count(df).first()
    assert cc["n_correct"] == 3 and cc["n_total"] == 8


def test_distinct_classes_sorted(spark):
    assert [r["class"] for r in metrics.distinct_classes(pairs_df(spark)).collect()] == [0, 1, 2]


def test_evaluate_matches_separate_reports(spark):
    df = pairs_df(spark)
    overall, per_class = metrics.evaluate(df, digits=6)
    assert overall.collect() == metrics.overall_report(df, digits=6).collect()
    assert per_class.collect() == metrics.classification_report(df, digits=6).collect()


def test_null_prediction_counts_as_wrong(spark):
    pred = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "label int, prediction double")
    assert abs(metrics.accuracy(pred).first()["accuracy"] - 2 / 3) < 1e-12
    assert abs(metrics.correct_count(pred).first()["accuracy"] - 2 / 3) < 1e-12
