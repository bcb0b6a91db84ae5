"""PCA, then a classifier, then the reports: scores worked out again from the prediction frame."""

import pytest

import __spark_entry__ as contract
from locations import SF_MID
from vecforge.operators import classify
from vecforge.plans import model_queries


@pytest.mark.parametrize("name,fit", [("logreg_pca_report", classify.fit_logistic_regression),
                                      ("rf_pca_report", classify.fit_random_forest)])
def test_report(spark, name, fit):
    report = {r["class"]: r for r in contract.queries()[name](spark, SF_MID).collect()}
    pred = [(float(r["label"]), r["prediction"]) for r in model_queries.pca_predictions(spark, SF_MID, fit).collect()]
    accuracy = sum(a == b for a, b in pred) / len(pred)
    labels = [a for a, _ in pred]
    assert accuracy > max(map(labels.count, set(labels))) / len(labels)  # better than the commonest class
    assert set(report) == {a for a, _ in pred}
    for c, r in report.items():
        tp = sum(a == b == c for a, b in pred)
        support, told = sum(a == c for a, _ in pred), sum(b == c for _, b in pred)
        assert r["support"] == support and abs(r["recall"] - tp / support) < 1e-9
        assert abs(r["precision"] - (tp / told if told else 0)) < 1e-9
        assert abs(r["accuracy"] - accuracy) < 1e-9 and abs(r["test_error"] - (1 - accuracy)) < 1e-9
