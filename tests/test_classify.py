import numpy as np
import pytest

from locations import SF_MID
from vecforge.operators import classify, metrics
from vecforge.plans.common import train_test
from vecforge.sources.tables import planted_label


@pytest.fixture(scope="module")
def planted(spark):
    train, test = train_test(spark, SF_MID)
    return train.withColumn("label", planted_label()), test.withColumn("label", planted_label())


def test_logistic_regression(spark, planted):
    train, test = planted
    model = classify.fit_logistic_regression(train)
    coef = classify.coefficients(model).collect()
    assert len(coef) == 4 * (64 + 1)                     # classes x (features + intercept)
    pred = classify.predict(model, test, keep=["id", "label"])
    rows = pred.collect()
    for r in rows:
        p = np.array(r["probability"])
        assert p.sum() == pytest.approx(1.0) and int(np.argmax(p)) == int(r["prediction"])
    acc = metrics.accuracy(pred).first()["accuracy"]
    assert acc > 0.6                                      # chance is about 0.25
    hist = classify.training_history(model).collect()
    assert hist[-1]["objective"] <= hist[0]["objective"]


def test_random_forest_repeats_with_seed(spark, planted):
    train, test = planted
    a = classify.predict(classify.fit_random_forest(train), test, keep=["id"]).orderBy("id").collect()
    b = classify.predict(classify.fit_random_forest(train), test, keep=["id"]).orderBy("id").collect()
    assert [r["prediction"] for r in a] == [r["prediction"] for r in b]
    acc = np.mean([r["prediction"] == lab for r, lab in
                   zip(a, [x["label"] for x in test.orderBy("id").collect()])])
    assert acc > 0.4
    imp = classify.feature_importances(classify.fit_random_forest(train)).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)


def test_random_forest_probabilities(spark, planted):
    train, test = planted
    rows = classify.predict(classify.fit_random_forest(train), test, keep=["id"]).collect()
    for r in rows:
        p = np.array(r["probability"])
        assert p.sum() == pytest.approx(1.0) and int(np.argmax(p)) == int(r["prediction"])
