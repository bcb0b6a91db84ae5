"""Models worked out again with numpy: the whole-table fits and the component sweep."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from locations import SF_SMALL
from vecforge.functions.vectors import to_vector
from vecforge.operators import classify
from vecforge.plans import model_queries
from vecforge.plans.common import SWEEP_KS, train_test


def query(spark, name):
    return contract.queries()[name](spark, SF_SMALL).collect()


@pytest.fixture(scope="module")
def lineitem(spark):
    rows = model_queries.lineitem_vectors(spark, SF_SMALL).collect()
    return [(r["l_orderkey"], r["l_linenumber"]) for r in rows], np.array([r["vec"] for r in rows]), np.array([r["label"] for r in rows])


def test_pca_lineitem(spark, lineitem):
    _, x, _ = lineitem
    values, axes = np.linalg.eigh(np.cov(x.T))
    axes = axes[:, np.argsort(-values)[:2]]
    want = x @ axes
    got = np.array(sorted((r["l_orderkey"], r["l_linenumber"], r["pc0"], r["pc1"]) for r in query(spark, "pca_lineitem")))
    order = np.lexsort((want[:, 1], want[:, 0], [k[1] for k in lineitem[0]], [k[0] for k in lineitem[0]]))
    for j in range(2):
        a, b = np.sort(got[:, 2 + j]), np.sort(want[order, j])
        assert min(np.abs(a - b).max(), np.abs(a + b[::-1]).max()) < 1e-5 * np.abs(b).max()


def test_logreg_lineitem(spark, lineitem):
    """Probabilities by the softmax of the weights; and at the optimum each weight's score equation holds."""
    train, test = model_queries.lineitem_split(spark, SF_SMALL)
    model = classify.fit_logistic_regression(train, max_iter=50)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()

    def softmax(x):
        z = x @ w.T + b
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    rows = test.collect()
    x = np.array([r["vec"] for r in rows])
    p = softmax(x)
    want = Counter((r["l_orderkey"], r["l_linenumber"], r["label"], float(np.argmax(q))) for r, q in zip(rows, p))
    got = query(spark, "logreg_lineitem")
    assert Counter((r["l_orderkey"], r["l_linenumber"], r["label"], r["prediction"]) for r in got) == want
    assert np.allclose(np.sort([r["probability"] for r in got], axis=0), np.sort(p, axis=0), atol=1e-6)
    rows = train.collect()
    x, y = np.array([r["vec"] for r in rows]), np.array([r["label"] for r in rows])
    scaled = np.column_stack([np.ones(len(x)), x / x.std(axis=0)])
    gradient = (softmax(x) - np.eye(len(b))[y]).T @ scaled / len(x)
    assert np.abs(gradient).max() < 5e-3  # every weight's, intercepts first


def test_rf_lineitem(spark, lineitem):
    """The forest's probabilities are the mean of its trees' class shares."""
    train, test = model_queries.lineitem_split(spark, SF_SMALL)
    model = classify.fit_random_forest(train)
    some = test.withColumn("_features", to_vector("vec"))
    total = {}
    for i, tree in enumerate(model.trees):
        assert tree.depth <= 5
        for r in tree.transform(some).select("l_orderkey", "l_linenumber", "_features", "probability").collect():
            key = (r["l_orderkey"], r["l_linenumber"], tuple(r["_features"].toArray()))
            total.setdefault(key, {})[i] = r["probability"].toArray()
    want = Counter((k[0], k[1], float(np.argmax(sum(v.values()) / len(model.trees)))) for k, v in total.items())
    got = Counter({(r["l_orderkey"], r["l_linenumber"], r["prediction"]): 1 for r in query(spark, "rf_lineitem")})
    assert set(got) == set(want) and len(model.trees) == 10


def test_components_sweep(spark):
    """Principal axes, the count for 95 % of the variance, projections, neighbours and votes, all in numpy."""
    train, test = (side.orderBy("id").collect() for side in train_test(spark, SF_SMALL))
    x, q = (np.array([r["vec"] for r in side]) for side in (train, test))
    labels = np.array([r["label"] for r in train])
    values, axes = np.linalg.eigh(np.cov(x.T))
    order = np.argsort(-values)
    need = int(np.searchsorted(np.cumsum(values[order]) / values.sum(), 0.95, "right")) + 1
    axes = axes[:, order[:need]]
    distance = np.sqrt((((q @ axes)[:, None, :] - (x @ axes)[None, :, :]) ** 2).sum(axis=2))
    right = dict.fromkeys(SWEEP_KS, 0)
    for r, d in zip(test, distance):
        near = np.argsort(d, kind="stable")
        for k in SWEEP_KS:
            votes = Counter(labels[near[:k]].tolist())
            first = {}
            for i in near[:k]:
                first.setdefault(int(labels[i]), d[i])
            best = min(votes, key=lambda c: (-votes[c], first[c], c))
            right[k] += best == r["label"]
    got = {r["k"]: (r["d"], r["accuracy"]) for r in query(spark, "knn_components_sweep")}
    assert got == {k: (need, round(n / len(test), 6)) for k, n in right.items()}


def test_grid_at_fifty_components(spark):
    """The (d, k) grid below full width, in numpy."""
    train, test = (side.orderBy("id").collect() for side in train_test(spark, SF_SMALL))
    x, q = (np.array([r["vec"] for r in side]) for side in (train, test))
    labels = np.array([r["label"] for r in train])
    values, axes = np.linalg.eigh(np.cov(x.T))
    axes = axes[:, np.argsort(-values)[:50]]
    distance = np.sqrt((((q @ axes)[:, None, :] - (x @ axes)[None, :, :]) ** 2).sum(axis=2))
    got = {(r["d"], r["k"]): r["accuracy"] for r in query(spark, "knn_grid")}
    for k in (5, 10):
        right = 0
        for r, d in zip(test, distance):
            near = np.argsort(d, kind="stable")[:k]
            votes = Counter(labels[near].tolist())
            first = {}
            for i in near:
                first.setdefault(int(labels[i]), d[i])
            right += min(votes, key=lambda c: (-votes[c], first[c], c)) == r["label"]
        assert got[50, k] == round(right / len(test), 6)


def test_score_equations_of_the_vectors(spark):
    """C1 on a learnable label: with a penalty-free fit the class sums of every feature are met."""
    train, _ = train_test(spark, SF_SMALL)
    rows = train.withColumn("label", (F.get("vec", 0) + 0.5 * F.sin(F.col("id") * 1.7) > 0).cast("int")).collect()
    x, y = np.array([r["vec"][:4] for r in rows]), np.array([r["label"] for r in rows])
    small = spark.createDataFrame([([float(v) for v in a], int(c)) for a, c in zip(x, y)], "vec array<double>, label int")
    model = classify.fit_logistic_regression(small)
    z = x @ model.coefficientMatrix.toArray().T + model.interceptVector.toArray()
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    design = np.column_stack([np.ones(len(x)), x])
    assert np.abs((p - np.eye(2)[y]).T @ design).max() < 1e-2 * len(x) ** 0.5
