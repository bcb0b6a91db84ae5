import numpy as np
import pytest

from locations import SF_MID
from vecforge.operators import knn, pca
from vecforge.plans.common import train_test


@pytest.fixture(scope="module")
def data(spark):
    train, test = train_test(spark, SF_MID)
    x = np.array([r["vec"] for r in train.orderBy("id").collect()])
    return train, test, x


def test_explained_variance_matches_eigenvalues(spark, data):
    train, _, x = data
    model = pca.fit(train, x.shape[1])
    ev = np.array([r["ratio"] for r in pca.explained_variance(model).orderBy("component").collect()])
    eig = np.sort(np.linalg.eigvalsh(np.cov(x, rowvar=False)))[::-1]
    assert np.allclose(ev, eig / eig.sum(), atol=1e-10)
    assert ev.sum() == pytest.approx(1.0)


def test_components_orthonormal_and_projection(spark, data):
    train, test, x = data
    model = pca.fit(train, 8)
    pc = model.pc.toArray()
    assert np.allclose(pc.T @ pc, np.eye(8), atol=1e-10)
    proj = pca.project(model, train).orderBy("id").collect()
    got = np.array([r["vec"] for r in proj])
    assert np.allclose(got, x @ pc, atol=1e-10)          # no centring
    comp = pca.components(model).collect()
    assert len(comp) == 8 * x.shape[1]


def test_components_for_target(spark, data):
    train, _, x = data
    var = pca.explained_variance(pca.fit(train, x.shape[1]))
    rows = {r["target"]: r["n_components"] for r in pca.components_for_target(var, [0.5, 0.9, 0.95]).collect()}
    cum = np.cumsum([r["ratio"] for r in var.orderBy("component").collect()])
    for t, n in rows.items():
        assert n == int(np.argmax(cum > t)) + 1
    assert rows[0.5] <= rows[0.9] <= rows[0.95]


def test_full_width_pca_keeps_euclidean_neighbours(spark, data):
    train, test, x = data
    model = pca.fit(train, x.shape[1])
    a = knn.neighbors(test, train, 5).select("test_id", "train_id", "rank").collect()
    b = knn.neighbors(pca.project(model, test), pca.project(model, train), 5).select(
        "test_id", "train_id", "rank").collect()
    assert sorted(a) == sorted(b)


def test_grid_full_width_equals_raw_space(spark, data):
    import __spark_entry__ as contract
    from pyspark.sql import functions as F
    train, test, x = data
    grid = {(r["d"], r["k"]): r["accuracy"] for r in contract.queries()["knn_grid"](spark, SF_MID).collect()}
    for k in (5, 10):
        pred = knn.classify(test, train, k, actual="label")
        acc = pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
        assert grid[(64, k)] == pytest.approx(round(acc, 6))
    assert {d for d, _ in grid} == {16, 32, 50, 64}
