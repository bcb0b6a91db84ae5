import numpy as np
import pytest
from pyspark.sql import functions as F

from locations import SF_MID
from vecforge.operators import pca, randomized_pca
from vecforge.plans.common import train_test


def rows(spark, matrix, parts=5):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(matrix)], "id long, vec array<double>").repartition(parts)


def test_axes_equal_those_of_the_full_matrix(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 30)) * np.geomspace(10, 0.05, 30) + 3
    frame = rows(spark, x).unionByName(spark.createDataFrame([(999, None)], "id long, vec array<double>"))
    got = randomized_pca.fit(frame, 6)
    model = pca.fit(frame.filter("vec IS NOT NULL"), 6)
    want = model.pc.toArray()
    for a, b in zip(got.components.T, want.T):
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
    assert np.allclose(got.ratio, model.explainedVariance.toArray(), rtol=1e-8)
    assert np.allclose(got.components.T @ got.components, np.eye(6), atol=1e-10)
    assert got.rows == 400 and np.allclose(got.mean, x.mean(axis=0))
    out = {r["id"]: r["vec"] for r in randomized_pca.project(got, frame).collect()}
    assert out[999] is None and np.allclose([out[i] for i in range(400)], x @ got.components)


def test_embeddings(spark):
    """The tables' vectors have no few strong axes: the full width is found exactly, and a part nearly."""
    train, _ = train_test(spark, SF_MID)
    full = pca.fit(train, 64)
    got = randomized_pca.fit(train, 64)
    assert np.allclose(got.ratio, full.explainedVariance.toArray(), atol=1e-9)
    some = randomized_pca.fit(train, 8, powers=12)
    assert np.allclose(some.ratio, full.explainedVariance.toArray()[:8], rtol=0.02)


def test_ends(spark):
    flat = randomized_pca.fit(rows(spark, np.ones((5, 4))), 2)
    assert flat.variance.tolist() == [0, 0] and flat.components.shape == (4, 2)
    line = randomized_pca.fit(rows(spark, np.outer(np.arange(6), [3.0, 4.0])), 2)
    assert np.allclose(np.abs(line.components[:, 0]), [0.6, 0.8]) and abs(line.ratio[0] - 1) < 1e-9
    few = randomized_pca.fit(rows(spark, np.random.default_rng(0).normal(size=(3, 9))), 5)
    assert few.components.shape[1] <= 5 and abs(few.ratio.sum() - 1) < 1e-9
    with pytest.raises(ValueError, match="two vectors"):
        randomized_pca.fit(rows(spark, np.ones((1, 4))), 2)
    with pytest.raises(ValueError, match="two vectors"):
        randomized_pca.fit(rows(spark, np.ones((2, 4))).filter(F.col("id") < 0), 2)
