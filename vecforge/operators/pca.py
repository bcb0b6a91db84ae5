"""Principal component analysis with ``pyspark.ml`` and the tables derived from a fitted model.

The fit is a distributed covariance aggregate (a ``d x d`` result on the driver, fine for
widths in the thousands); projection is a row-wise transform. ``PCAModel.transform`` does not
centre, so a full-width projection is a rotation and keeps Euclidean distances.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, PCAModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.functions.vectors import to_array, to_vector


def fit(frame: DataFrame, k: int, vec: str = "vec") -> PCAModel:
    """Fit on the given rows only (pass the train side, never test rows)."""
    ml = frame.select(to_vector(vec).alias("_features"))
    return PCA(k=int(k), inputCol="_features", outputCol="_pca").fit(ml)


def project(model: PCAModel, frame: DataFrame, vec: str = "vec", out: str | None = None) -> DataFrame:
    """Replace (or add, with ``out``) the vector column by its projection, as ``array<double>``."""
    target = out or vec
    keep = [c for c in frame.columns if c != target]
    staged = frame.withColumn("_features", to_vector(vec))
    projected = model.transform(staged)
    return projected.select(*keep, to_array("_pca").alias(target))


def components(model: PCAModel) -> DataFrame:
    """``(component, feature, loading)`` long table of the ``d x k`` principal axes."""
    pc = model.pc.toArray()
    d, k = pc.shape
    rows = [(int(j), int(i), float(pc[i, j])) for j in range(k) for i in range(d)]
    schema = T.StructType([T.StructField("component", T.IntegerType()),
                           T.StructField("feature", T.IntegerType()),
                           T.StructField("loading", T.DoubleType())])
    return SparkSession.getActiveSession().createDataFrame(rows, schema)


def explained_variance(model: PCAModel) -> DataFrame:
    """``(component, ratio, cumulative)``: each axis' share of total variance and the running sum."""
    ratio = np.asarray(model.explainedVariance.toArray(), dtype=float)
    cumulative = np.cumsum(ratio)
    rows = [(i, float(r), float(c)) for i, (r, c) in enumerate(zip(ratio, cumulative))]
    schema = T.StructType([T.StructField("component", T.IntegerType()),
                           T.StructField("ratio", T.DoubleType()),
                           T.StructField("cumulative", T.DoubleType())])
    return SparkSession.getActiveSession().createDataFrame(rows, schema)


def components_for_target(variance: DataFrame, targets: list[float]) -> DataFrame:
    """Smallest number of leading components whose cumulative share exceeds each target.

    (``index + 1`` of the first component past the target, i.e. a count, not an index.)
    """
    found = [F.struct(F.lit(float(t)).alias("target"),
                      (F.min(F.when(F.col("cumulative") > F.lit(float(t)), F.col("component"))) + 1)
                      .alias("n_components")) for t in targets]
    return (variance.agg(F.array(*found).alias("found")).select(F.explode("found").alias("f"))
            .select("f.target", "f.n_components").orderBy("target"))

