"""Multinomial logistic regression and random forests through ``pyspark.ml``.

Training is the library's distributed optimisation (tree aggregates per iteration or tree
level); scoring is a row-wise transform. Features are ``array<double>`` columns converted to
ML vectors at this boundary only; outputs come back as plain columns.
"""

from __future__ import annotations

from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.functions.vectors import to_array, to_vector

# Forest defaults (10 trees as the original scripts; a seed so runs repeat).
FOREST_TREES = 10
FOREST_SEED = 42


def _ml_input(frame: DataFrame, features: str, label: str) -> DataFrame:
    return frame.withColumn("_features", to_vector(features)).withColumn("_label", F.col(label).cast("double"))


def fit_logistic_regression(frame: DataFrame, features: str = "vec", label: str = "label",
                            max_iter: int = 100, reg_param: float = 0.0) -> LogisticRegressionModel:
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", family="multinomial",
                            maxIter=max_iter, regParam=reg_param)
    return lr.fit(_ml_input(frame, features, label).select("_features", "_label"))


def fit_random_forest(frame: DataFrame, features: str = "vec", label: str = "label",
                      num_trees: int = FOREST_TREES, seed: int = FOREST_SEED,
                      max_depth: int = 5) -> RandomForestClassificationModel:
    rf = RandomForestClassifier(featuresCol="_features", labelCol="_label", numTrees=num_trees,
                                seed=seed, maxDepth=max_depth)
    return rf.fit(_ml_input(frame, features, label).select("_features", "_label"))


def predict(model, frame: DataFrame, features: str = "vec", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``*keep, prediction, probability`` (probability as ``array<double>``)."""
    staged = frame.withColumn("_features", to_vector(features))
    scored = model.transform(staged)
    return scored.select(*keep, F.col("prediction").alias("prediction"),
                         to_array("probability").alias("probability"))


def coefficients(model: LogisticRegressionModel) -> DataFrame:
    """``(class, feature, weight)``; the intercept is the row with ``feature = -1``."""
    mat = model.coefficientMatrix.toArray()
    icpt = model.interceptVector.toArray()
    rows = []
    for c in range(mat.shape[0]):
        rows.append((c, -1, float(icpt[c])))
        rows.extend((c, j, float(mat[c, j])) for j in range(mat.shape[1]))
    schema = T.StructType([T.StructField("class", T.IntegerType()), T.StructField("feature", T.IntegerType()),
                           T.StructField("weight", T.DoubleType())])
    return _spark().createDataFrame(rows, schema)


def training_history(model: LogisticRegressionModel) -> DataFrame:
    """``(iteration, objective)`` from the training summary."""
    hist = model.summary.objectiveHistory
    return _spark().createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, objective double")


def feature_importances(model: RandomForestClassificationModel) -> DataFrame:
    imp = model.featureImportances.toArray()
    trees = model.getNumTrees
    return _spark().createDataFrame([(j, float(v), trees) for j, v in enumerate(imp)],
                                    "feature int, importance double, num_trees int")


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()
