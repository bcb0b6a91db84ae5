"""Classification metrics from confusion counts.

Everything starts from one ``groupBy(label, prediction).count()`` (partial aggregation on
the map side, so a dominant class costs nothing extra); the per-class table comes from the
confusion counts with a single further aggregate, never a join, and nothing is collected.

Conventions (fixed semantics):
* class reports list the classes present in the actual labels; a class never predicted has
  precision 0, and F is 0 when precision and recall are both 0;
* micro precision = micro recall = micro F = accuracy;
* macro averages are plain means over the listed classes, weighted averages weight by support;
* the full report (library style) lists every class seen in labels or predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pairs(frame: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction)``; both as double when their types differ (e.g. int label, ML prediction)."""
    same = frame.schema[label].dataType == frame.schema[prediction].dataType
    lab, pred = F.col(label), F.col(prediction)
    if not same:
        lab, pred = lab.cast("double"), pred.cast("double")
    return frame.select(lab.alias("label"), pred.alias("prediction"))


def confusion(frame: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n)`` - at most classes^2 rows whatever the input size."""
    return (pairs(frame, label, prediction).groupBy("label", "prediction")
            .agg(F.count(F.lit(1)).alias("n")))


def accuracy(frame: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows predicted right; a row without a prediction (or label) counts as wrong."""
    p = pairs(frame, label, prediction)
    right = F.coalesce(F.col("label") == F.col("prediction"), F.lit(False))
    return p.agg(F.avg(right.cast("double")).alias("accuracy"))


def test_error(frame: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return accuracy(frame, label, prediction).select((F.lit(1.0) - F.col("accuracy")).alias("test_error"))


def correct_count(frame: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows where label equals prediction, the total, and their ratio."""
    p = pairs(frame, label, prediction)
    return p.agg(F.count_if(F.col("label") == F.col("prediction")).alias("n_correct"),
                 F.count(F.lit(1)).alias("n_total")).withColumn(
        "accuracy", F.try_divide(F.col("n_correct").cast("double"), F.col("n_total")))


def class_counts(conf: DataFrame) -> DataFrame:
    """``(class, tp, support, predicted)`` for every class seen as label or prediction.

    Each confusion cell contributes once as an actual and once as a predicted class; one
    aggregate adds them up.
    """
    roles = F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp"))))
    return (conf.select(roles.alias("r")).select("r.*")
            .groupBy("class").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                  F.sum("predicted").alias("predicted")))


def _prf(counts: DataFrame) -> DataFrame:
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    with_pr = counts.withColumn("precision", p).withColumn("recall", r)
    f = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"),
                                F.col("precision") + F.col("recall")), F.lit(0.0))
    return with_pr.withColumn("f_score", f)


def per_class(frame: DataFrame, label: str = "label", prediction: str = "prediction",
              include_predicted_only: bool = False) -> DataFrame:
    return _per_class_from(confusion(frame, label, prediction), include_predicted_only)


def _per_class_from(conf: DataFrame, include_predicted_only: bool = False) -> DataFrame:
    counts = class_counts(conf)
    if not include_predicted_only:
        counts = counts.filter(F.col("support") > 0)
    return _prf(counts)


def classification_report(frame: DataFrame, label: str = "label", prediction: str = "prediction",
                          digits: int = 3) -> DataFrame:
    """``class, precision, recall, f_score`` per actual class, sorted by class."""
    return _class_report_from(confusion(frame, label, prediction), digits)


def _class_report_from(conf: DataFrame, digits: int) -> DataFrame:
    pc = _per_class_from(conf)
    return pc.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f_score")]
                     ).orderBy("class")


def overall_report(frame: DataFrame, label: str = "label", prediction: str = "prediction",
                   digits: int | None = None) -> DataFrame:
    """One row: accuracy and micro / macro / weighted precision, recall, F."""
    return _overall_from(confusion(frame, label, prediction), digits)


def evaluate(frame: DataFrame, label: str = "label", prediction: str = "prediction",
             digits: int = 3) -> tuple[DataFrame, DataFrame]:
    """Overall and per-class reports from one pass over the predictions.

    The confusion counts (at most classes^2 rows) are checkpointed into the session's shared
    checkpoint folder: the upstream work (e.g. a kNN search) runs once, and both reports
    read the small table, not the lineage.
    """
    from vecforge.session import checkpoint_dir
    checkpoint_dir(frame.sparkSession)
    conf = confusion(frame, label, prediction).checkpoint(eager=True)
    return _overall_from(conf, digits), _class_report_from(conf, digits)


def _overall_from(conf: DataFrame, digits: int | None) -> DataFrame:
    pc = _per_class_from(conf)
    total = F.sum("support")
    out = pc.agg(
        (F.sum("tp") / total).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f_score").alias("macro_f_score"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("weighted_recall"),
        (F.sum(F.col("f_score") * F.col("support")) / total).alias("weighted_f_score"))
    out = out.select("accuracy", F.col("accuracy").alias("micro_precision"),
                     F.col("accuracy").alias("micro_recall"), F.col("accuracy").alias("micro_f_score"),
                     "macro_precision", "macro_recall", "macro_f_score",
                     "weighted_precision", "weighted_recall", "weighted_f_score")
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out


def classification_report_full(frame: DataFrame, label: str = "label", prediction: str = "prediction",
                               digits: int = 4) -> DataFrame:
    """Library-style report: a row per class seen anywhere, then accuracy, macro and weighted rows.

    Columns ``class`` (string), ``precision``, ``recall``, ``f_score``, ``support``.
    """
    pc = per_class(frame, label, prediction, include_predicted_only=True)
    rows = pc.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f_score",
                     F.col("support").cast("long").alias("support"))
    total = F.sum("support")
    summary = pc.agg(
        (F.sum("tp") / total).alias("acc"), total.alias("n"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("wr"),
        (F.sum(F.col("f_score") * F.col("support")) / total).alias("wf"))
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f_score"),
                        F.col("n").cast("long").alias("support"))

    tail = summary.select(F.explode(F.array(
        row("accuracy", F.lit(None), F.lit(None), F.col("acc")),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")))).alias("t")).select("t.*")
    out = rows.unionByName(tail)
    return out.select("class", *[F.round(c, digits).alias(c) for c in ("precision", "recall", "f_score")],
                      "support")


def distinct_classes(frame: DataFrame, label: str = "label") -> DataFrame:
    return frame.select(F.col(label).alias("class")).distinct().orderBy("class")
