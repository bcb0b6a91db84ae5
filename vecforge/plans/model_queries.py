"""PCA and classifier queries.

Fitted axes, weights and trees have no SQL form. Queries named ``*_check`` hold what they imply
exactly against SQL; each says what that does and does not prove.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.functions.vectors import norm2
from vecforge.operators import classify, metrics, pca
from vecforge.plans.common import DIGITS, SQL_SPLIT, train_test
from vecforge.plans.registry import register
from vecforge.session import scratch_path
from vecforge.sources.tables import planted_label, table

# Variance targets of the component-count search; PCA width of the R1/R2 queries.
VARIANCE_TARGETS = [0.90, 0.95]
PCA_K = 16


@register("pca_fit")
def pca_fit(spark, sf_dir):
    """Principal axes fitted on the train rows (component, feature, loading)."""
    train, _ = train_test(spark, sf_dir)
    return pca.components(pca.fit(train, PCA_K))


@register("pca_project")
def pca_project(spark, sf_dir):
    """R2: the train-fitted model applied to the test rows (no centring)."""
    train, test = train_test(spark, sf_dir)
    model = pca.fit(train, PCA_K)
    out = pca.project(model, test)
    return out.select("id", "label", *[F.round(F.get("vec", i), DIGITS).alias(f"pc{i}") for i in range(PCA_K)])


def _full_variance(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    width = len(train.select("vec").first()["vec"])
    return pca.explained_variance(pca.fit(train, width))


@register("pca_explained_variance")
def pca_explained_variance(spark, sf_dir):
    """Explained-variance ratio per component and its running sum (full width)."""
    return _full_variance(spark, sf_dir)


@register("pca_components_for_target")
def pca_components_for_target(spark, sf_dir):
    """Components needed to pass 90% and 95% of the variance (a count: index + 1)."""
    return pca.components_for_target(_full_variance(spark, sf_dir), VARIANCE_TARGETS)


@register("logreg_fit")
def logreg_fit(spark, sf_dir):
    """Multinomial logistic regression fitted on the train rows; objective per iteration."""
    train, _ = train_test(spark, sf_dir)
    return classify.training_history(classify.fit_logistic_regression(train))


@register("logreg_predict")
def logreg_predict(spark, sf_dir):
    """Probability and prediction for every test row."""
    train, test = train_test(spark, sf_dir)
    model = classify.fit_logistic_regression(train)
    return classify.predict(model, test, keep=["id", "label"])


@register("logreg_coefficients")
def logreg_coefficients(spark, sf_dir):
    """Coefficient matrix and intercepts as a long table."""
    train, _ = train_test(spark, sf_dir)
    return classify.coefficients(classify.fit_logistic_regression(train))


@register("rf_fit")
def rf_fit(spark, sf_dir):
    """C4: random forest (10 trees, fixed seed) on the train rows; feature importances."""
    train, _ = train_test(spark, sf_dir)
    return classify.feature_importances(classify.fit_random_forest(train))


@register("rf_predict")
def rf_predict(spark, sf_dir):
    """Probability and prediction per test row."""
    train, test = train_test(spark, sf_dir)
    model = classify.fit_random_forest(train)
    return classify.predict(model, test, keep=["id", "label"])


# Lineitem as a labelled vector table - the numeric columns are the features and
# the return flag's place among the distinct flags, in order, gives the class index.
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem_vectors(spark, sf_dir):
    """``(l_orderkey, l_linenumber, vec, label)`` over the whole lineitem table."""
    li = table(spark, sf_dir, "lineitem")
    found = li.select("l_returnflag").distinct().filter("l_returnflag IS NOT NULL").orderBy("l_returnflag").collect()
    flags = F.array(*[F.lit(r[0]) for r in found])  # a row a flag
    return li.select("l_orderkey", "l_linenumber",
                     F.array(*[F.col(c).cast("double") for c in LINEITEM_FEATURES]).alias("vec"),
                     (F.array_position(flags, F.col("l_returnflag")) - 1).cast("int").alias("label"))


def lineitem_split(spark, sf_dir):
    data = lineitem_vectors(spark, sf_dir)
    test = F.pmod(F.col("l_orderkey"), F.lit(5)) == 0
    return data.filter(~test), data.filter(test)


@register("pca_lineitem")
def pca_lineitem(spark, sf_dir):
    """R1 + R2 at table scale: PCA (2 axes) fitted on every lineitem row, every row projected."""
    data = lineitem_vectors(spark, sf_dir)
    out = pca.project(pca.fit(data, 2), data)
    return out.select("l_orderkey", "l_linenumber",
                      *[F.round(F.get("vec", i), DIGITS).alias(f"pc{i}") for i in range(2)])


@register("logreg_lineitem")
def logreg_lineitem(spark, sf_dir):
    """C1 + C2 at table scale: return flag from the numeric columns (train: orderkey % 5 != 0)."""
    train, test = lineitem_split(spark, sf_dir)
    model = classify.fit_logistic_regression(train, max_iter=50)
    return classify.predict(model, test, keep=["l_orderkey", "l_linenumber", "label"])


@register("rf_lineitem")
def rf_lineitem(spark, sf_dir):
    """C4 + C5 at table scale: the same split with a 10-tree forest."""
    train, test = lineitem_split(spark, sf_dir)
    model = classify.fit_random_forest(train)
    return classify.predict(model, test, keep=["l_orderkey", "l_linenumber", "label"])


# -- what the fits imply, held against SQL -------------------------------------------------

@register("pca_project_check", f"""
WITH {SQL_SPLIT}
SELECT id, round(list_dot_product(vec, vec), {DIGITS}) AS norm2 FROM te
""")
def pca_project_check(spark, sf_dir):
    """R2: a full-width projection is a rotation, so every row keeps its squared norm. Proves that the
    axes are orthonormal and applied to every row, not which axes they are."""
    train, test = train_test(spark, sf_dir)
    out = pca.project(pca.fit(train, _width(train)), test)
    return out.select("id", F.round(norm2("vec"), DIGITS).alias("norm2"))


def _width(frame):
    return len(frame.select("vec").first()["vec"])


@register("pca_variance_check", f"""
WITH {SQL_SPLIT},
x AS (SELECT unnest(range(1, len(vec) + 1)) AS i, unnest(vec) AS v FROM tr),
s AS (SELECT var_samp(v) AS s FROM x GROUP BY i)
SELECT round(sum(s), {DIGITS}) AS variance, true AS falling, true AS shares_agree FROM s
""")
def pca_variance_check(spark, sf_dir):
    """The projected columns' variances add up to those of the raw columns, fall from axis to
    axis, and are the shares that the model tells. Proves total and order, not the single axes."""
    train, _ = train_test(spark, sf_dir)
    width = _width(train)
    model = pca.fit(train, width)
    out = pca.project(model, train)
    by_axis = out.select(F.posexplode("vec").alias("component", "x")).groupBy("component").agg(F.var_samp("x").alias("v"))
    told = pca.explained_variance(model)
    both = by_axis.join(told, "component").agg(
        F.sum("v").alias("total"), F.array_sort(F.collect_list(F.struct("component", "v", "ratio"))).alias("a"))
    v = F.transform("a", lambda x: x["v"])
    rounded = F.transform(v, lambda x: F.round(x, 9))
    fall = rounded == F.sort_array(rounded, asc=False)
    agree = F.forall("a", lambda x: F.abs(x["v"] / F.col("total") - x["ratio"]) < 1e-9)
    return both.select(F.round("total", DIGITS).alias("variance"), fall.alias("falling"), agree.alias("shares_agree"))


@register("pca_components_check", "SELECT * FROM (VALUES " + ", ".join(
    f"(CAST({t} AS DOUBLE), true, true)" for t in VARIANCE_TARGETS) + ") x(target, passes, fewer_do_not)")
def pca_components_check(spark, sf_dir):
    """As many components as told pass the target and one fewer do not. Proves the count for the
    model's own shares."""
    told = _full_variance(spark, sf_dir)
    need = pca.components_for_target(told, VARIANCE_TARGETS)
    by_target = told.withColumn("target", F.explode(F.array(*[F.lit(float(t)) for t in VARIANCE_TARGETS])))
    return (by_target.join(need, "target").groupBy("target").agg(
        F.max(F.when(F.col("component") == F.col("n_components") - 1, F.col("cumulative") > F.col("target"))).alias("passes"),
        F.coalesce(F.max(F.when(F.col("component") == F.col("n_components") - 2,
                                F.col("cumulative") <= F.col("target"))), F.lit(True)).alias("fewer_do_not")))


@register("logreg_fit_check", f"""
WITH {SQL_SPLIT}
SELECT CAST(label AS INTEGER) AS class, count(*) AS expected FROM tr GROUP BY label
""")
def logreg_fit_check(spark, sf_dir):
    """Without penalty the training probabilities of a class add up to its rows (the score
    equation of its intercept), at convergence. Proves the intercepts, not the other weights."""
    train, _ = train_test(spark, sf_dir)
    out = classify.predict(classify.fit_logistic_regression(train), train, keep=["id"])
    mass = out.select(F.posexplode("probability").alias("class", "p")).groupBy("class").agg(F.sum("p").alias("p"))
    return mass.select("class", F.round("p").cast("long").alias("expected")).filter("expected > 0")


@register("logreg_coefficients_check", f"""
WITH {SQL_SPLIT}, c AS (SELECT CAST(range AS INTEGER) AS class FROM range(0, (SELECT max(label) + 1 FROM tr)))
SELECT class, CAST(f.range AS INTEGER) AS feature FROM c, range(-1, 64) f
""")
def logreg_coefficients_check(spark, sf_dir):
    """One finite weight for every class and feature, and an intercept (-1). Proves the table's keys."""
    train, _ = train_test(spark, sf_dir)
    return (classify.coefficients(classify.fit_logistic_regression(train))
            .filter(~F.isnan("weight") & (F.abs("weight") < float("inf"))).select("class", "feature"))


SQL_PREDICT_CHECK = f"""
WITH {SQL_SPLIT}
SELECT id, CAST(label AS INTEGER) AS label, true AS sums_to_one, true AS largest FROM te
"""


def _predict_check(out):
    """Every test row once, with probabilities that add up to one and the largest one's class predicted."""
    total = F.aggregate("probability", F.lit(0.0), lambda s, x: s + x)
    return out.select("id", F.col("label").cast("int").alias("label"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
                      (F.get("probability", F.col("prediction").cast("int")) == F.array_max("probability")).alias("largest"))


@register("logreg_predict_check", SQL_PREDICT_CHECK)
def logreg_predict_check(spark, sf_dir):
    """Ids, labels, probability sums and argmax. Proves the output's shape, not the probabilities."""
    return _predict_check(logreg_predict(spark, sf_dir))


@register("rf_predict_check", SQL_PREDICT_CHECK)
def rf_predict_check(spark, sf_dir):
    """Ids, labels, probability sums and argmax. Proves the output's shape, not the votes."""
    return _predict_check(rf_predict(spark, sf_dir))


@register("rf_fit_check", """
SELECT CAST(range AS INTEGER) AS feature, 10 AS num_trees, true AS share FROM range(0, 64)
""")
def rf_fit_check(spark, sf_dir):
    """C4: every feature once, ten trees, importances that are shares of one. Proves the table, not the trees."""
    found = rf_fit(spark, sf_dir)
    total = found.agg(F.sum("importance")).first()[0]
    return found.select("feature", "num_trees", ((F.col("importance") >= 0) & F.lit(abs(total - 1) < 1e-6)).alias("share"))


# -- PCA, then a classifier, then the reports ----------------------------------------------

REPORT_WIDTH = 32  # fixed value: components before the classifier


def pca_predictions(spark, sf_dir, fit):
    """``(label, prediction)`` of the test rows, from a classifier on the train rows' components.

    The label is planted in the vectors, so there is something to learn."""
    train, test = (side.withColumn("label", planted_label()) for side in train_test(spark, sf_dir))
    model = pca.fit(train, REPORT_WIDTH)
    fitted = fit(pca.project(model, train))
    return classify.predict(fitted, pca.project(model, test), keep=["id", "label"])


def _reports(pred):
    """Each class's report with accuracy, test error and the overall scores beside it; predictions are
    made once and written."""
    path = scratch_path(pred.sparkSession, "predictions")
    pred.select(F.col("label").cast("double").alias("label"), "prediction").write.parquet(path)
    pred = pred.sparkSession.read.parquet(path)
    overall = metrics.overall_report(pred).first().asDict()  # one row
    return metrics.per_class(pred).select(
        "class", "support", "precision", "recall", "f_score", F.lit(1 - overall["accuracy"]).alias("test_error"),
        *[F.lit(v).alias(k) for k, v in overall.items()])


@register("logreg_pca_report")
def logreg_pca_report(spark, sf_dir):
    """PCA -> logistic regression -> accuracy, test error and the class report."""
    return _reports(pca_predictions(spark, sf_dir, classify.fit_logistic_regression))


@register("rf_pca_report")
def rf_pca_report(spark, sf_dir):
    """PCA -> random forest -> accuracy, test error and the class report."""
    return _reports(pca_predictions(spark, sf_dir, classify.fit_random_forest))
