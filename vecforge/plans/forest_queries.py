"""C4, C5 by the library's own forest: bags and root splits are worked out again in SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from vecforge.operators import forest
from vecforge.plans.common import SQL_SPLIT, VECTOR_WIDTH, train_test
from vecforge.plans.registry import register
from vecforge.sources.tables import planted_label

TREES, SEED, BINS = forest.TREES, forest.SEED, forest.BINS
TRIED = math.ceil(math.sqrt(VECTOR_WIDTH))  # features of a node
DEPTH = 4

# The label is the place of the largest of the first four elements: there is something to learn.
SQL_BAGS = f"""
{SQL_SPLIT},
rows AS (SELECT id, vec, CAST(list_position(vec[1:4], list_max(vec[1:4])) - 1 AS INTEGER) AS label FROM tr),
b AS (SELECT id, label, CAST(t.range AS INTEGER) AS tree,
             CAST('0x' || substr(md5('{SEED}:' || t.range || ':' || id), 1, 8) AS BIGINT) / 4294967296.0 AS share
      FROM rows, range({TREES}) t),
w AS (SELECT id, label, tree, {" + ".join(f"CAST(share >= {float(s)!r} AS INTEGER)" for s in forest.STEPS)} AS times FROM b)
"""


def _rows(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    return train.withColumn("label", planted_label()), test.withColumn("label", planted_label())


def _fitted(spark, sf_dir):
    train, test = _rows(spark, sf_dir)
    return forest.fit(train, max_depth=DEPTH), train, test


@register("forest_bags", f"""
WITH {SQL_BAGS}
SELECT tree, label, CAST(sum(times) AS BIGINT) AS in_bag, count(*) FILTER (times = 0) AS out_of_bag FROM w GROUP BY tree, label
""")
def forest_bags(spark, sf_dir):
    """C4: each tree's bag by class, drawn by hash."""
    return forest.bags(_rows(spark, sf_dir)[0])


@register("forest_root_splits", f"""
WITH {SQL_BAGS},
f AS (SELECT CAST(t.range AS INTEGER) AS tree, CAST(x.range AS INTEGER) AS feature,
             row_number() OVER (PARTITION BY t.range ORDER BY substr(md5('{SEED}:' || t.range || ':0:' || x.range), 1, 8), x.range) AS n
      FROM range({TREES}) t, range({VECTOR_WIDTH}) x QUALIFY n <= {TRIED}),
v AS (SELECT id, unnest(range(len(vec))) AS feature, unnest(vec) AS x FROM rows),
q AS (SELECT feature, list_sort(list(x)) AS xs FROM v GROUP BY feature),
t AS (SELECT DISTINCT feature, xs[CAST(ceil(len(xs) * i.range / {float(BINS)}) AS BIGINT)] AS threshold FROM q, range(1, {BINS}) i),
c AS (SELECT w.tree, f.feature, t.threshold, w.label, sum(CASE WHEN v.x <= t.threshold THEN times ELSE 0 END) AS l, sum(times) AS n
      FROM w JOIN f ON f.tree = w.tree JOIN v ON v.id = w.id AND v.feature = f.feature JOIN t ON t.feature = f.feature
      WHERE times > 0 GROUP BY w.tree, f.feature, t.threshold, w.label),
g AS (SELECT tree, feature, threshold, sum(l) AS left_n, sum(n - l) AS right_n,
             (sum(l * l) / sum(l) + sum((n - l) * (n - l)) / nullif(sum(n - l), 0) - sum(n * n) / sum(n)) / sum(n) AS gain
      FROM c GROUP BY tree, feature, threshold HAVING sum(l) > 0 AND sum(n - l) > 0),
s AS (SELECT tree, feature, threshold, round(gain, {forest.GAIN_DIGITS}) AS gain FROM g)
SELECT tree, feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain FROM s
QUALIFY row_number() OVER (PARTITION BY tree ORDER BY s.gain DESC, feature, s.threshold) = 1
""")
def forest_root_splits(spark, sf_dir):
    """C4: every tree's first split, the best of its hashed features' quantiles on its bag."""
    model, _, _ = _fitted(spark, sf_dir)
    roots = forest.nodes(model).filter("node = 0")
    return roots.select("tree", "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"))


@register("forest_predict")
def forest_predict(spark, sf_dir):
    """Class shares of the trees' leaves, averaged, and the class of the largest."""
    model, _, test = _fitted(spark, sf_dir)
    return forest.predict(model, test, keep=["id", "label"])


@register("forest_out_of_bag")
def forest_out_of_bag(spark, sf_dir):
    """C4: the error of votes by trees that have not seen the row, next to that on the test rows."""
    model, train, test = _fitted(spark, sf_dir)
    wrong = F.avg((F.col("prediction") != F.col("label")).cast("double")).alias("error")
    tested = forest.predict(model, test, keep=["label"]).agg(F.count(F.lit(1)).alias("rows"), F.count("prediction").alias("voted"), wrong)
    votes = forest.out_of_bag_error(forest.out_of_bag(model, train))
    return votes.withColumn("votes", F.lit("out of bag")).unionByName(tested.withColumn("votes", F.lit("test rows")))
