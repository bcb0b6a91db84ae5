"""kNN queries: neighbours, votes, classification, scores, sweeps, PCA space."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.functions.vectors import truncate
from vecforge.operators import knn, metrics, pca
from vecforge.operators.blocks import BlockGrid
from vecforge.plans.common import (DIGITS, K_DEFAULT, SQL_SPLIT, SQL_SPLIT_SCALED, SWEEP_KS, r6, scaled, sql_cos,
                                   sql_neighbors, sql_vote, train_test, vectors)
from vecforge.plans.registry import register
from vecforge.sources.tables import is_test_row

SQL_CLASSIFY = f"""
WITH {SQL_SPLIT}, {sql_neighbors(K_DEFAULT)}, {sql_vote()}
SELECT test_id, label, prediction FROM pred
"""


@register("knn_classify_native", SQL_CLASSIFY)
def knn_classify_native(spark, sf_dir):
    """K2/K4: built-in higher-order functions score each bounded train block; vote per test row."""
    train, test = train_test(spark, sf_dir)
    return knn.classify(test, train, K_DEFAULT, method="native", actual="label")


@register("knn_classify_block", SQL_CLASSIFY)
def knn_classify_block(spark, sf_dir):
    """K1: block-partitioned exact kNN (matrix product per grid cell), then the vote."""
    train, test = train_test(spark, sf_dir)
    return knn.classify(test, train, K_DEFAULT, method="block", actual="label")


@register("knn_classify_broadcast", SQL_CLASSIFY)
def knn_classify_broadcast(spark, sf_dir):
    """K1 as shipped-train form: the size-checked train side is broadcast once and every test
    partition is scored in place, batch by batch (no test-side shuffle)."""
    train, test = train_test(spark, sf_dir)
    return knn.classify(test, train, K_DEFAULT, method="broadcast", actual="label")


@register("knn_neighbors", f"""
WITH {SQL_SPLIT}, {sql_neighbors(K_DEFAULT)}
SELECT test_id, train_id, train_label, round(distance, {DIGITS}) AS distance, rnk AS rank FROM nb
""")
def knn_neighbors(spark, sf_dir):
    """K3: the k nearest train rows per test row, numbered 1..k (ties by train_id)."""
    train, test = train_test(spark, sf_dir)
    nb = knn.neighbors(test, train, K_DEFAULT)
    return nb.select("test_id", "train_id", "train_label", r6("distance"), "rank")


def _quantised(frame):
    return frame.withColumn("vec", F.transform("vec", lambda x: F.round(x * 10.0)))


@register("neighbor_rank_with_ties", f"""
WITH {SQL_SPLIT},
tq AS (SELECT id, list_transform(vec, lambda x: round(x * 10.0)) AS vec, label FROM te),
rq AS (SELECT id, list_transform(vec, lambda x: round(x * 10.0)) AS vec, label FROM tr),
pr AS (SELECT q.id AS test_id, t.id AS train_id, list_distance(q.vec, t.vec) AS distance FROM tq q, rq t),
nb AS (SELECT *, CAST(rank() OVER (PARTITION BY test_id ORDER BY distance) AS INTEGER) AS rnk
       FROM pr QUALIFY rnk <= {K_DEFAULT})
SELECT test_id, train_id, round(distance, {DIGITS}) AS distance, rnk AS rank FROM nb
""")
def neighbor_rank_with_ties(spark, sf_dir):
    """``rank() <= k`` keeps every tie at the cut. Run on integer-quantised vectors
    (``round(10 x)``), where equal distances are common and exact in every engine."""
    train, test = train_test(spark, sf_dir)
    nb = knn.neighbors(_quantised(test), _quantised(train), K_DEFAULT, keep_ties=True)
    return nb.select("test_id", "train_id", r6("distance"), "rank")


@register("knn_classify_cosine", f"""
WITH {SQL_SPLIT_SCALED}, {sql_neighbors(K_DEFAULT, "cosine")}, {sql_vote("cosine")}
SELECT test_id, label, prediction FROM pred
""")
def knn_classify_cosine(spark, sf_dir):
    """K5/K6: cosine similarity (descending, nulls last) on vectors scaled by 1 + id % 7."""
    train, test = train_test(spark, sf_dir)
    return knn.classify(scaled(test), scaled(train), K_DEFAULT, "cosine", actual="label")


@register("knn_single_query", f"""
WITH {SQL_SPLIT},
q1 AS (SELECT * FROM te ORDER BY id LIMIT 1),
{sql_neighbors(K_DEFAULT, test="q1")}, {sql_vote(keys="test_id")}
SELECT test_id, prediction, votes, round(best, {DIGITS}) AS best_distance FROM pred
""")
def knn_single_query(spark, sf_dir):
    """K7: one query vector (the first test row) against the whole train set, then the vote."""
    train, test = train_test(spark, sf_dir)
    first = test.orderBy("id").select("id", "vec").first()
    nb = knn.single_query_neighbors(train, list(first["vec"]), K_DEFAULT)
    voted = knn.majority_vote(nb.withColumn("test_id", F.lit(int(first["id"])).cast("long")))
    return voted.select("test_id", "prediction", "votes", r6("best_distance"))


@register("knn_score", f"""
WITH {SQL_SPLIT}, {sql_neighbors(10)}, {sql_vote()}
SELECT 10 AS k, 'euclidean' AS metric, round(avg(CAST(label = prediction AS DOUBLE)), {DIGITS}) AS accuracy
FROM pred
""")
def knn_score(spark, sf_dir):
    """K8: fraction of test rows classified right, for a given k (10) and metric."""
    train, test = train_test(spark, sf_dir)
    pred = knn.classify(test, train, 10, actual="label")
    return metrics.accuracy(pred).select(F.lit(10).alias("k"), F.lit("euclidean").alias("metric"),
                                         r6("accuracy"))


@register("majority_vote", f"""
WITH {SQL_SPLIT}, {sql_neighbors(K_DEFAULT)}, {sql_vote(keys="test_id")}
SELECT test_id, prediction, votes, round(best, {DIGITS}) AS best_distance FROM pred
""")
def majority_vote(spark, sf_dir):
    """V1: most votes, then nearest best distance, then smaller label."""
    train, test = train_test(spark, sf_dir)
    voted = knn.majority_vote(knn.neighbors(test, train, K_DEFAULT))
    return voted.select("test_id", "prediction", "votes", r6("best_distance"))


SQL_K_SWEEP = f"""
WITH {SQL_SPLIT_SCALED}, {sql_neighbors(max(SWEEP_KS), "cosine")},
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(1, {max(SWEEP_KS) + 1})),
nbk AS (SELECT nb.*, ks.k FROM nb JOIN ks ON nb.rnk <= ks.k),
{sql_vote("cosine", source="nbk", keys="test_id, label, k")}
SELECT k, round(avg(CAST(label = prediction AS DOUBLE)), {DIGITS}) AS accuracy FROM pred GROUP BY k
"""


@register("knn_k_sweep", SQL_K_SWEEP)
def knn_k_sweep(spark, sf_dir):
    """Accuracy for k = 1..9 (cosine) from one neighbour search at k = 9."""
    train, test = train_test(spark, sf_dir)
    votes = knn.classify_sweep(scaled(test), scaled(train), SWEEP_KS, "cosine", actual="label")
    return (votes.groupBy("k").agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))
                                   .alias("accuracy")).select("k", r6("accuracy")))


@register("knn_pca", SQL_CLASSIFY)
def knn_pca(spark, sf_dir):
    """PCA fitted on train, applied to both, kNN in the reduced space. At full width the
    projection is a rotation, so predictions equal those on the raw vectors."""
    train, test = train_test(spark, sf_dir)
    width = len(train.select("vec").first()["vec"])
    model = pca.fit(train, width)
    return knn.classify(pca.project(model, test), pca.project(model, train), K_DEFAULT, actual="label")


# The tuning grid's k values; reduced widths up to the full 64.
GRID_KS = (5, 10)
GRID_DIMS = (16, 32, 50, 64)


@register("knn_grid")
def knn_grid(spark, sf_dir):
    """(reduced dimension, k) grid. One PCA fit at the largest width (components are nested, so
    smaller widths are slices of its projection) and one neighbour search per dimension (at the
    largest k); each k is voted from that table."""
    return _grid(spark, sf_dir, GRID_DIMS)


def _sweep_accuracy(test, train, ks, sizes=None):
    votes = knn.classify_sweep(test, train, list(ks), actual="label", sizes=sizes)
    return (votes.groupBy("k").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"))
            .select("k", r6("accuracy")))


def _projected(spark, sf_dir, width):
    """Test and train rows in the space of the first ``width`` axes, from one fit, and their counts."""
    train, test = train_test(spark, sf_dir)
    model = pca.fit(train, width)
    counts = vectors(spark, sf_dir).agg(F.count_if(is_test_row()), F.count_if(~is_test_row())).first()
    return pca.project(model, test), pca.project(model, train), (int(counts[0]), int(counts[1])), model


def _grid(spark, sf_dir, dims, ks=GRID_KS):
    test, train, counts, _ = _projected(spark, sf_dir, max(dims))
    out = None
    for d in dims:
        cut = [side.withColumn("vec", truncate("vec", d)) for side in (test, train)]
        acc = _sweep_accuracy(*cut, ks, (*counts, d)).select(F.lit(d).alias("d"), "k", "accuracy")
        out = acc if out is None else out.unionByName(acc)
    return out


SQL_RAW_GRID = f"""
WITH {SQL_SPLIT}, {sql_neighbors(max(GRID_KS))},
nbk AS (SELECT nb.*, ks.k FROM nb JOIN (VALUES {", ".join(f"({k})" for k in GRID_KS)}) ks(k) ON nb.rnk <= ks.k),
{sql_vote(source="nbk", keys="test_id, label, k")}
SELECT 64 AS d, CAST(k AS INTEGER) AS k, round(avg(CAST(label = prediction AS DOUBLE)), {DIGITS}) AS accuracy
FROM pred GROUP BY k
"""


@register("knn_grid_full_width", SQL_RAW_GRID)
def knn_grid_full_width(spark, sf_dir):
    """T2 at full width, where the projection is a rotation: its accuracies are those on the raw
    vectors. Proves the fit, the slices and the sweep, not the accuracies at smaller widths."""
    return _grid(spark, sf_dir, (64,))


@register("knn_components_sweep")
def knn_components_sweep(spark, sf_dir):
    """R4 -> P11 -> T1: components for 95% of the variance, projections cut to as many, k swept there."""
    test, train, counts, model = _projected(spark, sf_dir, 64)
    need = pca.components_for_target(pca.explained_variance(model), [0.95]).first()["n_components"]
    cut = [side.withColumn("vec", truncate("vec", int(need))) for side in (test, train)]
    return _sweep_accuracy(*cut, SWEEP_KS, (*counts, int(need))).select(F.lit(int(need)).alias("d"), "k", "accuracy")


SCORE_RUNS = (("euclidean", 5), ("euclidean", 10), ("cosine", 2))  # fixed values: the published score runs


def _sql_score(metric, k):
    best = "" if metric == "euclidean" else "cosine"
    return (f"SELECT {k} AS k, '{metric}' AS metric, round(avg(CAST(label = prediction AS DOUBLE)), {DIGITS}) AS accuracy "
            f"FROM (WITH {SQL_SPLIT_SCALED}, {sql_neighbors(k, metric)}, {sql_vote(best or 'euclidean')} "
            "SELECT * FROM pred)")


@register("knn_score_runs", " UNION ALL ".join(_sql_score(m, k) for m, k in SCORE_RUNS))
def knn_score_runs(spark, sf_dir):
    """K8 for several k and both metrics, on the scaled vectors."""
    train, test = train_test(spark, sf_dir)
    out = None
    for metric, k in SCORE_RUNS:
        pred = knn.classify(scaled(test), scaled(train), k, metric, actual="label")
        one = metrics.accuracy(pred).select(F.lit(k).alias("k"), F.lit(metric).alias("metric"), r6("accuracy"))
        out = one if out is None else out.unionByName(one)
    return out


@register("knn_classify_block_merge", SQL_CLASSIFY)
def knn_classify_block_merge(spark, sf_dir):
    """K1 on a grid of 2 x 3 blocks: every test row's candidates come from three cells and are merged."""
    train, test = train_test(spark, sf_dir)
    return knn.classify(test, train, K_DEFAULT, method="block", actual="label", grid=BlockGrid(2, 3))


# Fixed value: every 17th vector gets a null first element.
HOLE_MODULUS = 17


def _holes(frame):
    hole = F.pmod("id", F.lit(HOLE_MODULUS)) == 0
    return frame.withColumn("vec", F.when(hole, F.transform("vec", lambda x, i: F.when(i > 0, x))).otherwise(F.col("vec")))


def _sql_holes(metric):
    name = "distance" if metric == "euclidean" else "similarity"
    score = ("list_distance(q.vec, t.vec)" if metric == "euclidean" else sql_cos("q.vec", "t.vec"))
    order = f"{name} {'ASC' if metric == 'euclidean' else 'DESC'} NULLS LAST, train_id"
    return f"""
WITH {SQL_SPLIT_SCALED},
pr AS (SELECT q.id AS test_id, t.id AS train_id,
              CASE WHEN q.id % {HOLE_MODULUS} <> 0 AND t.id % {HOLE_MODULUS} <> 0 THEN {score} END AS {name} FROM te q, tr t),
nb AS (SELECT *, CAST(row_number() OVER (PARTITION BY test_id ORDER BY {order}) AS INTEGER) AS rnk
       FROM pr QUALIFY rnk <= {K_DEFAULT})
SELECT test_id, train_id, round({name}, {DIGITS}) AS {name}, rnk AS rank FROM nb
"""


@register("knn_neighbors_holes", _sql_holes("euclidean"))
def knn_neighbors_holes(spark, sf_dir):
    """K3 with null elements in every 17th vector, test and train: null distances, sorted last."""
    train, test = train_test(spark, sf_dir)
    nb = knn.neighbors(_holes(scaled(test)), _holes(scaled(train)), K_DEFAULT)
    return nb.select("test_id", "train_id", r6("distance"), "rank")


@register("knn_neighbors_holes_cosine", _sql_holes("cosine"))
def knn_neighbors_holes_cosine(spark, sf_dir):
    """The same by cosine similarity, on the block grid with a merge."""
    train, test = train_test(spark, sf_dir)
    nb = knn.neighbors(_holes(scaled(test)), _holes(scaled(train)), K_DEFAULT, "cosine", method="block",
                       grid=BlockGrid(1, 3))
    return nb.select("test_id", "train_id", r6("similarity"), "rank")
