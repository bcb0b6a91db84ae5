"""Exact searches that look at less than all pairs, the kNN graph, heavy keys, and the index of any frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecforge.functions.vectors import euclidean, norm2
from vecforge.operators import cells, graph, knn, metric_index, pairs, randomized_pca, refine, rowid, skewjoin
from vecforge.plans.common import DIGITS, K_DEFAULT, SQL_SPLIT, SQL_SPLIT_SCALED, VECTOR_WIDTH, r6, scaled, sql_neighbors, train_test, vectors
from vecforge.plans.knn_queries import SQL_CLASSIFY
from vecforge.plans.registry import register
from vecforge.plans.vector_queries import SQL_CENTROIDS
from vecforge.session import scratch_path
from vecforge.sources.tables import table

SQL_NEIGHBORS = f"""
WITH {SQL_SPLIT}, {sql_neighbors(K_DEFAULT)}
SELECT test_id, train_id, train_label, round(distance, {DIGITS}) AS distance, rnk AS rank FROM nb
"""


@register("knn_neighbors_cells", SQL_NEIGHBORS)
def knn_neighbors_cells(spark, sf_dir):
    """K3 by pivot cells: a test row goes only to the cells that can hold a neighbour."""
    train, test = train_test(spark, sf_dir)
    return cells.join(test, train, K_DEFAULT).neighbors.select("test_id", "train_id", "train_label", r6("distance"), "rank")


@register("knn_neighbors_cells_cosine", f"""
WITH {SQL_SPLIT_SCALED}, {sql_neighbors(K_DEFAULT, "cosine")}
SELECT test_id, train_id, train_label, round(similarity, {DIGITS}) AS similarity, rnk AS rank FROM nb
""")
def knn_neighbors_cells_cosine(spark, sf_dir):
    """K5 by pivot cells: bounds at unit length, similarities of the vectors as they are; small cells, so that there are many."""
    train, test = train_test(spark, sf_dir)
    found = cells.join(scaled(test), scaled(train), K_DEFAULT, knn.COSINE, cell_rows=64).neighbors
    return found.select("test_id", "train_id", "train_label", r6("similarity"), "rank")


@register("knn_classify_cells", SQL_CLASSIFY)
def knn_classify_cells(spark, sf_dir):
    """K1 by pivot cells, then the vote."""
    train, test = train_test(spark, sf_dir)
    voted = knn.majority_vote(cells.join(test, train, K_DEFAULT, carry=["label"], cell_rows=256).neighbors, by=["label"])
    return voted.select("test_id", "label", "prediction")


REDUCED_WIDTH = 50  # fixed value: the reduced dimension of the original scripts


@register("knn_neighbors_refined", SQL_NEIGHBORS)
def knn_neighbors_refined(spark, sf_dir):
    """R5 -> K3, exact: filter by distances in the space of 50 principal axes, refine in full until none can be nearer."""
    train, test = train_test(spark, sf_dir)
    return refine.neighbors(test, train, K_DEFAULT, REDUCED_WIDTH).select("test_id", "train_id", "train_label", r6("distance"), "rank")


@register("knn_single_query_indexed", f"""
WITH {SQL_SPLIT},
q1 AS (SELECT * FROM te ORDER BY id LIMIT 1),
{sql_neighbors(K_DEFAULT, test="q1")}
SELECT train_id, train_label, round(distance, {DIGITS}) AS distance, rnk AS rank FROM nb
""")
def knn_single_query_indexed(spark, sf_dir):
    """K7 from a written metric index: the first test row's neighbours, cells opened by bound."""
    train, test = train_test(spark, sf_dir)
    path = scratch_path(spark, "metric-index")
    metric_index.build(train, path, cell_rows=256)
    first = test.orderBy("id").select("vec").first()
    return metric_index.neighbors(spark, path, list(first["vec"]), K_DEFAULT).neighbors.select("train_id", "train_label", r6("distance"), "rank")


@register("self_knn_graph", f"""
WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
pr AS (SELECT a.id, b.id AS neighbor_id, list_distance(a.vec, b.vec) AS distance FROM e a JOIN e b ON a.id <> b.id),
nb AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY distance, neighbor_id) AS INTEGER) AS rank
       FROM pr QUALIFY rank <= {K_DEFAULT})
SELECT id, neighbor_id, round(distance, {DIGITS}) AS distance, rank FROM nb
""")
def self_knn_graph(spark, sf_dir):
    """Every row's nearest other rows, from a triangular grid of its own blocks."""
    return graph.self_knn_graph(vectors(spark, sf_dir), K_DEFAULT).select("id", "neighbor_id", r6("distance"), "rank")


@register("row_index_any_frame", """
SELECT l_orderkey, l_linenumber, revenue, row_number() OVER (ORDER BY l_orderkey, l_linenumber, revenue) - 1 AS row_index
FROM (SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue FROM lineitem WHERE l_quantity > 25)
""")
def row_index_any_frame(spark, sf_dir):
    """P5 of a derived frame: filtered and projected rows, sorted, then numbered without gaps."""
    revenue = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("revenue")
    rows = table(spark, sf_dir, "lineitem").filter("l_quantity > 25").select("l_orderkey", "l_linenumber", revenue)
    return rowid.with_row_index(rows.orderBy("l_orderkey", "l_linenumber", "revenue"))


@register("heavy_flags", """
SELECT l_returnflag AS key, count(*) AS rows FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag
""")
def heavy_flags(spark, sf_dir):
    """A1 by Misra-Gries summaries: with counters for all keys the estimates are the counts."""
    found, _ = skewjoin.heavy_keys(table(spark, sf_dir, "lineitem"), "l_returnflag")
    return spark.createDataFrame(sorted(found.items()), "key string, rows long")


@register("salted_centroid_join", f"""
WITH {SQL_CENTROIDS}
SELECT id, label, round(list_distance(vec, centroid), {DIGITS}) AS distance FROM ec
""")
def salted_centroid_join(spark, sf_dir):
    """J1, J7 by the heavy-key join: rows of a frequent label are dealt out, its centroid is copied."""
    rows = vectors(spark, sf_dir)
    found = skewjoin.salted_join(rows, pairs.class_centroids(rows), "label", rows_per_salt=25)
    return found.select("id", "label", F.round(euclidean("vec", "centroid"), DIGITS).alias("distance"))


@register("pca_randomized_check", f"""
WITH {SQL_SPLIT},
x AS (SELECT unnest(range(1, len(vec) + 1)) AS i, unnest(vec) AS v FROM tr),
s AS (SELECT var_samp(v) AS s FROM x GROUP BY i),
t AS (SELECT id, list_dot_product(vec, vec) AS norm2 FROM te)
SELECT id, round(norm2, {DIGITS}) AS norm2, round(total, {DIGITS}) AS variance FROM t, (SELECT sum(s) AS total FROM s)
""")
def pca_randomized_check(spark, sf_dir):
    """R1-R3 by the randomised range finder at full width: the axes' variances add up to the columns', and projected test rows keep their norms."""
    train, test = train_test(spark, sf_dir)
    axes = randomized_pca.fit(train, VECTOR_WIDTH)
    out = randomized_pca.project(axes, test)
    return out.select("id", F.round(norm2("vec"), DIGITS).alias("norm2"), F.round(F.lit(float(axes.variance.sum())), DIGITS).alias("variance"))
