"""Vector expressions, pair scores on linear pairings, joins and row ids."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from vecforge.functions import vectors as V
from vecforge.operators import pairs, rowid
from vecforge.plans.common import DIGITS, SQL_SPLIT, VECTOR_WIDTH, r6, spread, sql_spread, vectors
from vecforge.plans.registry import register
from vecforge.sources.tables import is_test_row, table

SQL_E = "e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings)"

SQL_CENTROIDS = f"""
{SQL_E},
ex AS (SELECT id, label, unnest(vec) AS x, unnest(range(len(vec))) AS pos FROM e),
cm AS (SELECT label, pos, avg(x) AS m FROM ex GROUP BY label, pos),
c AS (SELECT label, list(m ORDER BY pos) AS centroid FROM cm GROUP BY label),
ec AS (SELECT e.id, e.label, e.vec, c.centroid FROM e JOIN c USING (label))
"""


def _with_centroid(spark, sf_dir):
    return pairs.with_centroid(vectors(spark, sf_dir))


@register("euclidean_pairs", f"""
WITH {SQL_CENTROIDS}
SELECT id, label, round(list_distance(vec, centroid), {DIGITS}) AS distance FROM ec
""")
def euclidean_pairs(spark, sf_dir):
    """Euclidean distance of every vector to its class centroid (array expressions, no UDF)."""
    ec = _with_centroid(spark, sf_dir)
    return ec.select("id", "label", F.round(V.euclidean("vec", "centroid"), DIGITS).alias("distance"))


@register("cosine_pairs", f"""
WITH {SQL_CENTROIDS}
SELECT id, label, round(list_dot_product(vec, centroid) / nullif(sqrt(list_dot_product(vec, vec)) *
       sqrt(list_dot_product(centroid, centroid)), 0), {DIGITS}) AS similarity FROM ec
""")
def cosine_pairs(spark, sf_dir):
    """D3: cosine similarity of every vector to its class centroid (null for a zero norm)."""
    ec = _with_centroid(spark, sf_dir)
    return ec.select("id", "label", F.round(V.cosine_similarity("vec", "centroid"), DIGITS).alias("similarity"))


@register("dot_pairs", f"""
WITH {SQL_CENTROIDS}
SELECT id, label, round(list_dot_product(vec, centroid), {DIGITS}) AS dot FROM ec
""")
def dot_pairs(spark, sf_dir):
    """Dot product of every vector with its class centroid."""
    ec = _with_centroid(spark, sf_dir)
    return ec.select("id", "label", F.round(V.dot("vec", "centroid"), DIGITS).alias("dot"))


@register("vector_norm2", f"""
WITH {SQL_E}
SELECT id, round(list_dot_product(vec, vec), {DIGITS}) AS norm2 FROM e
""")
def vector_norm2(spark, sf_dir):
    """Squared norm of every vector."""
    return vectors(spark, sf_dir).select("id", F.round(V.norm2("vec"), DIGITS).alias("norm2"))


@register("self_pairs_dot", f"""
WITH {SQL_E}
SELECT a.id, round(sum(list_dot_product(a.vec, b.vec)), {DIGITS}) AS dot_sum
FROM e a JOIN e b ON a.id <> b.id GROUP BY a.id
""")
def self_pairs_dot(spark, sf_dir):
    """J4 + F3: over all distinct pairs within one set (self pairs dropped), the dot products
    summed per vector - computed as x.(S - x) in one pass instead of n^2 pairs."""
    return pairs.partner_dot_sums(vectors(spark, sf_dir)).select("id", r6("dot_sum"))


@register("cross_pairs_count", f"""
WITH {SQL_SPLIT}
SELECT (SELECT count(*) FROM te) AS n_test, (SELECT count(*) FROM tr) AS n_train,
       (SELECT count(*) FROM te, tr) AS n_pairs
""")
def cross_pairs_count(spark, sf_dir):
    """Size of the test x train product, from one counting pass (no product built)."""
    return pairs.cross_pair_count(vectors(spark, sf_dir), is_test_row("id"))


@register("self_join_id", f"""
WITH {SQL_E}
SELECT a.id, a.label = b.label AS same_label, round(list_dot_product(a.vec, b.vec), {DIGITS}) AS self_dot
FROM e a JOIN e b ON a.id = b.id
""")
def self_join_id(spark, sf_dir):
    """The frame joined to itself on its id (aliased sides)."""
    e = vectors(spark, sf_dir)
    a, b = e.alias("a"), e.alias("b")
    j = a.join(b, F.col("a.id") == F.col("b.id"))
    return j.select(F.col("a.id").alias("id"), (F.col("a.label") == F.col("b.label")).alias("same_label"),
                    F.round(V.dot(F.col("a.vec"), F.col("b.vec")), DIGITS).alias("self_dot"))


@register("join_features_labels", f"""
WITH {SQL_E}
SELECT id, label, CAST(len(vec) AS INTEGER) AS n_features, {sql_spread("vec", VECTOR_WIDTH, "f")} FROM e
""")
def join_features_labels(spark, sf_dir):
    """Features and labels as separate projections, re-joined on a stable key (the input id)."""
    e = vectors(spark, sf_dir)
    feats = e.select("id", "vec")
    labels = e.select("id", "label")
    j = feats.join(labels, "id")
    return j.select("id", "label", F.size("vec").alias("n_features"), *spread("vec", VECTOR_WIDTH, "f"))


LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("assemble_vector", """
SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2, l_tax AS f3
FROM lineitem
""")
def assemble_vector(spark, sf_dir):
    """Numeric columns assembled into one ML vector (VectorAssembler), read back by position."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINEITEM_NUMERIC)
    assembled = VectorAssembler(inputCols=LINEITEM_NUMERIC, outputCol="features").transform(li)
    arr = V.to_array("features")
    return assembled.select("l_orderkey", "l_linenumber",
                            *[F.get(arr, i).alias(f"f{i}") for i in range(len(LINEITEM_NUMERIC))])


@register("row_id_unique", """
SELECT count(*) AS n_rows, count(*) AS n_distinct_ids FROM lineitem
""")
def row_id_unique(spark, sf_dir):
    """Monotonically increasing ids are unique: distinct ones counted exactly, by bitmaps."""
    return rowid.id_counts(rowid.with_row_id(table(spark, sf_dir, "lineitem").select("l_orderkey"), "rid"), "rid")


@register("contiguous_row_index", """
SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS row_index FROM embeddings
""")
def contiguous_row_index(spark, sf_dir):
    """P5: contiguous 0..n-1 index in file order (the table is stored in vec_id order, which the
    oracle uses; the Spark side never looks at vec_id)."""
    scan = table(spark, sf_dir, "embeddings").select("vec_id")
    return rowid.with_file_order_index(scan).select("vec_id", "row_index")


@register("vector_element", f"""
WITH {SQL_E}
SELECT id, round(vec[1], {DIGITS}) AS first_value, label FROM e
""")
def vector_element(spark, sf_dir):
    """Element 0 of a vector as a scalar (``get`` is null-safe past the end)."""
    e = vectors(spark, sf_dir)
    return e.select("id", F.round(V.element("vec", 0), DIGITS).alias("first_value"), "label")


@register("feature_pow", f"""
SELECT l_orderkey, l_linenumber, round(pow(l_quantity, 2), {DIGITS}) AS quantity_sq,
       round(pow(l_discount, 0.5), {DIGITS}) AS discount_root FROM lineitem
""")
def feature_pow(spark, sf_dir):
    """Power of a column (built-in ``pow``, no UDF)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.pow("l_quantity", F.lit(2.0)), DIGITS).alias("quantity_sq"),
                     F.round(F.pow("l_discount", F.lit(0.5)), DIGITS).alias("discount_root"))


@register("feature_sqrt", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(sqrt({c}), {DIGITS}) AS sqrt_{c}" for c in LINEITEM_NUMERIC) + " FROM lineitem")
def feature_sqrt(spark, sf_dir):
    """Square root over every feature column in one projection."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     *[F.round(F.sqrt(c), DIGITS).alias(f"sqrt_{c}") for c in LINEITEM_NUMERIC])


@register("vector_arith", f"""
WITH {SQL_CENTROIDS},
d AS (SELECT id, list_transform(list_zip(vec, centroid), lambda p: (p[1] - p[2]) * 2.5) AS dv FROM ec)
SELECT id, CAST(len(dv) AS INTEGER) AS width, {sql_spread("dv", VECTOR_WIDTH, "d")} FROM d
""")
def vector_arith(spark, sf_dir):
    """P10: element-wise difference (vector minus class centroid) scaled by a constant."""
    ec = _with_centroid(spark, sf_dir)
    dv = V.scale(V.subtract("vec", "centroid"), 2.5)
    out = ec.select("id", dv.alias("dv"))
    return out.select("id", F.size("dv").alias("width"), *spread("dv", VECTOR_WIDTH, "d"))


KEPT = 8  # fixed value: components kept


@register("truncate_components", f"""
WITH {SQL_E}
SELECT id, CAST(len(vec[1:{KEPT}]) AS INTEGER) AS n_kept, {sql_spread("vec", KEPT, "c")} FROM e
""")
def truncate_components(spark, sf_dir):
    """Keep the first n (8) components."""
    e = vectors(spark, sf_dir).select("id", V.truncate("vec", KEPT).alias("head"))
    return e.select("id", F.size("head").alias("n_kept"), *spread("head", KEPT, "c"))
