"""Pivot cells, filter and refine, the metric index, the kNN graph, heavy keys and the index of any frame."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from locations import SF_MID
from vecforge.operators import cells, graph, knn, metric_index, refine, rowid, skewjoin
from vecforge.operators.blocks import BlockGrid
from vecforge.plans.common import train_test


def rows_of(frame, *names):
    return sorted((tuple(r[c] for c in names) for r in frame.collect()), key=repr)


def same(a, b, *names):
    assert rows_of(a, *names) == rows_of(b, *names)


def clustered(n, groups=25, width=6, seed=1, spread=0.02):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, width))
    return [(i, (centres[rng.integers(groups)] + spread * rng.normal(size=width)).tolist(), int(rng.integers(4))) for i in range(n)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "id long, vec array<double>, label int").repartition(parts)


def awkward(n=120):
    rows = clustered(n, 6)
    rows += [(1000 + i, rows[3][1], 1) for i in range(80)]                   # one very common vector
    rows += [rows[5], rows[5], (7, [9.0] * 6, 2)]                            # repeated rows; one id, two vectors
    rows += [(2000, None, 0), (2001, [float("nan")] + [0.0] * 5, 1), (2002, [0.0] * 6, 2), (2003, [1e200] * 6, 3)]
    return rows


NAMES = ("test_id", "train_id", "train_label", "distance", "rank")
COSINE_NAMES = ("test_id", "train_id", "train_label", "similarity", "rank")


@pytest.mark.parametrize("metric", [knn.EUCLIDEAN, knn.COSINE])
@pytest.mark.parametrize("cell_rows", [8192, 20])
def test_cells_equal_the_grid(spark, metric, cell_rows):
    rows = awkward()
    test, train = frame(spark, rows[::3] + rows[-8:]), frame(spark, rows)
    names = NAMES if metric == knn.EUCLIDEAN else COSINE_NAMES
    got = cells.join(test, train, 4, metric, cell_rows=cell_rows).neighbors
    same(got, knn.neighbors(test, train, 4, metric, method="block"), *names)


def test_cells_copy_less_than_the_grid(spark):
    train, test = frame(spark, clustered(3000)), frame(spark, clustered(900, seed=1))
    found = cells.join(test, train, 5, cell_rows=120)
    same(found.neighbors, knn.neighbors(test, train, 5, method="block"), *NAMES)
    report = found.report.first()
    assert report["queries"] == 900 and report["train_rows"] == 3000 and report["cells"] > 10
    assert 2 * (report["query_copies"] + report["train_copies"]) < report["grid_copies"]


def test_cells_carry_and_few_rows(spark):
    rows = awkward(30)
    test, train = frame(spark, rows), frame(spark, rows[:3] + rows[-3:])
    same(cells.join(test, train, 5, carry=["label"]).neighbors, knn.neighbors(test, train, 5, method="block", carry=["label"]), *NAMES, "label")
    none = frame(spark, []).limit(0)
    assert cells.join(none, train, 3).neighbors.count() == 0 and cells.join(test, none, 3).neighbors.count() == 0
    with pytest.raises(Exception, match="length"):
        cells.join(frame(spark, [(1, [1.0, 2.0], 0)]), frame(spark, clustered(50)), 3).neighbors.collect()


def test_cells_on_the_tables(spark):
    train, test = train_test(spark, SF_MID)
    same(cells.join(test, train, 10, cell_rows=50).neighbors, knn.neighbors(test, train, 10, method="block"), *NAMES)


@pytest.mark.parametrize("metric", [knn.EUCLIDEAN, knn.COSINE])
@pytest.mark.parametrize("group_rows", [40, 200])
def test_cells_in_groups_equal_the_grid(spark, metric, group_rows):
    rows = awkward()
    test, train = frame(spark, rows[::3] + rows[-8:]), frame(spark, rows)
    got = cells.join(test, train, 4, metric, cell_rows=10, group_rows=group_rows).neighbors
    same(got, knn.neighbors(test, train, 4, metric, method="block"), *(NAMES if metric == knn.EUCLIDEAN else COSINE_NAMES))


def test_cells_of_unclustered_vectors_copy_no_more_than_groups(spark):
    """Bounds rule nothing out: copies go by groups, not by the many small cells."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=30).tolist(), 0) for i in range(1500)]
    test, train = frame(spark, rows[:300]), frame(spark, rows[300:])
    found = cells.join(test, train, 5, cell_rows=10, group_rows=300)
    report = found.report.first()
    assert report["cells"] > 50 and report["query_copies"] <= 300 * (2 + 8)
    same(found.neighbors, knn.neighbors(test, train, 5, method="block"), *NAMES)


def test_groups_of_cells():
    first, blocks = cells.grouped(np.array([3, 0, 4, 25, 2, 9, 1]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 5, 5] and blocks.tolist() == [1, 1, 1, 3, 1, 1, 1]


def good_rows(rows):
    return [r for r in rows if r[1] is not None and float(np.sum(np.square(r[1]))) < 1e300]


@pytest.mark.parametrize("width", [1, 3, 6, 50])
@pytest.mark.parametrize("grid", [None, BlockGrid(2, 3)])
def test_refined_equal_the_grid(spark, width, grid):
    rows = awkward()
    test, train = frame(spark, rows[::4]), frame(spark, rows)
    got = refine.neighbors(test, train, 4, width, grid=grid)
    plain = knn.neighbors(frame(spark, good_rows(rows[::4])), frame(spark, good_rows(rows)), 4, method="block")
    same(got, plain, *NAMES)


def test_share_refined(spark):
    """With most of the variance on the axes used few pairs are compared in full."""
    rng = np.random.default_rng(5)
    scale = np.array([10, 6, 3] + [0.05] * 17)
    rows = [(i, (rng.normal(size=20) * scale).tolist(), 0) for i in range(1500)]
    test, train = frame(spark, rows[:200]), frame(spark, rows[200:])
    found = refine.neighbors(test, train, 5, 3)
    same(found, knn.neighbors(test, train, 5, method="block"), *NAMES)
    share = refine.share_refined(found, 1300).first()
    assert share["queries"] == 200 and share["share"] < 0.1 and share["compared"] >= 200 * 5
    assert abs(share["share"] - share["compared"] / (200 * 1300)) < 1e-12
    assert refine.neighbors(test, frame(spark, []).limit(0), 5, 3).count() == 0


def test_multi_step_stops_where_bounds_pass():
    rng = np.random.default_rng(6)
    full = rng.random((30, 200))
    low = full * rng.random((30, 200))
    looked = []
    r, c, s, refined = refine.multi_step(low, lambda a, b: (looked.append(len(a)), full[a, b])[1], 3, np.zeros(30))
    for i in range(30):
        want = np.sort(full[i])[:3]
        assert np.array_equal(np.sort(s[r == i])[:3], want)
        assert refined[i] >= (low[i] <= want[-1]).sum()  # what no method on these bounds can leave out
    assert refined.sum() == sum(looked) < 30 * 200


def test_metric_index(spark, tmp_dir):
    rows = awkward(400)
    train = frame(spark, rows)
    for metric, names in ((knn.EUCLIDEAN, NAMES[1:]), (knn.COSINE, COSINE_NAMES[1:])):
        path = f"{tmp_dir}/{metric}"
        metric_index.build(train, path, metric, cell_rows=40)
        for query in (rows[0][1], [0.3] * 6, [50.0] * 6, [0.0] * 6, [float("nan")] * 6):
            for k in (1, 5, 100, 2000):
                found = metric_index.neighbors(spark, path, query, k)
                plain = knn.single_query_neighbors(train.filter("vec IS NOT NULL"), query, k, metric)
                same(found.neighbors, plain, names[0], *names[2:])  # rows of one id and score may stand in any order
                assert found.cells_opened <= found.cells and found.rows_opened <= found.rows


def test_metric_index_opens_few_cells(spark, tmp_dir):
    rows = clustered(4000)
    metric_index.build(frame(spark, rows), f"{tmp_dir}/index", cell_rows=160)
    found = metric_index.neighbors(spark, f"{tmp_dir}/index", rows[17][1], 5)
    assert found.cells > 15 and found.cells_opened <= 5 and found.rows_opened < found.rows / 3
    read = found.neighbors.inputFiles()
    assert read and all("cell=" in f for f in read)


def plain_graph(rows, k):
    good = good_rows(rows)
    out = []
    for a, (i, v, _) in enumerate(good):
        near = []
        for b, (j, w, _) in enumerate(good):
            if a != b:
                total = 0.0
                for x, y in zip(v, w):
                    total += (x - y) * (x - y)
                near.append((float(np.sqrt(total)), j))
        out += [(i, j, d, n + 1) for n, (d, j) in enumerate(sorted(near)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [None, 40, 7])
def test_self_graph(spark, block_rows):
    rows = awkward(90)
    got = graph.self_knn_graph(frame(spark, rows), 4, block_rows=block_rows)
    assert sorted(tuple(r) for r in got.collect()) == plain_graph(rows, 4)


def test_pair_of_blocks_holds_only_the_best(monkeypatch):
    """Many chunks of one side: the other side's neighbours are cut to k as they come."""
    monkeypatch.setattr(knn, "_CHUNK_CELLS", 1 << 14)
    rng = np.random.default_rng(3)
    x, y = np.round(rng.normal(size=(2000, 4)), 1), np.round(rng.normal(size=(1500, 4)), 1)  # many ties
    x_ids, y_ids = rng.permutation(2000), rng.permutation(1500)
    tracemalloc.start()
    forth, back = graph.pair_of_blocks(x, x_ids, y, y_ids, False, 5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6e6, most
    for (r, c, s), of, to, ids in ((forth, x, y, y_ids), (back, y, x, x_ids)):
        away = np.zeros((len(of), len(to)))
        for j in range(4):
            away = away + (of[:, j][:, None] - to[:, j][None, :]) ** 2
        away = np.sqrt(away)
        want = np.lexsort((np.broadcast_to(ids, away.shape), away), axis=1)[:, :5]
        assert np.array_equal(r, np.repeat(np.arange(len(of)), 5)) and np.array_equal(c, want.ravel())
        assert np.array_equal(s, np.take_along_axis(away, want, 1).ravel())


def test_self_graph_ends(spark):
    assert graph.self_knn_graph(frame(spark, []).limit(0), 3).count() == 0
    assert graph.self_knn_graph(frame(spark, [(1, [1.0], 0)]), 3).count() == 0
    two = graph.self_knn_graph(frame(spark, [(None, [1.0], 0), (1, [1.0], 0), (1, [1.0], 0)]), 3).collect()
    assert len(two) == 6 and all(r["distance"] == 0 for r in two)
    assert {r["rank"] for r in two if r["neighbor_id"] is None} == {2}  # behind the others


def test_row_index_of_any_frame(spark):
    rows = spark.range(0, 1000, 1, 7).withColumn("part", F.col("id") % 3).filter("id % 5 <> 0")
    got = rowid.with_row_index(rows).collect()
    assert sorted(r["row_index"] for r in got) == list(range(800))
    assert [r["id"] for r in sorted(got, key=lambda r: r["row_index"])] == [i for i in range(1000) if i % 5]
    joined = rows.join(rows.select("part", F.col("id").alias("other")).filter("other < 20"), "part")
    indexed = rowid.with_row_index(joined, "n")
    assert indexed.columns == ["part", "id", "other", "n"] and indexed.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (0, joined.count() - 1, joined.count())
    odd = spark.createDataFrame([(5, 1, 2, 3)], "row_index long, place long, part long, `a.b` long")
    assert rowid.with_row_index(odd).collect()[0][:] == (1, 2, 3, 0)
    assert rowid.with_row_index(rows.limit(0)).count() == 0


def test_misra_gries():
    rng = random.Random(7)
    for size in (1, 3, 10):
        keys = [rng.choice("aaaabbbcddddddefghij") for _ in range(3000)]
        parts, total = [skewjoin.MisraGries(size) for _ in range(5)], Counter(keys)
        for i, key in enumerate(keys):
            parts[i % 5].add(key)
        whole = skewjoin.MisraGries(size)
        for p in parts:
            assert len(p.held) <= size
            whole.merge(p.held.items())
        assert len(whole.held) <= size
        for key, n in total.items():
            assert n - len(keys) / (size + 1) <= whole.held.get(key, 0) <= n


def skewed(spark, n=20000):
    """One label on 90 % of the rows."""
    return spark.range(0, n, 1, 8).select("id", F.when(F.col("id") % 10 != 0, F.lit(1)).when(F.col("id") % 70 == 0, F.lit(None))
                                          .otherwise(F.col("id") % 50).cast("int").alias("label"))


def test_heavy_keys(spark):
    found, rows = skewjoin.heavy_keys(skewed(spark), "label", 8)
    exact = Counter(r["label"] for r in skewed(spark).collect() if r["label"] is not None)
    assert rows == sum(exact.values()) and len(found) <= 8
    assert all(exact[k] - rows / 9 <= n <= exact[k] for k, n in found.items()) and found[1] > 0.7 * rows
    assert skewjoin.heavy_keys(skewed(spark).limit(0), "label") == ({}, 0)


def test_salted_join(spark):
    left = skewed(spark)
    right = spark.createDataFrame([(i, f"name{i}") for i in range(0, 50, 5)] + [(1, "one"), (1, "uno"), (None, "none")], "label int, salt string")
    got, plain = skewjoin.salted_join(left, right, "label", 16, 1000), left.join(right, "label")
    assert got.columns == plain.columns
    same(got, plain, *plain.columns)
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in held}
    try:  # as on a cluster whose small side is no longer broadcast
        for name, value in held.items():
            spark.conf.set(name, value)
        largest = [max(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
                   for joined in (skewjoin.salted_join(left, right, "label", 16, 1000), left.join(right, "label"))]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert largest[0] < 0.4 * got.count() and largest[1] > 0.9 * got.count()


def test_salted_join_without_heavy_keys(spark):
    left, right = skewed(spark, 500), spark.createDataFrame([(1, "one")], "label int, name string")
    same(skewjoin.salted_join(left, right, "label"), left.join(right, "label"), "id", "label", "name")
