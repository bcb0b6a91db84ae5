import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vecforge.llm import kmeans_tree
from vecforge.llm.kmeans_tree import KMeansTree, best_of, lifted, lifted_queries, search
from vecforge.llm.kmeans_tree_queries import op12_kmeans_tree_search


def fold(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def plain(rows, is_query, k):
    """[(query id, rank, id, score)] over usable rows by all pairs; equal query rows once."""
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v in dict.fromkeys((i, tuple(v)) for i, v in good):
        if is_query(i):
            near = sorted((-fold(v, w), j) for j, w in good if j != i and len(w) == len(v))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(near[:k])]
    return out


def vectors(n, d=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    return [(i, (centres[rng.integers(12)] + 0.2 * rng.normal(size=d)).astype(np.float32).astype(float).tolist()) for i in range(n)]


def frame(spark, rows):
    clash = [(i, v, 5, "x") for i, v in rows]
    return spark.createDataFrame(clash, "vec_id long, embedding array<double>, leaf long, v string").repartition(4)


def run(spark, rows, k=4, **how):
    return [(r.query_id, r["rank"], r.vec_id, r.score) for r in
            search(frame(spark, rows), "vec_id", "embedding", F.pmod("vec_id", F.lit(5)) == 0, k, **how).collect()]


def odd_rows():
    rows = vectors(160)
    rows += [(1000, None), (1001, [0.0] * 8), (1002, [1.0] * 7 + [float("nan")]), (1003, [1.0] * 7 + [None]), (None, [1.0] * 8),
             (1005, [float("inf")] + [1.0] * 7), (1010, [1.0, 2.0]), (1015, [2.0, 1.0]), (1016, [-2.0, 1.0]), (1020, []), (1021, [])]
    rows += [(i, [0.5] * 8) for i in range(2000, 2400)]  # one very common vector
    rows += [rows[5], rows[5], (10, [3.0] * 8)]          # a repeated query row; one id, two vectors
    return rows


@pytest.mark.parametrize("how", [dict(recall=1.0), dict(recall=1.0, group_rows=20), dict(recall=1.0, sample_rows=50, group_rows=7)])
def test_all_leaves_are_exact(spark, how):
    rows = odd_rows()
    assert sorted(run(spark, rows, **how)) == sorted(plain(rows, lambda i: i % 5 == 0, 4))


def test_calibrated_recall(spark):
    rows = vectors(3000, 16)
    out = search(frame(spark, rows), "vec_id", "embedding", F.pmod("vec_id", F.lit(5)) == 0, 5, sample_rows=1500).collect()
    want = {}
    for q, _, i, s in plain([r for r in rows], lambda i: i % 5 == 0 and i < 500, 5):
        want.setdefault(q, set()).add(i)
    got, by_id = {}, dict(rows)
    for r in out:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        assert r.score == fold(by_id[r.query_id], by_id[r.vec_id])
    found = sum(len(want[q] & {i for _, i, _ in got[q]}) for q in want)
    assert found >= 0.9 * 5 * len(want)
    assert all([n for n, _, _ in sorted(own)] == list(range(1, 6)) for own in got.values())
    assert out[0].visits < KMeansTree.fit(lifted(np.array([v for _, v in rows[:1500]]), 100.0)).leaves  # not all leaves are opened


def test_tree():
    points = np.array([v for _, v in vectors(2000)])
    radius2 = float((points ** 2).sum(axis=1).max())
    up = lifted(points, radius2)
    assert np.allclose((up ** 2).sum(axis=1), radius2)
    tree = KMeansTree.fit(up)
    leaf = tree.leaf_of(up)
    assert sorted(set(leaf)) == list(range(tree.leaves)) and np.bincount(leaf).max() <= 200
    order = tree.visits(lifted_queries(points[:20], radius2), tree.leaves)
    assert all(sorted(own) == list(range(tree.leaves)) for own in order)          # every leaf once
    assert [own[:7] for own in order] == tree.visits(lifted_queries(points[:20], radius2), 7)
    same = KMeansTree.fit(np.ones((500, 3)))
    assert same.leaves == 1 and set(same.leaf_of(np.ones((4, 3)))) == {0}


def test_best_of():
    rng = np.random.default_rng(2)
    rows = rng.integers(-2, 3, (300, 5)).astype(float)  # many ties
    ids = rng.permutation(300)
    r, c, score = best_of(rows[:20], ids[:20], rows, ids, 6)
    got = {}
    for i, j, s in zip(r, c, score):
        got.setdefault(int(ids[i]), []).append((-s, int(ids[j])))
    for i in range(20):
        want = sorted((-fold(rows[i], rows[j]), int(ids[j])) for j in range(300) if j != i)[:6]
        assert got[int(ids[i])] == want


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    out = op12_kmeans_tree_search(spark, sf).collect()
    got = {}
    for r in out:
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        near = x @ x[q]
        near[q] = -np.inf
        hits += len({int(i) for i in ids[np.argsort(-near)[:20]]} & set(got[int(ids[q])]))
    assert len(got) == (ids % 20 == 0).sum() and all(len(v) == 20 for v in got.values())
    assert hits >= 0.9 * 20 * len(got)


@pytest.mark.parametrize("dense", [0, 8, 10 ** 9])
def test_both_ways_through_a_cell(dense, monkeypatch):
    """As one masked product, or leaf by leaf: the best of the visited leaves' rows, ties by id."""
    monkeypatch.setattr(kmeans_tree, "DENSE", dense)
    rng = np.random.default_rng(7)
    x = rng.integers(-2, 3, (400, 5)).astype(float)
    x[:30] = 1.0
    leaf, ids = rng.integers(0, 12, 400), rng.permutation(400)
    visited = [sorted(rng.choice(14, rng.integers(1, 9), replace=False).tolist()) for _ in range(40)]
    left = pa.table({"id": pa.array(ids[:40], pa.int64()), "v": pa.array([r.tolist() for r in x[:40]], pa.list_(pa.float64())),
                     "qkey": pa.array(range(40), pa.int64()), "leaves": pa.array(visited, pa.list_(pa.int64()))})
    right = pa.table({"id": pa.array(ids, pa.int64()), "v": pa.array([r.tolist() for r in x], pa.list_(pa.float64())),
                      "leaf": pa.array(leaf, pa.int64())})
    got = {}
    for r in kmeans_tree._cell(6)(left, right).to_pylist():
        got.setdefault(r["qkey"], []).append((-r["score"], r["vec_id"]))
    for i in range(40):
        want = sorted((-fold(x[i], x[j]), int(ids[j])) for j in range(400) if leaf[j] in visited[i] and j != i)[:6]
        assert got.get(i, []) == want


def test_few_and_none(spark):
    assert run(spark, []) == [] and run(spark, [(0, [1.0, 2.0])]) == []
    rows = [(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.0, -1.0])]
    assert sorted(run(spark, rows)) == sorted(plain(rows, lambda i: i % 5 == 0, 4))
    assert run(spark, rows[1:]) == []
