import tracemalloc

import numpy as np
import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locations import SF_MID
from vecforge.operators import knn
from vecforge.operators.blocks import BlockGrid, plan_grid
from vecforge.plans.common import scaled, train_test


def frame(spark, rows, with_label=True):
    schema = "id long, vec array<double>, label int" if with_label else "id long, vec array<double>"
    return spark.createDataFrame(rows, schema)


def brute(test_rows, train_rows, k, metric):
    out = {}
    for qid, qv, *_ in test_rows:
        q = np.array(qv, float)
        scored = []
        for tid, tv, lab in train_rows:
            t = np.array(tv, float)
            if metric == "euclidean":
                key = float(np.sqrt(((q - t) ** 2).sum()))
                scored.append((key, tid, lab, key))
            else:
                den = np.linalg.norm(q) * np.linalg.norm(t)
                sim = float(q @ t / den) if den > 0 else None
                scored.append((-sim if sim is not None else np.inf, tid, lab, sim))
        scored.sort(key=lambda s: (s[0], s[1]))
        out[qid] = [(s[1], s[2]) for s in scored[:k]]
    return out


def collect_nb(df):
    out = {}
    for r in df.orderBy("test_id", "rank").collect():
        out.setdefault(r["test_id"], []).append((r["train_id"], r["train_label"]))
    return out


@pytest.mark.parametrize("method,block_rows", [("block", None), ("block", 64), ("native", None),
                                               ("native", 64), ("broadcast", None)])
@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_matches_brute_force(spark, method, metric, block_rows):
    train, test = train_test(spark, SF_MID)
    if metric == "cosine":
        train, test = scaled(train), scaled(test)
    tr = [(r["id"], r["vec"], r["label"]) for r in train.collect()]
    te = [(r["id"], r["vec"]) for r in test.collect()]
    expect = brute(te, tr, 5, metric)
    got = collect_nb(knn.neighbors(test, train, 5, metric, method=method, max_block_rows=block_rows))
    assert got == expect


def test_block_equals_native_predictions(spark):
    train, test = train_test(spark, SF_MID)
    a = {r["test_id"]: r["prediction"] for r in knn.classify(test, train, 7, method="block").collect()}
    b = {r["test_id"]: r["prediction"] for r in
         knn.classify(test, train, 7, method="native", grid=BlockGrid(3, 2)).collect()}
    assert a == b and len(a) == 100


def test_broadcast_bound_falls_back_to_grid(spark):
    train, test = train_test(spark, SF_MID)
    small = {r["test_id"]: r["prediction"] for r in knn.classify(test, train, 5).collect()}
    forced = {r["test_id"]: r["prediction"] for r in
              knn.neighbors(test, train, 5, broadcast_bytes=1000).transform(knn.majority_vote).collect()}
    assert small == forced
    # beyond the bound "broadcast" completes, on the grid
    beyond = knn.classify(test, train, 5, method="broadcast", broadcast_bytes=1000)
    assert small == {r["test_id"]: r["prediction"] for r in beyond.collect()}


def test_k_larger_than_train(spark):
    train = frame(spark, [(1, [0.0, 0.0], 1), (2, [1.0, 0.0], 2), (3, [3.0, 0.0], 1)])
    test = frame(spark, [(10, [0.1, 0.0], 0)])
    for method in ("block", "native", "broadcast"):
        nb = knn.neighbors(test, train, 10, method=method).orderBy("rank").collect()
        assert [r["train_id"] for r in nb] == [1, 2, 3]
        assert [r["rank"] for r in nb] == [1, 2, 3]


def test_equal_distances_broken_by_train_id(spark):
    # ids 5 and 2 are both at distance 1 from the query; 7 farther
    train = frame(spark, [(5, [1.0, 0.0], 1), (2, [0.0, 1.0], 2), (7, [2.0, 2.0], 3)])
    test = frame(spark, [(1, [0.0, 0.0], 0)])
    for method in ("block", "native", "broadcast"):
        nb = knn.neighbors(test, train, 1, method=method).collect()
        assert [(r["train_id"], r["rank"]) for r in nb] == [(2, 1)]


def test_rank_keeps_ties(spark):
    train = frame(spark, [(5, [1.0, 0.0], 1), (2, [0.0, 1.0], 2), (3, [-1.0, 0.0], 3), (7, [2.0, 2.0], 3)])
    test = frame(spark, [(1, [0.0, 0.0], 0)])
    for method in ("block", "native"):
        for grid in (BlockGrid(1, 1), BlockGrid(1, 3)):
            nb = knn.neighbors(test, train, 2, method=method, keep_ties=True, grid=grid).collect()
            assert sorted((r["train_id"], r["rank"]) for r in nb) == [(2, 1), (3, 1), (5, 1)]
    nb = knn.neighbors(test, train, 2, method="broadcast", keep_ties=True).collect()
    assert sorted((r["train_id"], r["rank"]) for r in nb) == [(2, 1), (3, 1), (5, 1)]


def test_vote_tie_smaller_best_distance_then_label(spark):
    nb = spark.createDataFrame(
        [(1, 10, 3, 0.5, 1), (1, 11, 4, 0.6, 2), (1, 12, 3, 0.9, 3), (1, 13, 4, 0.95, 4),
         (2, 20, 6, 0.5, 1), (2, 21, 5, 0.5, 2)],
        "test_id long, train_id long, train_label int, distance double, rank int")
    got = {r["test_id"]: r["prediction"] for r in knn.majority_vote(nb).collect()}
    assert got == {1: 3, 2: 5}


def test_all_labels_different_nearest_wins(spark):
    train = frame(spark, [(1, [1.0], 9), (2, [2.0], 1), (3, [3.0], 0)])
    test = frame(spark, [(10, [1.2], 0)])
    pred = knn.classify(test, train, 3).collect()
    assert pred[0]["prediction"] == 9


def test_zero_vector_cosine_null_last(spark):
    train = frame(spark, [(1, [0.0, 0.0], 1), (2, [1.0, 0.0], 2), (3, [0.0, 1.0], 3)])
    test = frame(spark, [(10, [1.0, 0.1], 0), (11, [0.0, 0.0], 0)])
    for method in ("block", "native", "broadcast"):
        rows = knn.neighbors(test, train, 3, "cosine", method=method).orderBy("test_id", "rank").collect()
        first = [(r["train_id"], r["similarity"] is None) for r in rows if r["test_id"] == 10]
        assert first == [(2, False), (3, False), (1, True)]
        zero = [(r["train_id"], r["similarity"]) for r in rows if r["test_id"] == 11]
        assert zero == [(1, None), (2, None), (3, None)]


def test_empty_test_set(spark):
    train = frame(spark, [(1, [0.0], 1)])
    test = frame(spark, [], with_label=True)
    for method in ("block", "native", "broadcast"):
        out = knn.classify(test, train, 3, method=method, actual="label")
        assert out.collect() == []
        assert out.columns == ["test_id", "label", "prediction"]


def test_row_in_both_sets_has_distance_zero(spark):
    rows = [(1, [0.5, 0.5], 1), (2, [1.0, 0.0], 2)]
    nb = knn.neighbors(frame(spark, rows[:1]), frame(spark, rows), 1).collect()
    assert nb[0]["train_id"] == 1 and nb[0]["distance"] == 0.0


def test_sweep_matches_separate_runs(spark):
    train, test = train_test(spark, SF_MID)
    nb = knn.neighbors(test, train, 9, carry=["label"])
    sweep = knn.k_sweep_votes(nb, [1, 4, 9], by=["label"])
    for k in (1, 4, 9):
        single = {r["test_id"]: r["prediction"] for r in knn.classify(test, train, k).collect()}
        swept = {r["test_id"]: r["prediction"] for r in sweep.filter(F.col("k") == k).collect()}
        assert single == swept


def test_single_query(spark):
    train, test = train_test(spark, SF_MID)
    q = test.orderBy("id").first()
    single = knn.single_query_neighbors(train, list(q["vec"]), 5).orderBy("rank").collect()
    grid = knn.neighbors(test.filter(F.col("id") == q["id"]), train, 5).orderBy("rank").collect()
    assert [r["train_id"] for r in single] == [r["train_id"] for r in grid]


def test_grid_planner_bounds():
    g = plan_grid(10_000, 60_000, 784, 8)
    assert g.ref_blocks >= 2 and g.query_blocks >= 1
    assert plan_grid(100, 400, 64, 8) == BlockGrid(1, 1)        # cheap: one cell
    assert plan_grid(400, 1600, 64, 8, method="native").cells >= 8


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(1, 40), st.integers(1, 6), st.integers(1, 8),
       st.sampled_from(["euclidean", "cosine"]), st.booleans(), st.integers(0, 10_000))
def test_cell_kernel_is_exact(nq, nt, d, k, metric, ties, seed):
    check_kernel(nq, nt, d, k, metric, ties, seed)


def check_kernel(nq, nt, d, k, metric, ties, seed):
    rng = np.random.default_rng(seed)
    Q = rng.integers(-2, 3, size=(nq, d)).astype(float)      # small integers: many exact ties
    T = rng.integers(-2, 3, size=(nt, d)).astype(float)
    tids = rng.permutation(nt * 3)[:nt].astype(np.int64)
    r, c, score, rank = knn.cell_top_k(Q, knn.Reference(T, tids, metric), k, ties)
    for i in range(nq):
        # left-to-right folds, as Spark's aggregate: equal floats are ties exactly as the kernel sees them
        if metric == "euclidean":
            acc = np.zeros(nt)
            for j in range(d):
                diff = Q[i, j] - T[:, j]
                acc = acc + diff * diff
            keys = np.sqrt(acc)
        else:
            qq, tt, dots = 0.0, np.zeros(nt), np.zeros(nt)
            for j in range(d):
                qq = qq + Q[i, j] * Q[i, j]
                tt = tt + T[:, j] * T[:, j]
                dots = dots + Q[i, j] * T[:, j]
            den = np.sqrt(qq) * np.sqrt(tt)
            keys = np.where(den > 0, -(dots / np.where(den > 0, den, 1.0)), np.inf)
        order = np.lexsort((tids, keys))
        if ties:
            kth = keys[order[min(k, nt) - 1]]
            expect = {int(tids[j]) for j in range(nt) if keys[j] <= kth < np.inf} | {int(tids[j]) for j in order[:k]}
        else:
            expect = {int(tids[j]) for j in order[:k]}
        got = {int(tids[j]) for j in c[r == i]}
        assert got == expect


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 12), st.integers(300, 900), st.integers(1, 4), st.integers(1, 4),
       st.sampled_from(["euclidean", "cosine"]), st.booleans(), st.integers(0, 10_000))
def test_cell_kernel_block_bound_path(nq, nt, d, k, metric, ties, seed):
    # wide reference blocks take the block-minimum bound; tiny integer grids force heavy ties
    check_kernel(nq, nt, d, k, metric, ties, seed)


def test_in_task_vote_matches_dataframe_vote(spark):
    train, test = train_test(spark, SF_MID)
    for metric, tr, te in (("euclidean", train, test), ("cosine", scaled(train), scaled(test))):
        fused = {r["test_id"]: (r["label"], r["prediction"]) for r in
                 knn.classify(te, tr, 6, metric, method="broadcast", actual="label").collect()}
        plain = {r["test_id"]: (r["label"], r["prediction"]) for r in
                 knn.majority_vote(knn.neighbors(te, tr, 6, metric, method="block", carry=["label"]),
                                   metric, by=["label"]).withColumnRenamed("label", "label").collect()}
        assert fused == plain and len(fused) == 100


def test_in_task_vote_tie_rules(spark):
    # votes 2-2: label 3 has the nearer best distance
    train = frame(spark, [(1, [0.5], 3), (2, [0.6], 4), (3, [0.9], 3), (4, [0.95], 4)])
    test = frame(spark, [(10, [0.0], 0)])
    assert knn.classify(test, train, 4, method="broadcast").first()["prediction"] == 3
    # votes 1-1 and equal best distance: the smaller label
    train = frame(spark, [(1, [-0.5], 6), (2, [0.5], 5)])
    assert knn.classify(test, train, 2, method="broadcast").first()["prediction"] == 5


def test_vote_rows_kernel():
    rows = np.array([0, 0, 0, 1, 1])
    key = np.array([0.1, 0.2, 0.3, 0.5, 0.5])
    lab = np.array([7, 8, 8, 2, 1])
    gr, gl, votes, best = knn.vote_rows(rows, key, lab)
    assert list(gr) == [0, 1] and list(gl) == [8, 1] and list(votes) == [2, 1]


@pytest.mark.parametrize("method", ["broadcast", "block"])
def test_classify_sweep_matches_single_k(spark, method):
    train, test = train_test(spark, SF_MID)
    sweep = knn.classify_sweep(test, train, [1, 4, 9], method=method, actual="label").collect()
    for k in (1, 4, 9):
        single = {r["test_id"]: r["prediction"] for r in knn.classify(test, train, k, method="block").collect()}
        assert single == {r["test_id"]: r["prediction"] for r in sweep if r["k"] == k}


def test_null_vectors_are_skipped(spark):
    train = frame(spark, [(1, [0.0, 0.0], 1), (2, None, 2), (3, [3.0, 0.0], 3)])
    test = frame(spark, [(10, [0.1, 0.0], 0), (11, None, 0)])
    for method in ("block", "native", "broadcast"):
        nb = knn.neighbors(test, train, 5, method=method).orderBy("rank").collect()
        assert [(r["test_id"], r["train_id"]) for r in nb] == [(10, 1), (10, 3)], method


@settings(max_examples=6, deadline=None)
@given(st.integers(1, 6), st.integers(1, 25), st.integers(1, 3), st.integers(1, 5),
       st.sampled_from(["euclidean", "cosine"]), st.booleans(), st.integers(0, 10_000))
def test_all_plans_agree_under_ties(spark, nq, nt, d, k, metric, ties, seed):
    rng = np.random.default_rng(seed)
    te_rows = [(int(i), [float(x) for x in rng.integers(-2, 3, d)], 0) for i in range(nq)]
    tr_rows = [(int(100 + j), [float(x) for x in rng.integers(-2, 3, d)], int(rng.integers(0, 3)))
               for j in range(nt)]
    test, train = frame(spark, te_rows), frame(spark, tr_rows)
    results = []
    for method, grid in (("broadcast", None), ("block", None), ("block", BlockGrid(2, 3)),
                         ("native", BlockGrid(2, 2))):
        nb = knn.neighbors(test, train, k, metric, method=method, keep_ties=ties, grid=grid)
        results.append(sorted((r["test_id"], r["train_id"], r["rank"]) for r in nb.collect()))
    assert all(r == results[0] for r in results[1:])
    if not ties:
        expect = brute(te_rows, tr_rows, k, metric)
        got = {}
        for t, tid, _ in sorted(results[0], key=lambda x: (x[0], x[2])):   # by rank
            got.setdefault(t, []).append(tid)
        assert {q: [x[0] for x in v] for q, v in expect.items()} == got


ODD = [None, float("nan"), float("inf"), float("-inf"), 1e200, 0.0, 1.0, -2.0]


def plain_scores(te, tr, metric):
    """(test_id, train_id) to score; None where either vector is malformed."""
    def fine(v):
        if any(x is None or x != x or abs(x) == float("inf") for x in v):
            return False
        n = sum(x * x for x in v)
        return n < 1e300 and (metric == "euclidean" or n > 0)

    out = {}
    for i, q, _ in te:
        for j, t, _ in tr:
            ok = q is not None and t is not None
            if not ok:
                continue
            if not (fine(q) and fine(t)):
                out[i, j] = None
            elif metric == "euclidean":
                out[i, j] = sum((a - b) ** 2 for a, b in zip(q, t)) ** 0.5
            else:
                dots = sum(a * b for a, b in zip(q, t))
                out[i, j] = dots / (sum(a * a for a in q) ** 0.5 * sum(b * b for b in t) ** 0.5)
    return out


@settings(max_examples=8, deadline=None, phases=[Phase.generate])  # shrinking Spark runs takes too long
@given(st.lists(st.lists(st.sampled_from(ODD), min_size=2, max_size=2), min_size=1, max_size=4),
       st.lists(st.lists(st.sampled_from(ODD), min_size=2, max_size=2), min_size=1, max_size=14),
       st.integers(1, 6), st.sampled_from(["euclidean", "cosine"]), st.booleans())
def test_malformed_vectors_on_every_plan(spark, qs, ts, k, metric, ties):
    """Null, NaN, infinite and huge elements on either side: null scores, last, and no other row is touched."""
    te = [(i, q, 0) for i, q in enumerate(qs)] + [(50, None, 0)]
    tr = [(100 + j, t, j % 3) for j, t in enumerate(ts)] + [(300, None, 0)]
    scores = plain_scores(te, tr, metric)
    want = set()
    for i, _, _ in te:
        mine = sorted(((s is None, 0 if s is None else (s if metric == "euclidean" else -s), j)
                       for (q, j), s in scores.items() if q == i))
        for n, (null, key, j) in enumerate(mine):
            rank = 1 + sum((a, round(b, 9)) < (null, round(key, 9)) for a, b, _ in mine) if ties and not null else n + 1
            if rank <= k:
                want.add((i, j, null) if not ties else (i, j, null, rank))
    test, train = frame(spark, te), frame(spark, tr)
    for method, grid in (("broadcast", None), ("block", None), ("block", BlockGrid(2, 3)), ("native", BlockGrid(1, 2))):
        rows = knn.neighbors(test, train, k, metric, method=method, keep_ties=ties, grid=grid).collect()
        score = knn.score_name(metric)
        got = {(r["test_id"], r["train_id"], r[score] is None, *([r["rank"]] if ties else [])) for r in rows}
        if ties or metric == "euclidean":
            assert got == want, (method, grid)
        else:  # cosines of parallel vectors may differ in the last digit: ties at the cut are free
            assert {(a, c) for a, _, c in got} == {(a, c) for a, _, c in want} and len(got) == len(want)


def test_malformed_rows_make_no_table_of_ties(spark):
    """With ties kept and few good train rows, a test row still gets k rows, not all malformed ones."""
    bad = [(i, [float("nan"), 1.0], 0) for i in range(100, 400)]
    test, train = frame(spark, [(1, [0.0, 1.0], 0), (2, [None, 1.0], 0)]), frame(spark, [(5, [0.0, 1.0], 1), (6, [0.0, 1.0], 1), *bad])
    for method, grid in (("broadcast", None), ("block", BlockGrid(1, 3)), ("native", BlockGrid(1, 2))):
        got = sorted((r["test_id"], r["rank"], r["train_id"]) for r in knn.neighbors(test, train, 4, method=method, keep_ties=True, grid=grid).collect())
        assert got == [(1, 1, 5), (1, 1, 6), (1, 3, 100), (1, 4, 101), (2, 1, 5), (2, 2, 6), (2, 3, 100), (2, 4, 101)], method


def test_one_bad_element_keeps_all_predictions(spark):
    train, test = train_test(spark, SF_MID)
    bad = train.withColumn("vec", F.when(F.col("id") == 1, F.transform("vec", lambda x, i: F.when(i != 3, x)))
                           .otherwise(F.col("vec")))
    rest = train.filter("id <> 1")
    want = {r["test_id"]: r["prediction"] for r in knn.classify(test, rest, 5).collect()}
    for method in ("auto", "block", "native"):
        assert {r["test_id"]: r["prediction"] for r in knn.classify(test, bad, 5, method=method).collect()} == want


@pytest.mark.parametrize("bytes_", [1000, 1 << 30])
def test_size_switch_gives_the_same_rows(spark, bytes_):
    """Repeated ids and repeated rows come back as often as they came in, whatever the plan."""
    train, test = train_test(spark, SF_MID)
    some = test.filter("id < 60")
    test = test.unionByName(some).unionByName(some.withColumn("vec", F.reverse("vec"))).withColumn("name", F.lit("x"))
    words = train.withColumn("label", F.concat(F.lit("class "), F.col("label").cast("string")))
    def run(tr, method):
        nb = knn.neighbors(test, tr, 3, carry=["name"], method=method, broadcast_bytes=bytes_).collect()
        cl = knn.classify(test, tr, 3, actual="label", method=method, broadcast_bytes=bytes_).collect()
        sw = knn.classify_sweep(test, tr, [1, 3], method=method, broadcast_bytes=bytes_).collect()
        return [sorted(map(repr, x)) for x in (nb, cl, sw)]

    n = test.count()
    for tr in (train, words):
        auto, block = run(tr, "auto"), run(tr, "block")
        assert auto == block
        assert [len(x) for x in auto] == [3 * n, n, 2 * n]


def test_ml_vectors_are_taken(spark):
    from pyspark.ml.functions import array_to_vector
    train, test = train_test(spark, SF_MID)
    ml = [side.withColumn("vec", array_to_vector("vec")) for side in (test, train)]
    for method in ("auto", "block", "native"):
        assert collect_nb(knn.neighbors(*ml, 3, method=method)) == collect_nb(knn.neighbors(test, train, 3))
    q = list(test.orderBy("id").first()["vec"])
    assert ([r["train_id"] for r in knn.single_query_neighbors(ml[1], q, 4).orderBy("rank").collect()]
            == [r["train_id"] for r in knn.single_query_neighbors(train, q, 4).orderBy("rank").collect()])


@pytest.mark.parametrize("case", ["plain", "outlier", "equal"])
def test_kernel_memory_is_bounded(case):
    """One outlier row or equal rows keep the candidates of a chunk from piling up over chunks."""
    import tracemalloc
    rng = np.random.default_rng(0)
    Q, T = rng.normal(size=(1000, 8)), rng.normal(size=(8192, 8))
    if case == "outlier":
        T[17] *= 1e9
    if case == "equal":
        T[:] = T[0]
    tracemalloc.start()
    r, c, score, rank = knn.cell_top_k(Q, knn.Reference(T, np.arange(8192), "euclidean"), 5, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(r) == 5000 and peak < 350 << 20
    exact = np.sqrt(((Q[:20, None, :] - T[None, :, :]) ** 2).sum(axis=2))
    assert np.allclose(np.sort(exact, axis=1)[:, :5].ravel(), score[:100])


def test_planning_runs_no_upstream_shuffle(spark):
    """Choosing a plan runs the counting jobs only, and none at all when the sizes are given."""
    train, test = train_test(spark, SF_MID)
    group = "knn-planning"
    spark.sparkContext.setJobGroup(group, group)
    try:
        heavy = test.groupBy("id").agg(F.first("vec").alias("vec"))
        knn._resolve(heavy, train, 3, "euclidean", "block", "id", "id", "vec", "label", [], None, None, 1 << 20,
                     (100, 400, 64))
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("ties", [False, True])
def test_tiles_equal_the_whole(metric, ties):
    """Train rows scored a tile at a time: the same neighbours and ranks, of malformed rows too."""
    rng = np.random.default_rng(8)
    T = np.round(rng.normal(size=(400, 3)))
    T[[5, 80, 333]] = np.nan
    tids = rng.permutation(400)
    Q = np.concatenate([np.round(rng.normal(size=(60, 3))), [[np.nan] * 3, [0.0] * 3]])
    for train, ids in ((T, tids), (T[[5, 80, 333, 1, 2]], tids[[5, 80, 333, 1, 2]])):
        want = knn.cell_top_k(Q, knn.Reference(train, ids, metric), 4, ties)
        got = knn.Tiles(train, ids, metric, tile_rows=max(2, len(train) // 9)).top_k(Q, 4, ties)
        plain = [sorted(zip(r, ids[c], np.nan_to_num(s, nan=-9.0), rank)) for r, c, s, rank in (want, got)]
        assert plain[0] == plain[1]


def test_tiles_hold_one_tile(monkeypatch):
    monkeypatch.setattr(knn, "_CHUNK_CELLS", 1 << 14)
    T = np.random.default_rng(9).normal(size=(40000, 16))
    tiles = knn.Tiles(T, np.arange(40000), "euclidean", tile_rows=1000)
    tracemalloc.start()
    tiles.top_k(T[:50], 5, False)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < T.nbytes / 2, most


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_native_scores_few_pairs(spark, metric):
    """A first look rules most pairs out before any is scored by higher-order functions; wide vectors are compared in part."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=140).tolist(), i % 3) for i in range(900)] + [(1000, [float("nan")] * 140, 1), (1001, [0.0] * 140, 2)]
    test, train = frame(spark, rows[::30]), frame(spark, rows)
    names = ("test_id", "train_id", "train_label", knn.score_name(metric), "rank")
    got, want = (sorted(tuple(r[n] for n in names) for r in knn.neighbors(test, train, 3, metric, method=m, grid=BlockGrid(2, 3)).collect())
                 for m in ("native", "block"))
    assert got == want
    plan = knn.neighbors(test, train, 3, metric, method="native", grid=BlockGrid(2, 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "_t_half" in plan.split("Join Inner")[1].split("\n")[0]


def test_native_join_is_compiled(spark):
    """Spark compiles no join of over 100 columns: 64 elements on either side take 32 each."""
    rng = np.random.default_rng(5)
    train = frame(spark, [(i, rng.normal(size=64).tolist(), i % 3) for i in range(200)])
    line = knn.neighbors(train, train, 3, method="native", grid=BlockGrid(2, 2))._jdf.queryExecution().optimizedPlan().toString()
    columns = {w.split("#")[0] for w in line.split("Join Inner")[1].split("\n")[0].replace("(", " ").split() if w[:2] in ("_q", "_t")}
    assert 64 <= len(columns) <= 80, columns
