import math
import random

import numpy as np
from pyspark.sql import functions as F

from vecforge.llm import pivots
from vecforge.llm.pivots import top_k


def check(spark, rows, k=5):
    data = [(*r, "x", 1.0) for r in rows]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, v string, score double")
    got = {}
    for r in top_k(df, "vec_id", "embedding", F.pmod("vec_id", F.lit(50)) == 0, k).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    use = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    limit = (1 << 63) - 1
    want = {}
    for i, q in use:
        if i % 50 == 0:
            s = sorted((-max(-limit - 1, min(limit, sum(a * b for a, b in zip(q, x)))), j) for j, x in use
                       if j != i and len(x) == len(q))[:k]
            if s:
                want[i] = [(n + 1, j, -a) for n, (a, j) in enumerate(s)]
    assert {i: sorted(x) for i, x in got.items()} == want


def test_awkward(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, [0.5] * 6) for i in range(20)]  # ties
    rows += [(1000, None), (1050, [None] + [0.1] * 5), (1100, [float("nan")] * 6), (1150, [float("inf")] + [0.0] * 5),
             (None, [0.9] * 6), (1200, [0.0] * 6), (1250, [1.0, 2.0]), (1251, [2.0, 1.0]), (1300, []), (1301, []),
             (1350, [0.25] * 6), (1350, [0.25] * 6), (7, [0.5] * 6)]
    check(spark, rows)
    check(spark, rows[:3], k=50)
    check(spark, [])


def test_many_cells_and_large_values(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK_BYTES", 64 * 8 * 41)
    monkeypatch.setattr(pivots, "FIRST_LOOK", 8)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) + (i % 4) for _ in range(5)]) for i in range(500)]
    check(spark, rows)
    check(spark, rows[:200] + [(600, [3e9, -2e9, 1.0, 0.0, 5e8]), (601, [3e9] * 5), (602, [1e15] * 5), (650, [-3e15] * 5)])


def test_stops_before_the_end(monkeypatch):
    """On clustered data the bounds leave out most candidates, and the result is still exact."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 8)) * 2000
    rows = np.concatenate([c + rng.normal(size=(200, 8)) * 20 for c in centres]).astype(np.int64)
    rows = (rows / np.linalg.norm(rows, axis=1, keepdims=True) * 5000).astype(np.int64)
    radius2 = float((rows.astype(float) ** 2).sum(axis=1).max())
    lifted = pivots._lifted(rows, radius2)
    p = pivots._far_apart(lifted, 32)
    seen = []
    whole = pivots._scores
    monkeypatch.setattr(pivots, "_scores", lambda r, q, s: seen.append(len(r)) or whole(r, q, s))
    ids = np.arange(len(rows))
    found = list(pivots.search_cell(rows[::500], ids[::500], rows, ids, pivots._distances(lifted, p), p, radius2, 5))
    assert sum(seen) < 0.1 * len(rows) * len(rows[::500])
    assert sum(x[2] for x in found if x[1] < 0) == sum(seen)
    found = [x for x in found if x[1] >= 0]
    for i in range(len(rows[::500])):
        s = rows @ rows[500 * i]
        s[500 * i] = s.min()
        assert sorted(x[2] for x in found if x[0] == i) == sorted(s)[-5:]


def test_share_evaluated_by_the_whole_query(spark):
    """Clustered vectors: under half of all pairs are compared, over all cells."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 24))
    rows = [(i, (centres[rng.integers(30)] + 0.1 * rng.normal(size=24)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(df, "vec_id", "embedding", F.pmod("vec_id", F.lit(50)) == 0, 5).collect()
    by_query = {r.query_id: (r.evaluated, r.candidates) for r in got}
    assert len(by_query) == 60 and all(n == 2999 for _, n in by_query.values())
    share = sum(e for e, _ in by_query.values()) / sum(n for _, n in by_query.values())
    assert 5 / 2999 <= share < 0.5
    x = np.floor(256 * np.array([v for _, v in rows])).astype(np.int64)
    for q in by_query:
        s = x @ x[q]
        order = sorted((-int(v), i) for i, v in enumerate(s) if i != q)[:5]
        assert [(i, -v) for v, i in order] == [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]


def test_span_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.integers(-300, 300, (400, 12))
    radius2 = float((x ** 2).sum(axis=1).max())
    up = pivots._lifted(x, radius2)
    p = pivots._far_apart(up, 6)
    p = np.concatenate([p, p[:1]])  # a direction twice
    turn, norm2 = pivots.span_of(p)
    inside, outside = pivots.coordinates(pivots._distances(up, p), np.full(len(up), radius2), turn, norm2)
    q = np.concatenate([x[:30], np.zeros((30, 1))], axis=1).astype(float)
    q_in, q_out = pivots.coordinates(pivots._distances(q, p), (q ** 2).sum(axis=1), turn, norm2)
    bound = q_in @ inside.T + q_out[:, None] * outside[None, :]
    assert (bound >= x[:30] @ x.T - 1e-6 * radius2).all() and bound.mean() < radius2
