import random

import pytest

from brute import awkward, components, frame, prose, shingle_set
from vecforge.llm.components import connected_components
from vecforge.llm.minhash import MISS, near_duplicates, setting


def check(spark, rows, extra=True):
    got = near_duplicates(frame(spark, rows, extra)).collect()
    assert len(got) == len(rows)
    want = components(rows)
    sizes = {}
    for i, t in rows:
        sizes.setdefault(i, set()).add(len(shingle_set(t)))
    for r in got:
        assert r.n_shingles in sizes[r.doc_id]
        assert r.component_id == want.get(r.doc_id), r
        assert r.kept == (r.doc_id is not None and r.component_id == r.doc_id)


def test_awkward(spark):
    check(spark, awkward())


def test_chains_and_large_group(spark):
    """Near copies of one template, most pairs of them below the threshold, and chains of edits."""
    rng = random.Random(3)
    rows, base = [], prose(rng, 200).split()
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10 ** 6)}"
        rows.append((100 + i, " ".join(copy)))
    chain = prose(rng, 150).split()
    for i in range(25):
        chain = chain[:5 * i] + [f"c{i}"] + chain[5 * i + 1:]
        rows.append((900 - i, " ".join(chain)))
    rows += [(2000 + i, prose(rng, 60)) for i in range(60)]
    check(spark, rows, extra=False)


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300, 300), (None, 4), (5, None)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 6000 + i) for i in range(50)]
    edges += [(7, 7), (3, 4), (4, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_setting_follows_the_threshold():
    assert setting(85)[:2] == (28, 5) and round(setting(85).screen, 2) == 0.64
    for percent in range(8, 101):
        bands, rows, screen = setting(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= MISS and screen <= percent / 100
    for percent in (0, 5, 101):
        with pytest.raises(ValueError):
            setting(percent)


def test_half_alike(spark):
    """Pairs just over a similarity of 0.5, of which the setting for 0.85 screens out nearly all."""
    rng = random.Random(4)
    rows = []
    for i in range(30):
        base = prose(rng, 150, 10 ** 5).split()
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(f"n{j}" if j % 17 == 3 else w for j, w in enumerate(base)))]
    want = components(rows, 50)
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows, False), percent=50).collect()}
    assert got == want == {i: i - i % 2 for i in range(60)}
