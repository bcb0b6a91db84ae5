"""The forest worked out again: bags, root and inner splits, votes, out-of-bag errors."""

import math
from collections import Counter

import numpy as np
import pytest

from vecforge.operators import forest, partials


def plain_split(x, y, weight, features, thresholds, classes):
    best = None
    for f in features:
        for t in thresholds[f]:
            left = x[:, f] <= t
            sides = [np.array([weight[side & (y == c)].sum() for c in classes], float) for side in (left, ~left)]
            if not all(s.sum() for s in sides):
                continue
            whole = sides[0] + sides[1]
            total = whole.sum()
            gain = round(float((sum((s ** 2).sum() / s.sum() for s in sides) - (whole ** 2).sum() / total) / total), 9)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, float(t))
    return best


def data(n=300, d=6, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    return x, (x[:, 0] + x[:, 1] ** 2 > 0.8).astype(int) + 2 * (x[:, 2] > 1)


def frame(spark, x, y, parts=5):
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, vec array<double>, label int").repartition(parts)


@pytest.fixture(scope="module")
def grown(spark):
    x, y = data()
    return x, y, frame(spark, x, y), forest.fit(frame(spark, x, y), trees=4, max_depth=4, bins=12, features=3, seed=9)


def test_split_points_are_quantiles(grown):
    x, _, _, model = grown
    for f, got in enumerate(model.thresholds):
        ordered = np.sort(x[:, f])
        assert np.array_equal(got, np.unique([ordered[math.ceil(len(ordered) * i / 12) - 1] for i in range(1, 12)]))


def test_every_split_is_the_best(grown):
    x, y, _, model = grown
    classes = sorted(set(y.tolist()))
    splits = 0
    for t, tree in enumerate(model.trees):
        weight = np.array([forest.copies(9, t, str(i)) for i in range(len(x))])
        for node in tree.weights:
            here = np.ones(len(x), bool)
            way, at = [], node
            while at:
                way.append((at, (at - 1) // 2))
                at = (at - 1) // 2
            for child, parent in way:
                left = x[:, tree.feature[parent]] <= tree.threshold[parent]
                here &= left if child == 2 * parent + 1 else ~left
            own = weight * here
            assert np.array_equal(tree.weights[node], [own[y == c].sum() for c in classes])
            depth = int(math.log2(node + 1))
            want = None if depth == 4 or np.count_nonzero(tree.weights[node]) < 2 else plain_split(
                x, y, own, forest.chosen_features(9, t, node, 6, 3), model.thresholds, classes)
            assert (want is None) == (node not in tree.feature)
            if want:
                splits += 1
                assert (tree.gain[node], tree.feature[node], tree.threshold[node]) == want
    assert splits > 20


def plain_leaf(tree, row):
    node = 0
    while node in tree.feature:
        node = 2 * node + (1 if row[tree.feature[node]] <= tree.threshold[node] else 2)
    return tree.weights[node] / tree.weights[node].sum()


def test_votes(grown):
    x, y, df, model = grown
    for r in forest.predict(model, df, keep=["id", "label"]).collect():
        p = np.mean([plain_leaf(t, x[r["id"]]) for t in model.trees], axis=0)
        assert np.allclose(p, r["probability"]) and r["prediction"] == model.classes[int(np.argmax(p))] and r["label"] == y[r["id"]]


def test_out_of_bag(grown):
    x, y, df, model = grown
    votes = {r["id"]: r for r in forest.out_of_bag(model, df).collect()}
    wrong = voted = 0
    for i in range(len(x)):
        lacks = [t for t in range(4) if forest.copies(9, t, str(i)) == 0]
        assert votes[i]["trees"] == len(lacks)
        if not lacks:
            assert votes[i]["prediction"] is None
            continue
        p = sum(plain_leaf(model.trees[t], x[i]) for t in lacks)
        assert votes[i]["prediction"] == model.classes[int(np.argmax(p))]
        voted, wrong = voted + 1, wrong + (votes[i]["prediction"] != y[i])
    found = forest.out_of_bag_error(forest.out_of_bag(model, df)).first()
    assert (found["rows"], found["voted"]) == (len(x), voted) and abs(found["error"] - wrong / voted) < 1e-12
    commonest = max(Counter(y.tolist()).values()) / len(y)
    assert 0 < found["error"] < 1 - commonest  # better than the commonest class, on rows that a tree has not seen


def test_bags(grown, spark):
    _, y, df, _ = grown
    got = {(r["tree"], r["label"]): (r["in_bag"], r["out_of_bag"]) for r in forest.bags(df, 4, 9).collect()}
    want = {}
    for t in range(4):
        for i, c in enumerate(y.tolist()):
            n = forest.copies(9, t, str(i))
            a, b = want.get((t, c), (0, 0))
            want[t, c] = (a + n, b + (n == 0))
    assert got == want
    counts = Counter(forest.copies(1, 0, str(i)) for i in range(20000))
    for k in range(4):
        assert abs(counts[k] / 20000 - math.exp(-1) / math.factorial(k)) < 0.01


def test_odd_rows(spark):
    x, y = data(60, 3)
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    odd = [(None, [1.0] * 3, 0), (900, None, 1), (901, [1.0, None, 2.0], 1), (902, [float("nan")] * 3, 0), (903, [1.0] * 3, None)]
    schema = "id long, vec array<double>, label int"
    a = forest.fit(spark.createDataFrame(rows, schema).repartition(3), trees=2, max_depth=2)
    b = forest.fit(spark.createDataFrame(rows + odd, schema).repartition(7), trees=2, max_depth=2)
    for s, t in zip(a.trees, b.trees):
        assert s.feature == t.feature and s.threshold == t.threshold
    one = forest.fit(spark.createDataFrame([(1, [1.0, 2.0], 5)] * 3, schema), trees=2)
    assert all(not t.feature for t in one.trees) and one.classes == [5]
    with pytest.raises(ValueError, match="rows"):
        forest.fit(spark.createDataFrame(odd[1:2], schema))


def test_partial_sums(spark):
    """More tasks than are put together at once."""
    def fold(batch, held):
        own = [np.array([float(batch.num_rows)]), np.array(batch.column(0).to_numpy(), float).sum(keepdims=True)]
        return own if held is None else [a + b for a, b in zip(held, own)]

    got = partials.reduced(partials.by_part(spark.range(0, 1000, 1, 40), fold))
    assert got[0].tolist() == [1000] and got[1].tolist() == [sum(range(1000))]
    assert partials.reduced(partials.by_part(spark.range(0), fold)) == {}
