"""A random forest whose bags, splits and votes can all be worked out again.

* **Bags.** A row is in a tree's bag a Poisson(1) number of times, read off a hash of row id, tree and seed: no
  sampling pass, the same bag after any lost task, and rows out of a bag are known without a list.
* **Split points.** Quantiles of each feature from mergeable sketches (``percentile_approx``).
* **Growth.** All trees grow level by level. A pass over the binned rows adds up, for every open node and each
  of its features (a hash picks them), the weight by bin and class; the sums of all tasks, a few numbers a
  node, go to the driver, where the split of largest Gini gain is taken.
* **Votes.** Each tree gives its leaf's class shares; their mean is the probability. A training row's
  out-of-bag vote is that of the trees whose bag lacks it.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.operators import knn, partials
from vecforge.session import scratch_path

# Defaults of the forest, and digits to which gains are compared (equal ones go by feature, threshold).
TREES = 10
MAX_DEPTH = 5
BINS = 32
SEED = 42
GAIN_DIGITS = 9
MOST_COPIES = 12  # a hash below 2^-32 is not told further


def poisson_steps() -> list[float]:
    """Where the distribution of a Poisson(1) number steps up: probability of at most 0, 1, 2, ..."""
    out, total = [], 0.0
    for k in range(MOST_COPIES):
        total += math.exp(-1) / math.factorial(k)
        out.append(total)
    return out


STEPS = np.array(poisson_steps())


def share_of(*parts) -> float:
    """A number in [0, 1) from a hash: the first 32 bits of MD5 of the parts, joined by colons."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2 ** 32


def copies(seed: int, tree: int, row: str) -> int:
    """How often the row is in the tree's bag."""
    return int(np.searchsorted(STEPS, share_of(seed, tree, row), "right"))


def chosen_features(seed: int, tree: int, node: int, width: int, count: int) -> list[int]:
    """The ``count`` features of least hash, ascending."""
    return sorted(sorted(range(width), key=lambda f: (share_of(seed, tree, node, f), f))[:count])


@dataclass
class Tree:
    """Nodes by number: the children of ``i`` are ``2 i + 1`` (at most the threshold) and ``2 i + 2``."""

    feature: dict[int, int] = field(default_factory=dict)
    threshold: dict[int, float] = field(default_factory=dict)
    gain: dict[int, float] = field(default_factory=dict)
    weights: dict[int, np.ndarray] = field(default_factory=dict)  # by class, of every node

    def place(self, rows: np.ndarray, thresholds: list[np.ndarray] | None = None) -> np.ndarray:
        """The leaf of every row; rows of bin numbers if ``thresholds`` is given."""
        at = np.zeros(len(rows), np.int64)
        for node in sorted(self.feature):
            here = np.flatnonzero(at == node)
            f, t = self.feature[node], self.threshold[node]
            cut = t if thresholds is None else int(np.searchsorted(thresholds[f], t))
            at[here] = np.where(rows[here, f] <= cut, 2 * node + 1, 2 * node + 2)
        return at

    def shares(self, rows: np.ndarray, classes: int) -> np.ndarray:
        """Each row's class shares at its leaf."""
        at = self.place(rows)
        table = np.zeros((max(self.weights) + 1, classes))
        for node, w in self.weights.items():
            table[node] = w / w.sum() if w.sum() else 0
        return table[at]


@dataclass
class Forest:
    """Trees, the classes in order, and the split points of every feature."""

    trees: list[Tree]
    classes: list[int]
    thresholds: list[np.ndarray]
    seed: int

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        return np.mean([t.shares(rows, len(self.classes)) for t in self.trees], axis=0)


def split_points(frame: DataFrame, vec: str, bins: int) -> list[np.ndarray]:
    """Distinct quantiles ``1 / bins, 2 / bins, ...`` of each element of the vectors."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = (frame.select(F.posexplode(vec).alias("feature", "x")).groupBy("feature")
             .agg(F.percentile_approx("x", at, F.lit(10000)).alias("q")).orderBy("feature").collect())  # a row a feature
    return [np.unique(np.array(r["q"], float)) for r in found]


def _best_split(hist: np.ndarray, features: list[int], thresholds: list[np.ndarray]):
    """``(gain, feature, threshold)`` of the largest Gini gain (None if nothing is gained).

    ``hist`` is features x bins x classes; bin b holds what is above threshold b - 1 and at most threshold b.
    """
    best = None
    whole = hist[0].sum(axis=0)
    total = whole.sum()
    for own, f in zip(hist, features):
        for b, t in enumerate(thresholds[f]):
            left = own[:b + 1].sum(axis=0)
            right = whole - left
            if not left.sum() or not right.sum():
                continue
            gain = ((left ** 2).sum() / left.sum() + (right ** 2).sum() / right.sum() - (whole ** 2).sum() / total) / total
            gain = round(float(gain), GAIN_DIGITS)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, f, float(t))
    return best


def fit(frame: DataFrame, vec: str = "vec", label: str = "label", id_col: str = "id", trees: int = TREES,
        max_depth: int = MAX_DEPTH, bins: int = BINS, features: int | None = None, seed: int = SEED) -> Forest:
    """Grow the forest. ``features`` of each node are tried (the square root of the width, rounded up, if not given).

    Rows with a null id, label or vector, or a null or non-finite element, are left out; rows of one id
    are in the same bags. Labels are integers. The driver holds the trees and one level's sums: trees x open
    nodes x features x bins x classes numbers.
    """
    spark = frame.sparkSession
    v = knn._vector(frame, vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (frame.select(F.col(id_col).cast("string").alias("id"), v.alias("v"), F.col(label).cast("int").alias("label"))
            .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(~bad, F.lit(False))))
    classes = [r[0] for r in rows.select("label").distinct().orderBy("label").collect()]  # a row a class
    if not classes:
        raise ValueError("a forest needs rows to learn from")
    thresholds = split_points(rows, "v", bins)
    width, number = len(thresholds), np.array(classes)
    count = features or math.ceil(math.sqrt(width))

    def binned(batches):
        """Bin numbers, class numbers and bag counts: all that growing needs of a row, as bytes."""
        for batch in batches:
            if not batch.num_rows:
                continue
            x = knn._matrix(batch.column(1))
            codes = np.stack([np.searchsorted(t, x[:, f], "left") for f, t in enumerate(thresholds)], axis=1).astype(np.uint16)
            bags = np.array([[copies(seed, t, i) for t in range(trees)] for i in batch.column(0).to_pylist()], np.uint8)
            label_no = np.searchsorted(number, batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(label_no, pa.int32()),
                                              pa.array([r.tobytes() for r in bags], pa.binary())], ["codes", "label", "bags"])

    path = scratch_path(spark, "forest-rows")
    rows.mapInArrow(binned, "codes binary, label int, bags binary").write.parquet(path)
    table = spark.read.parquet(path)
    grown = [Tree() for _ in range(trees)]
    open_nodes = [(t, 0) for t in range(trees)]
    most_bins = max(len(t) for t in thresholds) + 1
    for depth in range(max_depth + 1):
        if not open_nodes:
            break
        tried = {key: chosen_features(seed, *key, width, count) for key in open_nodes}
        sums = partials.reduced(_histograms(table, grown, open_nodes, tried, thresholds, most_bins, len(classes), width))
        next_nodes = []
        for i, (t, node) in enumerate(open_nodes):
            if i not in sums:
                continue
            hist = sums[i].reshape(-1, most_bins, len(classes))
            whole = hist[0].sum(axis=0)
            grown[t].weights[node] = whole
            if depth == max_depth or np.count_nonzero(whole) < 2:
                continue
            best = _best_split(hist, tried[t, node], thresholds)
            if best:
                grown[t].gain[node], grown[t].feature[node], grown[t].threshold[node] = best
                next_nodes += [(t, 2 * node + 1), (t, 2 * node + 2)]
        open_nodes = next_nodes
    return Forest(grown, classes, thresholds, seed)


def _histograms(table, grown, open_nodes, tried, thresholds, most_bins, n_classes, width) -> DataFrame:
    """For each open node (its place in the list is the part) the weight by tried feature, bin and class."""
    of_tree: dict[int, list[tuple[int, int]]] = {}
    for i, (t, node) in enumerate(open_nodes):
        of_tree.setdefault(t, []).append((i, node))

    def fold(batch, held):
        codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint16).reshape(batch.num_rows, width)
        label = batch.column(1).to_numpy()
        bags = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
        if held is None:
            held = [np.zeros((len(tried[key]), most_bins, n_classes)) for key in open_nodes]
        for t, nodes in of_tree.items():
            at, weight = grown[t].place(codes, thresholds), bags[:, t].astype(float)
            for i, node in nodes:
                here = np.flatnonzero((at == node) & (weight > 0))
                for j, f in enumerate(tried[open_nodes[i]]):
                    cell = codes[here, f].astype(np.int64) * n_classes + label[here]
                    held[i][j] += np.bincount(cell, weight[here], most_bins * n_classes).reshape(most_bins, n_classes)
        return held

    return partials.by_part(table.select("codes", "label", "bags"), fold)


def _scored(frame: DataFrame, forest: Forest, vec: str, keep: list[str], fn, schema: str, names: list[str]) -> DataFrame:
    source = frame.select(*keep, knn._vector(frame, vec).alias("_v"))

    def run(batches):
        for batch in batches:
            rows, good = knn._valid_matrix(batch.column(len(keep)))
            if len(good):
                take = pa.array(good, pa.int64())
                kept = [batch.column(i).take(take) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *fn(rows, kept)], names)

    return source.mapInArrow(run, schema)


def predict(forest: Forest, frame: DataFrame, vec: str = "vec", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``*keep, prediction, probability`` of all non-null vectors; the first of equally likely classes is predicted."""
    keep = list(keep)
    classes = np.array(forest.classes)

    def fn(rows, _):
        p = forest.probabilities(rows)
        return [pa.array(classes[p.argmax(axis=1)], pa.int32()), pa.array(list(p), pa.list_(pa.float64()))]

    kinds = [f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in keep]
    return _scored(frame, forest, vec, keep, fn, ", ".join([*kinds, "prediction int", "probability array<double>"]),
                   [*keep, "prediction", "probability"])


def out_of_bag(forest: Forest, frame: DataFrame, vec: str = "vec", label: str = "label", id_col: str = "id") -> DataFrame:
    """``id, label, trees, prediction`` of the training rows: votes of the ``trees`` whose bag lacks the row; null if none does."""
    classes = np.array(forest.classes)

    def fn(rows, kept):
        lacks = np.array([[copies(forest.seed, t, str(i)) == 0 for t in range(len(forest.trees))] for i in kept[0].to_pylist()])
        votes = sum(t.shares(rows, len(classes)) * lacks[:, [i]] for i, t in enumerate(forest.trees))
        n = lacks.sum(axis=1)
        return [pa.array(n, pa.int32()), pa.array(classes[votes.argmax(axis=1)], pa.int32(), mask=n == 0)]

    kinds = [f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in (id_col, label)]
    return _scored(frame, forest, vec, [id_col, label], fn, ", ".join([*kinds, "trees int, prediction int"]), [id_col, label, "trees", "prediction"])


def out_of_bag_error(votes: DataFrame, label: str = "label") -> DataFrame:
    """``rows, voted, error`` from :func:`out_of_bag`: the share of the rows with a vote that it gets wrong."""
    wrong = F.count_if(F.col("prediction") != F.col(label))
    voted = F.count("prediction")
    return votes.agg(F.count(F.lit(1)).alias("rows"), voted.alias("voted"), (wrong / voted).alias("error"))


def bags(frame: DataFrame, trees: int = TREES, seed: int = SEED, id_col: str = "id", label: str = "label") -> DataFrame:
    """``tree, label, in_bag, out_of_bag``: drawn rows, repeats counted, and rows not drawn, by tree and class; in built-in functions."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = frame.select(F.col(id_col).alias("id"), F.col(label).alias("label"), tree.alias("tree"))
    key = F.concat_ws(":", F.lit(str(seed)), F.col("tree").cast("string"), F.col("id").cast("string"))
    share = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / 2 ** 32
    times = sum((share >= F.lit(float(s))).cast("int") for s in STEPS)
    return (rows.withColumn("times", times).groupBy("tree", "label")
            .agg(F.sum("times").cast("long").alias("in_bag"), F.count_if(F.col("times") == 0).alias("out_of_bag")))


def nodes(forest: Forest) -> DataFrame:
    """``tree, node, feature, threshold, gain`` of every split."""
    from pyspark.sql import SparkSession

    rows = [(i, n, t.feature[n], t.threshold[n], t.gain[n]) for i, t in enumerate(forest.trees) for n in sorted(t.feature)]
    return SparkSession.getActiveSession().createDataFrame(rows, "tree int, node int, feature int, threshold double, gain double")


def _register() -> None:
    from vecforge.shipping import by_value
    by_value(__name__)


_register()
