import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from brute import awkward, frame
from vecforge.llm.spelling import RUN, frequent, near_pairs, one_edit, pivots_of, variants, words_of


def plain_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall(RUN, (text or "").translate({c: c + 32 for c in range(65, 91)})):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            found[run] += 1
    return found


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_pairs(words):
    return {frozenset(p) for p in itertools.combinations(sorted(set(words)), 2) if abs(len(p[0]) - len(p[1])) < 2 and distance(*p) == 1}


def vocabulary(seed, n=60, letters="abé"):
    rng = random.Random(seed)
    words = set()
    for _ in range(n):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 12)))
        words.add(word)
        for _ in range(rng.randrange(4)):
            at, c = rng.randrange(len(word)), rng.choice(letters + "z")
            words.add(rng.choice([word[:at] + word[at + 1:], word[:at] + c + word[at:], word[:at] + c + word[at + 1:]]))
    return sorted(w for w in words if len(w) >= 7)


def test_one_edit():
    words = vocabulary(1, 25) + ["", "a"]
    for a, b in itertools.product(words, words):
        assert one_edit(a, b) == (distance(a, b) == 1)


def test_pivots():
    """The two lightest prefix bigrams that do not overlap, by trying all."""
    rng = np.random.default_rng(3)
    for size in (6, 9):
        ranks = rng.integers(0, 12, (200, size))
        inside, first, second, last = pivots_of(ranks, ranks.astype(float))
        for row, own, a, b, end in zip(ranks, inside, first, second, last):
            assert end == sorted(row)[2] and list(own) == [x <= end for x in row] and b - a >= 2 and own[a] and own[b]
            assert row[a] + row[b] == min(row[i] + row[j] for i in range(size) for j in range(i + 2, size) if own[i] and own[j])


@pytest.mark.parametrize("hot", [1 << 18, 4])
@pytest.mark.parametrize("letters", ["ab", "abé", "abcdefghijklmnopqrstuvwxyzàéÿÉ"])
def test_pairs(spark, hot, letters):
    words = vocabulary(2, 90, letters)
    given = spark.createDataFrame([(w,) for w in words] + [(words[0],), (None,)], "word string").repartition(3)
    got = [frozenset(r) for r in near_pairs(given, hot).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_pairs(words)


def plain_variants(counts):
    near = {w: [] for w in counts}
    for pair in plain_pairs(counts):
        a, b = pair
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-counts[x], x.encode()), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return out


def test_variants(spark):
    rng = random.Random(4)
    counts = {w: rng.choice([2, 3, 25, 40, 300, 5000]) for w in vocabulary(5, 70, "abc")}
    chain = ["abababab", "ababababz", "ababababzz", "ababababzzz", "ababababzzzz"]
    counts.update({w: 2 * 11 ** i for i, w in enumerate(chain)})
    given = spark.createDataFrame([*counts.items(), (None, 7)], "word string, n long")
    got = variants(given)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain_variants(counts)
    assert dict(counts)[chain[-1]] and {r["word"]: r["root"] for r in got.collect()}[chain[0]] == chain[-1]


def test_words_of_documents(spark):
    rng = random.Random(6)
    rows = awkward() + [(i, " ".join("".join(rng.choice("abÉé") for _ in range(rng.randrange(5, 9))) for _ in range(40))) for i in range(100, 160)]
    rows += [(200, "ÀÿA×÷b'C-d\n" * 20), (201, "x" * 100000)]
    found = plain_words(rows)
    assert {r["word"]: r["n"] for r in words_of(frame(spark, rows)).collect()} == found
    want = {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}
    assert {tuple(r) for r in variants(frequent(words_of(frame(spark, rows)))).collect()} == plain_variants(want)


def test_empty_table(spark):
    assert variants(frequent(words_of(frame(spark, [])))).count() == 0
