"""Plain versions of what the operators compute, and a frame of awkward documents."""

import itertools
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def low_words(text):
    return words((text or "").translate(LOWER))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice('abcé')}" for _ in range(n))


def awkward():
    """(doc_id, text): copies, near copies, nulls, empty and long texts, repeated rows, odd characters."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    passage = "§ " + prose(rng, 90)
    long = prose(rng, 9000)
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, base.upper()), (5, None), (6, ""), (7, " \n\t "),
            (8, "one two three"), (9, "ONE two  three"), (10, "x" * 5000), (11, "ab" * 900), (12, long),
            (13, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30)), (14, passage),
            (15, prose(rng, 25) + "\r\n\r\n" + passage), (None, base), (None, None), (16, "日本語 テキスト éàü " * 30),
            (17, "line one is here\n" * 40), (18, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
            (19, "SHOUTING!! WORDS!! HERE!! " * 12), (20, "a | b | c | d | " * 20), (8, "one two three"), (-4, prose(rng, 50))]
    return rows


def frame(spark, rows, extra=True):
    """Rows as a frame; with columns whose names the operators use themselves."""
    if not extra:
        return spark.createDataFrame(rows, "doc_id long, text string")
    clash = [(i, t, "x", None, 1.5, 7, b"k", None) for i, t in rows]
    return spark.createDataFrame(clash, "doc_id long, text string, kept string, id long, size double, n long, key binary, "
                                        "component_id long")


def shingle_set(text, width=5):
    w = low_words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) or frozenset([tuple(w)])


def components(rows, percent=85):
    """component of each id, of rows without a null id; rows of one id are one node."""
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        common = len(x & y)
        if common and 100 * common >= percent * (len(x) + len(y) - common):
            u, v = find(a), find(b)
            parent[max(u, v)] = min(u, v)
    return {i: find(i) for i in parent}


def covered(texts, length):
    """For each text a mask of the bytes in strings of that length that start anywhere else too."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            seen[s] = seen.get(s, 0) + 1
    masks = []
    for t in raw:
        mask = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mask[i:i + length] = b"\x01" * length
        masks.append(mask)
    return raw, masks
