import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import WORD, awkward, covered, frame, prose
from vecforge.llm import suffix_dedup, suffixes
from vecforge.llm.suffix_dedup import removal_report, remove_repeats
from vecforge.llm.suffixes import repeated_starts


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=40) | st.binary(max_size=30).map(lambda b: b.decode("latin-1")), min_size=1, max_size=7),
       st.integers(1, 12))
def test_starts(texts, length):
    raw = [t.encode("latin-1") for t in texts]
    count = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            count[t[i:i + length]] = count.get(t[i:i + length], 0) + 1
    want = [[i for i in range(len(t) - length + 1) if count[t[i:i + length]] > 1] for t in raw]
    assert [x.tolist() for x in repeated_starts(raw, length)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=6), st.integers(1, 9))
def test_starts_of_words(texts, length):
    big = [[x * (1 << 61) + 5 for x in t] for t in texts]
    count = {}
    for t in big:
        for i in range(len(t) - length + 1):
            count[tuple(t[i:i + length])] = count.get(tuple(t[i:i + length]), 0) + 1
    want = [[i for i in range(len(t) - length + 1) if count[tuple(t[i:i + length])] > 1] for t in big]
    assert [x.tolist() for x in repeated_starts([np.array(t, "<u8").tobytes() for t in big], length, 8)] == want


def passages(texts, words):
    """(passages, words in them) of each text: maximal runs of words in windows that start anywhere else too."""
    own = [WORD.findall(t or "") for t in texts]
    met = Counter(tuple(w[i:i + words]) for w in own for i in range(len(w) - words + 1))
    out = []
    for w in own:
        mask = [0] * len(w)
        for i in range(len(w) - words + 1):
            if met[tuple(w[i:i + words])] > 1:
                mask[i:i + words] = [1] * words
        # windows that only touch are one span, as with bytes
        out.append((sum(1 for j, x in enumerate(mask) if x and not (j and mask[j - 1])), sum(mask)))
    return out


def check(spark, rows, length, extra=True, words=None):
    got = removal_report(frame(spark, rows, extra), length=length, words=words).collect()
    if words:
        counted = passages([t for _, t in rows], words)
        assert sorted((repr(r.doc_id), r.n_passages, r.n_passage_words) for r in got) == sorted((repr(i), *c) for (i, _), c in zip(rows, counted))
    got = [tuple(r)[:5] for r in got]
    raw, masks = covered([t for _, t in rows], length)
    want = []
    for (i, _), t, m in zip(rows, raw, masks):
        kept = bytes(b for b, gone in zip(t, m) if not gone)
        spans = sum(1 for j, x in enumerate(m) if x and not (j and m[j - 1]))
        want.append((i, len(t), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("length", [400, 60])
def test_report(spark, length):
    check(spark, awkward(), length)


@pytest.mark.parametrize("words", [51, 6])
def test_report_of_passages(spark, words):
    rng = random.Random(12)
    between = {n: prose(rng, n, 300) for n in (51, 55, 63, 50, 49)}  # planted: 51 to 63 words, of under 400 bytes
    rows = awkward()
    for j, passage in enumerate(between.values()):
        rows += [(100 + 2 * j, prose(rng, 30) + " " + passage + " " + prose(rng, 9)), (101 + 2 * j, passage.replace(" ", "\n ", 5) + "\t" + prose(rng, 20))]
    assert all(len(p) < 400 for p in between.values())
    check(spark, rows, 400, words=words)


def test_heavy_anchors_are_cut_again(spark, monkeypatch):
    rng = random.Random(2)
    base, rows = prose(rng, 300).split(), []
    for i in range(40):
        copy = list(base)
        for _ in range(4):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(suffix_dedup, "HEAVY_BYTES", 5000)
    check(spark, rows, 100, extra=False, words=12)


def test_text_stays_valid(spark):
    a = "é" * 150 + "x" + "日本語" * 40
    rows = [(1, "1" + a), (2, a[1:]), (3, "ö" + a + "ö"), (4, None), (5, "")]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in remove_repeats(docs, length=101).collect()}
    assert remove_repeats(docs, length=101).columns == docs.columns and got[1].kept == "x"
    raw, masks = covered([t for _, t in rows], 101)
    for (i, t), b, m in zip(rows, raw, masks):
        if t is None:
            assert got[i].text is None
            continue
        # characters that are covered whole go; all others stay
        out, at = [], 0
        for ch in t:
            n = len(ch.encode())
            if not all(m[at:at + n]):
                out.append(ch)
            at += n
        assert got[i].text == "".join(out)


def test_empty_table(spark):
    assert removal_report(frame(spark, [])).count() == 0
    assert remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("width", [1, 8])
def test_only_what_may_repeat_is_sorted(monkeypatch, width):
    """Texts that share a gram but no string: none of them enters the suffix array, whose time they took before."""
    rng, kind = np.random.default_rng(5), "<u1" if width == 1 else "<u8"
    shared = rng.integers(97, 123, 64).astype(kind)
    texts = [np.concatenate([rng.integers(97, 123, 200), shared, rng.integers(97, 123, 200)]).astype(kind) for _ in range(50)]
    texts += [texts[7][20:], texts[9][:-30]]
    sorted_, whole = [], suffixes.suffix_array
    monkeypatch.setattr(suffixes, "suffix_array", lambda symbols, depth: sorted_.append(len(symbols)) or whole(symbols, depth))
    got = [x.tolist() for x in suffixes.repeated_starts([t.tobytes() for t in texts], 300, width)]
    want = {7: (20, 165), 50: (0, 145), 9: (0, 135), 51: (0, 135)}
    assert got == [list(range(*want.get(i, (0, 0)))) for i in range(52)]
    assert sum(sorted_) == sum(hi - lo + 300 for lo, hi in want.values())  # a separator each


@pytest.mark.parametrize("n", [1, 2, 1000, (1 << 21) - 1, 1 << 21])  # from 2 ** 21 on, places no longer fit in the keys
def test_suffixes_are_in_order(n):
    symbols = np.random.default_rng(n).integers(1, 4, n)
    symbols[n // 2:n // 2 + n // 4] = symbols[:n // 4]
    order = suffixes.suffix_array(symbols, 20)
    key = np.zeros(n, np.int64)
    padded = np.append(symbols, np.zeros(20, np.int64))
    for j in range(20):
        key = key * 4 + padded[j:n + j]
    assert (np.bincount(order, minlength=n) == 1).all() and (np.diff(key[order]) >= 0).all()


def test_pieces_of_texts_end_to_end():
    """Texts worked on together have the pieces that each has alone: none crosses into the next text."""
    raw = [(t or "").encode() for _, t in awkward()] + [b"", b"x" * 99, b"x" * 100, b""]
    bounds = np.cumsum([0, *map(len, raw)])
    strings = suffix_dedup.Strings(1, 100)
    alone = [(a + lo, a + hi, x) for a, t in zip(bounds.tolist(), raw)
             for one in suffix_dedup.pieces(np.frombuffer(t, np.uint8), np.array([0, len(t)]), strings, 0) for lo, hi, x in zip(*(c.tolist() for c in one))]
    together = [row for some in suffix_dedup.pieces(np.frombuffer(b"".join(raw), np.uint8), bounds, strings, 0)
                for row in zip(*(c.tolist() for c in some))]
    assert alone == together and alone
