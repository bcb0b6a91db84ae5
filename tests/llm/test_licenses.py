import random

import pytest

from brute import awkward, frame, low_words, prose
from vecforge.llm.licenses import CONTAINED, TEMPLATES, Scanner, license_matches


def plain(text):
    """Templates of which some run of as many shingles as they have holds the least share."""
    w = low_words(text)
    have = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    found = set()
    for name, template in TEMPLATES.items():
        t = low_words(template)
        s = {tuple(t[i:i + 5]) for i in range(len(t) - 4)}
        at = [i for i, x in enumerate(have) if x in s]
        if any(len({have[j] for j in at if i <= j < i + len(t) - 4}) >= CONTAINED * len(s) for i in at):
            found.add(name)
    return found


def test_matches(spark):
    rng = random.Random(8)
    rows, n = [(i, t) for i, (_, t) in enumerate(awkward())], 100
    for name, template in TEMPLATES.items():
        w = template.split()
        rows += [(n, template), (n + 1, prose(rng, 300) + "\n" + template.upper() + " " + prose(rng, 200)),
                 (n + 2, prose(rng, 7) + " " + " ".join(w[:-max(1, len(w) // 12)])),
                 (n + 3, " ".join(w[:len(w) // 2]) + " " + prose(rng, 40)),
                 (n + 4, " ".join(w[:len(w) // 2] + ["odd"] + w[len(w) // 2:]))]
        n += 10
    rows.append((n, None))
    got = license_matches(frame(spark, rows)).collect()
    by_doc = {}
    for r in got:
        assert r.contained >= CONTAINED and 0 <= r.first_word <= r.last_word - 4
        by_doc.setdefault(r.doc_id, set()).add(r.license)
    for i, t in rows:
        missed = plain(t) - by_doc.get(i, set())
        assert not missed, (i, missed)
    # windows are longer than templates, so a passage with words put in may be found too, never less than contained
    for r in got:
        t = dict(rows)[r.doc_id]
        w = low_words(t)[r.first_word:r.last_word + 1]
        s = low_words(TEMPLATES[r.license])
        s = {tuple(s[i:i + 5]) for i in range(len(s) - 4)}
        assert abs(len(s & {tuple(w[i:i + 5]) for i in range(len(w) - 4)}) / len(s) - r.contained) < 1e-9


def test_every_place_of_a_template(spark):
    """A notice that stands three times is found three times; its places share no shingle."""
    rng = random.Random(9)
    for name in ("MIT", "Zlib-text", "MIT-line"):
        w = TEMPLATES[name].split()
        worn = " ".join(w[:len(w) // 2] + (["odd"] if len(w) > 60 else []) + w[len(w) // 2:])
        text = " ".join([prose(rng, 50), TEMPLATES[name], prose(rng, 130), worn, prose(rng, 90), TEMPLATES[name].upper(), prose(rng, 20)])
        got = sorted((r.first_word, r.last_word) for r in license_matches(frame(spark, [(1, text)])).collect() if r.license == name)
        at = [50, 50 + len(w) + 130, 50 + len(w) + 130 + len(worn.split()) + 90]
        assert got == [(a, a + n - 1) for a, n in zip(at, (len(w), len(worn.split()), len(w)))], name


def test_clauses_are_told_apart(spark):
    rows = [(2, TEMPLATES["BSD-2-Clause-text"]), (3, TEMPLATES["BSD-3-Clause-text"])]
    got = {(r.doc_id, r.license): r.contained for r in license_matches(frame(spark, rows)).collect()}
    assert got[2, "BSD-2-Clause-text"] == 1 and got[3, "BSD-3-Clause-text"] == 1
    assert (3, "BSD-third-clause") in got and (2, "BSD-third-clause") not in got


def test_bounds_and_empty(spark):
    assert license_matches(frame(spark, [])).count() == 0
    assert license_matches(frame(spark, [(1, "some text of five words")]), {}).count() == 0
    assert license_matches(frame(spark, [(1, "short one"), (2, "a short one here")]), {"s": "Short One"}).count() == 1
    with pytest.raises(ValueError):
        Scanner({"x": "a" * (2 << 20)})
