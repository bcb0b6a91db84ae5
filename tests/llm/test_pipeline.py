import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from brute import awkward, components, covered, frame, prose, shingle_set
from vecforge.llm.quality import RULES, Text


def plain(rows):
    """(doc_id, text) that reach the packing stage."""
    kept = []
    for i, t in rows:
        x = Text((t or "").encode())
        if not x.base_failed and not any(r.rejects(x) for r in RULES):
            kept.append((i, t))
    part = components(kept, corpus_pipeline.NEAR_PERCENT)
    stay = [(i, t) for i, t in kept if i is None or part[i] == i]
    rows = sorted((x for x in stay if x[0] is not None), key=lambda x: (x[0], x[1] is None, (x[1] or "").encode()))
    stay = [x for x in stay if x[0] is None] + [x for x, before in zip(rows, [(None, None), *rows]) if x[0] != before[0]]
    texts = without_repeats([t for _, t in stay], corpus_pipeline.REPEAT_WORDS, corpus_pipeline.REPEAT_BYTES)
    return [(i, t) for (i, _), t in zip(stay, texts)]


def without_repeats(texts, words=51, length=400):
    """Texts without strings of 400 bytes, or passages of 51 words, that start anywhere else too."""
    raw, masks = covered(texts, length)
    spans = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", x)] for x in raw]
    met = Counter(tuple(x[a:b] for a, b in own[i:i + words]) for x, own in zip(raw, spans) for i in range(len(own) - words + 1))
    for x, own, mask in zip(raw, spans, masks):
        for i in range(len(own) - words + 1):
            if met[tuple(x[a:b] for a, b in own[i:i + words])] > 1:
                lo, hi = own[i][0], own[i + words - 1][1]
                mask[lo:hi] = b"\x01" * (hi - lo)
    return [bytes(b for b, gone in zip(x, mask) if not gone).decode() for x, mask in zip(raw, masks)]


def test_stages_against_brute_force(spark):
    rows = awkward()
    docs = frame(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, None)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    want = plain(rows)
    assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) == sorted(want, key=repr)
    assert {r.kept for r in docs.collect()} == {"x"}  # a column of the documents keeps its values
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, None).collect()
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*model.encode(t, add_special_tokens=False).ids, 0] for i, t in want}
    for i, own in ids.items():
        if i is None:
            continue
        at = 0
        for p in sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(own[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(own)


def test_repeated_ids_and_empty_table(spark):
    text = " ".join(f"word{i} stands here alone" for i in range(20))
    rows = [(1, text), (1, text), (2, text + " and more"), (None, text)]
    out = corpus_pipeline.near_dedup(spark, frame(spark, rows), None).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1]
    other = [(1, text + " b"), (1, text + " a"), (1, None), (3, "zeta eta theta iota kappa lambda"), (3, "alpha beta gamma delta eps")]
    for order in (other, other[::-1]):  # whichever comes first
        out = corpus_pipeline.near_dedup(spark, frame(spark, order), None).collect()
        assert sorted((r.doc_id, r.text) for r in out if r.text) == [(1, text + " a"), (3, "alpha beta gamma delta eps")] and len(out) == 2
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, None)
    assert docs.count() == 0


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    pieces = corpus_pipeline.run(spark, sf).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(model.encode(t, add_special_tokens=False).ids) + 1 for i, t in plain(rows)}
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == want


def test_near_copies_of_four_fifths(spark):
    """A pair of similarity about 0.82 is one group in the stage; one of about 0.78 is not."""
    rng = random.Random(21)
    rows = []
    for i, changed in ((1, (20, 60, 100)), (11, (20, 50, 80, 110))):
        base = prose(rng, 150).split()
        copy = [f"new{j}" if j in changed else w for j, w in enumerate(base)]
        rows += [(i, " ".join(base)), (i + 1, " ".join(copy))]
    share = []
    for (_, t), (_, u) in zip(rows[::2], rows[1::2]):
        a, b = shingle_set(t), shingle_set(u)
        share.append(len(a & b) / len(a | b))
    assert 0.8 <= share[0] < 0.85 and share[1] < 0.8
    part = components(rows, 80)
    out = corpus_pipeline.near_dedup(spark, frame(spark, rows), None).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows if part[i] == i) == [1, 11, 12]


def test_passages_of_over_fifty_words(spark):
    """51 words of under 400 bytes go, under any space between them, in one text as in two; 50 words stay."""
    rng = random.Random(22)
    long, short, twice = (prose(rng, n, 10 ** 4) for n in (51, 50, 55))
    unspaced = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(140))
    rows = [(1, prose(rng, 30) + " " + long + " " + prose(rng, 9)), (2, long.replace(" ", "\n", 7) + "\n" + prose(rng, 40)),
            (3, prose(rng, 20) + " " + short + " " + prose(rng, 20)), (4, prose(rng, 20) + " " + short + "!"),
            (5, twice + " é " + twice), (6, "a " + unspaced), (7, unspaced + " b"), (8, ""), (9, None), (10, prose(rng, 60))]
    assert len(long) < 400 < len(unspaced.encode())
    out = {r.doc_id: r.text for r in corpus_pipeline.suffix_dedup(spark, frame(spark, rows), None).collect()}
    want = without_repeats([t for _, t in rows])
    assert out[9] is None and {i: t or "" for i, t in out.items()} == {i: w for (i, _), w in zip(rows, want)}
    assert long not in out[1] and out[3] == rows[2][1] and out[4] == rows[3][1] and out[5] == " é " and out[6] == "a "
