import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from brute import awkward, frame
from vecforge.llm.packing import HarmonicBins, cut_lengths, pack
from vecforge.llm.tokens import ByteBpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_library_s():
    rng = random.Random(0)
    parts = [" ", "  ", "\n", "\n\n", " \n", "\t", "a", "Bc", "'s", "don't", "é", "1", "23", "!", "...", "\xa0", " ", "\x1c",
             "<|endoftext|>", "日本", "\r\n", "", "　 "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(1500)] + [t or "" for _, t in awkward()]
    model = ByteBpe(PATH)
    assert model.fast is not None
    assert [model.ids(t).tolist() for t in texts] == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert model.ids("a <|endoftext|> b").tolist().count(50256) == 1
    for other in ("word_bpe_49k.json",):  # another kind of file: all by the library
        path = public_tokenizers.path(other)
        own, plain = ByteBpe(path), Tokenizer.from_file(path)
        assert own.fast is None
        assert [own.ids(t).tolist() for t in texts[:50]] == [plain.encode(t, add_special_tokens=False).ids for t in texts[:50]]


def test_characters_of_the_faster_way():
    rng = random.Random(8)
    chars = [chr(c) for c in [*range(9, 14), *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028)]]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(50))) for _ in range(1500)]
    texts += ["a" * 255, "a" * 3000, " " * 255, " " * 3000, "\n" * 400 + "b", "ab " * 900]
    model = ByteBpe(PATH)
    assert [model.ids(t).tolist() for t in texts] == [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]


def test_pack(spark):
    rows = [*awkward(), (30, "before <|endoftext|> after"), (31, "<|endoftext|>")]
    got = [r.asDict() for r in pack(frame(spark, rows), PATH, with_ids=True).collect()]
    model = library()
    want = sorted(model.encode(t or "", add_special_tokens=False).ids + [0] for _, t in rows)
    # pieces of one row follow each other; rows of one id are told apart by their total and pieces
    whole = {}
    for r in got:
        assert r["length"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        whole.setdefault((r["doc_id"], r["doc_tokens"]), {}).setdefault(r["start"], []).append(r["ids"])
    back = []
    for (_, total), starts in whole.items():
        for copy in range(len(starts[0])):
            ids = [x for s in sorted(starts) for x in starts[s][copy]]
            assert len(ids) == total
            back.append(ids)
    assert sorted(back) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0  # nothing is padded


def test_bins():
    rng = random.Random(4)
    bins, out, total = HarmonicBins(64, 1000), [], 0
    for i in range(300):
        for n in cut_lengths(rng.randrange(1, 200), 64):
            total += n
            out += bins.add((i, 0, n))
    closed = {p[3] for p in out}
    for s in closed:
        assert sum(p[2] for p in out if p[3] == s) == 64
        assert len({p[2] for p in out if p[3] == s}) == 1  # one class a bin
    out += bins.rest()
    assert sum(p[2] for p in out) == total
    for s in {p[3] for p in out} - closed:
        n = sum(p[2] for p in out if p[3] == s)
        assert n & (n - 1) == 0
    assert list(bins.rest()) == []


def test_empty_table(spark):
    assert pack(frame(spark, []), PATH).count() == 0
