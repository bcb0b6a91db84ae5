import random

import public_tokenizers
import sentencepiece

from brute import awkward, frame
from vecforge.llm.sentence_pieces import PieceModel, decode, encode, round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_ids_are_the_library_s():
    rng = random.Random(0)
    parts = [" ", "  ", "    ", "\n", "a", "B", "the", "ing", "é", "日", "1", "2", "<s>", "<0x41>", "▁", "\t", "€", "aa", "!!", "...",
             "🙂", "=====", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(800)]
    texts += ["a" * 3000, "ab" * 2000, " " * 500, "=" * 777 + " x"] + [t or "" for _, t in awkward()]
    model, library = PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids, bounds = model.encode([t.encode() for t in texts])
    got = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert [x.tolist() for x in got] == library.encode(texts)
    assert [model.decode(x).decode("utf-8", "replace") for x in got] == [library.decode(x.tolist()) for x in got]


def test_edges_are_all_occurrences():
    import numpy as np
    model = PieceModel(PATH)
    text = "▁the▁thing▁in▁▁▁éàü123...".encode()
    symbols = np.append(np.frombuffer(text, np.uint8).astype(np.uint16) + 1, 0).astype(np.uint16)
    got = {(int(p), int(s)) for p, s, _ in zip(*model.edges(symbols))}
    have = set(model.pieces)
    assert got == {(i, j - i) for i in range(len(text)) for j in range(i + 1, len(text) + 1) if text[i:j] in have}


def test_frames(spark):
    docs = frame(spark, awkward())
    encoded = encode(docs, PATH)
    back = decode(encoded, PATH)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((i or 0, t or "") for i, t in awkward())
    trip = round_trip(docs, PATH).collect()
    assert len(trip) == len(awkward()) and all(r.exact for r in trip)
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [tuple(r) for r in decode(nothing, PATH).orderBy("doc_id").select("doc_id", "text").collect()] == [(1, None), (2, "")]
    assert encode(frame(spark, []), PATH).count() == round_trip(frame(spark, []), PATH).count() == 0
