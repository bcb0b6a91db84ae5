"""Token ids of whole texts: those of the `tokenizers` library for a byte-level BPE file."""

from __future__ import annotations

import json
import re

import numpy as np

# Characters that the two libraries' patterns are sure to class alike; a text with any other one, or
# with one run of this many characters (merged in quadratic time by the faster one), goes to `tokenizers`.
OTHER = re.compile("[^\t-\r\x20-\x7e¡-ɏ‐-‧]")
LONG = 256
LONG_SPACE = re.compile(r"\s{%d}" % LONG)
# Fixed value: the pattern of the file's pre-tokenizer (ByteLevel with `use_regex`).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The printable character that a byte-level vocabulary writes for each byte, to the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class ByteBpe:
    """``ids(text)`` as ``tokenizers`` gives them with ``add_special_tokens=False``.

    Most texts are encoded by `tiktoken` with the file's own vocabulary, which takes under half the
    time; ids of merged pieces are in the order of the merges, as it needs. Texts that the two might
    split differently, that hold the string of a special token, or that have a very long run, go to
    ``tokenizers``, and so do all texts if the file is of another kind.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        self.special = [t["content"] for t in given["added_tokens"]]
        self.fast = self._fast(given)

    @staticmethod
    def _fast(given: dict):
        import tiktoken

        kind, vocab, merges = given["pre_tokenizer"] or {}, given["model"]["vocab"], given["model"].get("merges", [])
        to_byte = byte_characters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        in_order = [vocab.get(a + b) for a, b in pairs]
        if (given["normalizer"] or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex")
                or given["model"]["type"] != "BPE" or any(given["model"].get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
                or len(vocab) != len(pairs) + 256 or in_order != sorted(set(in_order)) or not all(c in vocab for c in to_byte)):
            return None
        ranks = {bytes(to_byte[c] for c in piece): number for piece, number in vocab.items()}
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if (self.fast is None or OTHER.search(text) or max(map(len, text.split()), default=0) >= LONG
                or LONG_SPACE.search(text) or any(s in text for s in self.special)):
            return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(self.fast.encode_ordinary(text), np.uint32)
