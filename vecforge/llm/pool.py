"""Ids of text chunks that were encoded before, by the chunks' hashes."""

from __future__ import annotations

from itertools import chain

import numpy as np

POOL_IDS = 6 << 20  # ids remembered before it starts afresh


class ChunkPool:
    """``ids_of(hashes, spans, encode)``: each distinct chunk goes through ``encode`` once."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.known: dict[int, int] = {}
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(sizes) > len(self.begin):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.ids[self.used:self.used + len(flat)] = flat
        new = slice(self.count, self.count + len(sizes))
        self.size[new] = sizes
        self.begin[new] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.count += len(sizes)

    def ids_of(self, hashes: np.ndarray, encode):
        """``(ids, upto)``: ids of all chunks in order, and how many the first i chunks have.

        ``encode(places)`` gets the places of chunks that are new and gives ``(flat ids, sizes)``.
        """
        if self.used > POOL_IDS:
            self.clear()
        found, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        keys = found.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            base = self.count
            self.add(*encode(first[new]))
            self.known.update((keys[i], base + j) for j, i in enumerate(new))
        number = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))[which]
        sizes = self.size[number]
        upto = np.append([0], np.cumsum(sizes))
        return self.ids[np.repeat(self.begin[number] - upto[:-1], sizes) + np.arange(upto[-1])], upto


def flat_ids(lists: list[list[int]]):
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes
