"""Suffix arrays in numpy, and common prefixes by threshold-bounded interval expansion on a BWT."""

from __future__ import annotations

import numpy as np

from vecforge.llm.words import U64, mix

GRAM_SEEDS = mix(np.arange(1, 65, dtype=U64)) | U64(1)


def _place_type(n: int):
    return np.int32 if n < 1 << 31 else np.int64


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols (at least); symbols are not negative.

    The first symbols, as many as fit beside a place, are sorted as one number; then prefixes
    double, and only suffixes that still share theirs with another are sorted again. Of fewer than
    2 ** 21 suffixes the keys carry their place, so plain numbers are sorted, which is several times as
    fast as sorting places by them.
    """
    n = len(symbols)
    place = _place_type(n)
    wide = max(1, n.bit_length())  # bits of a place
    low, mask = U64(wide), U64((1 << wide) - 1)
    packs = 3 * wide <= 64
    bits = max(1, int(symbols.max(initial=0)).bit_length())
    begin = max(1, min(7, (64 - wide if packs else 63) // bits))
    padded = np.concatenate([symbols, np.zeros(begin, symbols.dtype)])
    key = np.zeros(n, U64)
    for j in range(begin):
        key <<= U64(bits)
        key |= padded[j:n + j].astype(U64)
    if begin * bits + wide <= 64:
        key <<= low
        key |= np.arange(n, dtype=U64)
        key.sort()
        order = (key & mask).astype(place)
        key >>= low
    else:
        order = np.argsort(key, kind="stable").astype(place)
        key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    del key
    head = np.maximum.accumulate(np.where(new, np.arange(n, dtype=place), place(0)))
    rank = np.full(n + 1, -1, place)  # place of the first suffix with the same prefix; -1 past the end
    rank[order] = head
    at = np.flatnonzero(~(new & np.append(new[1:], True))).astype(place)
    suffix, head = order[at], head[at]
    h = begin
    while len(at) and h < depth:
        second = rank[np.minimum(suffix.astype(np.int64) + h, n)] + place(1)
        if packs:
            both = head.astype(U64)
            for part in (second, suffix):
                both <<= low
                both |= part.astype(U64)
            both.sort()
            suffix = (both & mask).astype(place)
            both >>= low
        else:
            both = head.astype(np.int64) * (n + 1) + second
            by = np.argsort(both, kind="stable")
            suffix, both = suffix[by], both[by]
        order[at] = suffix
        first = np.ones(len(at), bool)
        first[1:] = both[1:] != both[:-1]
        head = at[np.maximum.accumulate(np.where(first, np.arange(len(at), dtype=place), place(0)))]
        rank[suffix] = head
        shared = ~(first & np.append(first[1:], True))
        at, suffix, head = at[shared], suffix[shared], head[shared]
        h *= 2
    return order.astype(np.int64)


def boundaries_below(bwt: np.ndarray, limit: int) -> np.ndarray:
    """Whether the common prefix of suffixes ``i - 1`` and ``i`` is under ``limit``, for ``i`` in 0 to n.

    Breadth-first backward extension (Beller, Gog, Ohlebusch, Schnattinger): the intervals of all
    strings of length 1, 2, ... are derived from those one symbol shorter. A string of length ``m``
    whose interval ends at a boundary that is still unset has found a common prefix of ``m - 1``
    there, and goes on; one that finds nothing is dropped. It stops at length ``limit``, so what is
    unset then has a common prefix of ``limit`` or more. Symbol 0 separates texts and is never
    extended by, so a boundary beside a suffix with a separator in its first ``limit`` symbols may
    stay unset. An interval inside a run of one symbol has one extension, as wide as itself.
    """
    n = len(bwt)
    place = _place_type(n)
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(n, place)  # where the suffix one symbol longer stands
    step[by_symbol] = np.arange(n, dtype=place)
    starts_with = bwt[by_symbol]
    stride = n + 1
    ranks = starts_with.astype(np.int64) * stride + by_symbol  # ascending: searchsorted counts symbols
    alphabet = np.unique(bwt)
    alphabet = alphabet[alphabet > 0].astype(np.int64)
    run_end = np.flatnonzero(np.append(bwt[1:] != bwt[:-1], True)).astype(place) + place(1)
    run_end = np.repeat(run_end, np.diff(run_end, prepend=place(0)))
    wide = U64(max(1, n.bit_length()))
    mask = (U64(1) << wide) - U64(1)
    found = np.zeros(n + 1, bool)
    found[[0, n]] = True
    # The empty string's interval is all suffixes; its end is known, so the first level is special.
    lo, hi = np.zeros(1, place), np.full(1, n, place)
    for _ in range(limit):
        plain = run_end[lo] >= hi
        a, b = lo[plain], hi[plain]
        full = bwt[a] > 0
        a, b = a[full], b[full]
        to = step[a]
        new_lo, new_hi = [to], [to + (b - a)]
        lo, hi = lo[~plain], hi[~plain]
        sizes = hi - lo
        if len(lo):
            if 8 * len(lo) * len(alphabet) < int(sizes.sum(dtype=np.int64)):  # a search costs as much as several suffixes
                a = np.searchsorted(ranks, (alphabet[:, None] * stride + lo[None, :]).ravel())
                b = np.searchsorted(ranks, (alphabet[:, None] * stride + hi[None, :]).ravel())
                some = b > a
                new_lo.append(a[some].astype(place))
                new_hi.append(b[some].astype(place))
            else:
                owner = np.repeat(np.arange(len(lo), dtype=place), sizes)
                inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes, dtype=np.int64) - sizes - lo, sizes)
                full = bwt[inside] > 0
                owner, inside = owner[full], inside[full]
                both = (owner.astype(U64) << wide) | step[inside].astype(U64)
                both.sort()
                if len(both):
                    to = (both & mask).astype(place)
                    both >>= wide
                    symbol = starts_with[to]
                    first = np.ones(len(to), bool)
                    first[1:] = (both[1:] != both[:-1]) | (symbol[1:] != symbol[:-1])
                    new_lo.append(to[first])
                    new_hi.append(to[np.append(first[1:], True)] + place(1))
        lo, hi = np.concatenate(new_lo), np.concatenate(new_hi)
        fresh = ~found[hi]
        lo, hi = lo[fresh], hi[fresh]
        found[hi] = True
        if not len(lo):
            break
    return found


def gram_hashes(symbols: np.ndarray, gram: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every string of ``gram`` symbols (a power of two), in order."""
    h = symbols.astype(U64) + U64(1)
    width = 1
    while width < gram:
        h = h[:-width] * GRAM_SEEDS[8 * seed + width.bit_length() - 1] + h[width:]
        width *= 2
    return mix(h ^ GRAM_SEEDS[seed])


def may_repeat(symbols: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """Places where a string of ``length`` symbols may start that starts elsewhere too, in texts of ``sizes`` end to end.

    Its first and its last symbols, as many as the largest power of two that fits, must both be met
    elsewhere (by hash); none that repeats is left out, and some that do not are in.
    """
    n = len(symbols)
    if n < length:
        return np.zeros(0, np.int64)
    gram = 1 << (length.bit_length() - 1)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    at = np.flatnonzero(room >= gram)
    wide = U64(n.bit_length())
    packed = (gram_hashes(symbols, gram)[at] >> wide << wide) | at.astype(U64)
    packed.sort()
    same = (packed[1:] ^ packed[:-1]) >> wide == 0
    met = np.zeros(n, bool)
    for side in (packed[1:], packed[:-1]):
        met[(side[same] & ((U64(1) << wide) - U64(1))).astype(np.int64)] = True
    both = met & (room >= length)
    both[:n - (length - gram)] &= met[length - gram:]
    return np.flatnonzero(both)


def repeated_starts(texts: list[bytes], length: int, width: int = 1) -> list[np.ndarray]:
    """For each text the starts of its strings of ``length`` symbols that start anywhere else in ``texts``.

    A symbol is a byte, or with ``width`` 8 a 64-bit number; starts count symbols. The suffix array is
    that of the stretches where a string may repeat (:func:`may_repeat`).
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) // width
    joined = np.frombuffer(b"".join(texts), np.uint8 if width == 1 else "<u8")
    ends = np.cumsum(sizes)
    hits = may_repeat(joined, sizes, length)
    if len(hits):
        owner = np.searchsorted(ends, hits, "right")
        cut = np.flatnonzero((hits[1:] - hits[:-1] > 1) | (owner[1:] != owner[:-1])) + 1
        first, last = hits[np.append(0, cut)], hits[np.append(cut - 1, len(hits) - 1)]
        hits = _repeated(joined, first, last - first + length, length)
    begins = ends - sizes
    cuts = np.searchsorted(hits, np.append(begins, len(joined)))
    return [hits[cuts[i]:cuts[i + 1]] - begins[i] for i in range(len(texts))]


def _repeated(joined: np.ndarray, begins: np.ndarray, sizes: np.ndarray, length: int) -> np.ndarray:
    """Where in ``joined`` a string of ``length`` symbols starts that starts elsewhere too, both inside the given stretches."""
    total = int(sizes.sum()) + len(sizes)
    ends = np.cumsum(sizes + 1) - 1
    origin = np.arange(total) + np.repeat(begins - (ends - sizes), sizes + 1)
    inside = np.ones(total, bool)
    inside[ends] = False
    if joined.dtype == np.uint8:
        symbols = np.zeros(total, np.uint16)
        there = joined[origin[inside]]
        present = np.zeros(256, bool)
        present[there] = True
        symbols[inside] = np.cumsum(present)[there]  # few bits a symbol, so that more of them fit in a key
    else:
        symbols = np.zeros(total, np.int64)
        symbols[inside] = np.unique(joined[origin[inside]], return_inverse=True)[1] + 1
    order = suffix_array(symbols, length)
    below = boundaries_below(symbols[order - 1], length)
    fits = (np.repeat(ends, sizes + 1) - np.arange(total) >= length)[order]
    same = fits[1:] & fits[:-1] & ~below[1:-1]
    flagged = np.zeros(total, bool)
    flagged[1:] |= same
    flagged[:-1] |= same
    return np.sort(origin[order[flagged]])
