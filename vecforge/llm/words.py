"""Vectorised words, 64-bit hashes and word shingles over Arrow text columns.

All positions are byte offsets into one buffer that holds the UTF-8 texts of a slice of rows;
a null text is an empty one. Words are runs of bytes other than 0x20 and 0x09-0x0D, so no
multi-byte character is ever cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20  # text bytes worked on at once; one longer text is taken whole

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

U64 = np.uint64
# Multipliers of the SplitMix64 finaliser, and odd bases of the polynomial hashes.
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
BYTE_BASE, WORD_BASE = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)


def mix(z: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    z = (z ^ (z >> U64(30))) * MIX_A
    z = (z ^ (z >> U64(27))) * MIX_B
    return z ^ (z >> U64(31))


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``begin[i], begin[i] + 1, ...`` (``size[i]`` of them) for every i."""
    upto = np.cumsum(size)
    return np.repeat(begin - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


def slices(column, limit: int = SLICE_BYTES):
    """``(first row, buffer, offsets)`` over runs of rows of about ``limit`` bytes at most."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], arr.type)
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    n = len(arr)
    if n == 0:
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = arr.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, whole[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def split_words(buf: np.ndarray, offs: np.ndarray):
    """``(starts, ends, bounds)``: words of row ``i`` are numbers ``bounds[i]`` to ``bounds[i + 1] - 1``."""
    full = ~SPACE[buf]
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1]
    last[:-1] &= ~full[1:]
    filled = offs[:-1] < offs[1:]
    at = offs[:-1][filled]
    first[at] = full[at]
    at = offs[1:][filled] - 1
    last[at] = full[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int):
    """``base ** i`` and its inverse for ``i < n``, modulo 2 ** 64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        m = 1 << n.bit_length()
        inverse = U64(pow(int(BYTE_BASE), -1, 1 << 64))
        for name, base in (("up", BYTE_BASE), ("down", inverse)):
            p = np.full(m, base, U64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes in every process."""
    up, down = _powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, U64)
    np.cumsum((buf.astype(U64) + U64(1)) * up[:len(buf)], dtype=U64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int = 5):
    """``(shingle hashes, bounds)``: all word windows; a shorter row has its whole sequence as one."""
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(made)])
    n = len(hashes)
    rolled = np.zeros(n, U64)
    if n >= width:
        acc = hashes[:n - width + 1].copy()
        for j in range(1, width):
            acc = acc * WORD_BASE + hashes[j:n - width + 1 + j]
        rolled[:n - width + 1] = acc
    within = np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], made)
    out = rolled[np.repeat(bounds[:-1], made) + within]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        acc = hashes[bounds[i]:bounds[i] + 1].copy()
        for j in range(1, counts[i]):
            acc = acc * WORD_BASE + hashes[bounds[i] + j:bounds[i] + j + 1]
        out[out_bounds[i]] = acc[0]
    return mix(out + U64(width)), out_bounds


def word_shingles(buf: np.ndarray, offs: np.ndarray, width: int = 5):
    """Shingle hashes of lower-cased (A-Z) texts, with bounds per row; repeats included."""
    low = LOWER[buf]
    starts, ends, bounds = split_words(low, offs)
    return shingles(hash_spans(low, starts, ends), bounds, width)
