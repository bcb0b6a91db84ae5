"""SentencePiece encoding by suffix-array matching, and decoding.

A batch's distinct chunks (a run of word marks and what follows up to the next) are laid end to
end and indexed by a suffix array. Each piece of the vocabulary is binary-searched in it, and its
range of occurrences gives the edges of the lattice, which are sorted by position. Relaxing goes by
what the model is: a BPE model merges the best edge over two neighbouring symbols until none is
left, so the ids are those of the `sentencepiece` library. (A shortest path over the scores, which
a unigram model takes, gives other ids on a BPE vocabulary.)
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.llm.pool import ChunkPool
from vecforge.llm.process import process_wide
from vecforge.llm.suffixes import suffix_array
from vecforge.llm.words import hash_spans, ragged

MARK = "▁".encode()  # stands for a space
PACK = 7                  # symbols of 9 bits in one sort key
LONG = 256                # symbols from which a stretch is merged with a heap
NONE = np.int64(1) << 62
TEXT_BYTES = 4 << 20      # text bytes encoded at once


def _packed(symbols: np.ndarray) -> np.ndarray:
    """The ``PACK`` symbols from every place on as one number; past the end are zeros."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(PACK, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(PACK):
        key = (key << 9) | padded[j:n + j]
    return key


class PieceModel:
    """Vocabulary of a BPE model with byte fallback; identity normalisation, a word mark before the text."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        normal = [i for i in range(count) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
                                                  or model.is_unused(i))]
        self.piece_ids = np.array(normal, np.int64)
        self.pieces = [model.id_to_piece(i).encode() for i in normal]
        scores = np.array([model.get_score(i) for i in normal])
        self.rank = np.searchsorted(np.unique(-scores), -scores).astype(np.int64)  # 0 is the best; equal scores share one
        self.longest = max(map(len, self.pieces))
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        self.bytes_of = [b""] * count
        for i, piece in zip(normal, self.pieces):
            self.bytes_of[i] = piece.replace(MARK, b" ")
        for b, i in enumerate(self.byte_id):
            self.bytes_of[i] = bytes([b])
        sizes = np.array([len(p) for p in self.pieces])
        self.steps = -(-sizes // PACK)
        width = int(self.steps.max())
        # keys of the least and the greatest continuation of each piece, PACK symbols at a time
        self.least, self.most = np.zeros((len(sizes), width), np.int64), np.zeros((len(sizes), width), np.int64)
        for i, piece in enumerate(self.pieces):
            for j in range(self.steps[i]):
                part = piece[PACK * j:PACK * (j + 1)]
                key = 0
                for b in part:
                    key = key << 9 | (b + 1)
                free = 9 * (PACK - len(part))
                self.least[i, j], self.most[i, j] = key << free, (key << free) | ((1 << free) - 1)
        self.sizes = sizes
        self.pool = ChunkPool()

    # -- lattice --------------------------------------------------------------------------

    def edges(self, symbols: np.ndarray):
        """``(place, size, piece)`` of all occurrences of all pieces, sorted by place, then size."""
        order = suffix_array(symbols, self.longest)
        key = np.concatenate([_packed(symbols), np.zeros(self.longest + PACK, np.int64)])
        low, high = np.zeros(len(self.sizes), np.int64), np.full(len(self.sizes), len(order))
        for j in range(int(self.steps.max())):
            on = np.flatnonzero((self.steps > j) & (low < high))
            for bound, ends in ((self.least[on, j], low), (self.most[on, j] + 1, high)):
                a, b = low[on].copy(), high[on].copy()
                while (open_ := a < b).any():  # the first suffix of the range that is not below the bound
                    mid = (a + b) // 2
                    below = key[order[np.minimum(mid, len(order) - 1)] + PACK * j] < bound
                    a, b = np.where(open_ & below, mid + 1, a), np.where(open_ & ~below, mid, b)
                if ends is low:
                    new_low = a
                else:
                    high[on] = a
            low[on] = new_low
        found = np.maximum(high - low, 0)
        place = order[ragged(low, found)]
        piece = np.repeat(np.arange(len(found)), found)
        by = np.argsort(place * 64 + self.sizes[piece], kind="stable")
        return place[by], self.sizes[piece[by]], piece[by]

    def encode_chunks(self, chunks: list[bytes]):
        """``(flat ids, sizes)`` of the chunks, each on its own."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        joined = np.frombuffer(b"\x00".join(chunks) + b"\x00", np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        symbols = joined.astype(np.uint16) + np.uint16(1)
        symbols[ends] = 0
        place, size, piece = self.edges(symbols)
        edge_key = place * 64 + size

        def edge(start, end):
            """Number of the edge from start to end, or -1."""
            want = start * 64 + (end - start)
            at = np.minimum(np.searchsorted(edge_key, want), max(0, len(edge_key) - 1))
            ok = (end - start < 64) & (edge_key[at] == want) if len(edge_key) else np.zeros(len(want), bool)
            return np.where(ok, at, -1)

        # characters are the first symbols; a border that no edge crosses parts independent stretches
        is_char = (joined & 0xC0) != 0x80
        start = np.flatnonzero(is_char)
        end = np.append(start[1:], len(joined))
        crossed = np.zeros(len(joined) + 1, np.int64)
        np.add.at(crossed, place + 1, 1)
        np.add.at(crossed, place + size, -1)
        crossed = np.cumsum(crossed) > 0
        keep = symbols[start] > 0
        start, end = start[keep], end[keep]
        stretch = np.cumsum(~crossed[start]) - 1
        start, end = self._merge(start, end, stretch, edge, piece)
        # an edge gives its piece; a character that none covers goes by its bytes
        at = edge(start, end)
        n_ids = np.where(at >= 0, 1, end - start)
        flat = np.zeros(int(n_ids.sum()), np.uint32)
        upto = np.cumsum(n_ids)
        known = at >= 0
        flat[(upto - n_ids)[known]] = self.piece_ids[piece[at[known]]]
        bare = ~known
        flat[ragged((upto - n_ids)[bare], n_ids[bare])] = self.byte_id[joined[ragged(start[bare], n_ids[bare])]]
        owner = np.searchsorted(ends, start)
        return flat, np.bincount(owner, n_ids, len(chunks)).astype(np.int64)

    def _merge(self, start, end, stretch, edge, piece):
        """Merge the best edge of every stretch (the leftmost of equal ones) until none has any."""
        count = np.bincount(stretch) if len(stretch) else np.zeros(0, np.int64)
        done_start, done_end = [], []
        large = count[stretch] > LONG
        for s in np.unique(stretch[large]):
            own = stretch == s
            a, b = self._merge_long(start[own], end[own], edge, piece)
            done_start.append(a)
            done_end.append(b)
        start, end, stretch = start[~large], end[~large], stretch[~large]

        def cost(i, j):
            at = edge(start[i], end[j])
            return np.where(at >= 0, self.rank[piece[at]] if len(piece) else 0, NONE)

        # cost of merging each symbol with the next one of its stretch
        n = len(start)
        pair = np.full(n, NONE)
        inner = np.flatnonzero(stretch[:-1] == stretch[1:]) if n else np.zeros(0, np.int64)
        pair[inner] = cost(inner, inner + 1)
        while len(start):
            first = np.flatnonzero(np.append(True, stretch[1:] != stretch[:-1]))
            best = np.minimum.reduceat(pair, first)
            live = np.repeat(best < NONE, np.diff(np.append(first, len(start))))
            done_start.append(start[~live])
            done_end.append(end[~live])
            start, end, stretch, pair = start[live], end[live], stretch[live], pair[live]
            if not len(start):
                break
            first = np.flatnonzero(np.append(True, stretch[1:] != stretch[:-1]))
            best = np.minimum.reduceat(pair, first)
            hits = np.flatnonzero(pair == np.repeat(best, np.diff(np.append(first, len(start)))))
            left = hits[np.append(True, stretch[hits[1:]] != stretch[hits[:-1]])]
            end[left] = end[left + 1]
            keep = np.ones(len(start), bool)
            keep[left + 1] = False
            new_place = np.cumsum(keep) - 1
            start, end, stretch, pair = start[keep], end[keep], stretch[keep], pair[keep]
            left = new_place[left]
            for i in (left, left[left > 0] - 1):  # the pairs that the new symbol is in
                has = (i + 1 < len(start)) & (stretch[np.minimum(i + 1, len(start) - 1)] == stretch[i])
                pair[i[~has]] = NONE
                pair[i[has]] = cost(i[has], i[has] + 1)
        start, end = np.concatenate([start, *done_start]), np.concatenate([end, *done_end])
        order = np.argsort(start, kind="stable")
        return start[order], end[order]

    def _merge_long(self, start, end, edge, piece):
        """The same for one long stretch, with a heap over its pairs."""
        start, end = start.copy(), end.copy()
        n = len(start)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        alive = np.ones(n, bool)

        def costs(i):
            at = edge(start[i], end[after[i]])
            return [(int(self.rank[piece[a]]), int(k), int(end[after[k]])) for a, k in zip(at, i) if a >= 0]

        heap = costs(np.arange(n - 1))
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], alive[j], after[i] = end[j], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            around = [k for k in (before[i], i) if k >= 0 and after[k] < n]
            for found in costs(np.array(around, np.int64)):
                heapq.heappush(heap, found)
        return start[alive], end[alive]

    # -- texts ----------------------------------------------------------------------------

    def encode(self, texts: list[bytes]):
        """``(ids, bounds)`` of the texts; an empty text has no ids."""
        marked = [MARK + t.replace(b" ", MARK) if t else b"" for t in texts]
        offs = np.append([0], np.cumsum([len(t) for t in marked])).astype(np.int64)
        raw = b"".join(marked)
        buf = np.frombuffer(raw, np.uint8)
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        mark = np.zeros(len(buf) + 3, bool)
        m = (buf[:-2] == MARK[0]) & (buf[1:-1] == MARK[1]) & (buf[2:] == MARK[2])
        mark[3:3 + len(m)] = m  # moved by 3: mark[i] tells of the place i - 3
        starts = mark[3:3 + len(buf)] & ~mark[:len(buf)]
        starts[offs[:-1][offs[:-1] < offs[1:]]] = True
        s = np.flatnonzero(starts)
        e = np.append(s[1:], len(buf))
        ids, upto = self.pool.ids_of(hash_spans(buf, s, e), lambda at: self.encode_chunks(
            [raw[a:b] for a, b in zip(s[at].tolist(), e[at].tolist())]))
        return ids, upto[np.searchsorted(s, offs)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text's bytes: word marks are spaces, and the one before the text is dropped."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))[1:]


def _groups(column, limit: int = TEXT_BYTES):
    """Texts of a column as bytes (null: empty), in runs of about ``limit`` bytes."""
    held, size, first = [], 0, 0
    for i, x in enumerate(column):
        held.append((x.as_py() or "").encode())
        size += len(held[-1])
        if size >= limit:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids`` for every row: the piece ids of its whole text, by the SentencePiece file ``model``.

    Narrow: texts are encoded where they are read, and a worker encodes each distinct chunk once. A
    null or empty text has no ids, a null id and repeated rows are encoded as they are, an empty
    table gives no rows, and other columns are not read. A text without spaces is one chunk, of any length.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        pieces = process_wide(f"pieces:{model}", lambda: PieceModel(model))
        for batch in batches:
            for first, texts in _groups(batch.column(1)):
                ids, bounds = pieces.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    [id_col, "ids"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``encoded`` with the text of its ids; bytes that are not UTF-8 become U+FFFD, a null stays null."""
    kept = [c for c in encoded.columns if c != text_col]
    schema = encoded.select(*kept).schema.add(text_col, "string")

    def run(batches):
        pieces = process_wide(f"pieces:{model}", lambda: PieceModel(model))
        for batch in batches:
            texts = [None if x.as_py() is None else pieces.decode(np.array(x.as_py(), np.int64)).decode("utf-8", "replace")
                     for x in batch.column(batch.schema.get_field_index(ids_col))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(texts, pa.string())],
                [*kept, text_col])

    return encoded.select(*kept).mapInArrow(run, schema)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_ids, n_byte_ids, ids_crc32`` (little-endian unsigned 32-bit ids) ``, decoded_sha1, exact``.

    ``exact`` tells whether decoding gives the text back; it must, but for texts that hold a word
    mark, which decodes to a space. Conventions are those of :func:`encode`.
    """
    import hashlib

    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_ids", "n_byte_ids", "ids_crc32", "decoded_sha1", "exact"]

    def run(batches):
        pieces = process_wide(f"pieces:{model}", lambda: PieceModel(model))
        bare = np.zeros(len(pieces.bytes_of), bool)
        bare[pieces.byte_id] = True
        for batch in batches:
            for first, texts in _groups(batch.column(1)):
                ids, bounds = pieces.encode(texts)
                out = [[] for _ in names[1:]]
                for i, text in enumerate(texts):
                    own = ids[bounds[i]:bounds[i + 1]]
                    back = pieces.decode(own)
                    for column, value in zip(out, (len(own), int(bare[own].sum()), zlib.crc32(own.astype("<u4").tobytes()),
                                                   hashlib.sha1(back).hexdigest(), back == text)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), *(pa.array(c, pa.int64()) for c in out[:3]),
                     pa.array(out[3], pa.string()), pa.array(out[4], pa.bool_())], names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, n_ids long, n_byte_ids long, ids_crc32 long, decoded_sha1 string, exact boolean")
