"""Harmonic packing of tokenized documents into fixed-length sequences, independently in each task."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.llm.process import give_back, process_wide
from vecforge.llm.tokens import ByteBpe

CAPACITY = 1024
END_ID = 0
ROWS_IDS = 1 << 19  # ids whose pieces go out in one batch


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[int]:
    """``n`` as full sequences and falling powers of two: every length is a reciprocal of the capacity."""
    rest = n % capacity
    return [capacity] * (n // capacity) + [1 << k for k in range(capacity.bit_length() - 1, -1, -1) if rest >> k & 1]


class HarmonicBins:
    """Class j holds pieces of ``capacity / j`` ids; a bin of it is closed by its j-th piece.

    Since pieces have exactly the length of their class, closed bins are full. ``rest`` puts the
    pieces of bins that are still open together, longest first; what then fills no sequence is
    split so that each sequence's length is a power of two, which takes no padding.
    """

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list] = {}

    def number(self) -> int:
        """The id of the next sequence."""
        self.next_id += 1
        return self.next_id - 1

    def _close(self, pieces):
        number, at = self.number(), 0
        for piece in pieces:
            yield (*piece, number, at)
            at += piece[2]

    def add(self, piece: tuple):
        """``piece[2]`` is its length; yields the pieces of a bin that it closes, with sequence and offset."""
        of = self.capacity // piece[2]
        held = self.open.setdefault(of, [])
        held.append(piece)
        if len(held) == of:
            del self.open[of]
            yield from self._close(held)

    def rest(self):
        left = [p for of in sorted(self.open) for p in self.open[of]]
        self.open.clear()
        bins, now, held = [], [], 0
        for piece in left:  # falling powers of two: a sequence is always filled exactly
            now.append(piece)
            held += piece[2]
            if held == self.capacity:
                bins.append(now)
                now, held = [], 0
        part, need = [], 1 << (held.bit_length() - 1) if held else 0
        for piece in now:
            part.append(piece)
            if sum(p[2] for p in part) == need:
                bins.append(part)
                held -= need
                part, need = [], 1 << (held.bit_length() - 1) if held else 0
        for one in bins:
            yield from self._close(one)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``capacity`` ids (a power of two).

    ``tokenizer`` is the path of a byte-level BPE file for the `tokenizers` library, readable by
    every executor; ids are the library's with ``add_special_tokens=False`` (strings of special
    tokens in a text are those tokens). A document is the ids of its whole text and then id 0, cut by
    :func:`cut_lengths`. Columns: the id, ``start``, ``length``, ``ids_crc32`` (of little-endian
    unsigned 32-bit ids), ``doc_tokens``, ``sequence_id``, ``offset``, and ``ids`` if asked for.

    There is no shuffle: each task fills bins of its own, and holds only the open ones, of at most
    one sequence a class. Sequence ids are numbered within a partition, from its number times
    2 ** 33. No sequence needs padding: it is full, or a power of two long.

    A null or empty text is one piece, id 0; a null id and repeated rows are packed as they are;
    an empty table gives no rows; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + (", ids array<int>" if with_ids else ""))
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        model = process_wide(f"byte-bpe:{tokenizer}", lambda: ByteBpe(tokenizer))
        bins = HarmonicBins(capacity, TaskContext.get().partitionId() << 33)
        kept_type = None

        def rows_out(rows):
            doc, start, length, crc, total, ids, number, at = zip(*rows)
            columns = [pa.array(doc, kept_type)] + [pa.array(x, pa.int64()) for x in (start, length, crc, total, number, at)]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names + (["ids"] if with_ids else []))

        for batch in batches:
            kept_type = batch.column(0).type
            rows, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.append(model.ids(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                raw, total, at = memoryview(own).cast("B"), len(own), 0
                for n in cut_lengths(total, capacity):
                    piece = (doc, at, n, zlib.crc32(raw[4 * at:4 * (at + n)]), total,
                             own[at:at + n].tolist() if with_ids else None)
                    if n == capacity:  # a bin of its own
                        rows.append((*piece, bins.number(), 0))
                    else:
                        rows.extend(bins.add(piece))
                    at += n
                held += total
                if held > ROWS_IDS and rows:
                    yield rows_out(rows)
                    rows, held = [], 0
            if rows:
                yield rows_out(rows)
        rows = list(bins.rest())
        if rows:
            yield rows_out(rows)
        give_back()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
