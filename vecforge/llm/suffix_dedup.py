"""Exact removal of repeated strings: anchored pieces, suffix arrays, interval expansion.

Strings are of bytes, or of words (as 64-bit hashes, whatever space stands between them); both are
found in one pass. Every string of ``length`` symbols contains the least of its grams (by a mixed hash;
ties to the left): its anchor. Equal strings have equal anchors at equal places, so each maximal run of
starts with one anchor, a *piece* (its starts, and ``length - 1`` symbols more), needs to be compared
only with pieces of the same anchor. Pieces with an anchor that is met twice are dealt out by
anchor, and a suffix array and a Burrows-Wheeler transform over each batch of them tell which
starts repeat (:mod:`vecforge.llm.suffixes`). Where all pieces of an anchor are equal, they repeat whole.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.llm.process import give_back
from vecforge.llm.suffixes import gram_hashes, repeated_starts
from vecforge.llm.words import U64, hash_spans, mix, ragged, slices, split_words
from vecforge.session import scratch_path

CHUNK = 1 << 20              # starts worked on at once
PLACE_BITS = U64(22)         # of a packed gram: its place in a chunk; the rest is its hash
BATCH_BYTES = 1 << 20        # piece bytes in one suffix array, unless one anchor has more
HEAVY_BYTES = 16 << 20       # an anchor with more is cut again by other anchors
MAX_CUTS = 6
CODE = 8                     # bytes of a word, where words are the symbols
RUN_BYTES = 1 << 17          # text bytes whose pieces are found at once: arrays of them fit a core's cache
RUN_ROWS = 1 << 14           # pieces sent on at once
SCRAMBLED = mix(np.arange(256, dtype=U64))


@dataclass(frozen=True)
class Strings:
    """Strings of ``length`` symbols that are looked for; a symbol has ``width`` bytes (1: a byte, ``CODE``: a word)."""

    width: int
    length: int

    @property
    def gram(self) -> int:
        return min(64 if self.width == 1 else 8, 1 << (self.length.bit_length() - 1))

    def symbols(self, raw: np.ndarray, coded: bool) -> np.ndarray:
        """Symbols of a text's bytes, or of a piece that holds them as they are."""
        return self.of_texts(raw, np.array([0, len(raw)], np.int64), coded)[0]

    def of_texts(self, raw: np.ndarray, offs: np.ndarray, coded: bool) -> tuple[np.ndarray, np.ndarray]:
        """``(symbols, bounds)`` of texts end to end: text ``i`` has those from ``bounds[i]`` to ``bounds[i + 1]``."""
        if self.width == 1:
            return raw, offs
        if coded:
            return np.frombuffer(raw.tobytes(), "<u8"), offs // CODE
        starts, ends, bounds = split_words(raw, offs)
        return hash_spans(raw, starts, ends), bounds


def pieces(symbols: np.ndarray, bounds: np.ndarray, strings: Strings, seed: int):
    """``(first start, last start, anchor)`` of every run of starts with one anchor, in order, of texts end to end.

    Text ``i`` is from ``bounds[i]`` to ``bounds[i + 1]``; no string goes beyond its text.
    """
    gram, length = strings.gram, strings.length
    starts = ragged(bounds[:-1], np.maximum(np.diff(bounds) - length + 1, 0))
    for begin in range(0, len(symbols) - length + 1, CHUNK):
        inside = starts[np.searchsorted(starts, begin):np.searchsorted(starts, begin + CHUNK)]
        if not len(inside):
            continue
        h = gram_hashes(symbols[begin:begin + CHUNK + length - 1], gram, seed)
        least, width, span = (h >> PLACE_BITS << PLACE_BITS) | np.arange(len(h), dtype=U64), 1, length - gram + 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[:-(span - width)], least[span - width:])
        place = (least[inside - begin] & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        yield inside[first], inside[np.append(first[1:], len(place)) - 1], h[place[first]].view(np.int64)


RUN = "width int, anchor long, content binary, key binary, n long, lo long, hi long"


def _runs(texts: DataFrame, sought: list[Strings], seed: int, coded: bool) -> DataFrame:
    """A ``RUN`` row for each piece of ``(key, n, text)``; ``content`` is a 128-bit hash of its symbols.

    A key that a task meets again is told twice at most: twice is enough to repeat.
    """
    names = [x.split()[0] for x in RUN.split(",")]

    def rows(batch, held):
        width, anchor, content, row, lo, hi = (np.concatenate(x) for x in zip(*held))
        at = pa.array(row, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(width), pa.array(anchor), _binary(content), batch.column(0).take(at),
                                           batch.column(1).take(at), pa.array(lo), pa.array(hi)], names)

    def run(batches):
        told: dict[bytes, int] = {}
        for batch in batches:
            fresh = []
            for key in batch.column(0).to_pylist():
                told[key] = told.get(key, 0) + 1
                fresh.append(told[key] <= 2)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            held = []
            for first, buf, offs in slices(batch.column(2), RUN_BYTES):  # many texts at once
                for strings in sought:
                    symbols, bounds = strings.of_texts(buf, offs, coded)
                    for lo, hi, anchor in pieces(symbols, bounds, strings, seed):
                        base = int(lo[0])  # contents are hashed within the chunk
                        part = symbols[base:int(hi[-1]) + strings.length]
                        begin, end = lo - base, hi - base + strings.length
                        other = SCRAMBLED[part] if strings.width == 1 else mix(part)
                        content = np.stack([hash_spans(part, begin, end), hash_spans(other, begin, end)], axis=1)
                        row = np.searchsorted(bounds, lo, "right") - 1
                        held.append((np.full(len(lo), strings.width, np.int32), anchor, content, first + row, lo - bounds[row], hi - bounds[row]))
                if sum(len(x[0]) for x in held) > RUN_ROWS:
                    yield rows(batch, held)
                    held = []
            if held:
                yield rows(batch, held)
        give_back()

    return texts.select("key", "n", "text").mapInArrow(run, RUN)


def _binary(values: np.ndarray) -> pa.Array:
    """Rows of a matrix of 64-bit numbers as binary values."""
    size = values.shape[1] * 8
    data = np.ascontiguousarray(values.astype("<u8"))
    return pa.Array.from_buffers(pa.binary(), len(values), [
        None, pa.py_buffer((np.arange(len(values) + 1) * size).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _once(texts: DataFrame, least: int) -> DataFrame:
    """``(key, text)`` of texts of ``least`` bytes or more, each key once a task."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keep = []
            for key, size in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                keep.append(size >= least and key not in seen)
                seen.add(key)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["key", "text"])

    return (texts.select("key", "text", F.length("text").alias("size"))
            .mapInArrow(run, "key binary, text binary"))


def _cut(texts: DataFrame, wanted: DataFrame, sought: list[Strings], coded: bool) -> DataFrame:
    """``(width, anchor, key, n, text)``: the symbols of the wanted pieces, keyed by content."""
    by_text = wanted.groupBy("key").agg(F.collect_list(F.struct("width", "anchor", "content", "n", "lo", "hi")).alias("cuts"))
    # a text of so many words has a byte each and one between them, at least
    least = min(s.length if s.width == 1 or coded else 2 * s.length - 1 for s in sought)
    found = _once(texts, least).join(by_text, "key").dropDuplicates(["key"]).select("text", "cuts")
    of_width = {s.width: s for s in sought}

    def run(batches):
        for batch in batches:
            rows, held = [], 0
            for text, cuts in zip(batch.column(0), batch.column(1)):
                raw, symbols = np.frombuffer(text.as_buffer(), np.uint8), {}
                for c in cuts.as_py():
                    strings = of_width[c["width"]]
                    if strings.width not in symbols:
                        symbols[strings.width] = strings.symbols(raw, coded)
                    part = symbols[strings.width][c["lo"]:c["hi"] + strings.length]
                    rows.append((strings.width, c["anchor"], c["content"], c["n"], part.tobytes()))
                    held += len(rows[-1][4])
                    if held > 4 << 20:
                        yield _piece_batch(rows)
                        rows, held = [], 0
            if rows:
                yield _piece_batch(rows)
        give_back()

    return found.mapInArrow(run, "width int, anchor long, key binary, n long, text binary")


def _piece_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
        zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()))], ["width", "anchor", "key", "n", "text"])


SPANS = "key binary, spans array<struct<lo:bigint,hi:bigint>>"


def _spans_of(starts: np.ndarray, length: int) -> list[dict]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    first, last = np.append(starts[:1], starts[cut]), np.append(starts[cut - 1], starts[-1:])
    return [{"lo": int(a), "hi": int(b) + length} for a, b in zip(first, last)]


def _expand(cut: DataFrame, sought: list[Strings]) -> DataFrame:
    """Repeated spans of each piece, by a suffix array and interval expansion over whole anchors."""
    dealt = cut.repartition("width", "anchor").sortWithinPartitions("width", "anchor", "key")
    of_width = {s.width: s for s in sought}

    def flush(rows):
        """A piece met n times is in the batch once: all its starts repeat then, by its copies."""
        strings = of_width[rows[0][0]]
        starts = repeated_starts([text for *_, text in rows], strings.length, strings.width)
        rows_out = []
        for (_, _, key, n, text), found in zip(rows, starts):
            if n > 1:
                found = np.arange(len(text) // strings.width - strings.length + 1)
            if len(found):
                rows_out.append((key, _spans_of(found, strings.length)))
        if rows_out:
            key, spans = zip(*rows_out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.binary()), pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))], ["key", "spans"])

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (row[0] != rows[-1][0] or held > BATCH_BYTES and row[1] != rows[-1][1]):
                    yield from flush(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[4])
        if rows:
            yield from flush(rows)
        give_back()

    return dealt.mapInArrow(run, SPANS)


def repeated_spans(texts: DataFrame, sought: list[Strings], seed: int = 0, coded: bool = False) -> DataFrame:
    """``(width, key, lo, hi)``: spans, in symbols, of each distinct text covered by strings that start elsewhere too.

    ``texts`` has ``(key binary, n long, text binary)``: a hash that names the text, how often the
    row counts, the bytes (``coded``: the symbols). Spans of one text may overlap.

    Only hashes are shuffled until pieces with a unique anchor are gone. Where all pieces of an anchor
    are equal, the anchor's count tells that they repeat; of the others one copy of each distinct piece
    travels. An anchor with over ``HEAVY_BYTES`` of distinct pieces, such as one in a large family of
    near copies, is not given to one task: its pieces are cut again, by other anchors, where equal parts
    fall together.
    """
    spark = texts.sparkSession

    def written(frame, name):
        path = scratch_path(spark, f"suffix-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    runs = written(_runs(texts, sought, seed, coded), "runs")
    named = F.xxhash64("content")
    # written first: both sides of the join are then plain shuffles, of which Spark can split a hot anchor's
    often = written(runs.groupBy("width", "anchor").agg(F.sum("n").alias("met"), F.min(named).alias("least"), F.max(named).alias("most"))
                    .filter("met > 1").select("width", "anchor", (F.col("least") == F.col("most")).alias("lone")), "often")
    shared = written(runs.join(often, ["width", "anchor"]), "shared")
    length = F.when(F.col("width") == 1, _length(sought, 1)).otherwise(_length(sought, CODE))
    whole = shared.filter("lone").select("width", "key", "lo", (F.col("hi") + length).alias("hi"))
    shared = shared.filter("NOT lone")
    distinct = (shared.groupBy("width", "anchor", "content")
                .agg(F.sum("n").alias("n"), F.min(F.struct("key", "lo", "hi")).alias("at"))
                .select("width", "anchor", "content", "n", "at.key", "at.lo", "at.hi"))
    cut = written(_cut(texts, distinct, sought, coded), "cut")
    heavy = (cut.groupBy("width", "anchor").agg(F.sum(F.length("text").cast("long")).alias("held"))
             .filter(F.col("held") > HEAVY_BYTES).select("width", "anchor"))
    heavy = written(heavy, "heavy")
    exploded = [F.explode("spans").alias("s")]
    if seed + 1 < MAX_CUTS and heavy.head(1):
        light = _expand(cut.join(heavy, ["width", "anchor"], "left_anti"), sought)
        spans = light.select("key", *exploded).select("key", "s.lo", "s.hi")
        again = cut.join(heavy, ["width", "anchor"], "left_semi")
        for strings in sought:
            spans = spans.unionByName(repeated_spans(again.filter(F.col("width") == strings.width), [strings], seed + 1, True)
                                      .select("key", "lo", "hi"))
    else:
        spans = _expand(cut, sought).select("key", *exploded).select("key", "s.lo", "s.hi")
    spans = written(spans.select(F.col("key").alias("content"), F.col("lo").alias("from"), F.col("hi").alias("to")), "spans")
    found = (shared.join(spans, "content")
             .select("width", "key", (F.col("lo") + F.col("from")).alias("lo"), (F.col("lo") + F.col("to")).alias("hi")))
    return found.unionByName(whole).distinct()


def _length(sought: list[Strings], width: int) -> int:
    return next((s.length for s in sought if s.width == width), 0)


def _merged(spans) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _in_bytes(text, spans) -> list[dict]:
    """Byte spans, from first word to last, of spans in words."""
    if not spans:
        return []
    raw = np.frombuffer(text.as_buffer(), np.uint8)
    starts, ends, _ = split_words(raw, np.array([0, len(raw)], np.int64))
    return [{"lo": int(starts[s["lo"]]), "hi": int(ends[s["hi"] - 1])} for s in spans]


def _keyed(docs: DataFrame, text_col: str):
    """``(key, n, text)`` of every row, and the expression of its key."""
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.unhex(F.md5(raw))
    return docs.select(key.alias("key"), F.lit(1).cast("long").alias("n"), raw.alias("text")), key


def free_name(columns, name: str) -> str:
    """``name``, or with underscores before it, so that no column has it (case does not tell columns apart)."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name = "_" + name
    return name


def with_spans(docs: DataFrame, text_col: str, length: int, words: int | None = None, name: str = "spans",
               word_name: str = "word_spans") -> DataFrame:
    """``docs`` with arrays of its repeated spans, unordered: of bytes, and of words if asked for (else null).

    A null text is empty; texts too short for a string have no spans; rows with equal texts (repeated rows
    too) have the same. Null where nothing repeats. An empty table gives no rows, and columns of ``docs``
    called ``name`` or ``word_name`` give way to the result.
    """
    texts, key = _keyed(docs, text_col)
    sought = [Strings(1, length)] + ([Strings(CODE, words)] if words else [])
    found = repeated_spans(texts, sought)
    kept = docs.drop(name, word_name)
    key_name = free_name([*kept.columns, name.lower(), word_name.lower()], "key")

    def spans(width, alias):
        return F.collect_list(F.when(F.col("width") == width, F.struct("lo", "hi"))).alias(alias)

    by_text = found.groupBy(F.col("key").alias(key_name)).agg(spans(1, name), spans(CODE, word_name))
    return kept.withColumn(key_name, key).join(by_text, key_name, "left").drop(key_name)


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                   words: int | None = None) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` for every row (see :func:`with_spans`).

    With ``words`` also ``n_passages, n_passage_words``: the passages of that many words or more, whatever
    space stands between them, that also start elsewhere, and their words. They count also where they are
    too short in bytes to be removed.
    """
    marked = with_spans(docs.select(F.col(id_col), F.col(text_col)), text_col, length, words).select(id_col, text_col, "spans", "word_spans")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + (["n_passages", "n_passage_words"] if words else [])

    def run(batches):
        for batch in batches:
            out = [[] for _ in names]
            for text, spans, in_words in zip(batch.column(1), batch.column(2), batch.column(3)):
                raw = (text.as_py() or "").encode()
                gone = _merged(spans.as_py())
                at, kept = 0, hashlib.sha256()
                for lo, hi in gone:
                    kept.update(raw[at:lo])
                    at = hi
                kept.update(raw[at:])
                passages = _merged(in_words.as_py())
                for column, value in zip(out, (len(raw), sum(b - a for a, b in gone), len(gone), kept.hexdigest(),
                                               len(passages), sum(b - a for a, b in passages))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string() if n == "kept_sha256" else pa.int64()) for n, c in zip(names, out))], [id_col, *names])
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join(f"{n} {'string' if n == 'kept_sha256' else 'long'}" for n in names)
    return marked.mapInArrow(run, f"`{id_col}` {kind}, {schema}")


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = 400, words: int | None = None) -> DataFrame:
    """``docs`` with its repeated spans cut out of ``text_col``: strings of ``length`` bytes or more.

    With ``words``, passages of that many words or more go too, however few bytes they have and whatever
    space stands between them, from their first word to the end of their last.
    A span that begins or ends inside a UTF-8 character is narrowed to whole characters, so the
    text stays valid. A null text stays null, and an empty one empty. Rows with equal texts, repeated
    rows too, repeat each other and lose the same spans; an empty table gives no rows; columns of any
    name are carried as they are.
    """
    gone_name, words_name = free_name(docs.columns, "gone"), free_name(docs.columns, "gone_words")
    marked = with_spans(docs, text_col, length, words, gone_name, words_name)
    columns = docs.columns
    schema = docs.select(*columns).schema

    def run(batches):
        for batch in batches:
            texts = []
            at_text, *at_gone = (batch.schema.get_field_index(c) for c in (text_col, gone_name, words_name))
            for text, spans, in_words in zip(batch.column(at_text), *map(batch.column, at_gone)):
                gone = _merged([*(spans.as_py() or ()), *_in_bytes(text, in_words.as_py())])
                if not gone:
                    texts.append(text.as_py())
                    continue
                raw, kept, at = text.as_py().encode(), [], 0
                for lo, hi in gone:
                    while lo < hi and raw[lo] & 0xC0 == 0x80:
                        lo += 1
                    while hi > lo and hi < len(raw) and raw[hi] & 0xC0 == 0x80:
                        hi -= 1
                    kept.append(raw[at:lo])
                    at = hi
                texts.append(b"".join([*kept, raw[at:]]).decode())
            arrays = [pa.array(texts, pa.string()) if c == text_col else batch.column(batch.schema.get_field_index(c))
                      for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return marked.select(*columns, gone_name, words_name).mapInArrow(run, schema)
