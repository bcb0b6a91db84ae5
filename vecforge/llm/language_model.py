"""A hierarchical Pitman-Yor language model over a corpus, and texts scored by it.

Each task turns the documents that it reads into blocks of bounded size and, for every block, lists
its distinct words with their contexts, training counts and the documents that hold them, dealt out
by ranges of the words' hashes. All that a range needs then meets in one task: a word's seats in
every restaurant are sampled there (:mod:`vecforge.llm.seating`), as words share only the
restaurants' totals; and with its probabilities known, so is what the word adds to the score of each
document. Texts are read once and never shuffled.

A context is the last word, each with a restaurant of its own; its parent is the word's class (of its last
three bytes), whose parent is the root. There are as many contexts as distinct words, so no task and not the
driver sees them all: after each pass a range tells the tables of its contexts to groups of contexts, by ranges
of their ids, and is told those of the whole corpus. Only the classes' and the root's totals travel with every task.
"""

from __future__ import annotations

import collections
import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecforge.llm.seating import KIND_BITS, LEVELS, Contexts, Rooms, Seating, Totals
from vecforge.llm.words import LOWER, U64, hash_spans, slices, split_words
from vecforge.session import remove_path, scratch_path, shuffles_removed

END = np.uint64(0x5EED0FE4D0F7E875)  # stands for the end of a text; no word hashes to it but by chance
BLOCK_BYTES = 8 << 20                # of text in a block
BLOCK_DOCS = 1 << 16
SLICE_BYTES = 1 << 20                # of text hashed at once
RANGE_BYTES = 16 << 20               # of text for which there is one more range of words
SALT_BLOCKS = 256                    # blocks of which a range's rows meet in one task
PASSES, PASS_SWEEPS = 2, 2           # passes that settle the totals, and sweeps in each
COMMON, COMMON_BYTES = 1 << 16, 32 << 20  # contexts that lists of a block write in short, and text in which they are looked for
GROUP_RANGES = 8                     # ranges of words for which there is one more group of contexts
ROOM_BYTES = 64 << 10                # of text for which a class of words has one more of :func:`rooms_for`
LEAST_WORDS, MOST_WORDS = 64, 4096   # of these, for a class
SAMPLES = 4                          # passes of one sweep after these, each a sample with totals of its own
WORDS_AT_ONCE = 200_000
ROUNDS = 4                           # in which ranges are scored, so that not all lists are shuffled at once


def rooms_for(text_bytes: int) -> Rooms:
    """Few enough rooms to be kept in arrays, by samplers that :func:`score_corpus` is compared with; it has none."""
    words = LEAST_WORDS
    while words < MOST_WORDS and words * ROOM_BYTES < text_bytes:
        words *= 2
    return Rooms(words=words)


def tokens(buf: np.ndarray, offs: np.ndarray, rooms: Rooms | Contexts):
    """``(hash, leaf context, bounds)`` of all tokens: a text's lower-cased words, then its end."""
    low = LOWER[buf]
    starts, ends, bounds = split_words(low, offs)
    words = hash_spans(low, starts, ends)
    kind = hash_spans(low, np.maximum(starts, ends - 3), ends) % U64(rooms.classes) + U64(1)
    room = rooms.leaf_of(kind, words)
    h = np.insert(words, bounds[1:], END)
    room = np.insert(room, bounds[1:], 0)  # what follows an end is a text's beginning, which has no last word
    leaf = np.concatenate([[0], room[:-1]])[:len(room)]
    return h, leaf, bounds + np.arange(len(bounds))


def _summed(h, leaf, n):
    order = np.lexsort((leaf, h))
    h, leaf, n = h[order], leaf[order], n[order]
    if not len(h):
        return h, leaf, n
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (leaf[1:] != leaf[:-1])))
    return h[first], leaf[first], np.add.reduceat(n, first)


# Arrays travel as bytes: ids of contexts ascending, in lists of a block without the `common` ones; words ascending, `leaves` (places among the contexts, with `counts`
# of training tokens) grouped by word, documents of the block (with `repeats` of the token) grouped by leaf.
KINDS = {"contexts": "<i8", "common": "<u2", "words": "<u8", "sizes": "<u4", "leaves": "<u4", "counts": "<u4", "holders": "<u4", "places": "<u2",
         "repeats": "<u1"}
MOST_REPEATS = 255  # of a token in one entry; a document with more has several
WORDS = ("words", "sizes", "leaves", "counts")
RANGE = ("contexts", *WORDS)
SCORING = [c for c in KINDS if c != "counts"]
# Of a range's contexts: places in their groups, customers of the whole corpus, and tables of it by the last exchange.
LEAF = {"numbers": "<u4", "customers": "<i8", "totals": "<i8"}
SEATS = tuple(f"{level}_tables" for level in LEVELS)  # that a pass hands to the next: the tables of every entry


RISING = ("contexts", "common", "words", "leaves", "numbers")  # travel as differences: words ascend, and so do the leaves of a word


def _bytes(name: str, values: np.ndarray) -> bytes:
    """An array as compressed bytes, its length first."""
    kind = KINDS.get(name) or LEAF.get(name, "<u4")
    values = values.astype(kind)
    if name in RISING:
        values = np.diff(values, prepend=values.dtype.type(0))
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _array(name: str, value) -> np.ndarray:
    kind = KINDS.get(name) or LEAF.get(name, "<u4")
    if not value:
        return np.zeros(0, kind)
    values = np.frombuffer(pa.decompress(value[8:], int.from_bytes(value[:8], "little"), "zstd", asbytes=True), kind)
    return np.cumsum(values, dtype=kind) if name in RISING else values


def _block_rows(texts: list[bytes], held: list[bool], parts: int, rooms: Contexts):
    """``(part, arrays)`` of a block, for every range of words that it has any of; and the texts' token counts."""
    arr = pa.array(texts, pa.large_binary())
    hashes, leaves, places = [], [], []
    sizes = []
    for first, buf, offs in slices(arr, SLICE_BYTES):
        h, leaf, bounds = tokens(buf, offs, rooms)
        hashes.append(h)
        leaves.append(leaf)
        places.append(np.repeat(np.arange(first, first + len(offs) - 1).astype(np.uint16), np.diff(bounds)))
        sizes.append(np.diff(bounds))
    words, word = np.unique(np.concatenate(hashes), return_inverse=True)
    contexts, leaf = np.unique(np.concatenate(leaves), return_inverse=True)
    pair, known = word * len(contexts) + leaf, None
    if len(words) * len(contexts) * BLOCK_DOCS >= 1 << 63:  # a text of very many words
        known, pair = np.unique(pair, return_inverse=True)
    key, repeats = np.unique(pair * BLOCK_DOCS + np.concatenate(places), return_counts=True)
    entries = -(-repeats // MOST_REPEATS)
    if entries.max(initial=0) > 1:
        last = np.cumsum(entries) - 1
        rest = repeats - (entries - 1) * MOST_REPEATS
        key, repeats = np.repeat(key, entries), np.full(int(entries.sum()), MOST_REPEATS)
        repeats[last] = rest
    place, pair = key % BLOCK_DOCS, key // BLOCK_DOCS
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    learn = ~np.array(held, bool)
    counts = np.add.reduceat(repeats * learn[place], first)
    owner, leaf = np.divmod(pair[first] if known is None else known[pair[first]], len(contexts))
    holders = np.diff(np.append(first, len(pair)))
    of_part = ((words >> U64(32)) * U64(parts)) >> U64(32)
    begin = np.searchsorted(of_part, np.arange(parts + 1, dtype=U64))
    leaf_begin = np.searchsorted(owner, begin)
    place_upto = np.append(first, len(pair))
    for p in np.flatnonzero(np.diff(begin)):
        w, x = slice(begin[p], begin[p + 1]), slice(leaf_begin[p], leaf_begin[p + 1])
        y = slice(place_upto[x.start], place_upto[x.stop])
        met, own_leaf = np.unique(leaf[x], return_inverse=True)
        common, others = rooms.in_short(contexts[met])
        own = {"contexts": others, "common": common, "words": words[w], "sizes": np.bincount(owner[x] - begin[p], minlength=w.stop - w.start),
               "leaves": own_leaf, "counts": counts[x], "holders": holders[x], "places": place[y], "repeats": repeats[y]}
        yield int(p), {n: _bytes(n, v) for n, v in own.items()}
    yield -1, np.concatenate(sizes)


def _common(texts: DataFrame, text_bytes: int, rooms: Contexts) -> np.ndarray:
    """Ids of contexts that are often met, by a look at some texts; what is counted does not depend on them."""
    def run(batches):
        sums = collections.Counter()
        for batch in batches:
            for _, buf, offs in slices(batch.column(0), SLICE_BYTES):
                sums.update(dict(zip(*(x.tolist() for x in np.unique(tokens(buf, offs, rooms)[1], return_counts=True)))))
        some = [(x, n) for x, n in sums.items() if n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in some], pa.int64()), pa.array([n for _, n in some], pa.int64())], ["id", "n"])

    found = (texts.sample(min(1.0, COMMON_BYTES / max(1, text_bytes)), 1).mapInArrow(run, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").limit(COMMON).select("id").toArrow())
    return np.sort(found.column(0).to_numpy())


def _listed(docs: DataFrame, parts: int, block_bytes: int, kind: str, rooms: Contexts) -> DataFrame:
    """Rows of words (``part`` from 0) and rows of documents (``part`` -1) of all blocks, in one pass."""
    schema = (f"block long, part int, {', '.join(f'{n} binary' for n in KINDS)}, place int, id {kind}, held_out boolean, "
              "n_tokens long")
    columns = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        block, id_type = TaskContext.get().partitionId() << 24, None
        ids, texts, held, size = [], [], [], 0

        def flush():
            rows = []
            for part, found in _block_rows(texts, held, parts, rooms):
                if part >= 0:
                    rows.append({"block": block, "part": part, **found})
                else:
                    rows += [{"block": block, "part": -1, "place": i, "id": x, "held_out": o, "n_tokens": int(n)}
                             for i, (x, o, n) in enumerate(zip(ids, held, found))]
            types = [pa.int64(), pa.int32(), *[pa.binary()] * len(KINDS), pa.int32(), id_type, pa.bool_(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in zip(columns, types)], columns)

        for batch in batches:
            id_type = batch.column(0).type
            for x, o, t in zip(*batch.columns):
                ids.append(x.as_py())
                held.append(o.as_py())
                texts.append((t.as_py() or "").encode())
                size += len(texts[-1])
                if size >= block_bytes or len(ids) == BLOCK_DOCS:
                    yield flush()
                    block += 1
                    ids, texts, held, size = [], [], [], 0
        if ids:
            yield flush()

    return docs.mapInArrow(run, schema)


def _added(table: pa.Table, rooms: Contexts) -> pa.Table:
    """The rows of one range as one, their training counts added up; words that training lacks go, all contexts stay."""
    names = [c for c in (*RANGE, "common") if c in table.column_names]
    rows = [{c: _array(c, v) for c, v in zip(names, values)} for values in zip(*(table.column(c).to_pylist() for c in names))]
    if "common" in names:
        for r in rows:
            r["contexts"] = rooms.whole(r["common"], r["contexts"])
    contexts = np.unique(np.concatenate([r["contexts"] for r in rows]))
    h, leaf, n = [], [], []
    for r in rows:
        taught = r["counts"] > 0
        h.append(np.repeat(r["words"], r["sizes"])[taught])
        leaf.append(np.searchsorted(contexts, r["contexts"])[r["leaves"][taught]])
        n.append(r["counts"][taught].astype(np.int64))
    h, leaf, n = _summed(*(np.concatenate(x) for x in (h, leaf, n)))
    words, sizes = np.unique(h, return_counts=True)
    out = {"contexts": contexts, "words": words, "sizes": sizes, "leaves": leaf, "counts": n}
    return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()),
                     *(pa.array([_bytes(c, out[c])], pa.binary()) for c in RANGE)], ["part", *RANGE])


def _seated(words, sizes, leaves, counts, seats, totals: Totals, seed: int):
    """``(first word, Seating)`` of a range's words, some at a time; seed and first word fix the draws.

    ``seats`` has the arrays of ``SEATS`` of the pass before, or nothing: then a first seating is drawn.
    """
    upto = np.append([0], np.cumsum(sizes.astype(np.int64)))
    used = dict.fromkeys(SEATS, 0)

    def take(level, entries):
        name = f"{level}_tables"
        used[name] += entries
        return seats[name][used[name] - entries:used[name]].astype(np.int64)

    for start in range(0, len(words), WORDS_AT_ONCE):
        stop = min(start + WORDS_AT_ONCE, len(words))
        x = slice(upto[start], upto[stop])
        word = np.repeat(np.arange(stop - start), sizes[start:stop])
        rng = np.random.default_rng([seed, int(words[start])])
        yield start, Seating(word, leaves[x].astype(np.int64), counts[x].astype(np.int64), totals, rng, take if seats else None)


def _rows(batches):
    """Each row's values by name."""
    for batch in batches:
        yield from batch.to_pylist()


def _arrays(row: dict, names) -> dict[str, np.ndarray]:
    return {c: _array(c, row[c]) for c in names}


def _counted(vocabulary: DataFrame, rooms: Contexts) -> tuple[np.ndarray, int]:
    """Training tokens by class of their contexts, and the number of distinct ones."""
    mids = rooms.mids

    def run(batches):
        sums = np.zeros(mids + 1, np.int64)
        for row in _rows(batches):
            a = _arrays(row, RANGE)
            sums[:mids] += np.bincount(rooms.kind_of(a["contexts"])[a["leaves"]], a["counts"], mids).astype(np.int64)
            sums[mids] += len(a["words"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(mids + 1)), pa.array(sums)], ["room", "n"])

    found = vocabulary.mapInArrow(run, "room long, n long").groupBy("room").sum("n").toArrow()  # a row a class
    sums = np.zeros(mids + 1, np.int64)
    sums[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return sums[:mids], int(sums[mids])


def _exchanged(vocabulary: DataFrame, groups: int) -> DataFrame:
    """``part`` and, of each of its contexts, the sum over all ranges: the first time of training tokens (and the
    contexts' numbers in their groups), then of the tables that were seated last.

    A group holds the contexts of a range of ids, so what it has of a range is a slice of that range's.
    """
    first = "numbers" not in vocabulary.columns
    key = "contexts" if first else "numbers"
    weight, total = ("counts", "customers") if first else ("leaf_tables", "totals")
    told = ["numbers", "customers"] if first else ["totals"]
    cuts = ((np.arange(1, groups, dtype=object) << (43 + KIND_BITS)) // groups).astype(np.int64)

    def tell(batches):
        for row in _rows(batches):
            a = _arrays(row, {"contexts", "leaves", weight, key})
            n = np.bincount(a["leaves"], a[weight], len(a["contexts"])).astype(np.int64)
            at = [0, *np.searchsorted(a["contexts"], cuts), len(n)]
            slices = [slice(x, y) for x, y in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(groups, dtype=np.int32)), pa.array([row["part"]] * groups, pa.int32()),
                 pa.array([_bytes(key, a[key][x]) for x in slices], pa.binary()),
                 pa.array([_bytes(total, n[x]) for x in slices], pa.binary())], ["grp", "part", "key", "n"])

    def add(table: pa.Table) -> pa.Table:
        keys = [_array(key, x) for x in table.column("key").to_pylist()]
        n = np.concatenate([_array(total, x) for x in table.column("n").to_pylist()])
        number = np.concatenate(keys)
        if first:
            number = np.unique(number, return_inverse=True)[1]
        own = {"numbers": number, total: np.bincount(number, n).astype(np.int64)[number]}  # exact below 2^53
        at = np.cumsum([0, *map(len, keys)])
        return pa.table([table.column("grp"), table.column("part"),
                         *(pa.array([_bytes(c, own[c][x:y]) for x, y in zip(at, at[1:])], pa.binary()) for c in told)],
                        ["grp", "part", *told])

    def put_together(table: pa.Table) -> pa.Table:
        table = table.sort_by("grp")
        return pa.table([table.column("part").slice(0, 1),
                         *(pa.array([_bytes(c, np.concatenate([_array(c, x) for x in table.column(c).to_pylist()]))], pa.binary()) for c in told)],
                        ["part", *told])

    columns = ", ".join(f"{c} binary" for c in told)
    return (vocabulary.select(*dict.fromkeys(["part", "contexts", "leaves", weight, key])).mapInArrow(tell, "grp int, part int, key binary, n binary")
            .groupBy("grp").applyInArrow(add, f"grp int, part int, {columns}").groupBy("part").applyInArrow(put_together, f"part int, {columns}"))


def _sample(j: int) -> list[str]:
    return [f"s{j}_{c}" for c in (*SEATS, "totals")]


def _swept(vocabulary: DataFrame, totals: Totals, seed: int, sweeps: int, samples: int) -> DataFrame:
    """The vocabulary with its seats after ``sweeps`` sweeps over all customers, and ``told``: each row's :func:`_flat` counts.

    Of the seats that it had, those of the first ``samples`` samples are carried on, with the leaf restaurants'
    tables; the last of these are what the sweeps begin with.
    """
    carried = [c for j in range(samples) for c in _sample(j)]
    last = dict(zip(_sample(samples - 1), (*SEATS, "totals")))  # the seats before, where they are a sample
    kept = [*RANGE, "numbers", "customers"]
    binary = [*kept, *SEATS, "told", *carried]
    seated = "totals" in vocabulary.columns

    def run(batches):
        for row in _rows(batches):
            a = _arrays(row, [*kept, *((*SEATS, "totals") if seated else ())])
            own = totals.of_range(a["contexts"], a["customers"], a.get("totals"))
            told, out = np.zeros(_slots(own.rooms)[-1], np.int64), {c: [] for c in SEATS}
            for _, seats in _seated(*(a[c] for c in WORDS), {c: a[c] for c in SEATS} if seated else {}, own, seed):
                for _ in range(sweeps):
                    seats.sweep()
                told += _flat(seats.counted())
                for level in LEVELS:
                    out[f"{level}_tables"].append(getattr(seats, level).tables)
            column = {c: row[last.get(c, c)] for c in (*kept, *carried)}
            column |= {c: _bytes(c, np.concatenate([*out[c], np.zeros(0, np.int64)])) for c in SEATS}
            column["told"] = told.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([row["part"]], pa.int32()), *(pa.array([column[c]], pa.binary()) for c in binary)],
                                             ["part", *binary])

    return vocabulary.mapInArrow(run, "part int, " + ", ".join(f"{c} binary" for c in binary))


TOLD = ("customers", "tables", "ones", "twos")


def _slots(rooms: Contexts) -> list[int]:
    """Where each of the told arrays begins, level by level, and where the last ends; the leaf restaurants' have no place."""
    sizes = [n for level in LEVELS for n in ((0, 0, 1, 1) if level == "leaf" else (rooms.count(level), rooms.count(level), 1, 1))]
    return [0, *np.cumsum(sizes).tolist()]


def _flat(counted: dict) -> np.ndarray:
    """Customers and tables of the restaurants, entries with one and two customers, in the order of the slots."""
    return np.concatenate([np.atleast_1d(x) for level in LEVELS for x in counted[level][2 * (level == "leaf"):]]).astype(np.int64)


def _totals(swept: DataFrame, vocabulary: int, rooms: Contexts) -> Totals:
    """Totals and discounts (by entries with one and two customers) of the seats; without those of the leaf restaurants."""
    slots = _slots(rooms)

    def run(batches):
        sums = np.zeros(slots[-1], np.int64)
        for batch in batches:
            for told in batch.column(0).to_pylist():
                sums += np.frombuffer(told, np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["slot", "n"])

    found = swept.select("told").mapInArrow(run, "slot long, n long").groupBy("slot").sum("n").toArrow()  # some numbers a class
    sums = np.zeros(slots[-1], np.int64)
    sums[found.column(0).to_numpy()] = found.column(1).to_numpy()
    by = {what: {} for what in TOLD}
    for i, (level, what) in enumerate((level, what) for level in LEVELS for what in TOLD):
        by[what][level] = sums[slots[i]:slots[i + 1]].astype(float)
    ones, twos = ({n: x[0] for n, x in by[what].items()} for what in ("ones", "twos"))
    discount = {n: min(0.95, max(0.05, (ones[n] + 1) / (ones[n] + 2 * twos[n] + 2))) for n in LEVELS}
    return Totals(by["customers"], by["tables"], discount, vocabulary, rooms)


class RangeModel:
    """A range's words with their training counts and predictive probabilities, by one sample's seats and totals."""

    def __init__(self, words, sizes, leaves, counts, seats, totals: Totals):
        self.words, self.totals = words, totals
        self.count, self.root = np.zeros(len(words)), np.zeros(len(words))
        mid_key, mid, leaf_key, leaf = [], [], [], []
        for start, seats in _seated(words, sizes, leaves, counts, seats, totals, 0):  # restored: nothing is drawn
            own = slice(start, start + seats.words)
            self.count[own], self.root[own] = seats.total, seats.p_root()
            mid_key.append((start + seats.mid_word) * totals.rooms.mids + seats.mid.room)
            leaf_key.append((start + seats.word) * totals.rooms.leaves + seats.leaf.room)
            mid.append(seats.p_mid())
            leaf.append(seats.p_leaf())
        none = [np.zeros(0)]
        self.mid_key, self.leaf_key = (np.concatenate(x or none).astype(np.int64) for x in (mid_key, leaf_key))
        self.mid, self.leaf = np.concatenate(mid or none), np.concatenate(leaf or none)

    def look_up(self, words, word, leaf, room):
        """Training count of each of ``words``, and the probability of each pair of one of them and a leaf (and its room).

        Where a restaurant does not know the word, its parent's probability counts, by the weight of a new table.
        """
        t = self.totals
        at = np.minimum(np.searchsorted(self.words, words), max(0, len(self.words) - 1))
        has = self.words[at] == words if len(self.words) else np.zeros(len(words), bool)
        count, root = np.zeros(len(words)), np.full(len(words), t.backoff("root")[0] * t.base)
        count[has], root[has] = self.count[at[has]], self.root[at[has]]
        number = np.where(has, at, -1)[word]
        p = t.backoff("mid")[room] * root[word]
        _replace(p, self.mid_key, self.mid, number * t.rooms.mids + room, number >= 0)
        known = leaf < t.rooms.leaves
        p = np.append(t.backoff("leaf"), 1.0)[leaf] * p  # a context never met has no customers
        _replace(p, self.leaf_key, self.leaf, number * t.rooms.leaves + leaf, (number >= 0) & known)
        return count, p


def _replace(p, keys, values, wanted, able):
    """Where ``keys`` (ascending) have a wanted one, ``p`` gets its value."""
    if len(keys):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = able & (keys[at] == wanted)
        p[hit] = values[at[hit]]


SHARE = "block long, places binary, base binary, model binary, known binary"
SHARE_KINDS = {"places": "<u4", "base": "<f8", "model": "<f8", "known": "<u4"}


def averaged(models: list[RangeModel], words, word, context, leaf=None):
    """:meth:`RangeModel.look_up` with the mean of the samples' probabilities; each sample's sum to 1, so theirs do.

    ``leaf``: the contexts' places among the range's, if known.
    """
    rooms = models[0].totals.rooms  # all samples have the same
    leaf = rooms.place(context) if leaf is None else leaf
    room, count, total = rooms.kind_of(context), None, 0.0
    for model in models:
        count, p = model.look_up(words, word, leaf, room)
        total = total + p
    return count, total / len(models)


def _shares(rows: pa.Table, samples: pa.Table, totals: list[Totals], learned: int) -> pa.Table:
    """What a range's words add to the scores of the documents that hold them; ``samples`` has its seats by sample."""
    names = [x.split()[0] for x in SHARE.split(", ")]
    if not rows.num_rows:
        return pa.table([pa.array([], pa.int64() if c == "block" else pa.binary()) for c in names], names)
    models = []
    for j, own in enumerate(totals):  # a range of which training has no word has no seats
        of_sample = dict(zip(SEATS, _sample(j)))
        found = {c: _array(c, samples.column(of_sample.get(c, c))[0].as_py() if samples.num_rows else b"") for c in (*WORDS, *SEATS)}
        models.append(RangeModel(*(found[c] for c in WORDS), {c: found[c] for c in SEATS}, own))
    for other in models[1:]:  # of the same words and contexts
        other.mid_key, other.leaf_key = models[0].mid_key, models[0].leaf_key
    out = []
    for i in range(rows.num_rows):
        a = {c: _array(c, rows.column(c)[i].as_py()) for c in SCORING}
        word = np.repeat(np.arange(len(a["words"])), a["sizes"])
        contexts = models[0].totals.rooms.whole(a["common"], a["contexts"])
        count, p = averaged(models, a["words"], word, contexts[a["leaves"]], models[0].totals.rooms.place(contexts)[a["leaves"]])
        base = np.log10((count + 0.5) / (learned + 0.5 * (totals[0].vocabulary + 1)))
        pair = np.repeat(np.arange(len(word)), a["holders"])
        repeats = a["repeats"].astype(np.float64)
        place = a["places"].astype(np.int64)
        places = np.unique(place)
        found = {"places": places, "base": np.bincount(place, base[word][pair] * repeats)[places],
                 "model": np.bincount(place, np.log10(p)[pair] * repeats)[places],
                 "known": np.bincount(place, (count > 0)[word][pair] * repeats)[places]}
        out.append((rows.column("block")[i].as_py(), *(_packed(found[c], SHARE_KINDS[c]) for c in names[1:])))
    columns = list(zip(*out))
    return pa.table([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names)


def _packed(values: np.ndarray, kind: str) -> bytes:
    raw = np.ascontiguousarray(values.astype(kind)).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(value: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.decompress(value[8:], int.from_bytes(value[:8], "little"), "zstd", asbytes=True), kind)


SCORED = "block long, place int, base_score double, score double, n_known long"


def _scored(table: pa.Table) -> pa.Table:
    """A block's documents with what all ranges add to them, in the order of the ranges.

    A range adds to a document only if it has a word of it, so a block has no more to add up than tokens.
    """
    table = table.sort_by("part")
    found = {c: np.concatenate([_unpacked(v, k) for v in table.column(c).to_pylist()]) for c, k in SHARE_KINDS.items()}
    place = found["places"].astype(np.int64)
    places = np.unique(place)
    sums = {c: np.bincount(place, found[c])[places] for c in ("base", "model", "known")}
    return pa.table([pa.array(np.full(len(places), table.column("block")[0].as_py())), pa.array(places, pa.int32()), pa.array(sums["base"]),
                     pa.array(sums["model"]), pa.array(sums["known"].astype(np.int64))], ["block", "place", "base_score", "score", "n_known"])


def score_corpus(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    The model learns from all whole texts that are not held out. ``score`` is the log10 probability
    of a text's tokens (perplexity is ``10 ** (-score / n_tokens)``), each by the average of the
    sampled predictive probabilities; ``base_score`` that of a unigram model with 0.5 added to counts.

    Shuffled are lists of words, each at most once a block however often it is met, with the places
    of their documents, and sums by document. A range of words has more tasks, by blocks, once there
    are more than ``SALT_BLOCKS`` of those, so a word that every document holds is no hot key; seats
    are sampled once a range, written, and only read there. The driver sees the totals of the classes' restaurants
    and the root's; those of the contexts' go between ranges (:func:`_exchanged`).

    A null or empty text has one token, its end. Rows with a null id and repeated rows are scored
    like others. With nothing to learn from, all tokens are unknown; an empty table gives no rows;
    other columns are not read.
    """
    spark = docs.sparkSession

    paths = {}

    def written(frame, name):
        paths[name] = scratch_path(spark, f"lm-{name}")
        with shuffles_removed(spark):
            frame.write.option("compression", "zstd").parquet(paths[name])
        return spark.read.parquet(paths[name])

    kind = docs.schema[id_col].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long")), F.count("*")).first()
    parts = max(1, math.ceil(((size[0] or 0) + 64 * size[1]) / RANGE_BYTES))
    given = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                        F.col(text_col).alias("text"))
    rooms = Contexts(np.zeros(0, np.int64))
    rooms = replace(rooms, common=_common(given.select("text"), size[0] or 0, rooms))
    groups = math.ceil(parts / GROUP_RANGES)
    listed = written(_listed(given, parts, block_bytes, kind, rooms), "listed")
    salts = max(1, math.ceil(parts * RANGE_BYTES / block_bytes / SALT_BLOCKS))
    rows = listed.filter("part >= 0").withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))

    added = "part int, " + ", ".join(f"{c} binary" for c in RANGE)

    def add(table: pa.Table) -> pa.Table:
        return _added(table, rooms)

    vocabulary = rows.select("part", "salt", *RANGE, "common").groupBy("part", "salt").applyInArrow(add, added)
    if salts > 1:
        vocabulary = vocabulary.groupBy("part").applyInArrow(add, added)
    vocabulary = written(vocabulary, "vocabulary")
    by_class, known = _counted(vocabulary, rooms)
    learned = int(by_class.sum())
    totals = Totals.guessed(np.zeros(0), by_class, known, rooms)
    of_sample, before = [], "vocabulary"
    for i in range(PASSES + SAMPLES):
        swept = _swept(vocabulary.join(_exchanged(vocabulary, groups), "part"), totals, seed + i, PASS_SWEEPS if i < PASSES else 1, len(of_sample))
        vocabulary = written(swept, f"seats-{i}")
        remove_path(spark, paths[before])
        before = f"seats-{i}"
        totals = _totals(vocabulary, known, rooms)  # of the very seats just written: with these every restaurant sums to 1
        if i >= PASSES:
            of_sample.append(totals)

    def share(left: pa.Table, right: pa.Table) -> pa.Table:
        of_range = []
        for j, own in enumerate(of_sample):  # a range of which no text has a word has no contexts
            names = ("contexts", "customers", "totals")
            found = [_array(c, right.column(n)[0].as_py() if right.num_rows else b"") for c, n in zip(names, (*names[:2], f"s{j}_totals"))]
            of_range.append(own.of_range(*found))
        out = _shares(left, right, of_range, learned)
        part = left.column("part")[0].as_py() if left.num_rows else 0
        return out.append_column("part", pa.array([part] * out.num_rows, pa.int32()))

    last = dict(zip((*SEATS, "totals"), _sample(SAMPLES - 1)))
    models = vocabulary.join(_exchanged(vocabulary, groups), "part").drop("told", "numbers").withColumnsRenamed({"part": "of", **last})
    models = written(models, "models")
    remove_path(spark, paths[before])
    for j in range(ROUNDS):
        some, own = rows.filter(F.col("part") % ROUNDS == j), models.filter(F.col("of") % ROUNDS == j)
        if salts > 1:
            own = own.join(some.select(F.col("part").alias("of"), F.col("salt").alias("turn")).distinct(), "of")
        else:
            own = own.withColumn("turn", F.lit(0))
        written(some.select("part", "salt", "block", *SCORING).groupBy("part", "salt")
                .cogroup(own.groupBy("of", "turn")).applyInArrow(share, SHARE + ", part int"), f"shares-{j}")
    remove_path(spark, paths["models"])
    shares = spark.read.parquet(*(paths[f"shares-{j}"] for j in range(ROUNDS))).groupBy("block").applyInArrow(_scored, SCORED)
    told = listed.filter("part = -1").select("block", "place", "id", "held_out", "n_tokens")
    return told.join(shares, ["block", "place"]).select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(learned).cast("long").alias("train_tokens"),
        "base_score", "score")
