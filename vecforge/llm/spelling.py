"""Words and their spelling variants: pairs one edit apart, found by pivotal bigrams.

All bigrams of all words have one order, the rarest first. A word's prefix is its first three bigrams in
that order (with all that equal the third); among them two that do not overlap and are rarest together
are its pivots. One edit cannot touch both, so of two words one edit apart the one whose prefix ends
earlier has a pivot that the other holds, and holds in its prefix. The edit lies wholly behind that pivot
or wholly before it, which limits its position: the two words are the same up to the pivot's end, or from
its start on. So the index has the beginnings that end with a first pivot and the ends that begin with a
second one, and every prefix bigram of every word is looked up there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.llm.process import give_back
from vecforge.llm.words import U64, mix
from vecforge.session import scratch_path

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, FORM_FACTOR, DAMAGE_MODULUS = 7, 2, 10, 31

PREFIX = 3               # bigrams: two for each edit and one
HOT_ENTRIES = 1 << 18    # a key with more entries is dealt out again, by what is left beside it
CHUNK = 1 << 17          # entries compared at once
BASE = U64(0x9E3779B97F4A7C15)
SIDES = (U64(0x2545F4914F6CDD1D), U64(0x632BE59BD9B4E019))


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: distinct damaged runs of letters of whole texts, and how often they occur.

    Only A-Z are lower-cased. With h the CRC-32 of ``<id>:<run>``, a run whose h is divided by 31 loses its
    code point h % length. A null text has no runs, a null id is an empty string.
    """
    upper = "".join(map(chr, range(65, 91)))
    low = F.translate(F.col(text_col), upper, upper.lower())
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id_"),
                       F.explode(F.regexp_extract_all(low, F.lit(RUN), F.lit(0))).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id_", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGE_MODULUS == 0, cut).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _codes(words: list[str], length: int) -> np.ndarray:
    if not length:
        return np.zeros((len(words), 0), U64)
    return np.array(words, f"<U{length}").view("<u4").reshape(len(words), length).astype(U64)


def _by_length(words: list[str]):
    """``(places, matrix of code points)`` of the words of each length."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield at, _codes([words[i] for i in at], int(n))


def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, BASE, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def pivots_of(ranks: np.ndarray, weights: np.ndarray):
    """``(prefix mask, first pivot, second pivot, rank of the prefix's end)`` of words of one length.

    ``ranks`` has each bigram's place in the common order, ``weights`` how often it occurs. Over places
    from the left, the lightest prefix bigram so far is carried on; it joins the one two places on.
    """
    last = np.partition(ranks, PREFIX - 1, axis=1)[:, PREFIX - 1]
    inside = ranks <= last[:, None]
    cost = np.where(inside, weights, np.inf)
    lightest = np.minimum.accumulate(cost, axis=1)
    both = lightest[:, :-2] + cost[:, 2:]
    second = both.argmin(axis=1) + 2
    before = np.where(np.arange(ranks.shape[1])[None, :] <= second[:, None] - 2, cost, np.inf)
    return inside, before.argmin(axis=1), second, last


def entries_of(words: list[str], order: dict[int, tuple[int, int]]):
    """``(word number, key, side, place, is pivot, rank of the prefix's end)`` of all index and lookup entries.

    Side 0 has the beginning up to and with the bigram at ``place`` as key, side 1 the end from it on.
    """
    keys = np.array(sorted(order), U64)
    rank_of, weight_of = (np.array([order[int(k)][i] for k in keys]) for i in (0, 1))
    out = [[] for _ in range(6)]
    for at, codes in _by_length(words):
        n, size = codes.shape
        grams = np.searchsorted(keys, codes[:, :-1] << U64(32) | codes[:, 1:])
        inside, first, second, last = pivots_of(rank_of[grams], weight_of[grams].astype(float))
        power = _powers(size)
        begin = np.cumsum((codes + U64(1)) * power[:size], axis=1, dtype=U64)               # of codes 0 to j
        end = np.cumsum(((codes + U64(1)) * power[:size][::-1])[:, ::-1], axis=1, dtype=U64)[:, ::-1]  # of codes j to the last
        for side in (0, 1):
            for pivot in (True, False):
                if pivot:
                    row, place = np.arange(n), first if side == 0 else second
                else:
                    row, place = np.nonzero(inside)
                part = begin[row, place + 1] + place.astype(U64) if side == 0 else end[row, place] + (size - place).astype(U64)
                found = (at[row], mix(part * U64(2) ^ SIDES[side]).view(np.int64), np.full(len(row), side), place,
                         np.full(len(row), pivot), last[row])
                for held, x in zip(out, found):
                    held.append(x)
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]


def rests(words: list[str], side: np.ndarray, place: np.ndarray) -> list[str]:
    """What stands beside the key: behind the bigram on side 0, before it on side 1."""
    return [w[p + 2:] if s == 0 else w[:p] for w, s, p in zip(words, side.tolist(), place.tolist())]


def signatures(rest: list[str], key: np.ndarray, pivot: np.ndarray):
    """``(entry, signature)``: entries of one key whose rests are one edit apart share a signature across index and lookups.

    A rest without its code point j, and j: shared by rests that differ in j alone. A whole rest (index) and a
    rest without any one code point (lookup), and the other way round: shared if one has one more.
    """
    rows, found = [], []
    for at, codes in _by_length(rest):
        size = codes.shape[1]
        power = _powers(size + 1)
        terms = (codes + U64(1)) * power[:size]
        whole = terms.sum(axis=1, dtype=U64)
        upto = np.concatenate([np.zeros((len(at), 1), U64), np.cumsum(terms, axis=1, dtype=U64)], axis=1)
        seed = key[at].view(U64)
        is_pivot = pivot[at].astype(bool)
        whole_kind, cut_kind = (np.where(is_pivot, U64(a), U64(b)) for a, b in ((1, 2), (2, 1)))
        rows.append(at)
        found.append(mix(mix(whole + U64(size)) * U64(4) + whole_kind ^ seed))
        if size:
            longer = _by_one(codes, power)
            places = np.arange(size, dtype=U64)
            changed = mix(mix(whole[:, None] - terms + (places << U64(40))) * U64(4) + U64(3) + U64(size) * U64(8) ^ seed[:, None])
            cut = upto[:, :-1] + longer
            cut = mix(mix(cut + U64(size - 1)) * U64(4) + cut_kind[:, None] ^ seed[:, None])
            for part in (changed, cut):
                rows.append(np.repeat(at, size))
                found.append(part.ravel())
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(found).view(np.int64)


def _by_one(codes: np.ndarray, power: np.ndarray) -> np.ndarray:
    """For each j the sum of the codes after j, each one place further left."""
    size = codes.shape[1]
    moved = (codes[:, 1:] + U64(1)) * power[:size - 1]
    behind = np.zeros(codes.shape, U64)
    if size > 1:
        behind[:, :-1] = np.cumsum(moved[:, ::-1], axis=1, dtype=U64)[:, ::-1]
    return behind


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point tells the words apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _matches(entry: np.ndarray, sig: np.ndarray, pivot: np.ndarray):
    """Pairs (index entry, lookup entry) with a signature in common."""
    is_pivot = pivot[entry].astype(bool)
    a, b = np.flatnonzero(is_pivot), np.flatnonzero(~is_pivot)
    a, b = a[np.argsort(sig[a])], b[np.argsort(sig[b])]
    low, high = np.searchsorted(sig[b], sig[a], "left"), np.searchsorted(sig[b], sig[a], "right")
    sizes = high - low
    left = np.repeat(a, sizes)
    right = b[np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    return entry[left], entry[right]


ENTRY = "deal long, key long, word string, side int, place int, pivot boolean, last long, sig long"


def _compared(batches):
    """Near pairs among entries that share a key (or, where a key is hot, a signature), sorted by ``deal``."""
    def flush(parts):
        table = pa.concat_tables(parts).combine_chunks()
        words = table.column("word").to_pylist()
        key, side, place, last, sig = (table.column(c).to_numpy() for c in ("key", "side", "place", "last", "sig"))
        pivot = np.array(table.column("pivot").to_pylist(), bool)
        plain = np.flatnonzero(sig == 0)
        chosen = [words[i] for i in plain]
        entry, found = signatures(rests(chosen, side[plain], place[plain]), key[plain], pivot[plain])
        told = np.flatnonzero(sig != 0)
        left, right = _matches(np.concatenate([plain[entry], told]), np.concatenate([found, sig[told]]), pivot)
        ahead = last[left] < last[right]
        same = last[left] == last[right]
        pairs = {(words[i], words[j]) for i, j, first, tie in zip(left.tolist(), right.tolist(), ahead.tolist(), same.tolist())
                 if (first or (tie and words[i] < words[j])) and one_edit(words[i], words[j])}
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["a", "b"])

    held, rows = [], 0
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rows > CHUNK and table.num_rows:
            deal = table.column("deal").to_numpy()
            before = held[-1].column("deal")[-1].as_py()
            cut = int(np.argmax(deal != before)) if (deal != before).any() else len(deal)
            held.append(table.slice(0, cut))
            rows += cut
            if cut < len(deal):
                yield flush(held)
                held, rows = [table.slice(cut)], len(deal) - cut
            continue
        if table.num_rows:
            held.append(table)
            rows += table.num_rows
    if held:
        yield flush(held)
    give_back()


def near_pairs(words: DataFrame, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """``a, b``: every unordered pair of the distinct words of ``word`` (five code points at least) that is one edit apart, once.

    Bigrams are counted over all words; these counts (an alphabet squared at most) reach the driver. Each
    word sends two index entries and two for every prefix bigram, dealt out by key. Entries of a key are
    matched by signatures of what stands beside it, so the work grows with entries, not with their pairs;
    what matches is verified. A key with over ``hot_entries`` entries is dealt out by signature instead.

    Null words have no pairs; repeated words count once; an empty table gives no rows.
    """
    spark = words.sparkSession

    def written(frame, name):
        path = scratch_path(spark, f"spelling-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    words = words.filter("word IS NOT NULL").select("word").distinct()

    def grams(batches):
        total: dict[int, int] = {}
        for batch in batches:
            for _, codes in _by_length(batch.column(0).to_pylist()):
                found, n = np.unique(codes[:, :-1] << U64(32) | codes[:, 1:], return_counts=True)
                for g, c in zip(found.tolist(), n.tolist()):
                    total[g] = total.get(g, 0) + c
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["gram", "n"])

    counted = words.mapInArrow(grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    by_rarity = sorted((r["n"], r["gram"]) for r in counted)
    order = {gram: (rank, n) for rank, (n, gram) in enumerate(by_rarity)}

    def entries(hot):
        def run(batches):
            for batch in batches:
                own = batch.column(0).to_pylist()
                if not own:
                    continue
                number, key, side, place, pivot, last = entries_of(own, order)
                spread = np.isin(key, hot)
                plain, told = np.flatnonzero(~spread), np.flatnonzero(spread)
                entry, sig = signatures(rests([own[i] for i in number[told]], side[told], place[told]), key[told], pivot[told])
                rows = np.concatenate([plain, told[entry]])
                sigs = np.concatenate([np.zeros(len(plain), np.int64), sig])
                deal = np.where(sigs == 0, key[rows], sigs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deal), pa.array(key[rows]), batch.column(0).take(pa.array(number[rows], pa.int64())),
                     pa.array(side[rows], pa.int32()), pa.array(place[rows], pa.int32()), pa.array(pivot[rows].astype(bool)),
                     pa.array(last[rows], pa.int64()), pa.array(sigs)], [x.split()[0] for x in ENTRY.split(", ")])
        return run

    def load(batches):
        for batch in batches:
            own = batch.column(0).to_pylist()
            if own:
                _, key, _, _, _, _ = entries_of(own, order)
                found, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n, pa.int64())], ["key", "n"])

    hot = (words.mapInArrow(load, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
           .filter(F.col("n") > hot_entries).select("key").collect())  # at most one in hot_entries entries
    hot = np.array([r["key"] for r in hot], np.int64)
    dealt = (words.mapInArrow(entries(hot), ENTRY).repartition("deal").sortWithinPartitions("deal"))
    return written(dealt.mapInArrow(_compared, "a string, b string"), "pairs").distinct()


def variants(words: DataFrame, factor: int = FORM_FACTOR, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``word, n``.

    A word's form is its near word of largest ``n`` (ties: least in code-point order) if that is at least
    ``factor`` times the word's own; ``root`` follows forms to the last. ``n_near`` counts near words.
    Counts grow along forms, so roots are found by doubling steps, in rounds of the logarithm of a chain's
    length. Words are distinct; null words are left out.
    """
    spark = words.sparkSession

    def written(frame, name):
        path = scratch_path(spark, f"spelling-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    words = written(words.filter("word IS NOT NULL").select("word", "n"), "words")
    pairs = near_pairs(words, hot_entries)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    best = (counted.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b"))).alias("best"))
            .select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("near"), (-F.col("best.less")).alias("near_n")))
    good = F.col("near_n") >= factor * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("near")).alias("form"),
        F.when(good, F.col("near_n")).alias("form_n")), "forms")
    step = written(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        then = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(step.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")), "roots")
        step = moved.select("word", "root")
        if not moved.filter("moved").head(1):
            break
    return formed.join(step, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def frequent(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    return words.filter((F.length("word") >= min_length) & (F.col("n") >= min_count))
