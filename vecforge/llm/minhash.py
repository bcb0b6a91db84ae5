"""MinHash near-duplicates: universal hash minima, banding, verification, connected components."""

from __future__ import annotations

import math
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.llm.components import connected_components
from vecforge.llm.process import give_back
from vecforge.llm.words import U64, mix, slices, word_shingles
from vecforge.session import scratch_path

WIDTH = 5            # words in a shingle
MISS = 1e-7          # most chance that a pair at the threshold shares no band
MOST_MINIMA = 208    # of a signature
SEED = 20240229
DEVIATIONS = 7       # of the share of equal minima, below the threshold, where the full comparison begins
BLOCK = 1024         # members of a bucket that meet as many others in one cell


class Setting(NamedTuple):
    """A signature for pairs of at least some similarity."""

    bands: int
    rows: int
    screen: float  # a pair below this share of equal minima is not compared in full


def setting(percent: int) -> Setting:
    """The longest bands (so fewest chance meetings) that miss a pair at the threshold with a chance under ``MISS``.

    85 percent: 28 bands of 5 and a screen of 0.64; 80: 41 of 5. A threshold that ``MOST_MINIMA`` cannot
    meet is rejected.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"a similarity of {percent} percent is not one of 1 to 100")
    share, best = percent / 100, None
    for rows in range(1, 17):
        bands = 1 if percent == 100 else math.ceil(math.log(MISS) / math.log1p(-share ** rows))
        if bands * rows <= MOST_MINIMA:
            best = bands, rows
    if best is None:
        raise ValueError(f"a similarity of {percent} percent needs more than {MOST_MINIMA} minima")
    return Setting(*best, share - DEVIATIONS * math.sqrt(share * (1 - share) / (best[0] * best[1])))


def _multipliers(n: int):
    """Of the universal family x -> (a x + b) mod 2 ** 64, upper 32 bits."""
    seeds = mix(np.arange(1, 2 * n + 1, dtype=U64) + U64(SEED))
    return seeds[:n] | U64(1), seeds[n:]


def _features(docs: DataFrame, id_col: str, text_col: str, n_hash: int) -> DataFrame:
    """``id, n_shingles, s1, s2`` (fingerprint of the whole shingle set) and ``sig``, 16 bits a minimum."""
    def run(batches):
        a, b = _multipliers(n_hash)
        for batch in batches:
            texts = batch.column(1)
            for first, buf, offs in slices(texts, 1 << 20):
                rows = len(offs) - 1
                found, bounds = word_shingles(buf, offs, WIDTH)
                count = np.zeros(rows, np.int64)
                prints = np.zeros((2, rows), U64)
                for i in np.flatnonzero(np.diff(bounds)):
                    one = np.sort(found[bounds[i]:bounds[i + 1]])
                    one = one[np.concatenate([[True], one[1:] != one[:-1]])]
                    count[i] = len(one)
                    prints[0, i], prints[1, i] = one.sum(dtype=U64), mix(one).sum(dtype=U64)
                filled = np.flatnonzero(np.diff(bounds))
                sig = np.zeros((rows, n_hash), np.uint16)
                if len(filled):
                    at, x, t = bounds[filled], found >> U64(32), np.empty_like(found)
                    for k in range(n_hash):
                        np.multiply(x, a[k], out=t)
                        t += b[k]
                        # of the upper 32 bits of the minimum the lower 16: evenly spread, unlike the upper ones
                        sig[filled, k] = np.minimum.reduceat(t, at) >> U64(32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(count), pa.array(prints[0].view(np.int64)),
                     pa.array(prints[1].view(np.int64)),
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * n_hash), rows, [None, pa.py_buffer(sig.tobytes())])
                     .cast(pa.binary())],
                    ["id", "n_shingles", "s1", "s2", "sig"])
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, n_shingles long, s1 long, s2 long, sig binary")


def _sigs(column) -> np.ndarray:
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(arr.to_pylist()), np.uint16).reshape(len(arr), -1)


def _alike(pairs: DataFrame, sigs: DataFrame, screen: float) -> DataFrame:
    """Pairs whose share of equal minima passes the screen."""
    both = (pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                share = (_sigs(batch.column(2)) == _sigs(batch.column(3))).mean(axis=1)
                keep = pa.array(share >= screen)
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def _sets(column):
    """The shingle set of each text, sorted."""
    for _, buf, offs in slices(column, 1 << 20):
        found, bounds = word_shingles(buf, offs, WIDTH)
        for i in range(len(offs) - 1):
            yield np.unique(found[bounds[i]:bounds[i + 1]])


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    least, most = sorted((len(x), len(y)))
    if 100 * least < percent * most:
        return False
    joined = np.sort(np.concatenate([x, y]))
    common = int(np.count_nonzero(joined[1:] == joined[:-1]))
    return common > 0 and 100 * common >= percent * (len(x) + len(y) - common)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets have ``100 * intersection >= percent * union``."""
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(_sets(batch.column(2)), _sets(batch.column(3))):
                keep.append(_linked(x, y, percent))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _unsettled(shared: DataFrame, parts: DataFrame, sigs: DataFrame, texts: DataFrame, percent: int, cut: Setting) -> DataFrame:
    """Links between members of a bucket that are still in different components.

    ``parts`` has ``(id, component)``. In each bucket the members outside its largest component are
    guests; in cells of at most about ``BLOCK`` guests and ``BLOCK`` members, each guest meets every
    member of another component. So a bucket costs its size times its guests, and one that a
    component fills costs nothing. Pairs are screened by their minima, then compared in full, in the
    cell; only links leave it. A pair is looked at in the first band that it shares, and not if one
    is the bucket's least id, which has met all members before.
    """
    known = shared.join(parts, "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")
    by_part = known.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    mixed = (by_part.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("members"),
                                           F.max_by(F.struct("part", "n"), F.struct("n", "part")).alias("main"))
             .filter("parts > 1 AND members > 2")  # of two members, both have met: one is the least
             .select("bucket", F.col("main.part").alias("main"),
                     F.ceil(F.col("members") / BLOCK).cast("int").alias("homes"),
                     F.ceil((F.col("members") - F.col("main.n")) / BLOCK).cast("int").alias("stays")))
    placed = (known.join(mixed, "bucket").join(sigs.select("id", "sig"), "id").join(texts, "id")
              .withColumn("guest", F.col("part") != F.col("main")))
    home = F.pmod(F.xxhash64("id"), F.col("homes")).cast("int")
    stay = F.pmod(F.xxhash64("id", F.lit(1)), F.col("stays")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("stays") - 1), lambda s: F.struct(
        s.alias("stay"), home.alias("home"), F.lit(False).alias("visits")))
    visits = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda h: F.struct(
        stay.alias("stay"), h.alias("home"), F.lit(True).alias("visits")))
    rows = (placed.withColumn("cell", F.explode(F.when(F.col("guest"), F.concat(cells, visits)).otherwise(cells)))
            .select("bucket", "cell.stay", "cell.home", "cell.visits", "band", "pivot", "id", "part", "sig", "text")
            .repartition("bucket", "stay", "home").sortWithinPartitions("bucket", "stay", "home"))

    def compare(cell: pa.Table):
        ids, part = cell.column("id").to_numpy(), cell.column("part").to_numpy()
        visits = cell.column("visits").to_numpy(zero_copy_only=False)
        sig, text = _sigs(cell.column("sig")), cell.column("text")
        band, pivot = cell.column("band")[0].as_py(), cell.column("pivot")[0].as_py()
        left, right = np.flatnonzero(visits), np.flatnonzero(~visits)
        sets: dict[int, np.ndarray] = {}

        def set_of(i):
            if i not in sets:
                sets[i] = next(_sets(text.slice(i, 1)))
            return sets[i]

        linked: dict[int, int] = {}  # of components, by links found in this cell

        def root(x):
            while linked.get(x, x) != x:
                x = linked[x]
            return x

        for s in range(0, len(left), 64):
            one = left[s:s + 64]
            same = sig[one][:, None, :] == sig[right][None, :, :]
            hit = (same.mean(axis=2) >= cut.screen) & (part[one][:, None] != part[right][None, :])
            for i, j in zip(*np.nonzero(hit)):
                shares = same[i, j].reshape(cut.bands, cut.rows).all(axis=1)
                a, b = int(one[i]), int(right[j])
                if shares[:band].any() or pivot in (ids[a], ids[b]) or root(part[a]) == root(part[b]):
                    continue
                if _linked(set_of(a), set_of(b), percent):
                    linked[root(part[a])] = root(part[b])
                    yield ids[a], ids[b]

    def run(batches):
        rest = None
        for batch in chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not rest.num_rows:
                continue
            key = [rest.column(c).to_numpy() for c in ("bucket", "stay", "home")]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            if batch is None:  # else the last cell may go on in the next batch
                cuts = np.append(cuts, rest.num_rows)
            start, found = 0, []
            for end in cuts.tolist():
                found += compare(rest.slice(start, end - start))
                start = end
            if found:
                x, y = np.array(found, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], ["a", "b"])
            rest = rest.slice(start)

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row of ``docs``.

    Two documents are linked if ``100 * intersection >= percent * union`` of their full sets of
    word shingles (64-bit hashes); a component has the least id that its documents reach.

    1. Rows get a set size, a set fingerprint and minima. Equal sets are linked to their least id
       and go on as one.
    2. Each bucket (band of equal minima) links its members to its least id only: as many pairs as
       members. Pairs that pass the screen are compared in full.
    3. Components are found; bucket members that are then still apart are compared with each
       other (:func:`_unsettled`). So every two members of a bucket end in one
       component or have been compared, and no bucket writes out all its pairs.

    Hot groups: copies are aggregated before any shuffle of theirs, the joins are ones that Spark
    splits. Nothing but counts reaches the driver.

    A text without words, null or empty, has no shingles and is linked with nothing. A row with a
    null id is linked with nothing, has no component and is not kept. Rows that share an id are one
    document. An empty table gives no rows; other columns are not read. Bands and screen follow from
    ``percent`` (:func:`setting`).
    """
    spark, cut = docs.sparkSession, setting(percent)

    def written(frame, name):
        path = scratch_path(spark, f"minhash-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    rows = written(_features(docs, id_col, text_col, cut.bands * cut.rows), "rows")
    named = rows.filter("n_shingles > 0 AND id IS NOT NULL")
    least = named.groupBy("s1", "s2").agg(F.min("id").alias("first"))
    copies = (named.select("id", "s1", "s2").join(least, ["s1", "s2"]).filter("id <> first")
              .select(F.col("id").alias("a"), F.col("first").alias("b")))
    sigs = written(named.select("id", "sig").join(least.select(F.col("first").alias("id")).distinct(), "id", "left_semi")
                   .dropDuplicates(["id", "sig"]), "sigs")

    width = 2 * cut.rows
    buckets = sigs.select("id", F.posexplode(F.array(*[
        F.xxhash64(F.substring("sig", 1 + width * k, width), F.lit(k)) for k in range(cut.bands)])).alias("band", "bucket"))
    pivots = (buckets.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("last"))
              .filter("last > pivot").select("bucket", "pivot"))
    shared = written(buckets.join(pivots, "bucket").select("bucket", "band", "id", "pivot"), "shared")
    star = (shared.filter("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct())
    tried = written(_alike(star, sigs, cut.screen), "tried")
    wanted = shared.select("id").distinct()
    texts = written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
                    .join(wanted, "id", "left_semi"), "texts")
    links = written(_verified(tried, texts, percent).unionByName(copies), "links")

    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    parts = written(connected_components(edges), "parts")
    more = written(_unsettled(shared, parts, sigs, texts, percent, cut), "more")
    if more.head(1):
        least_of = parts.select(F.col("id").alias("u"), F.col("component").alias("v"))
        parts = connected_components(least_of.unionByName(more.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    return (rows.select("id", "n_shingles").join(parts, "id", "left")
            .select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
