"""Quality rules: whole-text counts, and a short-circuit cascade ordered by rejection per cost."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.llm.process import give_back

# The symbols that are counted, and the base rule's limits.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SAMPLE_ROWS = 2000  # about how many rows cost and selectivity are estimated on

UPPER = bytes(range(0x41, 0x5B))
LOWER = bytes(range(0x61, 0x7B))
OTHER = bytes(range(0x80, 0x100))
CONTINUATION = bytes(range(0x80, 0xC0))


def _count(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


class Text:
    """One whole text as UTF-8; what several rules need is found once."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()  # at 0x20 and 0x09-0x0D

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def word_chars(self) -> int:
        return sum(map(len, self.words)) - _count(self.raw, CONTINUATION)

    @cached_property
    def n_symbols(self) -> int:
        return _count(self.raw, SYMBOLS)

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of 8 that occur twice or more. Windows are named exactly: words by
        their first place, then pairs, fours and eights by the rank of both halves."""
        n = len(self.words)
        if n <= WINDOW:
            return 0
        seen: dict[bytes, int] = {}
        names = np.fromiter(map(seen.setdefault, self.words, range(n)), np.int64, n)
        for half in (1, 2, 4):
            found, names = np.unique(names[:-half] * n + names[half:], return_inverse=True)
            if len(found) == len(names):
                return 0
        again = np.flatnonzero(np.bincount(names)[names] > 1)
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, again, 1)
        np.add.at(cover, again + WINDOW, -1)
        return int(np.count_nonzero(np.cumsum(cover)))

    @property
    def base_failed(self) -> bool:
        n = len(self.words)
        return n < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * n


@dataclass(frozen=True)
class Rule:
    """``rejects(text)``; rules are independent, so their order changes cost and never the verdict."""

    name: str
    rejects: Callable[[Text], bool]


def _mean_length(t: Text) -> bool:
    n = len(t.words)
    return not 25 * n <= 10 * t.word_chars <= 120 * n


def _shouting(t: Text) -> bool:
    upper = _count(t.raw, UPPER)
    return 100 * upper > 50 * (upper + _count(t.raw, LOWER))


# Thresholds of the rules, in integers so that every engine agrees.
RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > len(t.words)),               # over 0.1 a word
    Rule("repeated lines", lambda t: 100 * t.n_dup_lines > 40 * len(t.lines)),  # over 0.4 of the lines
    Rule("mean word length", _mean_length),                                   # outside 2.5 to 12
    Rule("shouting", _shouting),                                              # over half of a-z, A-Z in capitals
    Rule("exclamations", lambda t: 2 * _count(t.raw, b"!") > len(t.words)),   # over 0.5 a word
    Rule("wordless", lambda t: 2 * sum(1 for w in t.words if w.translate(None, UPPER + LOWER + OTHER) != w)
         < len(t.words)),                                                     # under half hold a letter
)


def _texts(batch: pa.RecordBatch, column: str):
    for x in batch.column(batch.schema.get_field_index(column)):
        yield Text((x.as_py() or "").encode())


def greedy_order(rules: list[str], masks: dict[int, int], cost: dict[str, float]) -> list[str]:
    """Rules by rejection per cost, each judged on the rows that those before it leave.

    ``masks`` counts rows by the set of rules that reject them (bit i: rule i). Of rules that reject
    nothing more the cheapest is first.
    """
    left, waiting, out = dict(masks), list(range(len(rules))), []
    while waiting:
        hits = {i: sum(n for m, n in left.items() if m >> i & 1) for i in waiting}
        # every rule meets the same rows that are left, so its cost a row ranks it
        best = min(waiting, key=lambda i: (-hits[i] / cost[rules[i]], cost[rules[i]], i))
        waiting.remove(best)
        out.append(rules[best])
        left = {m: n for m, n in left.items() if not m >> best & 1}
    return out


def order_rules(docs: DataFrame, rules=RULES, text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
                seed: int = 7) -> list[str]:
    """Names of the rules in the order in which the cascade runs them, as measured on a sample.

    The sample has about ``sample_rows`` rows, drawn over the whole table; of these, rows that fail the
    base rule meet no other rule and are left out. A rule is timed as the cascade runs it, with the counts
    of the result already found, and its rejections are those of rows that the rules before it let pass
    (:func:`greedy_order`). One row for each set of rules that rejects something comes to the driver. With no
    row to measure on, the given order stays.
    """
    names = [r.name for r in rules]
    total = docs.count()
    if not total:
        return names
    part = docs.select(text_col).sample(min(1.0, sample_rows / total), seed)

    def run(batches):
        spent, seen, masks = [0.0] * len(rules), 0, {}
        for batch in batches:
            for text in _texts(batch, text_col):
                if text.base_failed:
                    continue
                for c in COUNTS[1:]:
                    getattr(text, c)
                seen, mask = seen + 1, 0
                for i, rule in enumerate(rules):
                    began = time.perf_counter()
                    mask |= bool(rule.rejects(text)) << i
                    spent[i] += time.perf_counter() - began
                masks[mask] = masks.get(mask, 0) + 1
        if seen:  # the times go with the first set
            keys = list(masks)
            yield pa.RecordBatch.from_pydict({"mask": keys, "n": [masks[m] for m in keys],
                                              "spent": [spent] + [[0.0] * len(rules)] * (len(keys) - 1)})

    sums = [F.sum(F.get("spent", i)).alias(f"s{i}") for i in range(len(rules))]
    found = part.mapInArrow(run, "mask long, n long, spent array<double>").groupBy("mask").agg(F.sum("n").alias("n"), *sums).collect()
    if not found:
        return names
    rows = sum(r["n"] for r in found)
    cost = {name: max(sum(r[f"s{i}"] for r in found) / rows, 1e-9) for i, name in enumerate(names)}
    return greedy_order(names, {r["mask"]: r["n"] for r in found}, cost)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, rules=RULES, text_col: str = "text", carry: list[str] | None = None,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The columns of ``docs`` (or ``carry``) with the counts, ``base_failed`` and ``kept``.

    Narrow: each text is judged where it is read. A text that fails the base rule meets no
    other; the rest meet the rules in the order of :func:`order_rules` until one rejects. The
    sample decides the order alone; every row is judged, and the verdict is the same in any order.

    A null or empty text has no words and fails the base rule. Repeated rows are judged alike, an
    empty table gives no rows, and columns of ``docs`` named as a result column give way to it.
    """
    by_name = {r.name: r for r in rules}
    ordered = [by_name[name] for name in order_rules(docs, rules, text_col, sample_rows)]
    added = [*COUNTS, "base_failed", "kept"]
    kept_cols = [c for c in (docs.columns if carry is None else carry) if c not in added]
    source = docs.select(*dict.fromkeys([*kept_cols, text_col]))
    schema = T.StructType([source.schema[c] for c in kept_cols] + [T.StructField(c, T.LongType()) for c in COUNTS]
                          + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")])

    def run(batches):
        for batch in batches:
            found: dict[str, list] = {c: [] for c in added}
            for text in _texts(batch, text_col):
                failed = text.base_failed
                found["n_words"].append(len(text.words))
                for c in COUNTS[1:]:
                    found[c].append(getattr(text, c))
                found["base_failed"].append(failed)
                found["kept"].append(not failed and not any(rule.rejects(text) for rule in ordered))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept_cols]
            columns += [pa.array(found[c], pa.int64()) for c in COUNTS]
            columns += [pa.array(found[c], pa.bool_()) for c in ("base_failed", "kept")]
            yield pa.RecordBatch.from_arrays(columns, [*kept_cols, *added])
        give_back()

    return source.mapInArrow(run, schema)


# The same counts and rules in DuckDB SQL, over `documents`.
WORD = r"[^\x20\x09-\x0D]+"
JUDGE_SQL = rf"""
WITH d AS (SELECT *, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda l: regexp_matches(l, '{WORD}')) AS ls FROM documents),
c AS (SELECT *, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS word_chars,
             length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines FROM d),
g AS (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM c WHERE len(ws) >= {WINDOW}),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(ws, i, i + {WINDOW - 1})) AS n FROM g),
p AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS at FROM h WHERE n > 1),
r AS (SELECT doc_id, count(*) AS n_repeat_words FROM p GROUP BY doc_id),
b AS (SELECT c.*, coalesce(r.n_repeat_words, 0) AS n_repeat_words FROM c LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
             length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS up,
             length(regexp_replace(coalesce(text, ''), '[^a-z]', '', 'g')) AS low FROM b)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT 10 * n_symbols > n_words AND NOT 100 * n_dup_lines > 40 * len(ls)
       AND 10 * word_chars BETWEEN 25 * n_words AND 120 * n_words AND NOT 100 * up > 50 * (up + low)
       AND NOT 2 * length(regexp_replace(coalesce(text, ''), '[^!]', '', 'g')) > n_words
       AND NOT 2 * len(list_filter(ws, lambda w: regexp_matches(w, '[A-Za-z]|[^\x00-\x7F]'))) < n_words AS kept
FROM f
"""
