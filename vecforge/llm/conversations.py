"""Conversation structure repair: a run-length DP over role and fault symbols.

Rows of a conversation, in order, become symbols; equal consecutive ones are a run. Four states tell
how far the repaired roles have come in ``(s?(ua)+)?``: nothing yet, after ``s``, after ``u``, after
``a``. What a symbol costs from state to state is a 4 x 4 min-plus matrix, so a run is advanced by
cached binary powers of its matrix. The costs to the end, known at the ends of all runs, then say
which edits are cheapest; these are unrolled row by row, the ASCII-least of equally cheap ones.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecforge.session import scratch_path

# The edits' costs and the faults' names.
DELETE, REROLE, INSERT, TRUNCATED_KEPT = 2, 1, 5, 5
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
SPACE = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

NEVER = 1 << 60
STATES = range(4)                  # nothing yet, after s, after u, after a
AS_USER = ((0, 2), (1, 2), (3, 2))  # state changes of a user row, an assistant row, a system row
AS_ASSISTANT = ((2, 3),)
AS_SYSTEM = ((0, 1),)
HOT_ROWS = 1 << 17  # a conversation with more rows is cut into segments


def symbol_of(role: str, fault: str | None) -> str:
    """What the DP sees of a row: ``x`` if it has to go, else the role's initial and ``t`` if it is truncated."""
    if fault in (BLANK, DUPLICATE):
        return "x"
    return (role[:1] if role[:1] in ("s", "u", "a") else "-") + ("t" if fault == TRUNCATED else "")


def _times(a, b):
    return tuple(tuple(min(a[s][m] + b[m][t] for m in STATES) for t in STATES) for s in STATES)


def _apply(matrix, after):
    return tuple(min(matrix[s][t] + after[t] for t in STATES) for s in STATES)


ONE = tuple(tuple(0 if s == t else NEVER for t in STATES) for s in STATES)


class Steps:
    """Matrices of symbols, their binary powers, and the cheapest edits of a row; all cached."""

    def __init__(self):
        insert = [list(r) for r in ONE]
        for s, t in AS_USER + AS_ASSISTANT:
            insert[s][t] = INSERT
        self.inserts = _times(insert, _times(insert, insert))  # up to three in a row; no more ever help
        self.end = _apply(self.inserts, tuple(0 if s in (0, 3) else NEVER for s in STATES))
        self.powers: dict[str, list] = {}
        self.found: dict[tuple, tuple] = {}
        self.back: dict[tuple, tuple] = {}

    @staticmethod
    def edits(symbol: str):
        """``(letter, cost, from, to, new role)`` of all that can be done to a row."""
        out = [("D", DELETE, s, s, None) for s in STATES]
        if symbol != "x":
            extra = TRUNCATED_KEPT if symbol.endswith("t") else 0
            kept = {"u": AS_USER, "a": AS_ASSISTANT, "s": AS_SYSTEM}.get(symbol[0], ())
            out += [("K", extra, s, t, None) for s, t in kept]
            out += [("R", REROLE + extra, s, t, "user") for s, t in AS_USER]
            out += [("R", REROLE + extra, s, t, "assistant") for s, t in AS_ASSISTANT]
        return out

    def power(self, symbol: str, bit: int):
        known = self.powers.setdefault(symbol, [])
        if not known:
            row = [[NEVER] * 4 for _ in STATES]
            for _, cost, s, t, _ in self.edits(symbol):
                row[s][t] = min(row[s][t], cost)
            known.append(_times(self.inserts, row))
        while len(known) <= bit:
            known.append(_times(known[-1], known[-1]))
        return known[bit]

    def advance(self, symbol: str, count: int, after):
        """Costs to the end before ``count`` equal symbols, from those after them."""
        bit = 0
        while count >> bit:
            if count >> bit & 1:
                after = _apply(self.power(symbol, bit), after)
            bit += 1
        return after

    def matrix(self, runs):
        """The matrix of a whole list of runs ``(symbol, count)``."""
        whole = ONE
        for symbol, count in runs:
            for bit in range(count.bit_length()):
                if count >> bit & 1:
                    whole = _times(whole, self.power(symbol, bit))
        return whole

    def _before(self, symbol: str, after):
        """:meth:`advance` by one, with the least cost taken out, from the cache."""
        got = self.back.get((symbol, after))
        if got is None:
            costs = _apply(self.power(symbol, 0), after)
            least = min(costs)
            got = self.back[symbol, after] = tuple(c - least for c in costs)
        return got

    def _cheapest(self, symbol: str, state: int, after):
        """``(edits, next state)``: the ASCII-least cheapest way over one row, inserts before it included."""
        got = self.found.get((symbol, state, after))
        if got is not None:
            return got
        here, out, s = _apply(self.power(symbol, 0), after), [], state
        inserts = [("I", INSERT, a, b, role) for pairs, role in ((AS_USER, "user"), (AS_ASSISTANT, "assistant")) for a, b in pairs]
        while True:
            choices = [(letter, t, role) for letter, cost, a, t, role in self.edits(symbol) if a == s and cost + after[t] == here[s]]
            choices += [(letter, t, role) for letter, cost, a, t, role in inserts if a == s and cost + here[t] == here[s]]
            letter, s, role = min(choices, key=lambda c: c[0])
            out.append((letter, role))
            if letter != "I":
                break
        got = self.found[symbol, state, after] = (tuple(out), s)
        return got

    def unroll(self, runs, state: int, after):
        """For each symbol in order its edits; then the state that is reached is appended alone."""
        ends = []
        for symbol, count in reversed(runs):
            ends.append(after)
            after = self.advance(symbol, count, after)
        for (symbol, count), end in zip(runs, reversed(ends)):
            least = min(end)
            behind = [tuple(c - least for c in end)]
            for _ in range(count - 1):
                behind.append(self._before(symbol, behind[-1]))
            while behind:
                edits, state = self._cheapest(symbol, state, behind.pop())
                yield edits
        yield state

    def closing(self, state: int):
        """Roles inserted after the last row."""
        return {0: (), 1: ("user", "assistant"), 2: ("assistant",), 3: ()}[state]


def faults_of(rows, known=None):
    """The first fault of each ``(role, text)`` in order, or None; ``known`` tells duplicates if given."""
    seen, out = set(), []
    for i, (role, text) in enumerate(rows):
        left = text.rstrip(SPACE)
        again = known[i] if known is not None else (role, text) in seen
        if known is None:
            seen.add((role, text))
        out.append(BLANK if not left else DUPLICATE if again else TRUNCATED if left[-1] not in ".!?" else None)
    return out


def _runs(symbols):
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]


def _edited(steps: Steps, turns, rows, faults, state: int, after, last: bool):
    """``(edit, fault, turn, old role, role, text)`` of all rows and inserts, in order."""
    runs = _runs(map(symbol_of, (r for r, _ in rows), faults))
    for i, edits in enumerate(steps.unroll(runs, state, after)):
        if isinstance(edits, int):
            if last:
                for role in steps.closing(edits):
                    yield "I", None, None, None, role, ""
            return
        for letter, new in edits:
            if letter == "I":
                yield "I", None, None, None, new, ""
            else:
                yield letter, faults[i], turns[i], rows[i][0], new or rows[i][0], rows[i][1]


EDITS = [("edit", T.StringType()), ("fault", T.StringType()), ("turn", T.LongType()), ("old_role", T.StringType()),
         ("role", T.StringType()), ("text", T.StringType())]
BATCH_TEXT = 4 << 20  # characters of text that go out in one batch


def _by_conversation(batches, keys: int):
    """``(key columns, rows)`` of each stretch of rows with one key; rows are tuples of the other columns."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:keys] != key:
                yield key, held
                held = []
            key = row[:keys]
            held.append(row[keys:])
    if held:
        yield key, held


def _edit_batches(found, kind: pa.DataType):
    """Batches of ``(conversation, segment, seq, *edit)`` rows."""
    names = ["conversation", "segment", "seq", *(n for n, _ in EDITS)]
    kinds = [kind, pa.int64(), pa.int64(), *(pa.int64() if n == "turn" else pa.string() for n, _ in EDITS)]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows, size = [], 0
    for row in found:
        rows.append(row)
        size += len(row[-1]) + 64
        if size > BATCH_TEXT:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def repair(frame: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every edit of every conversation: ``conversation, segment, seq, edit, fault, turn, old_role, role, text``.

    Rows of a conversation are taken by turn (nulls first), then role, then text. A row's first fault
    counts: ``blank`` (white space only), ``duplicate`` (role and text seen in an earlier row),
    ``truncated`` (does not end in ``. ! ?``). Edits, by (``segment``, ``seq``): K keeps a row, R gives it
    the role user or assistant, D deletes it, I inserts a user or assistant row without text. What is not
    deleted has role initials ``(s?(ua)+)?``, at the least cost of all edits, the ASCII-least of equal ones.

    Conversations of up to ``hot_rows`` rows are dealt out by id, each repaired where it lands. Rows of
    a larger one are dealt out in order, as segments: duplicates by first places in an aggregate, a matrix
    a segment, costs to the end and states from these (one small row a segment), then every segment unrolls
    its own edits. No task holds all of a large conversation.

    Null roles and texts are a single space, null turns come first, a null id is a conversation too;
    equal rows are adjacent (the later ones duplicates); an empty table gives no rows; other columns are
    not read. Within one segment of a hot conversation, or one conversation, rows are held at once.
    """
    done, segmented = _parts(frame, conv_col, turn_col, role_col, text_col, hot_rows)
    return done if segmented is None else done.unionByName(segmented)


def repair_report(frame: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """:func:`report` of :func:`repair`; conversations that one task repaired are reported where they are."""
    done, segmented = _parts(frame, conv_col, turn_col, role_col, text_col, hot_rows)
    out = report(done, ordered=True)
    return out if segmented is None else out.unionByName(report(segmented))


def _parts(frame, conv_col, turn_col, role_col, text_col, hot_rows):
    """Edits of the conversations that one task can hold, in order, and those of larger ones (None if there is none)."""
    def text(name):
        return F.coalesce(F.col(name), F.lit(" "))

    rows = frame.select(F.col(conv_col).alias("conversation"), F.col(turn_col).cast("long").alias("turn"),
                        text(role_col).alias("role"), text(text_col).alias("text"))
    big = rows.groupBy("conversation").count().filter(F.col("count") > hot_rows).select("conversation", F.lit(True).alias("big"))
    path = scratch_path(frame.sparkSession, "conversations-big")
    big.write.parquet(path)
    big = frame.sparkSession.read.parquet(path)  # at most one row in hot_rows
    schema = T.StructType([T.StructField("conversation", rows.schema["conversation"].dataType),
                           T.StructField("segment", T.LongType()), T.StructField("seq", T.LongType()),
                           *(T.StructField(n, k) for n, k in EDITS)])

    def run(batches):
        steps, kind = Steps(), None

        def known(some):
            nonlocal kind
            for batch in some:
                kind = batch.schema.field(0).type
                yield batch

        def found():
            for (conv,), held in _by_conversation(known(batches), 1):
                turns, pairs = [h[0] for h in held], [h[1:] for h in held]
                for seq, edit in enumerate(_edited(steps, turns, pairs, faults_of(pairs), 0, steps.end, True)):
                    yield conv, 0, seq, *edit

        stream = found()
        first = next(stream, None)
        if first is not None:
            yield from _edit_batches(_chain(first, stream), kind)

    some_big = bool(big.head(1))
    if some_big:
        rows = rows.join(big.withColumnRenamed("conversation", "of"), F.col("conversation").eqNullSafe(F.col("of")), "left").drop("of")
    small = rows.filter("big IS NULL").drop("big") if some_big else rows
    done = (small.repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")
            .mapInArrow(run, schema))
    return done, _segmented(rows.filter("big").drop("big"), schema) if some_big else None


def _chain(first, rest):
    yield first
    yield from rest


def _segmented(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`repair` of conversations that are too large for one task."""
    spark = rows.sparkSession

    def written(frame, name):
        path = scratch_path(spark, f"conversations-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    # equal rows may stand in any order, so they are told apart by where they were read
    order = ["conversation", "turn", "role", "text", "copy"]
    dealt = (rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
             .drop("copy").withColumn("place", F.monotonically_increasing_id()))
    placed = written(dealt.withColumn("segment", F.shiftright("place", 33))
                     .withColumn("digest", F.md5(F.to_json(F.struct("conversation", "role", "text")))), "placed")
    first = written(placed.groupBy("digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1"), "first")
    marked = written(placed.join(first, "digest", "left")
                     .select("conversation", "segment", "place", "turn", "role", "text",
                             F.coalesce(F.col("place") > F.col("first"), F.lit(False)).alias("again")), "marked")
    kind = schema["conversation"].dataType
    costs, places = T.ArrayType(T.LongType()), ["conversation", "segment"]

    def in_order(frame):
        return frame.repartition("segment").sortWithinPartitions("segment", "conversation", "place")

    def symbols(held):
        return _runs(map(symbol_of, (h[1] for h in held), faults_of([h[1:3] for h in held], [h[3] for h in held])))

    def matrices(batches):
        steps = Steps()
        for (conv, segment), held in _by_conversation(batches, 2):
            flat = [c for row in steps.matrix(symbols(held)) for c in row]
            yield pa.RecordBatch.from_arrays([pa.array([conv]).cast(arrow_kind), pa.array([segment]), pa.array([flat], pa.list_(pa.int64()))],
                                             [*places, "matrix"])

    from pyspark.sql.pandas.types import to_arrow_type
    arrow_kind = to_arrow_type(kind)
    base = T.StructType([T.StructField("conversation", kind), T.StructField("segment", T.LongType())])
    body = marked.select(*places, "turn", "role", "text", "again", "place")
    flat = written(in_order(body).select(*places, "turn", "role", "text", "again")
                   .mapInArrow(matrices, T.StructType([*base, T.StructField("matrix", costs)])), "matrices")

    def costs_to_end(table: pa.Table) -> pa.Table:
        steps, out = Steps(), []
        after = steps.end
        found = sorted(table.to_pylist(), key=lambda r: -r["segment"])
        for i, r in enumerate(found):
            out.append((r["conversation"], r["segment"], list(after), i == 0))
            m = r["matrix"]
            after = _apply([m[4 * s:4 * s + 4] for s in STATES], after)
        return _table(out, ["conversation", "segment", "after", "last"], [arrow_kind, pa.int64(), pa.list_(pa.int64()), pa.bool_()])

    ends = written(flat.groupBy("conversation").applyInArrow(
        costs_to_end, T.StructType([*base, T.StructField("after", costs), T.StructField("last", T.BooleanType())])), "ends")

    def joined(frame, small):
        return in_order(frame.join(small.select(F.col("conversation").alias("of"), F.col("segment").alias("in"), *small.columns[2:]),
                                   F.col("conversation").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("in"))).drop("of", "in"))

    def exits(batches):
        steps = Steps()
        for (conv, segment, after), held in _by_conversation(_hashable(batches, 2), 3):
            reached = []
            for state in STATES:
                *_, end = steps.unroll(symbols(held), state, after)
                reached.append(end)
            yield pa.RecordBatch.from_arrays([pa.array([conv]).cast(arrow_kind), pa.array([segment]),
                                              pa.array([reached], pa.list_(pa.int64()))], [*places, "reached"])

    reached = written(joined(body, ends).select(*places, "after", "turn", "role", "text", "again")
                      .mapInArrow(exits, T.StructType([*base, T.StructField("reached", costs)])), "reached")

    def entries(table: pa.Table) -> pa.Table:
        state, out = 0, []
        for r in sorted(table.to_pylist(), key=lambda r: r["segment"]):
            out.append((r["conversation"], r["segment"], state))
            state = r["reached"][state]
        return _table(out, ["conversation", "segment", "state"], [arrow_kind, pa.int64(), pa.int64()])

    states = reached.groupBy("conversation").applyInArrow(entries, T.StructType([*base, T.StructField("state", T.LongType())]))
    known = written(ends.join(states.withColumnRenamed("conversation", "of").withColumnRenamed("segment", "in"),
                              F.col("conversation").eqNullSafe(F.col("of")) & (F.col("segment") == F.col("in"))).drop("of", "in"), "known")

    def edits(batches):
        steps = Steps()

        def found():
            for (conv, segment, after, last, state), held in _by_conversation(_hashable(batches, 2), 5):
                rows, again = [h[1:3] for h in held], [h[3] for h in held]
                done = _edited(steps, [h[0] for h in held], rows, faults_of(rows, again), state, after, last)
                for seq, edit in enumerate(done):
                    yield conv, segment, seq, *edit

        yield from _edit_batches(found(), arrow_kind)

    return (joined(body, known).select(*places, "after", "last", "state", "turn", "role", "text", "again")
            .mapInArrow(edits, schema))


def _hashable(batches, at: int):
    """The batches with the list column ``at`` read as tuples."""
    class Column:
        def __init__(self, column):
            self.column = column

        def to_pylist(self):
            return [tuple(x) for x in self.column.to_pylist()]

    class Batch:
        def __init__(self, columns):
            self.columns = columns

    for batch in batches:
        yield Batch([Column(c) if i == at else c for i, c in enumerate(batch.columns)])


def _table(rows, names, kinds) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


COUNTS = ("gaps", BLANK, DUPLICATE, TRUNCATED, "illegal", "cost")


def report(edits: DataFrame, ordered: bool = False) -> DataFrame:
    """A row a conversation from :func:`repair`: its counts, ``cost``, ``audit`` and ``repaired_sha256``.

    ``gaps`` are turns missing between the least and the largest; ``illegal`` counts neighbours whose
    role initials, before the repair, are not su, ua or au. The digest is of ``role:text`` of what is
    left, joined by newlines. Rows are streamed in order, and only the audit's letters are held: a digest
    is serial by its nature, so it is the one step of a hot conversation that a single task does.
    """
    if not ordered:
        edits = edits.repartition("conversation").sortWithinPartitions("conversation", "segment", "seq")
    kind = edits.schema["conversation"].dataType
    schema = T.StructType([T.StructField("conversation", kind), *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    names = [f.name for f in schema]
    costs = {"K": 0, "D": DELETE, "R": REROLE, "I": INSERT}

    def run(batches):
        conv, open_, sent = None, False, []
        arrow_kind = None

        def fresh():
            return dict.fromkeys(COUNTS, 0), [], hashlib.sha256(), [None, None, 0, None, True]

        def closed():
            low, high, turns, _, _ = marks
            counts["gaps"] = high - low + 1 - turns if turns else 0
            sent.append((conv, *(counts[c] for c in COUNTS), "".join(audit), digest.hexdigest()))

        def flushed():
            out = pa.RecordBatch.from_arrays([pa.array(c, arrow_kind if i == 0 else pa.int64() if i <= len(COUNTS) else pa.string())
                                              for i, c in enumerate(zip(*sent))], names)
            sent.clear()
            return out

        counts, audit, digest, marks = fresh()
        for batch in batches:
            arrow_kind = batch.schema.field(0).type
            for of, edit, fault, turn, old, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not open_ or of != conv:
                    if open_:
                        closed()
                    conv, open_ = of, True
                    counts, audit, digest, marks = fresh()
                audit.append(edit)
                counts["cost"] += costs[edit] + (TRUNCATED_KEPT if fault == TRUNCATED and edit != "D" else 0)
                if fault:
                    counts[fault] += 1
                if old is not None:
                    if marks[3] is not None and marks[3] + old[:1] not in LEGAL:
                        counts["illegal"] += 1
                    marks[3] = old[:1]
                    if turn is not None and turn != marks[1]:
                        marks[0] = turn if marks[0] is None else marks[0]
                        marks[1], marks[2] = turn, marks[2] + 1
                if edit != "D":
                    digest.update((f"{role}:{text}" if marks[4] else f"\n{role}:{text}").encode())
                    marks[4] = False
            if len(sent) > 5000:
                yield flushed()
        if open_:
            closed()
        if sent:
            yield flushed()

    return edits.select("conversation", "edit", "fault", "turn", "old_role", "role", "text").mapInArrow(run, schema)


def damage(frame: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows damaged by ``crc32(conv:turn) % 20``: 0 dropped, 1 emptied, 2 without ``. ! ?``, 3 twice, 4 as user.

    A null in any of the columns counts as one space (the columns of id and turn keep it).
    """
    def word(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(word(conv_col), F.lit(":"), word(turn_col))) % 20
    rows = frame.select(F.col(conv_col), F.col(turn_col), word(role_col).alias(role_col), word(text_col).alias(text_col),
                        what.alias("what_")).filter("what_ <> 0")
    text = F.when(F.col("what_") == 1, "").when(F.col("what_") == 2, F.translate(text_col, ".!?", "")).otherwise(F.col(text_col))
    times = F.explode(F.when(F.col("what_") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return (rows.select(F.col(conv_col), F.col(turn_col), F.when(F.col("what_") == 4, "user").otherwise(F.col(role_col)).alias(role_col),
                        text.alias(text_col), times.alias("time_")).drop("time_"))
