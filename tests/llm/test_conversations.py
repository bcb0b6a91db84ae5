import hashlib
import itertools
import random
import re
import zlib

import pytest

from vecforge.llm.conversation_queries import EMPTY_SHA256
from vecforge.llm.conversations import COUNTS, Steps, damage, faults_of, repair, repair_report, report, symbol_of, _runs

GOOD = re.compile("(s?(ua)+)?$")


def plain_faults(rows):
    out = []
    for i, (role, text) in enumerate(rows):
        left = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not left else "duplicate" if (role, text) in rows[:i] else "truncated" if left[-1] not in ".!?" else None)
    return out


def every_edit(rows, faults, inserts):
    """All (cost, audit, repaired rows), with up to that many inserts at each place."""
    gaps = [list(c) for n in range(inserts + 1) for c in itertools.product(("user", "assistant"), repeat=n)]
    choices = []
    for (role, text), fault in zip(rows, faults):
        own = [("D", 2, None)]
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            own += [("K", extra, role), ("R", 1 + extra, "user"), ("R", 1 + extra, "assistant")]
        choices.append(own)
    for picked in itertools.product(*choices):
        for where in itertools.product(gaps, repeat=len(rows) + 1):
            cost, audit, out = 0, "", []
            for i, gap in enumerate(where):
                cost, audit, out = cost + 5 * len(gap), audit + "I" * len(gap), out + [(g, "") for g in gap]
                if i < len(rows):
                    letter, price, role = picked[i]
                    cost, audit = cost + price, audit + letter
                    if role is not None:
                        out.append((role, rows[i][1]))
            if GOOD.match("".join(r[:1] or "-" for r, _ in out)):
                yield cost, audit, out


MOVES = {"D": [(s, s, None) for s in range(4)], "user": [(0, 2), (1, 2), (3, 2)], "assistant": [(2, 3)], "s": [(0, 1)]}


def plain_repair(rows):
    """(cost, audit, repaired): the least by state, row by row."""
    faults = plain_faults(rows)
    states = {0: (0, "", ())}

    def insert(now):
        for _ in range(3):
            for s, (cost, audit, out) in list(now.items()):
                for role in ("user", "assistant"):
                    for a, b in MOVES[role]:
                        if a == s:
                            new = (cost + 5, audit + "I", out + ((role, ""),))
                            now[b] = min(now.get(b, new), new, key=lambda x: x[:2])
        return now

    for (role, text), fault in zip(rows, faults):
        new = {}
        for s, (cost, audit, out) in insert(states).items():
            found = [(s, cost + 2, "D", out)]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                kept = {"u": MOVES["user"], "a": MOVES["assistant"], "s": MOVES["s"]}.get(role[:1], [])
                found += [(b, cost + extra, "K", out + ((role, text),)) for a, b in kept if a == s]
                found += [(b, cost + 1 + extra, "R", out + ((r, text),)) for r in ("user", "assistant") for a, b in MOVES[r] if a == s]
            for t, price, letter, said in found:
                one = (price, audit + letter, said)
                new[t] = min(new.get(t, one), one, key=lambda x: x[:2])
        states = new
    return min((v for s, v in insert(states).items() if s in (0, 3)), key=lambda x: x[:2])


def random_rows(rng, n):
    texts = ["a.", "b!", "c", " \n", "", "d?", "e. ", "f."] + [f"t{i}." for i in range(8)]
    return [(rng.choice(["user", "assistant", "system", "tool", "", "u", " "]), rng.choice(texts)) for _ in range(n)]


def test_plain_repair_is_the_least_of_all_edits():
    rng = random.Random(1)
    for _ in range(40):
        rows = random_rows(rng, rng.randrange(3))
        best = min(((c, a, tuple(o)) for c, a, o in every_edit(rows, plain_faults(rows), 2)), key=lambda x: x[:2])
        assert best == plain_repair(rows)


def repaired(rows):
    from vecforge.llm.conversations import _edited
    steps = Steps()
    edits = list(_edited(steps, [None] * len(rows), rows, faults_of(rows), 0, steps.end, True))
    costs = {"K": 0, "D": 2, "R": 1, "I": 5}
    cost = sum(costs[e[0]] + (5 if e[1] == "truncated" and e[0] != "D" else 0) for e in edits)
    return cost, "".join(e[0] for e in edits), tuple((e[4], e[5]) for e in edits if e[0] != "D")


def test_runs_against_plain_repair():
    rng = random.Random(2)
    for _ in range(1500):
        rows = random_rows(rng, rng.randrange(9))
        assert repaired(rows) == plain_repair(rows)
    for _ in range(30):  # long runs
        rows = [(r, f"{i}{j}{e}") for i in range(4) for r, e, n in [(rng.choice("usat"), rng.choice(".,"), rng.randrange(1, 40))] for j in range(n)]
        rows = [({"u": "user", "s": "system", "a": "assistant", "t": "tool"}[r], t) for r, t in rows]
        got = repaired(rows)
        assert got == plain_repair(rows)
        steps = Steps()
        runs = _runs(map(symbol_of, (r for r, _ in rows), faults_of(rows)))
        whole = steps.matrix(runs)
        assert min(whole[0][t] + steps.end[t] for t in range(4)) == got[0]


def plain_report(rows):
    """Of one conversation's (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    pairs = [r[1:] for r in rows]
    faults, turns = plain_faults(pairs), [r[0] for r in rows if r[0] is not None]
    cost, audit, out = plain_repair(pairs)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def awkward_conversations():
    rng = random.Random(3)
    rows = []
    for conv in (1, 2, 3, 7, -5, None):
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn, *random_rows(rng, 1)[0]))
    rows += [(20, t, r, f"{t}.") for t, r in zip([5, 3, None, 9, 3, 3, None], ["user", "assistant", "user", "user", "user", "user", None])]
    rows += [(21, None, None, None), (21, None, None, None), (22, 1, "user", None), (23, 4, "user", "x" * 200000 + ".")]
    rows += [(30, t // 3, "user" if t % 5 else "assistant", f"says {t % 37}" + "." * (t % 3)) for t in range(400)]  # a hot one
    rows += [(31, 0, "user", "the same.")] * 90
    return rows


def grouped(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return by


def frame(spark, rows):
    clash = [(*r, "x", 1, "seg") for r in rows]
    return spark.createDataFrame(clash, "conv_id long, turn long, role string, text string, edit string, conversation long, segment string").repartition(5)


@pytest.mark.parametrize("hot_rows", [1 << 17, 30, 3])
def test_report(spark, hot_rows):
    rows = awkward_conversations()
    got = {r["conversation"]: tuple(r[c] for c in (*COUNTS, "audit", "repaired_sha256"))
           for r in repair_report(frame(spark, rows), hot_rows=hot_rows).collect()}
    assert got == {conv: plain_report(own) for conv, own in grouped(rows).items()}


def test_edits_in_any_order_of_rows(spark):
    """The rows that repair() gives are whole: its report, when they are dealt out anew, is the same."""
    rows = awkward_conversations()
    edits = repair(frame(spark, rows), hot_rows=30)
    back = spark.createDataFrame(edits.collect(), edits.schema).repartition(7)
    got = {r["conversation"]: r["repaired_sha256"] for r in report(back).collect()}
    assert got == {conv: plain_report(own)[-1] for conv, own in grouped(rows).items()}
    kept = [r for r in edits.collect() if r.conversation == 20 and r.edit != "D"]
    assert GOOD.match("".join(r.role[0] for r in sorted(kept, key=lambda r: (r.segment, r.seq))))


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        what = zlib.crc32(key.encode()) % 20
        if what == 0:
            continue
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        out += [(conv, turn, "user" if what == 4 else role, text)] * (2 if what == 3 else 1)
    return out


def test_damage(spark):
    rows = awkward_conversations() + [(c, t, "assistant", "Yes. No! Why?") for c in range(40, 60) for t in range(6)]
    got = [tuple(r) for r in damage(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(plain_damage(rows), key=repr)


def test_query(spark, tmp_path):
    from vecforge.llm.conversation_queries import op11_conversation_repair
    rows = awkward_conversations() + [(99, 77, "user", "gone")]
    rows += [(c, t, "assistant", f"{t}.") for c in range(100, 140) for t in range(2)]
    frame(spark, rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: tuple(r[c] for c in (*COUNTS, "audit", "repaired_sha256"))
           for r in op11_conversation_repair(spark, str(tmp_path)).collect()}
    damaged = grouped(plain_damage(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", EMPTY_SHA256)
    assert got == {conv: plain_report(damaged[conv]) if conv in damaged else nothing for conv in {r[0] for r in rows}}


def test_empty_table(spark):
    assert repair(frame(spark, []).limit(0)).count() == 0
    assert repair_report(damage(frame(spark, []).limit(0))).count() == 0
