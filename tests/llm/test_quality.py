import duckdb

from brute import awkward, frame, prose, words
from vecforge.llm.quality import COUNTS, JUDGE_SQL, RULES, Rule, Text, greedy_order, judge, order_rules


def plain(text):
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    cover = {p for places in seen.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


def test_counts_and_verdict(spark):
    rows = awkward()
    docs = frame(spark, rows)
    got = judge(docs).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        assert tuple(r[c] for c in COUNTS) == plain(r.text), r.text
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        t = Text((r.text or "").encode())
        assert r.kept == (not r.base_failed and not any(x.rejects(t) for x in RULES))
        by_text[r.text] = r.kept
    assert by_text[rows[0][1]] and not by_text[None] and not by_text[rows[20][1]] and not by_text[rows[21][1]]
    assert judge(docs).columns.count("kept") == 1  # the clashing column gives way


def test_sql_agrees(spark):
    rows = [(i, t) for i, (_, t) in enumerate(awkward())]
    got = judge(frame(spark, rows, extra=False), carry=["doc_id"]).toPandas().set_index("doc_id").sort_index()
    con = duckdb.connect()
    con.register("documents", frame(spark, rows, extra=False).toPandas())
    want = con.sql(JUDGE_SQL).df().set_index("doc_id").sort_index()[list(got.columns)]
    assert (got == want).all().all()


def test_order_is_rejection_per_cost(spark):
    import random
    rng = random.Random(1)
    docs = spark.createDataFrame([(prose(rng, 30),) for _ in range(300)], "text string")

    def slow(t):
        sum(range(3000))
        return len(t.words) > 0

    rules = (Rule("never", lambda t: False), Rule("slow", slow), Rule("quick", lambda t: len(t.raw) > 0))
    assert order_rules(docs, rules) == ["quick", "never", "slow"]  # nothing is left for the slow one
    assert order_rules(docs.limit(0), rules) == ["never", "slow", "quick"]
    a = {r.text: r.kept for r in judge(docs, rules).collect()}
    assert a == {r.text: r.kept for r in judge(docs, rules[::-1]).collect()}


def test_later_rules_count_what_is_left():
    """a rejects most, but b has rejected nearly all of that for less; c's few rows are its own."""
    cost = {"a": 2.0, "b": 1.0, "c": 1.0}
    masks = {0b000: 50, 0b011: 40, 0b001: 1, 0b100: 5}
    assert greedy_order(["a", "b", "c"], masks, cost) == ["b", "c", "a"]
    assert greedy_order(["a", "b"], {0: 9}, {"a": 2.0, "b": 1.0}) == ["b", "a"]


def test_rows_that_fail_the_base_are_not_measured(spark):
    """Short texts fail the base rule: a rule that rejects only them rejects nothing in the cascade."""
    import random
    rng = random.Random(3)
    docs = spark.createDataFrame([("too short",)] * 200 + [(prose(rng, 40),) for _ in range(50)], "text string")
    rules = (Rule("short", lambda t: len(t.words) < 10), Rule("dear", lambda t: sum(range(20000)) < 0 or len(t.raw) > 0))
    assert order_rules(docs, rules) == ["dear", "short"]


def test_empty_table(spark):
    assert judge(frame(spark, [])).count() == 0
