import zlib

from brute import awkward, frame
from vecforge.llm.sharding import shard_by_bytes


def check(spark, rows, shards):
    got = [tuple(r) for r in shard_by_bytes(frame(spark, rows), shards).collect()]
    assert len(got) == len(rows)
    raw = sorted(((i is not None, i or 0), zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in rows)
    total, at, want = sum(r[2] for r in raw), 0, []
    for (has, i), crc, size in raw:
        shard = min(shards - 1, (2 * at + size) * shards // (2 * total))
        want.append((i if has else None, size, crc, shard))
        at += size
    assert sorted((r[:4] for r in got), key=repr) == sorted(want, key=repr)
    for s in {r[3] for r in got}:
        assert sorted(r[4] for r in got if r[3] == s) == list(range(sum(r[3] == s for r in got)))
    # slots follow the order of the rows
    assert [r[0] for r in sorted(got, key=lambda r: (r[3], r[4]))] == [r[0] for r in want]


def test_shards(spark):
    rows = awkward()
    for shards in (1, 3, 40):
        check(spark, rows, shards)
    check(spark, [(1, "same")] * 50 + rows, 7)
    check(spark, [], 4)


def test_balance(spark):
    rows = [(i, "x" * (i * 37 % 200)) for i in range(3000)]
    sizes = {}
    for r in shard_by_bytes(frame(spark, rows, extra=False), 40).collect():
        sizes[r.shard] = sizes.get(r.shard, 0) + r["size"]
    assert len(sizes) == 40 and max(sizes.values()) - min(sizes.values()) <= 2 * 216


def test_no_python_in_the_plan(spark):
    plan = shard_by_bytes(frame(spark, [(1, "a")]), 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
