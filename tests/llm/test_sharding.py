import hashlib
import heapq
import random
import zlib

import numpy as np

from riskframe.llm import sharding as op

from .cases import ROWS, docs, rows_of


def sequential(rows, shards):
    """The heap, one group after another."""
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(hashlib.sha256((t or "").encode()).hexdigest(), []).append(len((t or "").encode()) + 1)
    heap, where = [(0, s) for s in range(shards)], {}
    for g, sizes in sorted(groups.items(), key=lambda x: (-sum(x[1]), x[0])):
        load, s = heapq.heappop(heap)
        where[g] = s
        heapq.heappush(heap, (load + sum(sizes), s))
    return where


def compare(rows, got, shards=op.SHARDS):
    where = sequential(rows, shards)
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), where[hashlib.sha256((t or "").encode()).hexdigest()]) for i, t, *_ in rows]
    key = lambda r: tuple((x is None, x) for x in r)
    assert rows_of(got, "doc_id", "size", "text_crc32", "shard") == sorted(want, key=key)
    slots = {}
    for r in got.collect():
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_equals_the_sequential_heap(spark):
    r = random.Random(3)
    rows = [(i, "x" * r.choice([0, 1, 1, 1, 2, 5, 9, 40]) + r.choice("abcdefgh") * r.randint(0, 3), None, None) for i in range(600)]
    rows += [(1000 + i, "copied text", None, None) for i in range(300)]  # a third of all rows is one group
    compare(rows, op.assign_shards(docs(spark, rows)))
    compare(rows, op.assign_shards(docs(spark, rows), shards=3), 3)


def test_odd_rows(spark):
    compare(ROWS, op.assign_shards(docs(spark)))
    assert op.assign_shards(docs(spark, [])).count() == 0


def test_runs_equal_single_steps():
    r = random.Random(1)
    for _ in range(60):
        shards = r.randint(1, 6)
        runs = [(s, r.choice([1, 2, 7, 50, 300])) for s in sorted(r.sample(range(1, 400), 6), reverse=True)]
        heap = [(0, i) for i in range(shards)]
        for (size, n), loads in zip(runs, op.schedule(runs, shards)):
            assert sorted((x, i) for i, x in enumerate(loads)) == sorted(heap)
            took = []
            for _ in range(n):
                load, i = heap[0]
                took.append(i)
                heapq.heapreplace(heap, (load + size, i))
            got = op.place(np.arange(n), np.full(n, size), np.array([loads] * n))
            assert got.tolist() == took


def test_written_shards_hold_every_row(spark, tmp_path):
    rows = [(i, f"text {i % 50}", None, "s") for i in range(200)]
    plan = op.write_shards(docs(spark, rows).drop("shard", "slot"), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back, "doc_id", "shard") == rows_of(plan, "doc_id", "shard")


def test_written_rows_have_slots_of_their_own(spark, tmp_path):
    """Repeated rows, null ids, texts of one CRC-32 and columns named shard and slot."""
    rows = [(None, "plumless", "en", "a"), (None, "buckeroo", "en", "a")] + [(7, "same", None, "s")] * 5 + [(None, "null", None, None)] * 4 + [(i, f"t{i % 3}", None, "s") for i in range(20, 40)]
    df = docs(spark, rows)
    plan = op.write_shards(df, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {"shard_in", "slot_in"} <= set(back.columns) and back.count() == len(rows)
    assert rows_of(back, "doc_id", "shard", "slot") == rows_of(plan, "doc_id", "shard", "slot")
    texts = {(r["shard"], r["slot"]): r["text"] for r in back.collect()}
    assert len(texts) == len(rows) and sorted(map(str, texts.values())) == sorted(str(r[1]) for r in rows)
    assert len({s for (s, _), t in texts.items() if t == "same"}) == 1
