"""The sink's commit log: retries, failures before the commit, pinned readers, compaction beside a running stream, counts by
retraction (M1, M2)."""

import random

import pytest
from pyspark.sql import functions as F

from riskframe.session import scratch_path
from riskframe.streaming import commits, upsert

SCHEMA = "ACCT_NBR long, SEQ long, SCORE double"


def batches(seed, n_batches=6, rows=120, accounts=25):
    """Rows in any order: late ones, failed ones, a hot account."""
    r = random.Random(seed)
    out, seqs = [], r.sample(range(10_000), n_batches * rows)
    for b in range(n_batches):
        out.append([(1 if r.random() < 0.3 else r.randrange(accounts), seqs.pop(), None if r.random() < 0.2 else r.random()) for _ in range(rows)])
    return out


def state_after(parts):
    """Per account the newest scored row and the rows so far: what update mode emits is this, for a batch's accounts."""
    newest, n = {}, {}
    for a, s, v in [x for p in parts for x in p]:
        n[a] = n.get(a, 0) + 1
        if v is not None and s > newest.get(a, (-1, None))[0]:
            newest[a] = (s, v)
    return {a: (*newest.get(a, (None, None)), n[a]) for a in n}


def emitted(spark, parts, i):
    state = state_after(parts[: i + 1])
    return spark.createDataFrame([(a, *state[a]) for a in {x[0] for x in parts[i]}], "ACCT_NBR long, SEQ long, SCORE double, N_ROWS long")


def table(spark, sink, number=None):
    return {r.ACCT_NBR: (r.SEQ, r.SCORE) for r in upsert.current_table(spark, sink, number=number).collect()}


def scored(state):
    return {a: (s, v) for a, (s, v, _) in state.items() if v is not None}


def counts(df):
    return {r.NAME: r.N for r in df.collect()}


def test_counts_by_retraction_equal_the_whole_aggregate_in_every_version(spark):
    parts, sink = batches(1), scratch_path(spark, "sink")
    for i in range(len(parts)):
        upsert.write_batch(emitted(spark, parts, i), sink, i)
        state = state_after(parts[: i + 1])
        got = counts(upsert.latest_counts(spark, sink))
        assert got == counts(upsert.recounted(spark, sink))
        assert got["processed"] == sum(n for *_, n in state.values()) and got["stored"] == len(scored(state))
        if i == 2:
            upsert.compact(spark, sink)
            assert counts(upsert.latest_counts(spark, sink)) == got
    assert table(spark, sink) == scored(state_after(parts))


def test_retried_and_failed_batches(spark, monkeypatch):
    """A failure between write and commit leaves nothing; a retry of a committed batch changes nothing."""
    parts, sink = batches(2, 3), scratch_path(spark, "sink")
    upsert.write_batch(emitted(spark, parts, 0), sink, 0)
    before = (upsert.version(spark, sink), table(spark, sink), counts(upsert.latest_counts(spark, sink)))

    def dies(self, change):
        raise OSError("lost before the commit")

    with monkeypatch.context() as m:
        m.setattr(commits.Log, "commit", dies)
        with pytest.raises(OSError):
            upsert.write_batch(emitted(spark, parts, 1), sink, 1)
    assert (upsert.version(spark, sink), table(spark, sink), counts(upsert.latest_counts(spark, sink))) == before
    upsert.write_batch(emitted(spark, parts, 1), sink, 1)
    after = (upsert.version(spark, sink), table(spark, sink), counts(upsert.latest_counts(spark, sink)))
    assert after[1] == scored(state_after(parts[:2]))
    for again in (0, 1):
        upsert.write_batch(emitted(spark, parts, again), sink, again)
    assert (upsert.version(spark, sink), table(spark, sink), counts(upsert.latest_counts(spark, sink))) == after


def test_a_version_file_that_is_not_whole_does_not_count(spark):
    parts, sink = batches(3, 2), scratch_path(spark, "sink")
    upsert.write_batch(emitted(spark, parts, 0), sink, 0)
    log = commits.Log(spark, sink)
    out = log._fs.create(log._path(f"log/{2:020d}.json"), False)
    out.write(b'{"number": 2, "ba')
    out.close()
    assert upsert.version(spark, sink) == 1 and table(spark, sink) == scored(state_after(parts[:1]))
    upsert.write_batch(emitted(spark, parts, 1), sink, 1)
    assert upsert.version(spark, sink) == 3 and table(spark, sink) == scored(state_after(parts))


def test_pinned_readers_keep_their_version(spark):
    parts, sink = batches(4, 4), scratch_path(spark, "sink")
    pinned = []
    for i in range(4):
        upsert.write_batch(emitted(spark, parts, i), sink, i)
        pinned.append(upsert.version(spark, sink))
    open_reader = upsert.current_table(spark, sink, number=pinned[1])
    upsert.compact(spark, sink)
    for i, n in enumerate(pinned):
        assert table(spark, sink, n) == scored(state_after(parts[: i + 1]))
        assert counts(upsert.latest_counts(spark, sink, n)) == counts(upsert.recounted(spark, sink, number=n))
    assert {r.ACCT_NBR: (r.SEQ, r.SCORE) for r in open_reader.collect()} == scored(state_after(parts[:2]))
    with pytest.raises(ValueError):
        upsert.current_table(spark, sink, number=99)


def test_compaction_between_and_beside_batches(spark, monkeypatch):
    """A batch commits while the compaction writes its base: it stays in the list after it. Two compactions: one wins."""
    parts, sink = batches(5, 5), scratch_path(spark, "sink")
    for i in range(3):
        upsert.write_batch(emitted(spark, parts, i), sink, i)
    write = upsert._write

    def slow(df, path, key):
        write(df, path, key)
        if "/base-" in path and i == 2:
            monkeypatch.setattr(upsert, "_write", write)
            upsert.write_batch(emitted(spark, parts, 3), sink, 3)

    monkeypatch.setattr(upsert, "_write", slow)
    upsert.compact(spark, sink)
    at = commits.Log(spark, sink).latest()
    assert at.base and [b for b, _ in at.changes] == [3] and at.last_batch == 3
    assert table(spark, sink) == scored(state_after(parts[:4]))
    upsert.write_batch(emitted(spark, parts, 4), sink, 4)
    upsert.compact(spark, sink)
    assert not commits.Log(spark, sink).latest().changes
    assert table(spark, sink) == scored(state_after(parts)) and counts(upsert.latest_counts(spark, sink)) == counts(upsert.recounted(spark, sink))
    n = upsert.version(spark, sink)
    upsert.compact(spark, sink)
    assert upsert.version(spark, sink) == n  # nothing to fold


def test_two_writers_of_one_number(spark):
    sink = scratch_path(spark, "sink")
    log, calls = commits.Log(spark, sink), []

    def change(at):
        calls.append(at.number)
        if len(calls) == 1:
            commits.Log(spark, sink).commit(lambda v: commits.Version(0, "data/other", v.changes, v.last_batch, v.counts))
        return commits.Version(0, at.base, ((7, "data/mine"),), 7, {"high": 1})

    done = log.commit(change)
    assert calls == [0, 1] and done.number == 2 and done.base == "data/other" and log.latest() == done


def test_vacuum_keeps_what_versions_name(spark):
    parts, sink = batches(6, 5), scratch_path(spark, "sink")
    for i in range(5):
        upsert.write_batch(emitted(spark, parts, i), sink, i)
    upsert.compact(spark, sink)
    upsert.write_batch(emitted(spark, [*parts, parts[0]], 5), sink, 5)
    want = table(spark, sink)
    upsert.vacuum(spark, sink, keep=2)
    assert len(commits.Log(spark, sink).numbers()) == 2 and table(spark, sink) == want


def test_empty_sink_and_empty_batch(spark):
    sink = scratch_path(spark, "sink")
    assert upsert.version(spark, sink) == 0 and upsert.current_table(spark, sink).count() == 0 and upsert.latest_counts(spark, sink).count() == 0
    upsert.write_batch(emitted(spark, batches(7, 1), 0).limit(0), sink, 0)
    assert upsert.version(spark, sink) == 1 and upsert.current_table(spark, sink).count() == 0
    assert set(counts(upsert.latest_counts(spark, sink)).values()) == {0}
    parts = batches(8, 1)
    upsert.write_batch(emitted(spark, parts, 0), sink, 1)
    assert table(spark, sink) == scored(state_after(parts))


def test_a_stream_goes_on_after_a_compaction(spark):
    """Files arrive in two runs of the query, with a compaction between them."""
    src, sink, ck = scratch_path(spark, "src"), scratch_path(spark, "sink"), scratch_path(spark, "ck")
    parts = batches(9, 4, 80)
    run = lambda: upsert.run_upsert_stream(spark, f"{src}/f=*", SCHEMA, sink, ck, lambda r: r, files_per_trigger=1, state_partitions=4)
    for i, p in enumerate(parts):
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.parquet(f"{src}/f={i}")
        if i == 1:
            run()
            upsert.compact(spark, sink)
    run()
    assert table(spark, sink) == scored(state_after(parts))
    assert counts(upsert.latest_counts(spark, sink)) == counts(upsert.recounted(spark, sink))
    assert upsert.current_table(spark, sink).where(F.col("LEVEL").isNull()).count() == 0


def test_a_long_stream_lists_few_tables(spark):
    """As many micro-batches as it takes: a version never lists more than FOLD change tables, counts and rows stay right."""
    sink = scratch_path(spark, "sink")
    for i in range(upsert.FOLD + 2):
        rows = [(k, 10 * i + k, 0.1 * (k + 1) * (i % 2 + 1) / 2, i + 1) for k in range(4)]
        upsert.write_batch(spark.createDataFrame(rows, "ACCT_NBR bigint, SEQ bigint, SCORE double, N_ROWS bigint"), sink, i)
        assert len(commits.Log(spark, sink).latest().changes) < upsert.FOLD
    at = commits.Log(spark, sink).latest()
    assert at.base and len(at.changes) == 2 and at.last_batch == upsert.FOLD + 1
    got = {r.ACCT_NBR: (r.SEQ, r.SCORE) for r in upsert.current_table(spark, sink).collect()}
    assert got == {k: (s, v) for k, s, v, _ in rows}
    name = lambda df: {r.NAME: r.N for r in df.collect()}
    assert name(upsert.latest_counts(spark, sink)) == name(upsert.recounted(spark, sink))
