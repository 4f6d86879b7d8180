"""Suffix-array dedup: removes every byte covered by a string of ``LENGTH`` bytes that starts anywhere else as well.

A suffix array over the whole corpus would be one task's work, so candidates are gathered by content first:

1. **Runs.** Of the hashes of all ``gram``-byte strings within a window of ``LENGTH`` bytes the smallest is the window's
   value. Equal windows have equal values, whatever surrounds them. Neighbouring windows with one value form a run, about
   one for each (LENGTH - gram) / 2 bytes. Documents give their runs: value, digest of the run's bytes, place.
2. **Shared values.** A value that only one run has can't belong to a repeated window; counts (combined before the
   shuffle) and a join leave the runs whose value occurs again.
3. **Equal runs.** Runs with one value and one digest are copies of each other: all their windows are repeated. This
   settles the inside of copied documents and passages, also for a passage that a third of all documents hold, without
   moving its bytes.
4. **Suffix arrays.** What remains are different runs of one value (edges of shared passages, edited copies), one of each
   kind. Their bytes go to tasks by value, so that equal windows always meet. A task sorts the suffixes of its bytes in
   two stages: suffixes smaller than their successors are sorted directly, the others are induced by a scan over the
   buckets in ascending order; then the common prefixes of neighbours tell which windows occur twice.
   Values whose runs hold more than ``TASK`` bytes are not given to one task: their runs are cut again with a longer gram
   (``GRAMS``), down to single windows, where step 3 alone decides. So no group is capped and none is a single task's.
5. **Removal.** Repeated windows, as intervals, meet the text of one document of each different text.

Documents are named by a 128-bit hash of their text; copies are worked on once. Strings are judged on the input. Only the
texts that have a shared value are shuffled, besides one pass that looks for them.

Defined results: null text is empty; texts below LENGTH bytes lose nothing; ids, also null or repeated ones, pass through;
an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import id_text, table
from riskframe.llm.registry import register
from riskframe.llm.shingles import mixed
from riskframe.session import materialize

LENGTH = 400
#: Gram lengths, as shares of the window, of the successive levels; the last is the window itself. A run that doesn't repeat
#: itself has at most 273, 81, 21, 5, 1 windows, so the edges of a passage that very many documents hold settle in a few
#: runs, not window by window.
GRAMS = (0.32, 0.8, 0.95, 0.99, 1.0)
#: Bytes that a task sorts; windows of a long text that are looked at together; bytes hashed together.
TASK, PIECE, LOT = 2_000_000, 1_000_000, 400_000
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class Powers:
    """Powers of the base and of its inverse, modulo 2^64."""

    def __init__(self):
        self.n = 0

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 2 * self.n)
            steps = np.empty((2, self.n), dtype=np.uint64)
            steps[0], steps[1], steps[:, 0] = _BASE, pow(_BASE, -1, 1 << 64), 1
            self.up, self.down = np.cumprod(steps, axis=1)
        return self.up[:n], self.down[:n]


def grams_of(raw: np.ndarray, gram: int, powers: Powers) -> np.ndarray:
    """The hash of the ``gram`` bytes from each place on."""
    up, down = powers(len(raw) + 1)
    prefix = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * up[:-1], out=prefix[1:])
    return mixed((prefix[gram:] - prefix[:-gram]) * down[: len(raw) - gram + 1])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` values in a row."""
    low, size = values, 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(low) - (width - size)], low[width - size :]) if size < width else low


def runs_of(pieces: list[bytes], length: int, gram: int, powers: Powers) -> Iterator[tuple[int, int, int, int, int, bool]]:
    """(piece, start, windows, value, digest, again) of every run; ``again``: it may hold a window twice itself."""
    joined = b"".join(pieces)
    if len(joined) < length:
        return
    grams = grams_of(np.frombuffer(joined, np.uint8), gram, powers)
    value = smallest(grams, length - gram + 1)
    end = np.cumsum([len(p) for p in pieces])
    start = [0, *end[:-1].tolist()]
    valid = np.zeros(len(value), dtype=bool)
    for a, p in zip(start, pieces):
        valid[a : a + max(0, len(p) - length + 1)] = True
    # Between the windows of two pieces there are some that cross the border, so a piece's end ends its last run too.
    edge = np.flatnonzero((value[1:] != value[:-1]) | (valid[1:] != valid[:-1])) + 1
    first, beyond = np.concatenate([[0], edge]), np.concatenate([edge, [len(value)]])
    keep = valid[first]
    first, beyond = first[keep], beyond[keep]
    owner = np.searchsorted(end, first, side="right")
    raw = memoryview(joined)
    for a, b, p in zip(first.tolist(), beyond.tolist(), owner.tolist()):
        if gram < length:  # a second place with the run's value: the run may repeat a window
            again = bool((grams[a : b + length - gram] == value[a]).sum() > 1)
            digest = xxhash.xxh3_64_intdigest(raw[a : b - 1 + length])
        else:  # all windows of the run are one string
            again, digest = b - a > 1, xxhash.xxh3_64_intdigest(raw[a : a + length])
        yield p, a - start[p], b - a, int(value[a]), digest, again


def pieces_of(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of pieces with at most ``PIECE`` windows each; every window is in just one."""
    for a in range(0, max(0, len(text) - length + 1), PIECE):
        yield a, text[a : a + PIECE + length - 1]


_RUNS = "k1 bigint, k2 bigint, start bigint, windows int, value bigint, digest bigint, again boolean"


def run_table(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs of texts (k1, k2, start, raw): raw lies at ``start`` within the document k1, k2."""

    def emit(lot: list[tuple[int, int, int, bytes]], powers: Powers) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(7)]
        for p, start, windows, value, digest, again in runs_of([x[3] for x in lot], length, gram, powers):
            k1, k2, offset, _ = lot[p]
            for c, v in zip(out, (k1, k2, offset + start, windows, _signed(value), _signed(digest), again)):
                c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], [x.split()[0] for x in _RUNS.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for b in batches:
            lot, total = [], 0
            for k1, k2, at, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                for offset, piece in pieces_of(raw.as_py(), length):
                    lot.append((k1, k2, at + offset, piece))
                    total += len(piece)
                    if total >= LOT:
                        yield emit(lot, powers)
                        lot, total = [], 0
            if lot:
                yield emit(lot, powers)

    return texts.select("k1", "k2", "start", "raw").mapInArrow(task, _RUNS)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ---- two-stage suffix sorting ------------------------------------------------------------------------------------


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes, correct to ``depth`` bytes.

    Stage one sorts the suffixes that are smaller than their successors (type B), bucket by bucket of their first two
    bytes. Stage two goes through the buckets of first bytes in ascending order: a suffix larger than its successor
    (type A) takes the next free place of its bucket when its successor is met, and stands before the bucket's B suffixes.
    """
    t = np.frombuffer(text, np.uint8)
    n = len(t)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    differs = np.flatnonzero(t[:-1] != t[1:])
    smaller = np.zeros(n, dtype=bool)  # type B; the last suffix is larger than the empty one
    if len(differs):
        after = np.searchsorted(differs, np.arange(n))  # the next place that differs from its successor
        has = after < len(differs)
        at = differs[after[has]]
        smaller[has] = t[at] < t[at + 1]
    own = np.flatnonzero(smaller)
    key = t[own].astype(np.int64) << 8 | t[own + 1]
    order = np.argsort(key, kind="stable")
    own, key = own[order], key[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, dtype=np.int64)
    sorted_b: list[list[np.ndarray]] = [[] for _ in range(256)]
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        part = own[a:b].tolist()
        if len(part) > 1:
            part.sort(key=lambda i: text[i : i + depth])
        sorted_b[int(key[a]) >> 8].append(np.array(part, dtype=np.int64))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[int(t[n - 1])].append(np.array([n - 1], dtype=np.int64))
    out = []
    for c in range(256):
        bucket = []
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, dtype=np.int64)
        while len(wave):
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[(t[before] == c) & ~smaller[before]]
        bucket += sorted_b[c]
        if not bucket:
            continue
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        before = before[~smaller[before] & (t[before] > c)]
        if len(before):
            first = t[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            edge = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1], [True]]))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                waiting[int(first[a])].append(before[a:b])
    return np.concatenate(out)


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, which of its windows of ``length`` bytes start somewhere else in the parts as well."""
    text = b"\xff".join(parts) + b"\xff"  # a byte that UTF-8 never has ends each part
    size = np.array([len(p) for p in parts])
    start = np.cumsum(size + 1) - size - 1
    whole = np.zeros(len(text), dtype=bool)
    for a, n in zip(start.tolist(), size.tolist()):
        whole[a : a + max(0, n - length + 1)] = True
    order = suffix_array(text, length)
    order = order[whole[order]].tolist()
    hit = np.zeros(len(text), dtype=bool)
    for x, y in zip(order, order[1:]):  # neighbours whose common prefix has at least ``length`` bytes
        if text[x : x + length] == text[y : y + length]:
            hit[x] = hit[y] = True
    return [hit[a : a + max(0, n - length + 1)] for a, n in zip(start.tolist(), size.tolist())]


_FOUND = "k1 bigint, k2 bigint, start bigint, windows int"


def sorted_groups(contexts: DataFrame, length: int, tasks: int) -> DataFrame:
    """Repeated windows of the contexts (value, k1, k2, start, raw), as intervals; one suffix array for each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> pa.RecordBatch:
            out: list[tuple] = []
            for (_, k1, k2, start, _), hit in zip(rows, repeated_windows([r[4] for r in rows], length)):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                out += [(k1, k2, start + a, b - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
            columns = list(zip(*out)) or [(), (), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in _FOUND.split(", ")])

        rows, total, last = [], 0, None
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns]):
                if total >= TASK and r[0] != last:  # between two values; values come in order
                    yield done(rows)
                    rows, total = [], 0
                rows.append(r)
                total += len(r[4])
                last = r[0]
        if rows:
            yield done(rows)

    dealt = contexts.select("value", "k1", "k2", "start", "raw").repartition(tasks, "value").sortWithinPartitions("value")
    return dealt.mapInArrow(task, _FOUND)


# ---- levels ------------------------------------------------------------------------------------------------------


def bytes_of(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs ``wanted`` (value, k1, k2, start, windows) from texts (k1, k2, start, raw)."""
    asked = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("value", "start", "windows")).alias("asked"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                k1, k2, at, raw, some = (c[i].as_py() for c in b.columns)
                rows = []
                for r in some:
                    a = r["start"] - at
                    if 0 <= a and a + r["windows"] + length - 1 <= len(raw):
                        rows.append((r["value"], k1, k2, r["start"], raw[a : a + r["windows"] + length - 1]))
                if rows:
                    kinds = [pa.int64()] * 4 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["value", "k1", "k2", "start", "raw"])

    both = texts.join(asked, ["k1", "k2"]).select("k1", "k2", "start", "raw", "asked")
    return both.mapInArrow(task, "value bigint, k1 bigint, k2 bigint, start bigint, raw binary").dropDuplicates(["value", "k1", "k2", "start"])


def shared_runs(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The runs whose value occurs more than once."""
    runs = materialize(run_table(texts, length, gram), "suffix-runs")
    counts = runs.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"))
    return materialize(runs.join(counts.where((F.col("n") > 1) | F.col("again")).select("value"), "value", "left_semi"), "suffix-shared")


def classes_of(shared: DataFrame, length: int) -> DataFrame:
    """value, digest, n, again, rep (one run of each kind), kinds and bytes (of all kinds of the value)."""
    one = F.struct("k1", "k2", "start", "windows")
    classes = shared.groupBy("value", "digest").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"), F.min(one).alias("rep"))
    classes = materialize(classes, "suffix-classes")
    sums = classes.groupBy("value").agg(F.count(F.lit(1)).alias("kinds"), F.max("again").alias("any"), F.sum(F.col("rep.windows") + length).alias("bytes"))
    return classes.join(sums, "value")


def repeated_intervals(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(intervals k1, k2, start, windows of repeated windows; texts k1, k2, raw that have any candidate).

    ``docs``: doc_id, text, k1, k2."""
    raw = F.col("text").cast("binary").alias("raw")
    long = docs.where(F.octet_length("text") >= length)
    texts = long.select("k1", "k2", F.lit(0).cast("bigint").alias("start"), raw)
    found, touched = None, None
    for level, share in enumerate(GRAMS):
        gram = max(1, min(length, round(share * length)))
        shared = shared_runs(texts, length, gram)
        if touched is None:  # one document of each text that has a shared value
            keys = shared.select("k1", "k2").distinct()
            one = long.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id")).join(keys, ["k1", "k2"])
            one = one.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("doc_id").alias("o_id"))
            same = (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")) & F.col("doc_id").eqNullSafe(F.col("o_id"))
            touched = long.join(one, same, "left_semi").select("k1", "k2", F.lit(0).cast("bigint").alias("start"), raw)
            touched = materialize(touched.dropDuplicates(["k1", "k2"]), "suffix-texts")
        classes = materialize(classes_of(shared, length), "suffix-classes")
        equal = (F.col("n") > 1) | (F.col("again") & F.lit(gram == length))
        settled = shared.join(classes.where(equal).select("value", "digest"), ["value", "digest"], "left_semi").select("k1", "k2", "start", "windows")
        found = settled if found is None else found.unionByName(settled)
        if gram == length:
            break
        left = classes.where((F.col("kinds") > 1) | F.col("any")).select("value", "rep.*", "bytes")
        total = left.where(F.col("bytes") <= TASK).agg(F.sum(F.col("windows") + length)).first()[0] or 0
        if total:
            spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
            contexts = bytes_of(touched, left.where(F.col("bytes") <= TASK), length)
            found = found.unionByName(materialize(sorted_groups(contexts, length, max(spread, total // TASK + 1)), "suffix-found"))
        over = left.where(F.col("bytes") > TASK)
        if over.isEmpty():
            break
        texts = materialize(bytes_of(touched, over, length), "suffix-open").select("k1", "k2", "start", "raw")
    return found, touched


def removed(touched: DataFrame, intervals: DataFrame, length: int = LENGTH) -> DataFrame:
    """k1, k2, n_removed, n_spans, kept_sha256, spans (array of start, end in bytes) of the texts that lose any byte."""
    asked = intervals.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "windows")).alias("found"))
    schema = "k1 bigint, k2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<a: bigint, b: bigint>>"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(len(b)):
                k1, k2, raw, some = (c[i].as_py() for c in b.columns)
                spans: list[list[int]] = []
                for r in sorted(some, key=lambda r: r["start"]):
                    a, e = r["start"], r["start"] + r["windows"] - 1 + length
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([a, e])
                digest, at = hashlib.sha256(), 0
                for a, e in spans:
                    digest.update(raw[at:a])
                    at = e
                digest.update(raw[at:])
                rows.append((k1, k2, sum(e - a for a, e in spans), len(spans), digest.hexdigest(), [{"a": a, "b": e} for a, e in spans]))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["k1", "k2", "n_removed", "n_spans", "kept_sha256", "spans"])

    both = touched.join(asked, ["k1", "k2"]).select("k1", "k2", "raw", "found")
    return both.mapInArrow(task, schema)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and the text's name k1, k2."""
    return id_text(docs, id_col, text_col).select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans."""
    rows = keyed(docs, id_col, text_col)
    found, touched = repeated_intervals(rows, length)
    lost = materialize(removed(touched, found, length), "suffix-removed")
    whole = rows.select("doc_id", "k1", "k2", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    out = whole.join(lost, ["k1", "k2"], "left")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        "spans",
    )


@register("op7_suffix_dedup")
def op7_suffix_dedup(spark, sf_dir) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
