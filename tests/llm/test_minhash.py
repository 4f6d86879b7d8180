import random
import re
import string
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from riskframe.llm import minhash as op

from .cases import ROWS, docs, rows_of

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def expected(rows, k, percent):
    sets = [shingles(t, k) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    lowest = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            lowest[find(i)] = min(lowest.get(find(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        c = lowest.get(find(i)) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), c, r[0] == c))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_odd_rows(spark):
    assert rows_of(op.near_duplicates(docs(spark), 3, 85), *COLUMNS) == expected(ROWS, 3, 85)
    assert op.near_duplicates(docs(spark, []), 3, 85).count() == 0


def test_partitions_without_words(spark):
    """Every way to deal the odd rows to tasks, and a table whose rows all lack words."""
    odd = docs(spark)
    for n in range(1, 17):
        assert rows_of(op.sketched(odd.repartition(n), 3, 16, 8), "doc_id", "n_shingles") == [(i, len(shingles(t, 3))) for i, t, *_ in sorted(ROWS, key=lambda r: (r[0] is None, r[0]))]
    empty = [(1, None, "en", "a"), (2, "", None, None), (3, " \t\n", "en", "b"), (3, " ", "en", "b")]
    assert rows_of(op.near_duplicates(docs(spark, empty).coalesce(1), 3, 85), *COLUMNS) == expected(empty, 3, 85)
    assert rows_of(op.deduplicate(docs(spark, empty).coalesce(1)), "doc_id") == [(1,), (2,), (3,), (3,)]


def test_chains_edits_and_shared_passages(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for g in range(25):
        text = [word() for _ in range(r.randint(30, 150))]
        for _ in range(r.randint(1, 6)):  # a chain: each one an edit of the one before
            rows.append((len(rows) * 3 + 1, " ".join(text), None, None))
            text = [w if r.random() > 0.03 else word() for w in text]
    rows += [(1000 + i, passage + " " + " ".join(word() for _ in range(r.choice([3, 5, 7, 20, 100]))), None, None) for i in range(60)]
    r.shuffle(rows)
    got = rows_of(op.near_duplicates(docs(spark, rows), 3, 85), *COLUMNS)
    assert got == expected(rows, 3, 85)


def test_sketch_estimates_similarity_and_fills_every_coordinate():
    r = np.random.default_rng(2)
    t = 512
    for both, only in ((300, 100), (50, 50), (3, 1), (1, 0)):
        common, rest = r.integers(0, 2**63, both).astype(np.uint64), r.integers(0, 2**63, (2, only)).astype(np.uint64)
        s = op.sketches([np.unique(np.concatenate([common, x])) for x in rest], t)
        assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        similarity = both / (both + 2 * only)
        assert abs((s[0] == s[1]).mean() - similarity) < 0.12


def test_bands_meet_the_miss_bound():
    for percent in (80, 85, 95):
        n = op.bands_for(percent)
        assert (1 - (percent / 100) ** op.ROWS) ** n <= op.MISS < (1 - (percent / 100) ** op.ROWS) ** (n - 1)


def test_deduplicate(spark):
    kept = op.deduplicate(docs(spark))
    assert kept.columns == docs(spark).columns
    want = {r[0] for r in expected(ROWS, 5, 80) if r[3]}
    assert Counter(r[0] for r in rows_of(kept, "doc_id")) == Counter(want)
    assert op.deduplicate(docs(spark, [])).count() == 0


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    """Near copies that share an id, and groups without ids."""
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(4, text, None, "a"), (4, text + " x", None, "a"), (4, text + " y", None, "a"), (9, text + " z", None, "a")]
    rows += [(None, other, None, "a"), (None, other + " x", None, "a"), (None, other + " y", None, "a"), (4, "short text of its own", None, "a")]
    for some in (rows, rows[::-1]):
        got = rows_of(op.deduplicate(docs(spark, some)), "doc_id", "text")
        assert [i for i, _ in got] == [4, 4, None] and sum(t.startswith("w0 ") for _, t in got) == 1 and (4, "short text of its own") in got


def test_many_copies_below_the_threshold_without_their_source(spark, monkeypatch):
    """Edited copies of one text, each with words of its own, too far from each other to link; a few pairs among them link.
    No all-pairs step: the pairs that are verified stay far below the square of the group."""
    r = random.Random(11)
    base = [f"w{i}" for i in range(200)]

    def edited(no, share):
        out = list(base)
        for i in r.sample(range(200), int(200 * share)):
            out[i] = f"own{no}x{i}"
        return out

    rows = []
    for no in range(150):
        text = edited(no, 0.05)
        rows.append((no * 2, " ".join(text), None, None))
        if no % 10 == 0:
            rows.append((no * 2 + 1, " ".join([*text, "end"]), None, None))
    seen = []
    rare = op.rare_pairs
    monkeypatch.setattr(op, "rare_pairs", lambda *a: seen.append(rare(*a)) or seen[0])
    got = rows_of(op.near_duplicates(docs(spark, rows), 3, 85), *COLUMNS)
    assert got == expected(rows, 3, 85)
    assert seen and seen[0].count() < 10 * len(rows)


def test_rare_pairs_keep_every_link(spark):
    """Random sets over a small vocabulary, each node a component: all pairs above the threshold are among the pairs."""
    r = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        text = [w for w in base if r.random() > 0.03]
        for k in r.sample(range(len(text)), r.choice([0, 1, 2, 5])):
            text[k] = r.choice(base)
        rows.append((i, " ".join(text), None, None))
    df = docs(spark, rows)
    nodes = op.sketched(df, 1, 16, 8).groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"))
    placed = nodes.selectExpr("node", "n", "node as comp")
    ids = {bytes(x.node): x.first_id for x in nodes.collect()}
    pairs = {tuple(sorted((ids[bytes(x.a)], ids[bytes(x.b)]))) for x in op.rare_pairs(placed, df, nodes, 1, 80, "doc_id", "text").collect()}
    sets = {i: shingles(rows[i][1], 1) for i in ids.values()}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert linked and linked <= pairs
