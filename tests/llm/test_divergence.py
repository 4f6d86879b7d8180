import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import divergence as op

from .cases import ROWS, docs, rows_of

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(rows, least=10, top=10):
    n, held = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        c = Counter(terms(text))
        n[lang or "", source or ""] += c
        held[lang or ""].update(c.keys())
    out = []
    for lang, had in held.items():
        kept = {t for t, d in had.items() if d >= least}
        groups = {s: {t: c[t] for t in kept} for (g, s), c in n.items() if g == lang}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (x + 2) // (sum(c.values()) + 2 * len(kept)) for t, x in c.items()}
        p, q = {s: share(c) for s, c in groups.items()}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            parts = {"pair": {o: sum(f(p[s][t], p[o][t]) for t in kept) for o in groups if o != s}}
            parts["term"] = {t: f(p[s][t], q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]}
            for part, items in parts.items():
                ranked = sorted(items.items(), key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(ranked) if part == "pair" or k < top]
    return sorted(out)


COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def test_odd_rows(spark):
    for least in (1, 2, 10):
        assert rows_of(op.audit(docs(spark), least), *COLUMNS) == expected(ROWS, least)
    assert op.audit(docs(spark, [])).count() == 0


def some_rows(seed, sources, n=400):
    r = random.Random(seed)
    words = [r.choice(["été", "Ab", "x", "the", "naïveté", "straßenbahnhaltestelle", "日本"]) + "abcdefghij"[: r.randint(0, 10)] * r.randint(1, 3) for _ in range(60)]
    pick = lambda: r.choice(["", ". ", "9", "_", " "]).join(r.choice(words[: r.choice([3, 20, 60])]) + " " for _ in range(r.randint(0, 40)))
    return [(i, pick(), r.choice(["en", "de", None]), r.choice([None, *sources]) if r.random() < 0.6 else sources[0]) for i in range(n)]


def test_against_brute_force(spark):
    rows = some_rows(1, [f"s{i}" for i in range(7)])
    assert rows_of(op.audit(docs(spark, rows)), *COLUMNS) == expected(rows)


def test_many_tiles_and_blocks_give_the_same(spark):
    """Units of a few sources and a few counts, so that most terms of a pair are met by neither of its tiles in some block."""
    rows = some_rows(2, [f"s{i}" for i in range(23)], 500)
    assert rows_of(op.audit(docs(spark, rows), 3, tile=4, rows=90), *COLUMNS) == expected(rows, 3)


def test_groups_without_terms_take_part(spark):
    rows = [(i, "word " * (i % 3), "en", "a") for i in range(40)] + [(50, None, "en", "b"), (51, "!!", "en", None), (52, "", "fr", "a"), (53, "rare", "fr", "b")]
    got = rows_of(op.audit(docs(spark, rows)), *COLUMNS)
    assert got == expected(rows)
    assert {(r[1], r[3], r[4]) for r in got if r[0] == "fr"} == {("a", "b", 0), ("b", "a", 0)}


@pytest.mark.parametrize("small", [1, 2, 7, 2048])
def test_pointer_sort_orders_words_and_keeps_equal_ones_in_place(small, monkeypatch):
    monkeypatch.setattr(op, "SMALL", small)
    r = random.Random(small)
    for _ in range(60):
        texts = ["".join(r.choice("aAbBcé日 z0.\n") for _ in range(r.choice([0, 1, 5, 50, 400]))) for _ in range(r.randint(1, 12))]
        texts.append("abcdefghijklmnop" * 3 + " abcdefgh abcdefghi ABCDEFGHIJKLMNOP" * 4)
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0] + [len(t) for t in raw])
        words = op.Words(np.frombuffer(b"".join(raw), np.uint8), offsets)
        order, heads = op.pointer_sort(words)
        low = [bytes(words.low[a : a + n]).decode() for a, n in zip(words.start, words.length)]
        assert low == [t for x in texts for t in terms(x)]
        want = sorted(range(len(low)), key=lambda i: (low[i].encode(), i))
        assert order.tolist() == want
        assert heads.tolist() == [k for k, i in enumerate(want) if not k or low[want[k - 1]] != low[i]]


def test_long_text_is_one_slice(spark, monkeypatch):
    monkeypatch.setattr(op, "SLICE", 64)
    rows = [(i, "some words here " * (1 + 300 * (i == 4)), "en", "ab"[i % 2]) for i in range(30)]
    assert rows_of(op.audit(docs(spark, rows)), *COLUMNS) == expected(rows)
