import zlib

import numpy as np
import pytest

from riskframe.llm import toxicity as op

from .cases import ROWS, docs

SF = "/root/testdata/sf0.1"


def test_table_equals_the_kernel_over_landmarks():
    """<W, x> is the sum of a_l K(x, l), and K is the subsequence kernel by its definition."""

    def slow(u):
        c = op.stretches(u)[0]
        out = {}
        for i in range(len(c)):
            for k in range(i + 2, min(len(c), i + op.REACH)):
                for j in range(i + 1, k):
                    key = (c[i], c[j], c[k])
                    out.setdefault(key, []).append(op.DECAY ** (k - i + 1))
        size = np.sqrt(sum(w * w for v in out.values() for w in v))
        return {k: sum(v) / size for k, v in out.items()}

    def kernel(u, v):
        a, b = slow(u), slow(v)
        return sum(a[k] * b[k] for k in a if k in b)

    alpha = {"idiot": 0.7, "moron": -0.2, "potato": 1.1}
    table = np.zeros(op.SYMBOLS**3)
    t = op.Triples()
    for u, a in alpha.items():
        number, weight = op.features(op.stretches(u)[0][None, :], t)
        np.add.at(table, number[0], a * weight)
    m = op.Machine(table, 0.25, (0, 0, 0))
    units = ["idxiot", "oron", "tomato", "zz", "idiot"]
    want = [0.25 + sum(a * kernel(u, l) for l, a in alpha.items()) for u in units]
    assert np.allclose(m.values(units), want, atol=1e-5)
    assert kernel("idiot", "idxiot") > 2 * kernel("idiot", "tractor")


def test_units():
    assert op.plain("i.d.i.o.t,") == "idiot" and op.plain("1d10t") == "idiot" and op.plain("2024") == ""
    assert op.spelled("so i d i o t ok a b".split()) == ["idiot"]
    long = "x" * 100
    assert sum(len(s) for s in op.stretches(long)) >= 102 and max(map(len, op.stretches(long))) <= op.STRETCH


@pytest.fixture(scope="module")
def machine(spark):
    return op.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


def test_held_out_ranking(spark, machine):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    df = spark.read.parquet(f"{SF}/documents.parquet").join(labels.select("doc_id", "toxic"), "doc_id")
    got = op.score(df, machine=machine).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    bad, good = (np.array([r["score"] for r in out if r["toxic"] == t]) for t in (1, 0))
    assert (bad[:, None] > good[None, :]).mean() > 0.95
    assert np.mean(bad >= op.CUT) > 0.85 and np.mean(good >= op.CUT) < 0.05


def test_odd_rows(spark, machine):
    got = op.score(docs(spark), machine=machine).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= op.CUT) for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (1, 2, 3, 7)}
    assert len(empty) == 1
    assert op.score(docs(spark, []), machine=machine).count() == 0


def test_one_class_or_no_labels(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    assert {r["predicted"] for r in op.score(docs(spark), labels).collect()} == {0}
    assert {r["predicted"] for r in op.score(docs(spark), labels.limit(0)).collect()} == {0}


def test_large_copy_groups_count_once():
    """Hundreds of copies with a toxic label, equal and edited ones, don't make their ordinary words toxic."""
    r = np.random.default_rng(3)
    word = lambda: "".join(r.choice(list("bcdfglmnprst")) + r.choice(list("aeiou")) for _ in range(4))
    common, base = [word() for _ in range(300)], [word() for _ in range(40)]
    copies = [" ".join(base)] * 40 + [" ".join(word() if r.random() < 0.15 else w for w in base) for _ in range(260)]
    clean = [" ".join(r.choice(common, 25)) for _ in range(300)]
    toxic = [" ".join([*r.choice(common, 25), "idiot"]) for _ in range(60)]
    texts, y = copies + toxic + clean, np.array([True] * 360 + [False] * 300)
    group = op.groups_of([sorted({u for s in op.sentences(t) for u in s}) for t in texts])
    assert len(set(group[:300])) == 1 and len(set(group[300:])) == 360
    m = op.fit(texts, y, (360 / 660, 300 / 660))
    assert m.values(["idiot"])[0] > 0 and (m.values(base) > 0).mean() < 0.1


def test_runs_have_the_values_of_their_joined_words():
    m = op.Machine(np.random.default_rng(1).normal(size=op.SYMBOLS**3) * 0.1, -0.3, (0.0, 0.0, 0.0))
    texts = ["You are a st up id one. Next", "", "one", "a b\nc d é ,,, 12 f-g", "x" * 40 + " ab cd " + "word " * 300 + "y"]
    runs = m.runs(texts)
    assert [len(list(s)) for s in op.worded("a st. up id")] == [2, 2] and set(op.neighbours(["st", "up", "id"])) == {"stup", "upid", "stupid"}
    for t, got in zip(texts, runs.by_text()):
        units = sorted({u for s in op.worded(t) for u in op.neighbours(s)})
        assert np.isclose(got, m.values(units).max() if units else -9.0, atol=1e-4)
    long = "some words here. " * 10_000 + "st up id"
    assert len(list(op.parts(long))) > 1 and np.isclose(m.signs([long])[0, 0], max(m.strongest([long])[0][0], m.runs([long]).by_text()[0]), atol=1e-4)


def test_gapped_insults_and_combinations():
    """Insults cut by blanks, and ordinary words that are toxic side by side only."""
    r = np.random.default_rng(4)
    word = lambda: "".join(r.choice(list("bcdfglmnprst")) + r.choice(list("aeiou")) for _ in range(3))
    common = [word() for _ in range(300)]
    some = lambda *more: " ".join([*r.choice(common, 12), *more, *r.choice(common, 12)])
    toxic = [some(w) for w in ("idiot", "moron", "stupid") for _ in range(40)] + [some("drop", "dead") for _ in range(60)]
    clean = [some() for _ in range(150)] + [some(w) for w in ("drop", "dead") for _ in range(75)]
    m = op.fit(toxic + clean, np.array([True] * 180 + [False] * 300), (0.375, 0.625))
    score = lambda texts: m.score(m.signs(texts))
    for gapped in ("id iot", "mo ron", "st up id", "drop dead"):
        assert (score([some(gapped) for _ in range(20)]) >= op.CUT).mean() > 0.9, gapped
    assert (score([some(w) for w in ("drop", "dead", "it") for _ in range(50)]) >= op.CUT).mean() < 0.1
