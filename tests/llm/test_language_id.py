import zlib

import numpy as np

from riskframe.llm import language_id as op

from .cases import ROWS, docs, rows_of

SF = "/root/testdata/sf0.01"


def test_gradients_match_differences():
    r = np.random.default_rng(0)
    net = op.ByteNetwork(["a", "b", "c"], hidden=3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y, mask = r.integers(0, 256, (9, 5)), r.integers(0, 3, 5), (r.random((9, 5)) < 0.8).astype(float)

    def loss():
        p = net.probabilities(x)
        return -(np.log(p[:, y, np.arange(5)] + 1e-9) * mask).sum() / mask.sum()

    _, g = net.gradients(x, y, mask)
    for name, w in net.w.items():
        places = [tuple(r.integers(0, n) for n in w.shape) for _ in range(6)]
        if name == "E":
            places = [(d, k, int(x[t, 0])) for d, k, t in ((0, 1, 2), (1, 4, 3), (0, 7, 0), (1, 8, 8))]
        for at in places:
            old, step = w[at], 1e-2
            w[at] = old + step
            up = loss()
            w[at] = old - step
            down = loss()
            w[at] = old
            assert abs((up - down) / (2 * step) - g[name][at]) < 2e-3, (name, at)


def test_every_byte_counts_once():
    net = op.ByteNetwork(["a", "b"])
    texts = [b"", b"x", b"y" * op.SPAN, b"z" * (op.SPAN + 1), bytes(range(250)) * 7]
    got = net.documents(texts)
    for t, p in zip(texts, got):
        total = np.zeros(2)
        for i in range(0, len(t), op.SPAN):
            piece = np.zeros((op.SPAN, 1), np.uint8)
            piece[: len(t[i : i + op.SPAN]), 0] = list(t[i : i + op.SPAN])
            total += net.probabilities(piece)[: len(t) - i, :, 0].sum(axis=0)
        assert np.allclose(p, total / max(1, len(t)), atol=1e-5)


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = op.identify(df).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    out = [r for r in got if r["held_out"]]
    assert len(out) > 200 and sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows(spark):
    got = op.identify(docs(spark), op.train(docs(spark), steps=3))
    assert got.count() == len(ROWS)
    assert {r["doc_id"] for r in got.collect() if r["lang_pred"] == op.UND} == {1, 2, 3, 7}
    net = op.train(docs(spark), steps=3)
    both = [tuple(r)[2:] for r in op.identify(docs(spark), net).where("doc_id = 5").collect()]
    assert both[0] == both[1]


def test_no_labels_and_no_rows(spark):
    unlabelled = docs(spark, [(0, "some text", None, None)])
    assert rows_of(op.identify(unlabelled), "lang_pred", "score") == [("und", 0.0)]
    assert op.identify(docs(spark, [])).count() == 0
    assert op.keep_known(docs(spark, [])).count() == 0


def test_without_labels_documents_with_letters_stay(spark):
    df = docs(spark, [(1, "a text", None, "a"), (2, None, None, "a"), (3, "12 ?!", None, "a"), (4, "日本", None, "a")])
    got = op.keep_known(df)
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 4]


def test_wanted_languages_and_least_score(spark):
    df = docs(spark)
    scored = {r["doc_id"]: r for r in op.identify(df).collect()}
    for languages, least in ((None, 0.0), (None, 0.4), (["de"], 0.0), (["en"], 0.4), ([], 0.0), (None, 1.1)):
        kept = {r["doc_id"] for r in op.keep_known(df, languages=languages, least=least).collect()}
        assert kept == {i for i, r in scored.items() if r["lang_pred"] != op.UND and r["score"] >= least and (languages is None or r["lang_pred"] in languages)}
