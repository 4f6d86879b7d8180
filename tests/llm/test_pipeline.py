import hashlib
import re

import corpus_pipeline as P
from riskframe.llm import bpe, language_id, minhash
from riskframe.session import materialize

from .cases import ROWS, docs, rows_of
from .test_minhash import shingles


def test_stages_one_after_another(spark):
    """Each stage on what the one before kept, against the operators' rules by brute force."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns = df.columns
    before = [r for r in df.collect()]
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "bpe"]
    for name, stage in P.STAGES:
        df = materialize(stage(spark, df, "/root/testdata/sf0.001"), f"test-{name}")
        after = df.collect()
        if name != "bpe":
            assert df.columns == columns
        if name == "language_id":
            found = {r["doc_id"]: r for r in language_id.identify(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()}
            assert {i for i, r in found.items() if r["lang_pred"] != "und" and r["score"] >= language_id.LEAST} == {r["doc_id"] for r in after}
            assert len(after) >= 0.99 * sum(re.search(r"[^\W\d_]", r["text"] or "") is not None for r in before)
        if name == "exact_dedup":
            first = {}
            for r in sorted(before, key=lambda r: r["doc_id"]):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
            assert sorted(first.values()) == sorted(r["doc_id"] for r in after)
        if name == "near_dedup":
            sets = {r["doc_id"]: shingles(r["text"], 5) for r in before}
            kept = sorted(r["doc_id"] for r in after)
            near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b) > 0
            group = {}
            for i in sorted(sets):
                linked = {group[j] for j in group if near(sets[i], sets[j])}
                label = min(linked, default=i)
                group = {j: label if g in linked else g for j, g in group.items()} | {i: label}
            assert kept == sorted(i for i, g in group.items() if g == i)
        if name == "mix_sources":
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
            words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows)
            assert 0.95 * words(before) <= words(after) <= words(before)
        if name == "bpe":
            want = sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in before)
            assert rows_of(df, "doc_id", "decoded_sha256") == want
        before = after


def test_odd_rows_pass_all_stages(spark):
    df = docs(spark)
    for _, stage in P.STAGES:
        df = materialize(stage(spark, df, ""), "test-odd")
    assert 0 < df.count() <= 3 * len(ROWS)


def test_empty_table(spark):
    df = docs(spark, [])
    for _, stage in P.STAGES:
        df = materialize(stage(spark, df, ""), "test-empty")
    assert df.count() == 0 and df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_registered():
    import __spark_entry__ as E

    q, sql = E.queries(), E.oracle_sql()
    for n in range(1, 14):
        assert len([k for k in q if k.startswith(f"op{n}_")]) == 1
    assert q["pipeline"] is P.run and "pipeline" not in sql and {"op4_mix_sources", "op10_exact_dedup", "op11_exact_topk", "op12_source_divergence", "op13_merkle_manifest"} <= set(sql)
    assert minhash and bpe
