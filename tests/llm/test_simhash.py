import hashlib
import random

from pyspark.sql import functions as F

from riskframe.llm import simhash as op

from .cases import ROWS, docs

SF = "/root/testdata/sf0.001"


def test_edited_texts_and_neighbours(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in df.collect())
    got = {r["doc_id"]: r for r in op.op1_simhash(spark, SF).collect()}
    known = op.WordHashes()
    fp = [op.fingerprint(t, known) for _, t in rows]
    for n, (i, t) in enumerate(rows):
        m = (n + 1) % len(rows)
        k = len(t) // 4
        new = t[: len(t) - k] + rows[m][1][:k]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert r["fingerprint"] == f"{fp[n]:016x}" and r["edited_fingerprint"] == f"{op.fingerprint(new, known):016x}"
        assert r["near_next"] == 1 - bin(fp[n] ^ fp[m]).count("1") / 64
        assert r["near_edited"] == 1 - bin(fp[n] ^ op.fingerprint(new, known)).count("1") / 64
        within = sum(bin(fp[n] ^ x).count("1") <= op.RADIUS for x in fp)
        assert r["n_within"] == (within if i % 100 == 0 else None)
    wins = sum(r["near_edited"] > r["near_next"] for r in got.values())
    assert wins / len(got) > 0.9


def test_search_finds_all_within_the_radius(spark):
    r = random.Random(2)
    fps = [r.getrandbits(64) for _ in range(60)]
    for x in list(fps):
        for _ in range(4):
            y = x
            for _ in range(r.randint(0, 6)):
                y ^= 1 << r.randrange(64)
            fps.append(y)
    df = spark.createDataFrame([(op.signed(x),) for x in fps] + [(None,)], "fp bigint")
    for radius, blocks in ((0, 1), (1, 4), (3, 5), (3, 6), (5, 7)):
        got = op.within_radius(df, df, radius, blocks).collect()
        want = {(op.signed(a), op.signed(b), fps.count(b), bin(a ^ b).count("1")) for a in fps for b in fps if bin(a ^ b).count("1") <= radius}
        assert len(got) == len(want) and {tuple(x) for x in got} == want


def test_odd_rows(spark):
    got = op.edited_fingerprints(docs(spark)).collect()
    assert len(got) == len(ROWS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["fp"] == by_id[2]["fp"] == by_id[3]["fp"] == 0 and by_id[0]["fp"] == by_id[5]["fp"]
    assert by_id[None]["next_fp"] == by_id[0]["fp"] and by_id[10]["next_fp"] == by_id[None]["fp"]
    assert op.edited_fingerprints(docs(spark, [])).count() == 0


def test_a_single_document_follows_itself(spark):
    r = op.edited_fingerprints(docs(spark, [(4, "abcdefgh", None, None)])).first()
    assert r["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and r["next_fp"] == r["fp"]


def test_ranges_don_t_change_the_result(spark):
    rows = [(i, f"text number {i} " * (i % 5), None, None) for i in range(97)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for n in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, op.edited_fingerprints(docs(spark, rows)).where(F.lit(True)).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]
