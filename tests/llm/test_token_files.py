import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from riskframe.llm import token_files as op
from riskframe.session import scratch_path

from .cases import ROWS, docs, rows_of

T = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
T.encode_special_tokens = True


def expected(rows):
    at, out = 0, []
    for i, t, *_ in rows:
        ids = np.array([*T.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_round_trip_in_id_order(spark):
    rows = sorted([r for r in ROWS if r[0] is not None], key=lambda r: r[0])
    manifest = op.write_tokens(docs(spark, rows[::-1]), scratch_path(spark, "t"))
    assert rows_of(op.read_digests(manifest), "doc_id", "start", "n_tokens", "ids_crc32") == expected(rows)
    back = {r["start"]: r["ids"] for r in op.read_tokens(manifest).collect()}
    assert [len(back[s]) for _, s, _, _ in expected(rows)] == [n for _, _, n, _ in expected(rows)]


def test_null_ids_come_first(spark):
    manifest = op.write_tokens(docs(spark), scratch_path(spark, "t"))
    got = sorted(op.read_digests(manifest).collect(), key=lambda r: r["start"])
    assert got[0]["doc_id"] is None and len(got) == len(ROWS)
    assert [r["doc_id"] for r in got[1:]] == sorted(r[0] for r in ROWS if r[0] is not None)


def test_empty(spark):
    assert op.read_digests(op.write_tokens(docs(spark, []), scratch_path(spark, "t"))).count() == 0


def test_planes_and_random_access(tmp_path):
    r = np.random.default_rng(1)
    for bits in (1, 8):
        path = str(tmp_path / f"x{bits}.bin")
        w = op.IdWriter(path, bits, block=100)
        docs_ = [r.integers(0, 2**32, n).astype("<u4") for n in (1, 0, 99, 100, 101, 350, 7)]
        for i, d in enumerate(docs_):
            w.add(i if i != 2 else None, d.tobytes())
        assert w.close() == (tmp_path / f"x{bits}.bin").stat().st_size
        flat = np.concatenate(docs_)
        reader = op.IdReader(path)
        assert reader.lengths.tolist() == [len(d) for d in docs_] and reader.nulls.tolist() == [0, 0, 1, 0, 0, 0, 0]
        for a, n in ((0, 0), (0, 1), (99, 2), (150, 300), (0, len(flat)), (len(flat) - 1, 1)):
            assert (reader.read(a, n) == flat[a : a + n]).all()
        ids = np.arange(64, dtype="<u4") * 77
        assert (op.unplaned(op.planes(ids, bits), 64, bits) == ids).all()


def test_a_byte_plane_of_small_ids_costs_little(tmp_path):
    w = op.IdWriter(str(tmp_path / "x.bin"))
    w.add(0, np.arange(200_000, dtype="<u4").tobytes())
    assert w.close() < 200_000


def test_query_reads_added_tokens_as_the_unmodified_library(spark, tmp_path):
    plain, end = Tokenizer.from_file(P.path("byte_bpe_50k.json")), "<|endoftext|>"
    texts = [f"a {end} b", end, end * 2, f"  {end}  x\n{end}'s", f"tail \n{end}", "<|endoftext", f"{end}ly don't {end} ", "no such string", ""]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    at, want = 0, []
    for i, t in enumerate(texts):
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert plain.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    assert rows_of(op.op9_token_files(spark, str(tmp_path)), "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_cut_texts_have_the_ids_of_whole_ones():
    r = random.Random(5)
    some = [*"abZ9,.'!&#_-(\n\t\r\x1c\x00", *" " * 6, "'s", "don't", " é", "à ", "\u0085", "\u00a0", "\u2003", "\u2028", "\u3000", "\u1680", "\u200b", "’ ", "中", "😀", "²", "ⅷ", "Ω", "\u0301"]
    texts = ["".join(r.choice(some) for _ in range(r.choice([0, 1, 2, 9, 60]))) for _ in range(3000)]
    coder = op.tokenizer(*op.public_tokenizer())
    for _ in range(2):
        assert coder(texts) == [np.array(e.ids, "<u4").tobytes() for e in T.encode_batch(texts, add_special_tokens=False)]
    assert coder([]) == [] and coder(["", ""]) == [b"", b""]


def test_the_library_sees_a_word_once_whatever_sign_ends_it():
    coder, asked = op.tokenizer(*op.public_tokenizer()), []
    coder.forget()
    joined = coder.joined
    coder.joined = lambda parts: asked.append(parts) or joined(parts)
    try:
        coder([f"x {w}{sign} {w}" for w in ("queth", "sondra") for sign in (".&&&", "%%%", ",", "!")])
    finally:
        coder.joined = joined
    assert sorted(p for parts in asked for p in parts) == [" queth", " sondra"]
