import base64
import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskframe.llm import bpe as op

from .cases import LONG, ROWS, docs, rows_of


def library():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


LIBRARY = library()


def ids(text):
    return np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()


ALPHABET = st.sampled_from(["a", "the", "The ", " ", "  ", "\n", "\t", "é", "日本", "12", "'s", "'ll", "!", "?? ", "\x1c", "\x00", " ", "\u0085", " x", "\U0001f600", "<|endoftext|>", "zqxj"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=6))
def test_equals_the_library(texts):
    c = op.codec(*op.public_ranks())
    got = c.encode(texts)
    assert got == [ids(t) for t in texts]
    assert c.decode(got) == [t.encode() for t in texts]


def test_long_pieces():
    r = np.random.default_rng(4)
    texts = ["a" * 5000, "".join(r.choice(list("abcdefghij"), 3000)), "日本語" * 400, "=" * 3001, " " * 999 + "x", LONG]
    c = op.codec(*op.public_ranks())
    assert c.encode(texts) == [ids(t) for t in texts]


def test_caches_start_afresh():
    c = op.codec(*op.public_ranks())
    small = op.PartCoder(P.PATTERN, c.pieces, parts=5, pieces=5)
    texts = [" ".join(f"word{i}x{j}" for j in range(7)) for i in range(9)]
    assert [small([t])[0] for t in texts] == [ids(t) for t in texts]
    assert small(texts) == [ids(t) for t in texts]


def test_odd_rows(spark):
    want = [(i, len(ids(t or "")) // 4, hashlib.sha256(ids(t or "")).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ROWS]
    got = rows_of(op.round_trip(docs(spark)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    assert op.round_trip(docs(spark, [])).count() == 0


def test_encode_then_decode(spark):
    back = op.decode(op.encode(docs(spark)))
    assert sorted((bytes(r["bytes"]) for r in back.collect())) == sorted((t or "").encode() for _, t, *_ in ROWS)
