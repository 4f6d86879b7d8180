import hashlib
import random
from collections import Counter

import pytest

from riskframe.llm import suffix_dedup as op

from .cases import ROWS, docs, rows_of

SF = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def expected(rows, length):
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone, last = bytearray(len(b)), 0
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[max(k, last) : k + length] = b"\1" * (k + length - max(k, last))
                last = k + length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def test_two_stage_sorting_orders_all_suffixes():
    r = random.Random(3)
    for _ in range(300):
        letters = r.choice([b"ab", b"abc", b"a", b"abcdefgh", bytes(range(250))])
        text = bytes(r.choice(letters) for _ in range(r.randint(0, 70)))
        assert op.suffix_array(text, 100).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_repeated_windows():
    r = random.Random(4)
    for _ in range(300):
        letters, length = r.choice(["ab", "abc", "a", "abcdefgh"]), r.choice([3, 5, 8])
        parts = ["".join(r.choice(letters) for _ in range(r.randint(0, 40))).encode() for _ in range(r.randint(1, 5))]
        seen = Counter(p[i : i + length] for p in parts for i in range(len(p) - length + 1))
        want = [[seen[p[i : i + length]] > 1 for i in range(max(0, len(p) - length + 1))] for p in parts]
        assert [x.tolist() for x in op.repeated_windows(parts, length)] == want


def test_every_window_is_in_one_run():
    r = random.Random(5)
    for gram in (4, 9, 12):
        pieces = ["".join(r.choice("abc") for _ in range(n)).encode() for n in (5, 12, 13, 200, 0, 90)]
        pieces.append(b"z" * 60)
        at = Counter()
        for p, start, windows, _, _, _ in op.runs_of(pieces, 12, gram, op.Powers()):
            at.update((p, start + i) for i in range(windows))
        assert at == Counter((p, i) for p, b in enumerate(pieces) for i in range(len(b) - 11))


@pytest.mark.parametrize("task", [2_000_000, 60])  # 60 bytes: every group is cut again, down to single windows
def test_small_corpora(spark, monkeypatch, task):
    r = random.Random(6)
    passage = "".join(r.choice("abcdefgh ") for _ in range(120))
    rows = []
    for i in range(40):
        own = "".join(r.choice("abcdefgh ") for _ in range(r.randint(0, 150)))
        cut = r.randint(0, 60)
        rows.append((i, own + passage[cut : r.randint(60, 120)] + own[: r.randint(0, 30)], None, None))
    rows += [(100, rows[3][1], None, None), (101, "x" * 90, None, None), (102, "x" * 70 + "y", None, None), (103, "xy" * 50, None, None), (104, passage + passage, None, None)]
    monkeypatch.setattr(op, "TASK", task)
    assert rows_of(op.remove_repeats(docs(spark, rows), 40), *COLUMNS) == expected(rows, 40)


def test_edges_of_a_common_passage_settle_in_a_few_runs(spark, monkeypatch):
    monkeypatch.setattr(op, "TASK", 500)
    r = random.Random(8)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = text(700)
    rows = [(i, text(r.randint(200, 400)) + passage + text(r.randint(200, 400)), None, None) for i in range(60)]
    found, _ = op.repeated_intervals(op.keyed(docs(spark, rows)))
    assert found.count() < 30 * len(rows)  # 301 windows of each are repeated
    assert rows_of(op.remove_repeats(docs(spark, rows)), *COLUMNS) == expected(rows, op.LENGTH)


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(op, "PIECE", 50)
    r = random.Random(7)
    base = "".join(r.choice("abcdefgh ") for _ in range(700))
    rows = [(0, base, None, None), (1, "!" + base[133:480] + "?", None, None), (2, base[::-1], None, None)]
    assert rows_of(op.remove_repeats(docs(spark, rows), 40), *COLUMNS) == expected(rows, 40)


def test_odd_rows(spark):
    assert rows_of(op.remove_repeats(docs(spark), 40), *COLUMNS) == expected(ROWS, 40)
    assert op.remove_repeats(docs(spark, []), 40).count() == 0


def test_whole_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert rows_of(op.op7_suffix_dedup(spark, SF), *COLUMNS) == expected(rows, op.LENGTH)
