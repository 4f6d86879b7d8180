import hashlib
import random
import zlib

from pyspark.sql import functions as F

from riskframe.llm import manifest as op

from .cases import ROWS, docs, rows_of


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def tree(level):
    """The root, and for each leaf the (left, right) of every step up."""
    steps, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for k, a in enumerate(at):
            run = range(a // 3 * 3, min(a // 3 * 3 + 3, len(level)))
            steps[k].append(("".join(level[i] for i in run if i < a), "".join(level[i] for i in run if i > a)))
        level, at = [H("".join(level[i : i + 3])) for i in range(0, len(level), 3)], [a // 3 for a in at]
    return level[0], steps


def expected(rows):
    sources = {}
    for i, text, lang, source, *_ in rows:
        n = len(text or "")
        seen = None if text is None else text.replace("\n", "")
        tampered = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        sources.setdefault(source, []).append((i, leaf(i, text, lang, source, n), leaf(i, seen if tampered else text, lang, source, n)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {s: tree([r[1] for r in sources[s]]) for s in names}
    root, over = tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, over):
        for (i, own, seen), steps in zip(sources[s], trees[s][1]):
            path = steps + above
            folded = op.fold(seen, path)
            out.append((i, own, trees[s][0], root, H("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def run(df):
    text = F.col("text")
    return op.manifest(df, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text))


def test_odd_rows(spark):
    assert rows_of(run(docs(spark)), *COLUMNS) == expected(ROWS)
    assert run(docs(spark, [])).count() == 0


def test_sources_of_every_small_size_and_a_hot_one(spark):
    """Sources of 1 to 31 rows, of 81, 82 and 730 (two bands and more), and some lines to lose."""
    r = random.Random(3)
    rows, i = [], 0
    for no, n in enumerate([*range(1, 32), 81, 82, 243, 244, 730]):
        for _ in range(n):
            rows.append((i * 7 % 5003, r.choice(["a\nb", "line", "x\n", "\n", "", None]), r.choice(["en", None]), f"s{no}" if no else None))
            i += 1
    r.shuffle(rows)
    got = rows_of(run(docs(spark, rows)), *COLUMNS)
    assert got == expected(rows)
    assert {g[-1] for g in got} == {True, False}


def test_one_row_is_its_own_root(spark):
    got = rows_of(run(docs(spark, [(5, "alone", "en", "a")])), *COLUMNS)
    own = leaf(5, "alone", "en", "a", 5)
    assert got == [(5, own, own, own, H(""), own, True)]


def test_a_reader_can_check_a_row_with_its_proof(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}") for i in range(100)]
    for r in op.manifest(docs(spark, rows)).collect():
        own = leaf(r.doc_id, rows[r.doc_id][1], "en", r.source, len(rows[r.doc_id][1]))
        assert own == r.leaf and op.fold(own, [(s.left, s.right) for s in r.proof]) == r.root and r.verified
        assert op.fold(H("other"), [(s.left, s.right) for s in r.proof]) != r.root


def test_changed_ids_sources_and_fields_change_the_root(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}") for i in range(40)]
    roots = set()
    for change in (rows, rows[:-1], [(99, *rows[0][1:]), *rows[1:]], [(0, "text 0", "en", "s1"), *rows[1:]], [(0, "text 0", None, "s0"), *rows[1:]]):
        found = {r.root for r in op.manifest(docs(spark, change)).select("root").distinct().collect()}
        assert len(found) == 1
        roots |= found
    assert len(roots) == 5


def test_no_python_in_the_plan(spark):
    plan = run(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
