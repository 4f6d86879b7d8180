import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import topk as op

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA.replace("float", kind))
    return df.withColumns({c: F.lit(f"x-{c}") for c in ("row", "v", "lot", "no", "query", "query_id", "rank", "score", "i")})


def expected(rows, k=5, every=50):
    fine = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    some = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if fine(v)]
    out = []
    for a, (i, q) in enumerate(some):
        if i is None or i % every:
            continue
        found = [(-sum(x * y for x, y in zip(q, v)), j is None, j or 0, j) for b, (j, v) in enumerate(some) if a != b]
        out += [(i, n + 1, j, -s) for n, (s, _, _, j) in enumerate(sorted(found)[:k])]
    return sorted(out, key=lambda r: (r[0], r[1], r[3], r[2] is None, r[2] or 0))


def got(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=lambda r: (r[0], r[1], r[3], r[2] is None, r[2] or 0))


def floats(seed, n, dims):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dims))
    return [(i, [float(np.float32(x)) for x in centres[i % 4] + r.normal(size=dims) * 0.3]) for i in range(n)]


@pytest.mark.parametrize("n, dims", [(700, 64), (400, 17), (300, 3), (120, 1)])
def test_against_brute_force(spark, n, dims):
    rows = floats(n, n, dims)
    assert got(op.top_k(table(spark, rows).repartition(7))) == expected(rows)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0]), (50, [0.5, -1.0]), (1, []), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0]), (5, [float("inf")])]
    rows += [(None, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0]), (6, [1.0, 2.0, 3.0]), (100, []), (-50, [-1e-9, 4.0, 0.0, 9.0])]
    assert got(op.top_k(table(spark, rows))) == expected(rows)
    assert op.top_k(table(spark, [])).count() == 0
    assert op.top_k(table(spark, [(1, [1.0]), (2, [2.0])])).count() == 0
    assert op.top_k(table(spark, [(0, [1.0])])).count() == 0
    assert got(op.top_k(table(spark, [(0, []), (1, [])]))) == [(0, 1, 1, 0)]


def test_many_equal_vectors_and_lots(spark):
    """A vector that most rows share, so that thresholds are met with equality, and lots of three queries."""
    rows = [(i, [0.25] * 8 if i % 3 else v) for i, v in floats(9, 600, 8)]
    assert got(op.top_k(table(spark, rows).repartition(5), lot_rows=3)) == expected(rows)


def test_large_components_are_exact(spark):
    r = np.random.default_rng(4)
    for size in (1e4, 1e6, 2e6, 1e12):
        rows = [(i, [float(x) for x in r.normal(size=4) * size]) for i in range(60)]
        want = [(q, n, j, max(min(s, 2**63 - 1), -(2**63))) for q, n, j, s in expected(rows)]
        have = got(op.top_k(table(spark, rows, "double")))
        if size < 1e12:
            assert have == want
        else:
            assert [x[3] for x in have] == [x[3] for x in want]


def test_bounds_never_rule_out_and_do_rule_out():
    r = np.random.default_rng(8)
    rows = np.floor(256 * (np.repeat(r.normal(size=(20, 64)), 50, 0) + r.normal(size=(1000, 64)) * 0.1)).astype(np.int64)
    exact = op.scores_of(rows[:40], rows)
    q, x = op.Segments(rows[:40], 64), op.Segments(rows, 64)
    assert len(q.levels) == 3
    bounds = [a @ b.T for a, b in zip(q.levels, x.levels)]
    for coarse, fine in zip(bounds, [*bounds[1:], exact]):
        assert (coarse >= fine - 1e-6 * np.abs(coarse) - 1e-6).all()
    best = op.Best(np.full(40, np.iinfo(np.int64).min), 5)
    needed = sum(op.search(rows[:40], np.arange(40), q, best, rows[a : a + 100], np.arange(a, a + 100), np.arange(a, a + 100), np.zeros(100, bool)) for a in range(0, 1000, 100))
    assert needed < 0.5 * 40 * 1000
    exact[np.arange(40), np.arange(40)] = np.iinfo(np.int64).min
    assert sorted(best.score.reshape(40, 5).tolist()) == sorted(np.sort(exact, axis=1)[:, :-6:-1].tolist())
