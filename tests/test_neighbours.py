"""Exact nearest neighbours (pivot cells) and synthetic rows against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import neighbours, sampling


def square(x, y):
    d = 0.0
    for a, b in zip(x, y):  # not sum(), which compensates rounding
        d += (a - b) * (a - b)
    return d


def brute(rows, k):
    out = {}
    for key, x in rows:
        found = sorted((square(x, y), other) for other, y in rows if other != key)
        out[key] = found[:k]
    return out


def table(spark, rows):
    dims = len(rows[0][1]) if rows else 2
    cols = [f"c{i}" for i in range(dims)]
    return spark.createDataFrame([(k, *map(float, x), "x") for k, x in rows], "ACCT_NBR long, " + ", ".join(f"{c} double" for c in cols) + ", cell string"), cols


def got(df):
    return {r.ACCT_NBR: [(n.d2, n.key) for n in r.NEIGHBOURS] for r in df.collect()}


def clustered(seed, n, dims):
    r = random.Random(seed)
    centres = [[r.uniform(-50, 50) for _ in range(dims)] for _ in range(6)]
    return [(i * 3, [round(c + r.gauss(0, 2), r.choice([0, 3])) for c in r.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("n, dims, capacity, fan", [(300, 2, 16, 4), (250, 5, 32, 8), (200, 3, 1000, 4)])
def test_equals_brute_force(spark, n, dims, capacity, fan):
    rows = clustered(n, n, dims)
    df, cols = table(spark, rows)
    assert got(neighbours.nearest(df, cols, 5, "ACCT_NBR", capacity, fan)) == brute(rows, 5)


def test_one_dense_cell_and_far_rows(spark):
    """Most rows lie in a tiny ball, some of them alike: it is split again and again, and is compared with little else."""
    r = random.Random(4)
    rows = [(i, [r.randint(0, 40) / 1000, r.randint(0, 40) / 1000]) for i in range(600)] + [(2000 + i, [r.uniform(-1e6, 1e6), r.uniform(-1e6, 1e6)]) for i in range(60)]
    df, cols = table(spark, rows)
    assert got(neighbours.nearest(df, cols, 5, "ACCT_NBR", 16, 4)) == brute(rows, 5)
    compared, all_pairs = neighbours.compared_pairs(df, cols, 5, "ACCT_NBR", 16, 4)
    assert compared < 0.25 * all_pairs
    cells = neighbours.cells_of(neighbours.points_of(df.select(F.col("ACCT_NBR").alias("key"), neighbours.vector(cols).alias("x")), "key", 5), 16, 4)
    assert cells.points.groupBy("cell").count().agg(F.max("count")).first()[0] <= 16 and len(cells.levels) > 2


def test_equal_rows_and_few_rows(spark):
    same = [(i, [1.0, 2.0]) for i in range(300)] + [(1000, [1.0, 3.0]), (1001, [9.0, 9.0])]
    df, cols = table(spark, same)
    assert got(neighbours.nearest(df, cols, 5, "ACCT_NBR", 8, 3)) == brute(same, 5)
    few = [(3, [0.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0])]
    df, cols = table(spark, few)
    assert got(neighbours.nearest(df, cols, 5, "ACCT_NBR")) == brute(few, 5)
    assert got(neighbours.nearest(df.limit(1), cols, 5, "ACCT_NBR")) == {3: []}
    assert neighbours.nearest(df.limit(0), cols, 5, "ACCT_NBR").count() == 0


def test_only_the_nearest_of_a_cell_go_on_to_the_ranking():
    r = np.random.default_rng(5)
    x = np.round(r.normal(size=(128, 3)), 1)
    d2 = neighbours.square_distances(x, x)
    assert d2[7].tolist() == [square(x[7].tolist(), y) for y in x.tolist()]
    a, b, found = neighbours._first(d2, np.ones(d2.shape, bool), 5)
    for i in range(128):
        assert sorted(found[a == i]) == sorted(v for v in d2[i] if v <= sorted(d2[i])[5])
    assert len(a) < 128 * 10 and (d2[a, b] == found).all()
    allowed = d2 < 0.2
    a, b, _ = neighbours._first(d2, allowed, 5)
    assert allowed[a, b].all() and all((a == i).sum() >= min(6, allowed[i].sum()) for i in range(128))


def test_null_and_nan_count_as_zero(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 0.0, 4.0)], "ACCT_NBR long, c0 double, c1 double")
    assert got(neighbours.nearest(df, ["c0", "c1"], 2, "ACCT_NBR")) == {1: [(0.0, 2), (9.0, 3)], 2: [(0.0, 1), (9.0, 3)], 3: [(9.0, 1), (9.0, 2)]}


def test_synthetic_rows_lie_between_neighbours(spark):
    rows = clustered(9, 240, 3)
    df, cols = table(spark, rows)
    df = df.withColumn("LABEL", (F.col("ACCT_NBR") % 8 == 0).cast("int"))
    made = sampling.smote(df, cols).collect()
    minority = [(k, x) for k, x in rows if k % 8 == 0]
    near, by_key = brute(minority, 5), dict(rows)
    assert len(made) == 240 - 2 * len(minority) and len({r.DRAW for r in made}) == len(made)
    for r in made:
        assert r.LABEL == 1 and r.NEIGHBOUR in {k for _, k in near[r.BASE]} and 0 <= r.U < 1
        for c, a, b in zip(cols, by_key[r.BASE], by_key[r.NEIGHBOUR]):
            assert math.isclose(r[c], a + r.U * (b - a), rel_tol=1e-12, abs_tol=1e-12)
    assert {(r.DRAW, r.BASE, r.NEIGHBOUR) for r in sampling.smote(df.repartition(5), cols).collect()} == {(r.DRAW, r.BASE, r.NEIGHBOUR) for r in made}
    steps = sampling.zero_steps(sampling.smote(df, cols), ["TX_AMT"]).collect()
    assert len(steps) == len(made) and {(s.STEP, s.TX_AMT) for s in steps} == {(1, 0.0)}
    with pytest.raises(ValueError):
        sampling.smote(df.where("LABEL = 0 OR ACCT_NBR = 0"), cols)
