"""Every key with an oracle: Spark result equals the DuckDB oracle at sf0.001 (rows, columns, values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan  # no cross joins
    sp = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[key])
    cols = [d[0] for d in res.description]
    dk = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(sp) == len(dk)
    assert _rows(df.columns, sp) == _rows(cols, dk)
