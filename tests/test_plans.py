"""Plan shape checks: the properties the design relies on at scale."""

from riskframe.operators import features
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import FIXTURE_TODAY

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _txn(spark):
    return features.transaction_table(fx.transactions(spark, SF_SMALL), None, features.txn_policy(FIXTURE_TODAY))


def test_topk_has_partial_group_limit_and_no_join(spark):
    p = _plan(features.topk_wide(_txn(spark)))
    assert p.count("WindowGroupLimit") >= 2  # partial before the exchange, final after
    assert "Join" not in p  # slots come from one conditional aggregate, not five self-joins


def test_aggregates_are_partial(spark):
    p = _plan(features.txn_aggregates(_txn(spark)))
    assert "partial_count" in p and "partial_avg" in p


def test_no_python_in_hot_path(spark):
    import __spark_entry__ as E

    qs = E.queries()
    for k in ("join_features", "topk_wide", "account_profile", "threshold_curve", "txn_gap", "split_stratified"):
        p = _plan(qs[k](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, k


def test_scan_prunes_columns(spark):
    t = fx.transactions(spark, SF_SMALL).select("ACCT_NBR", "TX_AMT")
    p = _plan(t)
    # the view's amount reads the part number as well; nothing else is scanned
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double>" in p


def test_equal_rows_meet_before_they_are_compared(spark):
    """No map task keeps the rows of its split: all aggregates of the deduplication come after its one shuffle."""
    from riskframe.operators import clean

    df = spark.createDataFrame([(1, 0.0, "a"), (1, -0.0, "a"), (1, float("nan"), None), (1, float("nan"), None), (2, 0.0, "a")], "ACCT_NBR long, X double, C string")
    out = clean.distinct_rows(df)
    p = _plan(out)
    assert p.count("Exchange ") == 1 and "Aggregate" not in p[p.index("Exchange ") :]
    assert {(r.ACCT_NBR, str(abs(r.X)), r.C) for r in out.collect()} == {(1, "0.0", "a"), (1, "nan", None), (2, "0.0", "a")} and out.count() == 3


def test_topk_slots_need_no_table_of_accounts(spark):
    df = spark.createDataFrame([(1, 5, 3.0), (1, 4, 9.0), (None, 1, 1.0), (2, 1, None), (2, 2, None)], "ACCT_NBR long, TX_DATE int, TX_AMT double")
    got = features.topk_wide(df, k=2)
    p = _plan(got)
    assert "Aggregate" not in p and p.count("Exchange ") == 1
    rows = {r.ACCT_NBR: tuple(r)[1:] for r in got.collect()}
    assert got.columns == ["ACCT_NBR", "TX_DATE_1", "TX_AMT_1", "TOP_N_1", "TX_DATE_2", "TX_AMT_2", "TOP_N_2"]
    assert rows == {1: (4, 9.0, 1, 5, 3.0, 2), None: (1, 1.0, 1, None, None, None), 2: (1, None, 1, 2, None, 2)}
