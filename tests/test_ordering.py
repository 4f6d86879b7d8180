"""Distributed numbering, prefix sums and lag: exact against pandas, including a hot key spread over ranges."""

import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators import ordering, sampling, windows


def _hot(spark, n=3000):
    # account 7 holds a third of the rows (hot key); the rest spread over 200 accounts
    rows = [(7 if i % 3 == 0 else i % 200, i, float((i * 37) % 101)) for i in range(n)]
    return spark.createDataFrame(rows, "ACCT_NBR long, SEQ long, V double")


def test_row_index_global_and_grouped(spark):
    df = _hot(spark)
    g = ordering.row_index(df, [F.col("V").desc(), F.col("SEQ").asc()], name="R", partitions=8).toPandas()
    exp = g.sort_values(["V", "SEQ"], ascending=[False, True]).reset_index(drop=True)
    assert list(exp["R"]) == list(range(1, len(exp) + 1))
    w = ordering.row_index(df, ["SEQ"], by=["ACCT_NBR"], name="R", partitions=8).toPandas()
    w = w.sort_values(["ACCT_NBR", "SEQ"])
    assert (w.groupby("ACCT_NBR")["R"].apply(lambda s: list(s) == list(range(1, len(s) + 1)))).all()


def test_hot_key_spans_several_ranges(spark):
    df = _hot(spark)
    r = ordering._ranged(df, ["ACCT_NBR"], ["SEQ"], 8)
    pids = r.where("ACCT_NBR = 7").select("_rf_pid").distinct().count()
    assert pids >= 2  # the hot account is not confined to one task


def test_prefix_sums(spark):
    df = _hot(spark).select("SEQ", "V")
    got = ordering.prefix_sums(df, [F.col("SEQ").asc()], ["V"], partitions=8).toPandas().sort_values("SEQ")
    assert (got["cum_V"].values == got["V"].cumsum().values).all()


def test_lag_over_hot_key_matches_pandas(spark):
    df = _hot(spark)
    got = windows.txn_gap(df.withColumn("TX_DATE", F.col("V").cast("int")), "ACCT_NBR", "SEQ", "TX_DATE").toPandas()
    pdf = df.toPandas().sort_values(["ACCT_NBR", "SEQ"])
    pdf["TX_DATE"] = pdf["V"].astype(int)
    pdf["EXP"] = (pdf["TX_DATE"] - pdf.groupby("ACCT_NBR")["TX_DATE"].shift(1)).fillna(-30).astype(int)
    m = got.merge(pdf[["ACCT_NBR", "SEQ", "EXP"]], on=["ACCT_NBR", "SEQ"])
    assert len(m) == len(pdf) and (m["GAP"] == m["EXP"]).all()


def test_folds_disjoint_complete_and_stratified(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(700)]
    df = spark.createDataFrame(rows, "ACCT_NBR long, LABEL int")
    f = sampling.stratified_folds(df).toPandas()
    assert len(f) == 700 and f["ACCT_NBR"].is_unique and set(f["FOLD"]) == set(range(5))
    pos = f[f.LABEL == 1].groupby("FOLD").size()
    assert pos.max() - pos.min() <= 1


def test_exact_split_sizes(spark):
    rows = [(i, 1 if i % 5 == 0 else 0) for i in range(1003)]
    df = spark.createDataFrame(rows, "ACCT_NBR long, LABEL int")
    s = sampling.split_random(df).toPandas()
    assert (s.SPLIT == "test").sum() == 201  # ceil(0.2 * 1003)
    st = sampling.split_stratified(df).toPandas()
    assert ((st.SPLIT == "test") & (st.LABEL == 1)).sum() == 41 and ((st.SPLIT == "test") & (st.LABEL == 0)).sum() == 161


def test_bootstrap_balances_classes(spark):
    rows = [(i, 1 if i < 10 else 0) for i in range(100)]
    b = sampling.balance_bootstrap(spark.createDataFrame(rows, "ACCT_NBR long, LABEL int")).toPandas()
    assert (b.LABEL == 1).sum() == 90 and (b.LABEL == 0).sum() == 90
    assert set(b[b.LABEL == 1].ACCT_NBR) <= set(range(10))
    assert pd.Series(b[b.LABEL == 0].ACCT_NBR).between(10, 99).all()


def test_bootstrap_reaches_every_row_of_a_huge_class(spark):
    size = 2**33
    picks = spark.range(4000).select(sampling.bootstrap_pick(F.lit(0), F.col("id"), F.lit(size)).alias("i"))
    lo, hi, over = picks.agg(F.min("i"), F.max("i"), F.count(F.when(F.col("i") > 2**32, 1))).first()
    assert 1 <= lo <= hi <= size and 1500 < over < 2500


def test_null_groups_are_numbered_too(spark):
    df = spark.createDataFrame([(None, i) for i in range(30)] + [("a", i) for i in range(20)], "g string, x int")
    got = sorted((r.g or "", r.x, r.ROW_IDX) for r in ordering.row_index(df, ["x"], by=["g"], partitions=4).collect())
    assert got == sorted([("", i, i + 1) for i in range(30)] + [("a", i, i + 1) for i in range(20)])
