"""A hot account (a third of all rows) through the feature path: results equal a pandas computation."""

import pandas as pd
import pytest

from riskframe.operators import features


@pytest.fixture(scope="module")
def txn(spark):
    rows = []
    for i in range(3000):
        acct = 1 if i % 3 == 0 else 2 + i % 97
        rows.append((acct, 100 + (i * 7) % 400, float((i * 7919) % 100003) / 7.0, i % 2))
    pdf = pd.DataFrame(rows, columns=["ACCT_NBR", "TX_DATE", "TX_AMT", "mb_check"])
    df = spark.createDataFrame(pdf).repartition(8)
    return df, pdf


def test_hot_account_aggregates(spark, txn):
    df, pdf = txn
    got = features.txn_aggregates(df).toPandas().set_index("ACCT_NBR").sort_index()
    g = pdf.groupby("ACCT_NBR")
    n = g.size()
    tempo = ((g.TX_DATE.max() - g.TX_DATE.min()) / n).where(n > 1, 30.0)
    assert (got.TRN_COUNT == n).all()
    assert got.TX_DATE.round(9).equals(tempo.round(9))
    assert (got.TX_AMT - g.TX_AMT.mean()).abs().max() < 1e-9
    band = pd.cut(pdf.TX_AMT, [1, 500, 100000, float("inf")], labels=["small", "medium", "large"])
    small = (band == "small").groupby(pdf.ACCT_NBR).sum()
    assert (got.SMALL_TRN_COUNT == small).all()


def test_hot_account_top5(spark, txn):
    df, pdf = txn
    got = features.topk_wide(df).toPandas().set_index("ACCT_NBR")
    exp = pdf.sort_values(["ACCT_NBR", "TX_AMT", "TX_DATE"], ascending=[True, False, True]).groupby("ACCT_NBR").head(5)
    exp = exp.assign(N=exp.groupby("ACCT_NBR").cumcount() + 1)
    for n in range(1, 6):
        e = exp[exp.N == n].set_index("ACCT_NBR").TX_AMT
        assert (got.loc[e.index, f"TX_AMT_{n}"] == e).all()
    assert got.loc[1, "TOP_N_5"] == 5


def test_long_account_adds_no_padding_rows(spark):
    """One account of 100,000 rows in a batch with short ones: only real rows come out, padding follows from the lengths."""
    from pyspark.sql import functions as F

    from riskframe.operators import sequence

    long = spark.range(100_000).select(F.lit(1).alias("ACCT_NBR"), (F.col("id") + 1).alias("POS"), (F.col("id") % 7 - 3).cast("double").alias("Z"))
    short = spark.createDataFrame([(2, 1, 2.0), (2, 2, -5.0), (3, 1, 1.0)], "ACCT_NBR int, POS long, Z double")
    batches = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 2)], "ACCT_NBR int, BATCH long")
    padded = sequence.pad_and_mask(long.unionByName(short), batches, ["Z"])
    assert padded.count() == 100_003
    lens = {r.ACCT_NBR: (r.LEN, r.BATCH_LEN, r.BATCH_PADDED) for r in padded.select("ACCT_NBR", "LEN", "BATCH_LEN", "BATCH_PADDED").distinct().collect()}
    assert lens == {1: (100_000, 100_000, True), 2: (2, 100_000, True), 3: (1, 1, False)}
    imp = {(r.ACCT_NBR, r.POS): r.IMPORTANCE for r in sequence.sequence_importance(padded, "Z").where("ACCT_NBR > 1").collect()}
    assert imp[(2, 2)] == pytest.approx(5 / (5 + 1e-6)) and imp[(2, 1)] == pytest.approx(2 / (5 + 1e-6)) and imp[(3, 1)] == 0
