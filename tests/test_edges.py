"""Edge cases on small hand-made frames (bin edges, null keys, ties, zero division, NaN, single rows)."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions import bands
from riskframe.operators import clean, features, joins, metrics, profile, scoring, windows
from riskframe.operators.models import StandardScale
from riskframe.operators.policy import ColumnPolicy, class_flags
from riskframe.sources import files


def col(df, name):
    return [r[name] for r in df.collect()]


def test_amount_band_edges(spark):
    vals = [0.0, 1.0, 1.01, 500.0, 500.01, 100000.0, 1e9, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = col(df.select(bands.amount_band("x").alias("b")), "b")
    assert got == [None, None, "small", "small", "medium", "medium", "large", None]


def test_risk_band_cut_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.3, 0.30001, 0.6, 1.0]], "p double")
    assert col(df.select(bands.risk_band_cut("p").alias("b")), "b") == [None, "Low", "Medium", "Medium", "High"]


def test_risk_band_score_nan_is_low(spark):
    df = spark.createDataFrame([(v,) for v in [float("nan"), 0.4999, 0.5, 0.7499, 0.75, None]], "s double")
    assert col(df.select(bands.risk_band_score("s").alias("b")), "b") == ["low", "low", "medium", "medium", "high", "low"]


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.5000001,), (float("nan"),), (None,)], "p double")
    assert col(df.select(bands.apply_threshold("p", 0.5).alias("y")), "y") == [0, 1, 0, 0]


def test_null_keys_match_nothing_in_identity_join(spark):
    acc = spark.createDataFrame([(1, None), (2, 5)], "ACCT_NBR long, CUST_ID long")
    idn = spark.createDataFrame([(None, 30), (5, 40)], "CUST_ID long, DATE_OF_BIRTH int")
    out = {r.ACCT_NBR: r.DATE_OF_BIRTH for r in joins.join_identity(acc, idn).collect()}
    assert out == {1: None, 2: 40}


def test_tempo_single_and_missing_accounts(spark):
    acc = spark.createDataFrame([(1,), (2,), (3,)], "ACCT_NBR long")
    tx = spark.createDataFrame(
        [(1, 100, 50.0), (2, 100, 600.0), (2, 110, 700.0), (2, 130, 800.0)], "ACCT_NBR long, TX_DATE int, TX_AMT double"
    )
    out = {r.ACCT_NBR: r for r in features.account_features(acc, tx).collect()}
    assert out[1].TX_DATE == 30.0
    assert out[2].TX_DATE == pytest.approx(30 / 3)
    assert out[3].TX_DATE == 30.0 and out[3].TRN_COUNT == 0
    # an account without transactions keeps null band columns (their fill belongs to the aggregate side)
    assert out[3].SMALL_TRN_COUNT is None and out[3].LARGE_TRN_RATIO is None
    assert out[1].SMALL_TRN_COUNT == 1 and out[1].SMALL_TRN_RATIO == 1.0
    # slots: absent slot -> 0, TOP_N marks the slot
    assert out[2].TX_AMT_1 == 800.0 and out[2].TOP_N_3 == 3 and out[2].TOP_N_4 == 0 and out[2].TX_AMT_5 == 0.0


def test_band_ratio_zero_division(spark):
    tx = spark.createDataFrame([(1, 1, 0.5)], "ACCT_NBR long, TX_DATE int, TX_AMT double")
    r = features.txn_aggregates(tx).first()
    assert (r.SMALL_TRN_COUNT, r.MEDIUM_TRN_COUNT, r.LARGE_TRN_COUNT) == (0, 0, 0)
    assert (r.SMALL_TRN_RATIO, r.MEDIUM_TRN_RATIO, r.LARGE_TRN_RATIO) == (0.0, 0.0, 0.0)


def test_votes_tie_and_empty(spark):
    rows = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (1, 0), (2, 1)], "ACCT_NBR long, PRED int")
    acc = spark.createDataFrame([(1,), (2,), (3,)], "ACCT_NBR long")
    out = {r.ACCT_NBR: r.VOTE for r in scoring.vote_by_account(rows, acc).collect()}
    assert out == {1: 0, 2: 1, 3: 0}


def test_overlapping_classes(spark):
    df = spark.createDataFrame([(8,), (16,), (18,)], "TRN_CODE int")
    lists = [[1, 4, 7, 8], [2, 16], [8, 9], [31], [6, 16]]
    out = df.select(*class_flags("TRN_CODE", lists)).collect()
    assert [sum(r) for r in out] == [2, 2, 0]


def test_dedup_before_drop(spark):
    df = spark.createDataFrame([(1, 5.0, 10), (1, 5.0, 11), (1, 5.0, 11)], "ACCT_NBR long, TX_AMT double, EMP_NO long")
    out = clean.drop_columns(clean.distinct_rows(df), ["EMP_NO"])
    assert out.count() == 2


def test_one_hot_drift_and_alignment(spark):
    train = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "ACCT_NBR long, DRCR int")
    new = spark.createDataFrame([(4, 2), (5, 3)], "ACCT_NBR long, DRCR int")
    pol = ColumnPolicy({"DRCR": "one_hot_encode"})
    tr, nw = pol.apply(train), pol.apply(new)
    assert tr.columns == ["ACCT_NBR", "DRCR_1", "DRCR_2"]
    assert [tuple(r)[1:] for r in tr.orderBy("ACCT_NBR").collect()] == [(1, 0), (0, 1), (0, 0)]
    drift = {(r.STATUS, r.FEATURE) for r in scoring.feature_drift(tr, nw, exclude=["ACCT_NBR"]).collect()}
    assert drift == {("missing", "DRCR_1"), ("extra", "DRCR_3")}
    aligned = clean.align_features(nw, ["DRCR_1", "DRCR_2"], keep=["ACCT_NBR"])
    assert aligned.columns == ["ACCT_NBR", "DRCR_1", "DRCR_2"]
    assert [tuple(r) for r in aligned.orderBy("ACCT_NBR").collect()] == [(4, 0, 1), (5, 0, 0)]


def test_notices_sheet_duplicates(spark):
    notices = spark.createDataFrame([(1, 10), (1, 9), (7, 3), (-5, 1)], "ACCT_NBR long, DATA_DT int")
    acc = spark.createDataFrame([(1,), (2,), (7,)], "ACCT_NBR long")
    lab = {r.ACCT_NBR: r.LABEL for r in joins.label_accounts(acc, notices).collect()}
    assert lab == {1: 1, 2: 0, 7: 1}
    first = {r.ACCT_NBR: r.DATA_DT for r in clean.distinct_by_key(notices, "ACCT_NBR", ["DATA_DT"]).collect()}
    assert first == {1: 9, 7: 3, -5: 1}
    assert scoring.duplicate_key_count(notices).first()[0] == 2
    sheet = notices.select("ACCT_NBR").withColumn("Y", F.lit(""))
    preds = spark.createDataFrame([(1, 1), (7, 0)], "ACCT_NBR long, PRED int")
    filled = sorted((r.ACCT_NBR, r.Y) for r in files.fill_answer_sheet(sheet, preds).collect())
    assert filled == [(-5, ""), (1, "1"), (1, "1"), (7, "")]
    assert {r.Y for r in files.clear_answer_sheet(sheet).collect()} == {""}


def test_constant_column_and_single_row(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "ACCT_NBR long, C double, X double")
    sc = StandardScale.fit(df, ["C", "X"])
    out = sc.transform(df).orderBy("ACCT_NBR").collect()
    assert [r.C for r in out] == [0.0, 0.0] and [r.X for r in out] == [-1.0, 1.0]
    mm = profile.MinMaxScale.fit(df, ["C", "X"]).transform(df).orderBy("ACCT_NBR").collect()
    assert [r.C for r in mm] == [0.0, 0.0] and [r.X for r in mm] == [0.0, 1.0]
    one = spark.createDataFrame([(1, 4.0)], "ACCT_NBR long, X double")
    z = windows.standardize_within(one, "ACCT_NBR", ["X"]).first()
    assert z.Z_X == 0.0


def test_metrics_degenerate(spark):
    allpos = spark.createDataFrame([(0.9, 1), (0.2, 1)], "SCORE double, LABEL int")
    allneg = spark.createDataFrame([(0.9, 0), (0.2, 0)], "SCORE double, LABEL int")
    nopred = spark.createDataFrame([(0.1, 1), (0.2, 0)], "SCORE double, LABEL int")
    b = metrics.binary_metrics(nopred).first()
    assert (b.PRECISION, b.RECALL, b.F1) == (0.0, 0.0, 0.0)
    assert metrics.auc_score(allpos).first().AUC == 0.0
    assert metrics.auc_score(allneg).first().AUC == 0.0
    bal = scoring.class_balance(allneg).first()
    assert bal.N_POS == 0 and bal.POS_WEIGHT == 1.0
    rep = {r.CLASS: r for r in metrics.classification_report(allpos).collect()}
    assert rep["0"].SUPPORT == 0 and rep["0"].PRECISION == 0.0 and rep["accuracy"].F1 == 0.5


def test_auc_with_ties_matches_rank_formula(spark):
    rows = [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1), (0.1, 1)]
    df = spark.createDataFrame(rows, "SCORE double, LABEL int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    exact = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert metrics.auc_score(df).first().AUC == pytest.approx(exact)


def test_focal_loss_matches_formula(spark):
    df = spark.createDataFrame([(0.7, 1), (0.2, 0)], "SCORE double, LABEL int")

    def fl(p, y):
        l0, l1 = -math.log(1 - p), -math.log(p)
        nll = 7.0 * l1 if y == 1 else l0
        ce = 0.9 * nll + 0.1 * (l0 + 7.0 * l1) / 2
        return (1 - math.exp(-ce)) ** 1.5 * ce

    assert metrics.focal_loss(df).first()[0] == pytest.approx((fl(0.7, 1) + fl(0.2, 0)) / 2)


def test_last_write_wins_out_of_order(spark):
    df = spark.createDataFrame([(1, 5, 0.2), (1, 9, 0.8), (1, 7, 0.5)], "ACCT_NBR long, SEQ long, SCORE double")
    r = windows.last_write_wins(df, "ACCT_NBR", "SEQ").first()
    assert (r.SEQ, r.SCORE) == (9, 0.8)


def test_threshold_curve_equals_point_metrics(spark):
    """Scores on, beside and between the thresholds, null and NaN, thresholds out of order and repeated."""
    scores = [0.05, 0.1, 0.1000001, 0.15, 0.5, 0.85, 0.9, float("nan"), None, -1.0, 2.0]
    df = spark.createDataFrame([(s, y) for s in scores for y in (0, 1, 1, None)], "SCORE double, LABEL int")
    for ts in (None, [0.5, 0.1, 0.9, 0.5], [0.3]):
        curve = metrics.threshold_curve(df, thresholds=ts).collect()
        assert [r.THRESHOLD for r in curve] == (ts or metrics.sweep_thresholds())
        for r in curve:
            tp = sum(s > r.THRESHOLD for s in scores if s is not None and s == s) * 2
            flagged, pos = 2 * tp, 2 * len(scores)
            p = tp / flagged if flagged else 0.0
            assert (r.PRECISION, r.RECALL) == (pytest.approx(p), pytest.approx(tp / pos))
    assert [tuple(r) for r in metrics.threshold_curve(df.limit(0), thresholds=[0.2]).collect()] == [(0.2, 0.0, 0.0, 0.0)]


def test_profile_of_declared_domains_equals_the_general_one(spark):
    acc = spark.createDataFrame([(i, 0, 1, 5.0, 2, 3, 40) for i in range(1, 6)], "ACCT_NBR long, CANCEL_NO_CONTACT int, IS_DIGITAL int, AUM_AMT double, YEARLYINCOMELEVEL int, ACCT_OPEN_DT int, DATE_OF_BIRTH int")
    rows = [(1, 10.0, 1.0, 1, 0, 0, 1, "Sunday", h, c, t) for h, c, t in [(23, 1, 62), (0, 1, 0), (23, 19, 62), (0, 19, 1), (None, None, None)]]
    rows += [(2, 5.0, None, 0, 1, 1, 0, "Monday", None, None, None), (3, 7.0, 2.0, 0, 0, 0, 0, None, 5, 3, 3), (9, 7.0, 2.0, 0, 0, 0, 0, None, 5, 3, 3)]
    tx = spark.createDataFrame(rows, "ACCT_NBR long, TX_AMT double, PB_BAL double, mb_check int, eb_check int, SAME_NUMBER_IP int, SAME_NUMBER_UUID int, DAY_OF_WEEK string, TX_TIME int, CHANNEL_CODE int, TRN_CODE int")
    fast, general = profile.account_profile(acc, tx), profile.account_profile(acc, tx, domains={})
    assert fast.schema == general.schema
    assert sorted(map(str, fast.collect())) == sorted(map(str, general.collect()))
    first = {r.ACCT_NBR: r for r in fast.collect()}
    assert (first[1].MODE_TX_TIME, first[1].UNIQUE_CHANNELS, first[1].UNIQUE_TRN_CODES) == (0, 2, 3) and first[2].MODE_TX_TIME == 0
    for c, v in (("TX_TIME", 24), ("CHANNEL_CODE", 63), ("TRN_CODE", -1)):
        with pytest.raises(Exception, match="codes outside"):
            profile.account_profile(acc, tx.withColumn(c, F.lit(v))).collect()
