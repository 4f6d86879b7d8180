"""Registered queries: votes, balance, risk counts, bands, thresholds, ranking, paging, unions, text (D9-D12,
G1-G7, H1-H2, I1-I4, I6-I8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.defaults import SEED
from riskframe.functions import bands
from riskframe.functions.hashing import sql_hash_order
from riskframe.operators import clean, features, joins, scoring
from riskframe.plans import oracle_sql as osql
from riskframe.plans.account_queries import _acc, _txn, _tx_sql
from riskframe.plans.common import rounded
from riskframe.plans.registry import register
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import FIXTURE_TODAY, with_views

_RISK_SQL = "CASE WHEN SCORE > 0.0 AND SCORE <= 0.3 THEN 'Low' WHEN SCORE > 0.3 AND SCORE <= 0.6 THEN 'Medium' WHEN SCORE > 0.6 AND SCORE <= 1.0 THEN 'High' END"


@register(
    "vote_by_account",
    _tx_sql(
        ", v AS (SELECT ACCT_NBR, CASE WHEN 2 * sum(CASE WHEN TX_AMT > 35000 THEN 1 ELSE 0 END) > count(*) THEN 1 ELSE 0 END AS VOTE "
        "FROM tx GROUP BY ACCT_NBR) SELECT acc.ACCT_NBR, COALESCE(v.VOTE, 0) AS VOTE FROM acc LEFT JOIN v ON acc.ACCT_NBR = v.ACCT_NBR"
    ),
)
def vote_by_account(spark, sf):
    acc = _acc(spark, sf)
    t = _txn(spark, sf, acc).select("ACCT_NBR", F.when(F.col("TX_AMT") > 35000, 1).otherwise(0).alias("PRED"))
    return scoring.vote_by_account(t, acc)


_BAL = (
    "SELECT CAST(sum(CASE WHEN LABEL = 0 THEN 1 ELSE 0 END) AS BIGINT) AS N_NEG, CAST(sum(CASE WHEN LABEL = 1 THEN 1 ELSE 0 END) AS BIGINT) AS N_POS, "
    "count(*) AS N FROM lab_acc"
)


@register(
    "class_balance",
    with_views(
        f"WITH acc AS ({osql.account_cte()}), lab AS (SELECT DISTINCT ACCT_NBR FROM v_notices WHERE ACCT_NBR IS NOT NULL), "
        "lab_acc AS (SELECT acc.ACCT_NBR, CASE WHEN lab.ACCT_NBR IS NULL THEN 0 ELSE 1 END AS LABEL FROM acc LEFT JOIN lab ON acc.ACCT_NBR = lab.ACCT_NBR), "
        f"b AS ({_BAL}) SELECT N_NEG, N_POS, N, round(100.0 * N_POS / N, 6) AS POS_PCT, "
        "round(CASE WHEN N_POS > 0 THEN N_NEG / N_POS ELSE 1.0 END, 6) AS POS_WEIGHT FROM b",
        "v_accounts", "v_identity", "v_notices",
    ),
)
def class_balance(spark, sf):
    lab = joins.label_accounts(_acc(spark, sf), fx.notices(spark, sf))
    return rounded(scoring.class_balance(lab))


@register(
    "risk_distribution",
    with_views(
        f"WITH r AS (SELECT {_RISK_SQL} AS RISK_LEVEL FROM v_scored), lv AS (SELECT * FROM (VALUES ('Low'), ('Medium'), ('High')) t(RISK_LEVEL)) "
        "SELECT lv.RISK_LEVEL, count(r.RISK_LEVEL) AS N FROM lv LEFT JOIN r ON lv.RISK_LEVEL = r.RISK_LEVEL GROUP BY lv.RISK_LEVEL",
        "v_scored",
    ),
)
def risk_distribution(spark, sf):
    s = fx.scored(spark, sf).select(bands.risk_band_cut("SCORE").alias("RISK_LEVEL"))
    return scoring.risk_distribution(s)


@register(
    "flag_summary",
    with_views(
        "SELECT count(*) AS TOTAL, CAST(sum(CASE WHEN SCORE > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS FLAGGED, "
        "round(100.0 * sum(CASE WHEN SCORE > 0.5 THEN 1 ELSE 0 END) / count(*), 6) AS FLAGGED_PCT FROM v_scored",
        "v_scored",
    ),
)
def flag_summary(spark, sf):
    s = fx.scored(spark, sf).select(bands.apply_threshold("SCORE", 0.5).alias("PRED"))
    return rounded(scoring.flag_summary(s))


@register(
    "amount_band",
    with_views(
        "SELECT ACCT_NBR, round(TX_AMT, 6) AS TX_AMT, CASE WHEN TX_AMT > 1 AND TX_AMT <= 500 THEN 'small' WHEN TX_AMT > 500 AND TX_AMT <= 100000 "
        "THEN 'medium' WHEN TX_AMT > 100000 THEN 'large' END AS AMT_SIZE FROM v_txn",
        "v_txn",
    ),
)
def amount_band(spark, sf):
    t = fx.transactions(spark, sf)
    return rounded(t.select("ACCT_NBR", "TX_AMT", bands.amount_band("TX_AMT").alias("AMT_SIZE")))


@register("risk_band_cut", with_views(f"SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, {_RISK_SQL} AS RISK_LEVEL FROM v_scored", "v_scored"))
def risk_band_cut(spark, sf):
    return rounded(fx.scored(spark, sf).select("ACCT_NBR", "SCORE", bands.risk_band_cut("SCORE").alias("RISK_LEVEL")))


@register(
    "risk_band_score",
    with_views(
        "SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, CASE WHEN SCORE >= 0.75 THEN 'high' WHEN SCORE >= 0.5 THEN 'medium' ELSE 'low' END AS LEVEL FROM v_scored",
        "v_scored",
    ),
)
def risk_band_score(spark, sf):
    return rounded(fx.scored(spark, sf).select("ACCT_NBR", "SCORE", bands.risk_band_score("SCORE").alias("LEVEL")))


def _over(t: float) -> str:
    return f"CASE WHEN SCORE > {t} AND NOT isnan(SCORE) THEN 1 ELSE 0 END"


@register(
    "apply_threshold",
    with_views(f"SELECT ACCT_NBR, {_over(0.3)} AS PRED_03, {_over(0.5)} AS PRED_05, {_over(0.6)} AS PRED_06 FROM v_scored_nan", "v_scored_nan"),
)
def apply_threshold(spark, sf):
    """Scores with NaN among them: NaN is never over a threshold."""
    s = fx.scored_with_nan(spark, sf)
    return s.select("ACCT_NBR", *[bands.apply_threshold("SCORE", t).alias(n) for t, n in ((0.3, "PRED_03"), (0.5, "PRED_05"), (0.6, "PRED_06"))])


_FS_COLS = ["TX_TIME", "DRCR", "CHANNEL_CODE", "TRN_CODE", "mb_check", "eb_check", "DAY_OF_WEEK"]


@register(
    "feature_string",
    with_views(
        "SELECT ACCT_NBR, round(TX_AMT, 6) AS TX_AMT, concat_ws(',', "
        + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in _FS_COLS)
        + ") AS FEATURES FROM v_txn",
        "v_txn",
    ),
)
def feature_string(spark, sf):
    t = fx.transactions(spark, sf)
    return rounded(t.select("ACCT_NBR", "TX_AMT", bands.feature_string(_FS_COLS).alias("FEATURES")))


_DETAIL = ["CANCEL_NO_CONTACT", "IS_DIGITAL", "ACCT_OPEN_DT", "AUM_AMT", "DATE_OF_BIRTH", "YEARLYINCOMELEVEL", "CNTY_CD"]


def _detail_sql() -> str:
    parts = []
    for c in _DETAIL:
        v = f"printf('%.2f', {c})" if c == "AUM_AMT" else f"CAST({c} AS VARCHAR)"
        parts.append(f"SELECT ACCT_NBR, '{c}' AS FIELD, COALESCE({v}, '') AS VALUE FROM j")
    return (
        "WITH j AS (SELECT a.ACCT_NBR, a.CANCEL_NO_CONTACT, a.IS_DIGITAL, a.ACCT_OPEN_DT, a.AUM_AMT, i.DATE_OF_BIRTH, i.YEARLYINCOMELEVEL, i.CNTY_CD "
        "FROM v_accounts a LEFT JOIN v_identity i ON a.CUST_ID = i.CUST_ID) " + " UNION ALL ".join(parts)
    )


@register("detail_rows", with_views(_detail_sql(), "v_accounts", "v_identity"))
def detail_rows(spark, sf):
    j = joins.join_identity(fx.accounts(spark, sf), fx.identity(spark, sf))
    return scoring.detail_rows(j, "ACCT_NBR", _DETAIL, {"AUM_AMT": "%.2f"})


@register("score_text", with_views("SELECT ACCT_NBR, printf('%.4f', SCORE) AS SCORE_TEXT FROM v_scored", "v_scored"))
def score_text(spark, sf):
    return fx.scored(spark, sf).select("ACCT_NBR", bands.score_text("SCORE").alias("SCORE_TEXT"))


# ------------------------------------------------------------------------------------------- G: order
_RANK_SQL = "row_number() OVER (ORDER BY SCORE DESC, ACCT_NBR ASC)"


@register("rank_by_score", with_views(f"SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, {_RANK_SQL} AS RANK FROM v_scored", "v_scored"))
def rank_by_score(spark, sf):
    return rounded(scoring.rank_by_score(fx.scored(spark, sf).select("ACCT_NBR", "SCORE")))


@register(
    "page",
    with_views(
        f"SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, RANK, CAST(ceil((SELECT count(*) FROM v_scored) / 10.0) AS BIGINT) AS PAGES "
        f"FROM (SELECT ACCT_NBR, SCORE, {_RANK_SQL} AS RANK FROM v_scored) r WHERE RANK > 20 AND RANK <= 30",
        "v_scored",
    ),
)
def page(spark, sf):
    """Page 3 of the ranked list (rows 21-30) and the page count."""
    return rounded(scoring.page(fx.scored(spark, sf).select("ACCT_NBR", "SCORE"), 3))


@register(
    "sample_positive",
    with_views(
        f"SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, LABEL FROM v_scored WHERE LABEL = 1 ORDER BY {sql_hash_order('ACCT_NBR', SEED)}, ACCT_NBR LIMIT 1",
        "v_scored",
    ),
)
def sample_positive(spark, sf):
    s = fx.scored(spark, sf).where(F.col("LABEL") == 1)
    return rounded(scoring.sample_one(s, "ACCT_NBR", SEED))


@register(
    "head_sample",
    with_views("SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, LABEL FROM v_scored ORDER BY ACCT_NBR LIMIT 500", "v_scored"),
)
def head_sample(spark, sf):
    return rounded(scoring.head_sample(fx.scored(spark, sf), ["ACCT_NBR"]))


@register(
    "sort_keys",
    with_views(
        "SELECT ACCT_NBR, round(TX_AMT, 6) AS TX_AMT, TX_DATE, row_number() OVER (ORDER BY ACCT_NBR ASC, TX_AMT DESC, TX_DATE ASC) AS POS FROM v_txn",
        "v_txn",
    ),
)
def sort_keys(spark, sf):
    t = fx.transactions(spark, sf).select("ACCT_NBR", "TX_AMT", "TX_DATE")
    return rounded(scoring.sort_keys(t, [F.col("ACCT_NBR").asc(), F.col("TX_AMT").desc(), F.col("TX_DATE").asc()]))


# ------------------------------------------------------------------------------------------- H: sets
@register(
    "union_rows",
    with_views(
        "SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, LABEL FROM v_scored WHERE LABEL = 0 UNION ALL "
        "SELECT ACCT_NBR, round(SCORE, 6) AS SCORE, LABEL FROM v_scored WHERE LABEL = 1",
        "v_scored",
    ),
)
def union_rows(spark, sf):
    s = fx.scored(spark, sf)
    return rounded(scoring.union_rows([s.where("LABEL = 0"), s.where("LABEL = 1")]))


@register(
    "feature_drift",
    with_views(
        "WITH a AS (SELECT DISTINCT 'DRCR_' || CAST(DRCR AS VARCHAR) AS FEATURE FROM v_txn WHERE DRCR IS NOT NULL), "
        "b AS (SELECT DISTINCT 'DRCR_' || CAST(DRCR + 1 AS VARCHAR) AS FEATURE FROM v_txn WHERE DRCR IS NOT NULL) "
        "SELECT 'missing' AS STATUS, FEATURE FROM a WHERE FEATURE NOT IN (SELECT FEATURE FROM b) "
        "UNION ALL SELECT 'extra' AS STATUS, FEATURE FROM b WHERE FEATURE NOT IN (SELECT FEATURE FROM a)",
        "v_txn",
    ),
)
def feature_drift(spark, sf):
    """A new transaction file whose debit/credit codes are shifted by one: its one-hot columns drift."""
    t = fx.transactions(spark, sf)
    pol = features.txn_policy(FIXTURE_TODAY)
    train = pol.apply(t)
    new = pol.apply(t.withColumn("DRCR", F.col("DRCR") + 1))
    return scoring.feature_drift(train, new, exclude=["ACCT_NBR"])
