"""Registered queries: policies, cleaning, joins, per-account aggregates and top-k (B, C, D1-D8, D13-D15, F1-F6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.operators import clean, features, joins, profile, windows
from riskframe.operators.policy import days_since as _days_since
from riskframe.operators.policy import in_list, label_encode
from riskframe.plans import oracle_sql as osql
from riskframe.plans.common import rounded, sql_round
from riskframe.plans.registry import register
from riskframe.session import materialize
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import FIXTURE_CUTS, FIXTURE_TODAY, with_views

ALL_VIEWS = ("v_accounts", "v_identity", "v_txn", "v_notices")
TXN_VIEWS = ("v_accounts", "v_identity", "v_txn")
_tc = osql.TXN_CLASSES


def _acc(spark: SparkSession, sf: str) -> DataFrame:
    return features.account_table(fx.accounts(spark, sf), fx.identity(spark, sf), features.account_policy(FIXTURE_TODAY))


def _txn(spark: SparkSession, sf: str, acc: DataFrame | None = None) -> DataFrame:
    acc = acc if acc is not None else fx.accounts(spark, sf).select("ACCT_NBR")  # the key list is all that C2 needs
    return features.transaction_table(fx.transactions(spark, sf), acc, features.txn_policy(FIXTURE_TODAY))


def _tx_sql(body: str, *extra_views: str) -> str:
    """Oracle text with the account (acc) and transaction (tx) tables as CTEs."""
    return with_views(
        f"WITH acc AS ({osql.account_cte()}), tx AS ({osql.txn_cte()}) {body}", *TXN_VIEWS, *extra_views
    )


# ------------------------------------------------------------------------------------------- flagship
FEATURE_COLS = osql.ACCOUNT_COLS + osql.agg_columns()[1:] + osql.slot_columns() + ["LABEL"]


@register(
    "join_features",
    with_views(
        f"WITH {osql.feature_ctes()} SELECT {sql_round(FEATURE_COLS, osql.feature_doubles())} "
        f"FROM ({osql.features_select()}) f",
        *ALL_VIEWS,
    ),
)
def join_features(spark: SparkSession, sf: str) -> DataFrame:
    """C5 + C4: the labelled account feature table (flagship)."""
    out = features.feature_table(
        fx.accounts(spark, sf), fx.identity(spark, sf), fx.transactions(spark, sf), fx.notices(spark, sf),
        today=FIXTURE_TODAY, cuts=FIXTURE_CUTS,
    )
    return rounded(out)


# ------------------------------------------------------------------------------------------- B: policies
@register(
    "column_policy",
    with_views(f"SELECT {sql_round(osql.txn_columns(), osql.TXN_DOUBLES)} FROM ({osql.txn_select()}) t", "v_txn"),
)
def column_policy(spark, sf):
    t = fx.transactions(spark, sf)
    shaped = features.txn_policy(FIXTURE_TODAY).fit(t).transform(clean.distinct_rows(t))
    return rounded(clean.fill_all_zero(shaped, exclude=["ACCT_NBR"]))


_RAW_TXN = ["ACCT_NBR", "TX_DATE", "TX_TIME", "DRCR", "TX_AMT", "PB_BAL", "OWN_TRANS_ID", "CHANNEL_CODE", "TRN_CODE",
            "mb_check", "eb_check", "SAME_NUMBER_IP", "SAME_NUMBER_UUID", "DAY_OF_WEEK"]


@register("drop_columns", with_views(f"SELECT {sql_round(_RAW_TXN, ['TX_AMT', 'PB_BAL'])} FROM v_txn", "v_txn"))
def drop_columns(spark, sf):
    return rounded(clean.drop_columns(fx.transactions(spark, sf), ["CUST_ID", "OWN_TRANS_ACCT", "BRANCH_NO", "EMP_NO"]))


@register("days_since", with_views(f"SELECT ACCT_NBR, {FIXTURE_TODAY} - ACCT_OPEN_DT AS ACCT_OPEN_DT FROM v_accounts", "v_accounts"))
def days_since(spark, sf):
    return fx.accounts(spark, sf).select("ACCT_NBR", _days_since("ACCT_OPEN_DT", FIXTURE_TODAY).alias("ACCT_OPEN_DT"))


@register(
    "classify_binary",
    with_views(
        f"SELECT ACCT_NBR, round(TX_AMT, 6) AS TX_AMT, {osql._in('TX_TIME', _tc['TX_TIME'][0])} AS TX_TIME, "
        f"{osql._in('OWN_TRANS_ID', _tc['OWN_TRANS_ID'][0])} AS OWN_TRANS_ID, "
        f"{osql._in('DAY_OF_WEEK', _tc['DAY_OF_WEEK'][0])} AS DAY_OF_WEEK FROM v_txn",
        "v_txn",
    ),
)
def classify_binary(spark, sf):
    t = fx.transactions(spark, sf)
    return rounded(
        t.select("ACCT_NBR", "TX_AMT", *[in_list(c, _tc[c][0]).alias(c) for c in ("TX_TIME", "OWN_TRANS_ID", "DAY_OF_WEEK")])
    )


_MULTI = [f"{osql._in('CHANNEL_CODE', l)} AS CHANNEL_CODE_class_{i}" for i, l in enumerate(_tc["CHANNEL_CODE"])] + [
    f"{osql._in('TRN_CODE', l)} AS TRN_CODE_class_{i}" for i, l in enumerate(_tc["TRN_CODE"])
]


@register(
    "classify_multi",
    with_views(f"SELECT ACCT_NBR, round(TX_AMT, 6) AS TX_AMT, TRN_CODE AS TRN_CODE_RAW, {', '.join(_MULTI)} FROM v_txn", "v_txn"),
)
def classify_multi(spark, sf):
    from riskframe.operators.policy import class_flags

    t = fx.transactions(spark, sf)
    return rounded(
        t.select(
            "ACCT_NBR", "TX_AMT", F.col("TRN_CODE").alias("TRN_CODE_RAW"),
            *class_flags("CHANNEL_CODE", _tc["CHANNEL_CODE"]), *class_flags("TRN_CODE", _tc["TRN_CODE"]),
        )
    )


@register(
    "one_hot",
    with_views(
        "SELECT ACCT_NBR, round(TX_AMT, 6) AS TX_AMT, CASE WHEN DRCR = 1 THEN 1 ELSE 0 END AS DRCR_1, "
        "CASE WHEN DRCR = 2 THEN 1 ELSE 0 END AS DRCR_2 FROM v_txn",
        "v_txn",
    ),
)
def one_hot(spark, sf):
    from riskframe.operators.policy import ColumnPolicy

    t = fx.transactions(spark, sf).select("ACCT_NBR", "TX_AMT", "DRCR")
    return rounded(ColumnPolicy({"DRCR": "one_hot_encode"}).apply(t))


@register(
    "fill_by_column",
    with_views(f"SELECT {sql_round(osql.ACCOUNT_COLS, osql.ACCOUNT_DOUBLES)} FROM ({osql.account_cte()}) a", "v_accounts", "v_identity"),
)
def fill_by_column(spark, sf):
    return rounded(_acc(spark, sf))


@register(
    "fill_all_zero",
    with_views(
        "SELECT ACCT_NBR, TX_DATE, TX_TIME, COALESCE(DRCR, 0) AS DRCR, round(TX_AMT, 6) AS TX_AMT, "
        "round(COALESCE(PB_BAL, 0), 6) AS PB_BAL, OWN_TRANS_ID, DAY_OF_WEEK FROM v_txn",
        "v_txn",
    ),
)
def fill_all_zero(spark, sf):
    t = fx.transactions(spark, sf).select("ACCT_NBR", "TX_DATE", "TX_TIME", "DRCR", "TX_AMT", "PB_BAL", "OWN_TRANS_ID", "DAY_OF_WEEK")
    return rounded(clean.fill_all_zero(t))


@register(
    "drop_null_key",
    with_views("SELECT ACCT_NBR, CUST_ID, round(AUM_AMT, 6) AS AUM_AMT FROM v_accounts WHERE CUST_ID IS NOT NULL", "v_accounts"),
)
def drop_null_key(spark, sf):
    return rounded(clean.drop_null_key(fx.accounts(spark, sf).select("ACCT_NBR", "CUST_ID", "AUM_AMT"), "CUST_ID"))


_OBJ = "CASE WHEN SCORE = 0 THEN CAST('-inf' AS DOUBLE) ELSE SCORE - 0.5 END"


@register(
    "filter_known",
    with_views(f"SELECT ACCT_NBR, round(OBJECTIVE, 6) AS OBJECTIVE FROM (SELECT ACCT_NBR, {_OBJ} AS OBJECTIVE FROM v_scored) s "
               "WHERE OBJECTIVE > CAST('-inf' AS DOUBLE)", "v_scored"),
)
def filter_known(spark, sf):
    s = fx.scored(spark, sf).select(
        "ACCT_NBR", F.when(F.col("SCORE") == 0, F.lit(float("-inf"))).otherwise(F.col("SCORE") - 0.5).alias("OBJECTIVE")
    )
    return rounded(clean.filter_known(s, "OBJECTIVE"))


# Training feature list: the transaction table's columns plus a category the new table never saw.
_ALIGN_FEATURES = [c for c in osql.txn_columns() if c != "ACCT_NBR"] + ["DRCR_3"]


@register(
    "align_features",
    with_views(
        f"SELECT ACCT_NBR, {', '.join(('0 AS DRCR_3' if c == 'DRCR_3' else (f'round({c}, 6) AS {c}' if c in osql.TXN_DOUBLES else c)) for c in _ALIGN_FEATURES)} "
        f"FROM ({osql.txn_select()}) t",
        "v_txn",
    ),
)
def align_features(spark, sf):
    raw = fx.transactions(spark, sf)
    t = features.txn_policy(FIXTURE_TODAY).fit(raw).transform(clean.distinct_rows(raw))
    t = clean.fill_all_zero(t, exclude=["ACCT_NBR"]).withColumn("EXTRA", F.lit(1))
    return rounded(clean.align_features(t, _ALIGN_FEATURES, keep=["ACCT_NBR"]))


@register(
    "cast_int",
    with_views(
        "SELECT ACCT_NBR, CAST(trunc(TX_AMT) AS BIGINT) AS TX_AMT, CAST(trunc(PB_BAL) AS BIGINT) AS PB_BAL, "
        "CAST(TX_TIME AS BIGINT) AS TX_TIME FROM v_txn",
        "v_txn",
    ),
)
def cast_int(spark, sf):
    return clean.cast_int(fx.transactions(spark, sf).select("ACCT_NBR", "TX_AMT", "PB_BAL", "TX_TIME"), exclude=["ACCT_NBR"])


# ------------------------------------------------------------------------------------------- C: joins
_C1_COLS = ["ACCT_NBR", "CUST_ID", "CANCEL_NO_CONTACT", "IS_DIGITAL", "ACCT_OPEN_DT", "AUM_AMT", "DATE_OF_BIRTH",
            "YEARLYINCOMELEVEL", "CNTY_CD"]


@register(
    "join_identity",
    with_views(
        "SELECT a.ACCT_NBR, a.CUST_ID, a.CANCEL_NO_CONTACT, a.IS_DIGITAL, a.ACCT_OPEN_DT, round(a.AUM_AMT, 6) AS AUM_AMT, "
        "i.DATE_OF_BIRTH, i.YEARLYINCOMELEVEL, i.CNTY_CD FROM v_accounts a LEFT JOIN v_identity i "
        "ON a.CUST_ID = i.CUST_ID",
        "v_accounts", "v_identity",
    ),
)
def join_identity(spark, sf):
    return rounded(joins.join_identity(fx.accounts(spark, sf), fx.identity(spark, sf)).select(*_C1_COLS))


@register(
    "restrict_to_known",
    with_views(f"SELECT {sql_round(_RAW_TXN, ['TX_AMT', 'PB_BAL'])} FROM v_txn WHERE ACCT_NBR IN (SELECT ACCT_NBR FROM v_accounts)", "v_txn", "v_accounts"),
)
def restrict_to_known(spark, sf):
    return rounded(joins.restrict_to_known(fx.transactions(spark, sf).select(*_RAW_TXN), fx.accounts(spark, sf)))


@register(
    "orphan_rows",
    with_views(
        f"SELECT {sql_round(_RAW_TXN, ['TX_AMT', 'PB_BAL'])} FROM v_txn n "
        "WHERE NOT EXISTS (SELECT 1 FROM v_accounts a WHERE a.ACCT_NBR IS NOT DISTINCT FROM n.ACCT_NBR)",
        "v_txn", "v_accounts",
    ),
)
def orphan_rows(spark, sf):
    return rounded(joins.orphan_rows(fx.transactions(spark, sf).select(*_RAW_TXN), fx.accounts(spark, sf)))


@register(
    "label_accounts",
    with_views(
        f"WITH acc AS ({osql.account_cte()}), lab AS (SELECT DISTINCT ACCT_NBR FROM v_notices WHERE ACCT_NBR IS NOT NULL) "
        "SELECT acc.ACCT_NBR, CASE WHEN lab.ACCT_NBR IS NULL THEN 0 ELSE 1 END AS LABEL FROM acc LEFT JOIN lab ON acc.ACCT_NBR = lab.ACCT_NBR",
        "v_accounts", "v_identity", "v_notices",
    ),
)
def label_accounts(spark, sf):
    return joins.label_accounts(_acc(spark, sf), fx.notices(spark, sf)).select("ACCT_NBR", "LABEL")


_C6_COLS = osql.txn_columns() + osql.ACCOUNT_COLS[1:] + ["LABEL"]


@register(
    "txn_with_account",
    with_views(
        f"WITH acc AS ({osql.account_cte()}), tx AS ({osql.txn_cte()}), "
        "lab AS (SELECT DISTINCT ACCT_NBR FROM v_notices WHERE ACCT_NBR IS NOT NULL), "
        "accl AS (SELECT acc.*, CASE WHEN lab.ACCT_NBR IS NULL THEN 0 ELSE 1 END AS LABEL FROM acc LEFT JOIN lab ON acc.ACCT_NBR = lab.ACCT_NBR) "
        f"SELECT {sql_round(_C6_COLS, osql.TXN_DOUBLES + osql.ACCOUNT_DOUBLES)} FROM (SELECT tx.*, "
        + ", ".join(f"accl.{c}" for c in osql.ACCOUNT_COLS[1:] + ["LABEL"])
        + " FROM tx LEFT JOIN accl ON tx.ACCT_NBR = accl.ACCT_NBR) j",
        *ALL_VIEWS,
    ),
)
def txn_with_account(spark, sf):
    acc = _acc(spark, sf)
    labelled = joins.label_accounts(acc, fx.notices(spark, sf))
    return rounded(joins.txn_with_account(_txn(spark, sf, acc), labelled))


@register(
    "profile_lookup",
    with_views(
        "SELECT n.ACCT_NBR, round(s.SCORE, 6) AS SCORE FROM v_sheet n LEFT JOIN v_scored s ON n.ACCT_NBR = s.ACCT_NBR",
        "v_sheet", "v_scored",
    ),
)
def profile_lookup(spark, sf):
    return rounded(joins.profile_lookup(fx.answer_sheet(spark, sf).select("ACCT_NBR"), fx.scored(spark, sf), columns=["SCORE"]))


# ------------------------------------------------------------------------------------------- D: aggregates
def _agg(spark, sf, cuts=FIXTURE_CUTS):
    return features.txn_aggregates(_txn(spark, sf), cuts=cuts)


def _agg_sql(cols, doubles, cuts=FIXTURE_CUTS) -> str:
    return _tx_sql(f", agg AS ({osql.agg_cte(cuts)}) SELECT {sql_round(cols, doubles)} FROM agg")


@register("txn_tempo", _agg_sql(["ACCT_NBR", "TX_DATE"], ["TX_DATE"]))
def txn_tempo(spark, sf):
    t = _txn(spark, sf)
    return rounded(t.groupBy("ACCT_NBR").agg(features.tempo("TX_DATE").alias("TX_DATE")))


@register("txn_count", _agg_sql(["ACCT_NBR", "TRN_COUNT"], []))
def txn_count(spark, sf):
    return _txn(spark, sf).groupBy("ACCT_NBR").agg(F.count(F.lit(1)).alias("TRN_COUNT"))


@register("txn_means", _agg_sql(["ACCT_NBR"] + osql.mean_columns(), osql.mean_columns()))
def txn_means(spark, sf):
    t = _txn(spark, sf)
    cols = features.mean_columns(t)
    return rounded(t.groupBy("ACCT_NBR").agg(*[F.avg(c).alias(c) for c in cols]))


_BAND_COUNTS = ["SMALL_TRN_COUNT", "MEDIUM_TRN_COUNT", "LARGE_TRN_COUNT"]
_BAND_RATIOS = ["SMALL_TRN_RATIO", "MEDIUM_TRN_RATIO", "LARGE_TRN_RATIO"]


@register("amount_band_counts", _agg_sql(["ACCT_NBR"] + _BAND_COUNTS, [], cuts=features.AMOUNT_CUTS))
def amount_band_counts(spark, sf):
    """Default cuts; some amounts lie below the first one and count in no band."""
    return _txn(spark, sf).groupBy("ACCT_NBR").agg(*features.band_counts("TX_AMT"))


@register("amount_band_ratios", _agg_sql(["ACCT_NBR"] + _BAND_COUNTS + _BAND_RATIOS, _BAND_RATIOS))
def amount_band_ratios(spark, sf):
    a = _txn(spark, sf).groupBy("ACCT_NBR").agg(*features.band_counts("TX_AMT", FIXTURE_CUTS))
    return rounded(a.select("ACCT_NBR", *_BAND_COUNTS, *features.band_ratios()))


@register(
    "topk_wide",
    _tx_sql(
        f", ranked AS ({osql.ranked_cte()}), slots AS ({osql.slots_cte()}) "
        f"SELECT {sql_round(['ACCT_NBR'] + osql.slot_columns(), osql.slot_doubles())} FROM slots"
    ),
)
def topk_wide(spark, sf):
    return rounded(features.topk_wide(_txn(spark, sf)))


@register(
    "align_slots",
    _tx_sql(
        f", ranked AS ({osql.ranked_cte()}), slots AS ({osql.slots_cte()}) "
        f"SELECT {sql_round(['ACCT_NBR'] + osql.slot_columns(), osql.slot_doubles(), prefix='')} FROM "
        f"(SELECT acc.ACCT_NBR, {', '.join(f'COALESCE(slots.{c}, 0) AS {c}' for c in osql.slot_columns())} "
        "FROM acc LEFT JOIN slots ON acc.ACCT_NBR = slots.ACCT_NBR) s"
    ),
)
def align_slots(spark, sf):
    """The slot columns aligned on every account (absent slots 0) — one conditional aggregate, no joins
    between slots."""
    acc = _acc(spark, sf)
    slots = features.topk_wide(_txn(spark, sf, acc))
    out = acc.select("ACCT_NBR").join(slots, "ACCT_NBR", "left")
    return rounded(clean.fill_by_column(out, {c: 0 for c in slots.columns if c != "ACCT_NBR"}))


@register(
    "distinct_rows",
    with_views(f"SELECT DISTINCT {sql_round(list(_RAW_TXN) + ['BRANCH_NO', 'EMP_NO'], ['TX_AMT', 'PB_BAL'])} FROM v_txn_rep", "v_txn_rep"),
)
def distinct_rows(spark, sf):
    return rounded(clean.distinct_rows(fx.transactions_with_repeats(spark, sf)))


@register(
    "distinct_by_key",
    with_views(
        "SELECT ACCT_NBR, CUST_ID, DATA_DT FROM (SELECT *, row_number() OVER (PARTITION BY ACCT_NBR ORDER BY DATA_DT, CUST_ID) AS rn "
        "FROM v_notices) n WHERE rn = 1",
        "v_notices",
    ),
)
def distinct_by_key(spark, sf):
    return clean.distinct_by_key(fx.notices(spark, sf), "ACCT_NBR", ["DATA_DT", "CUST_ID"])


@register(
    "duplicate_key_count",
    with_views(
        "SELECT CAST(COALESCE(sum(n), 0) AS BIGINT) AS DUPLICATE_ROWS FROM (SELECT ACCT_NBR, count(*) AS n FROM v_sheet GROUP BY ACCT_NBR) g WHERE n > 1",
        "v_sheet",
    ),
)
def duplicate_key_count(spark, sf):
    from riskframe.operators import scoring

    return scoring.duplicate_key_count(fx.answer_sheet(spark, sf), "ACCT_NBR")


# ------------------------------------------------------------------------------------------- D14 / D15: profile
_PROFILE_SQL = f"""
WITH acc AS ({osql.account_cte()}),
 raw AS (SELECT DISTINCT * FROM v_txn WHERE ACCT_NBR IN (SELECT ACCT_NBR FROM acc)),
 hours AS (SELECT ACCT_NBR, TX_TIME, count(*) AS c FROM raw GROUP BY ACCT_NBR, TX_TIME),
 mode_h AS (SELECT ACCT_NBR, TX_TIME AS MODE_TX_TIME FROM (SELECT *, row_number() OVER (PARTITION BY ACCT_NBR ORDER BY c DESC, TX_TIME ASC) AS rn FROM hours) h WHERE rn = 1),
 t AS (SELECT ACCT_NBR, count(*) AS TX_COUNT, sum(TX_AMT) AS TX_SUM, avg(TX_AMT) AS TX_MEAN,
   COALESCE(stddev_samp(TX_AMT), 0.0) AS TX_STD, max(TX_AMT) AS TX_MAX, min(TX_AMT) AS TX_MIN,
   avg(PB_BAL) AS AVG_PB_BAL, max(PB_BAL) AS MAX_PB_BAL, min(PB_BAL) AS MIN_PB_BAL,
   count(DISTINCT CHANNEL_CODE) AS UNIQUE_CHANNELS, count(DISTINCT TRN_CODE) AS UNIQUE_TRN_CODES,
   CAST(sum(mb_check) AS BIGINT) AS SUM_MB_CHECK, CAST(sum(eb_check) AS BIGINT) AS SUM_EB_CHECK,
   max(SAME_NUMBER_IP) AS FLAG_SAME_IP, max(SAME_NUMBER_UUID) AS FLAG_SAME_UUID,
   avg(CASE WHEN DAY_OF_WEEK IN ('Saturday', 'Sunday') THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS IS_WEEKEND
   FROM raw GROUP BY ACCT_NBR)
SELECT acc.ACCT_NBR, acc.CANCEL_NO_CONTACT, acc.IS_DIGITAL, round(acc.AUM_AMT, 6) AS AUM_AMT, acc.YEARLYINCOMELEVEL,
  COALESCE(t.TX_COUNT, 0) AS TX_COUNT, round(COALESCE(t.TX_SUM, 0), 6) AS TX_SUM, round(COALESCE(t.TX_MEAN, 0), 6) AS TX_MEAN,
  round(COALESCE(t.TX_STD, 0), 6) AS TX_STD, round(COALESCE(t.TX_MAX, 0), 6) AS TX_MAX, round(COALESCE(t.TX_MIN, 0), 6) AS TX_MIN,
  round(COALESCE(t.AVG_PB_BAL, 0), 6) AS AVG_PB_BAL, round(COALESCE(t.MAX_PB_BAL, 0), 6) AS MAX_PB_BAL,
  round(COALESCE(t.MIN_PB_BAL, 0), 6) AS MIN_PB_BAL, COALESCE(m.MODE_TX_TIME, 0) AS MODE_TX_TIME,
  COALESCE(t.UNIQUE_CHANNELS, 0) AS UNIQUE_CHANNELS, COALESCE(t.UNIQUE_TRN_CODES, 0) AS UNIQUE_TRN_CODES,
  COALESCE(t.SUM_MB_CHECK, 0) AS SUM_MB_CHECK, COALESCE(t.SUM_EB_CHECK, 0) AS SUM_EB_CHECK,
  COALESCE(t.FLAG_SAME_IP, 0) AS FLAG_SAME_IP, COALESCE(t.FLAG_SAME_UUID, 0) AS FLAG_SAME_UUID,
  round(COALESCE(t.IS_WEEKEND, 0), 6) AS IS_WEEKEND, acc.ACCT_OPEN_DT AS ACCOUNT_AGE, acc.DATE_OF_BIRTH AS AGE
FROM acc LEFT JOIN t ON acc.ACCT_NBR = t.ACCT_NBR LEFT JOIN mode_h m ON acc.ACCT_NBR = m.ACCT_NBR"""


def _profile(spark, sf):
    # The profile's join from the accounts restricts the transactions to known ones, after the aggregate.
    return profile.account_profile(_acc(spark, sf), clean.distinct_rows(fx.transactions(spark, sf)))


@register("account_profile", with_views(_PROFILE_SQL, "v_accounts", "v_identity", "v_txn"))
def account_profile(spark, sf):
    return rounded(_profile(spark, sf))


_SCALE_COLS = ["TX_COUNT", "TX_MEAN", "TX_STD", "MODE_TX_TIME", "UNIQUE_CHANNELS", "UNIQUE_TRN_CODES", "AUM_AMT", "AGE"]


def unrounded_profile_sql() -> str:
    """The profile oracle text without the final rounding (input of derived computations)."""
    import re

    return re.sub(r"round\((.*?), 6\) AS", r"\1 AS", _PROFILE_SQL.strip())


def _minmax_sql() -> str:
    body = unrounded_profile_sql()
    last = body.rfind("SELECT acc.ACCT_NBR")
    ctes, final = body[: last].rstrip(), body[last:]
    stats = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in _SCALE_COLS)
    scaled = ", ".join(
        f"round(CASE WHEN s.mx_{c} = s.mn_{c} THEN 0.0 ELSE (p.{c} - s.mn_{c}) / CAST(s.mx_{c} - s.mn_{c} AS DOUBLE) END, 6) AS {c}"
        for c in _SCALE_COLS
    )
    return f"{ctes}, prof AS ({final}), st AS (SELECT {stats} FROM prof) SELECT p.ACCT_NBR, {scaled} FROM prof p, st s"


@register("min_max_scale", with_views(_minmax_sql(), "v_accounts", "v_identity", "v_txn"))
def min_max_scale(spark, sf):
    prof = materialize(_profile(spark, sf).select("ACCT_NBR", *_SCALE_COLS), "profile")  # read by the fit and the result
    return rounded(profile.MinMaxScale.fit(prof, _SCALE_COLS).transform(prof))


# ------------------------------------------------------------------------------------------- F: windows
_F1_COLS = ["ACCT_NBR", "TOP_N", "TX_AMT", "TX_DATE", "PB_BAL", "TRN_CODE_class_0"]


@register(
    "topk_per_account",
    _tx_sql(f", ranked AS ({osql.ranked_cte()}) SELECT {sql_round(_F1_COLS, ['TX_AMT', 'PB_BAL'])} FROM ranked"),
)
def topk_per_account(spark, sf):
    return rounded(features.topk_per_account(_txn(spark, sf)).select(*_F1_COLS))


@register(
    "txn_gap",
    with_views(
        "SELECT ACCT_NBR, SEQ, TX_DATE, COALESCE(TX_DATE - lag(TX_DATE) OVER (PARTITION BY ACCT_NBR ORDER BY SEQ), -30) AS GAP "
        f"FROM (SELECT ACCT_NBR, SEQ, {FIXTURE_TODAY} - TX_DATE AS TX_DATE FROM v_etxn) e",
        "v_etxn",
    ),
)
def txn_gap(spark, sf):
    """Dates as days before today (B3) first, so gaps are negative going forward, like the first one's value."""
    e = fx.event_transactions(spark, sf).select("ACCT_NBR", "SEQ", _days_since("TX_DATE", FIXTURE_TODAY).alias("TX_DATE"))
    return windows.txn_gap(e, "ACCT_NBR", "SEQ", "TX_DATE")


_VOTE_PRED = "CASE WHEN TX_AMT > 35000 THEN 1 ELSE 0 END"


@register(
    "group_mode_broadcast",
    _tx_sql(
        f", p AS (SELECT ACCT_NBR, TX_AMT, {_VOTE_PRED} AS PRED FROM tx), "
        "m AS (SELECT ACCT_NBR, CASE WHEN 2 * sum(PRED) > count(*) THEN 1 ELSE 0 END AS GROUP_MODE FROM p GROUP BY ACCT_NBR) "
        "SELECT p.ACCT_NBR, round(p.TX_AMT, 6) AS TX_AMT, p.PRED, m.GROUP_MODE FROM p JOIN m ON p.ACCT_NBR = m.ACCT_NBR"
    ),
)
def group_mode_broadcast(spark, sf):
    t = _txn(spark, sf).select("ACCT_NBR", "TX_AMT", F.when(F.col("TX_AMT") > 35000, 1).otherwise(0).alias("PRED"))
    return rounded(windows.group_mode_broadcast(t, "ACCT_NBR", "PRED", "GROUP_MODE"))


@register(
    "duplicate_flag",
    with_views(
        "SELECT n.*, CASE WHEN g.c > 1 THEN 1 ELSE 0 END AS DUPLICATE FROM v_sheet n JOIN "
        "(SELECT ACCT_NBR, count(*) AS c FROM v_sheet GROUP BY ACCT_NBR) g ON n.ACCT_NBR = g.ACCT_NBR",
        "v_sheet",
    ),
)
def duplicate_flag(spark, sf):
    return windows.duplicate_flag(fx.answer_sheet(spark, sf), "ACCT_NBR")


@register(
    "last_write_wins",
    with_views(
        "SELECT ACCT_NBR, SEQ, round(TX_AMT, 6) AS TX_AMT, CHANNEL FROM (SELECT *, row_number() OVER (PARTITION BY ACCT_NBR ORDER BY SEQ DESC) AS rn "
        "FROM v_etxn) e WHERE rn = 1",
        "v_etxn",
    ),
)
def last_write_wins(spark, sf):
    e = fx.event_transactions(spark, sf).select("ACCT_NBR", "SEQ", "TX_AMT", "CHANNEL")
    return rounded(windows.last_write_wins(e, "ACCT_NBR", "SEQ"))


_STD_COLS = ["TX_AMT", "PB_BAL", "TX_TIME"]


@register(
    "sequence_standardize",
    _tx_sql(
        ", st AS (SELECT ACCT_NBR, "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _STD_COLS)
        + " FROM tx GROUP BY ACCT_NBR) SELECT tx.ACCT_NBR, tx.TX_DATE, "
        + ", ".join(f"round(tx.{c}, 6) AS {c}" for c in ["TX_AMT", "PB_BAL"])
        + ", tx.TX_TIME, "
        + ", ".join(
            f"round((tx.{c} - st.m_{c}) / CASE WHEN st.s_{c} = 0 THEN 1.0 ELSE st.s_{c} END, 6) AS Z_{c}" for c in _STD_COLS
        )
        + " FROM tx JOIN st ON tx.ACCT_NBR = st.ACCT_NBR"
    ),
)
def sequence_standardize(spark, sf):
    t = _txn(spark, sf).select("ACCT_NBR", "TX_DATE", "TX_AMT", "PB_BAL", "TX_TIME")
    return rounded(windows.standardize_within(t, "ACCT_NBR", _STD_COLS))


# ------------------------------------------------------------------------------------------- I5, I15
@register(
    "label_encode",
    with_views(
        "WITH c AS (SELECT DISTINCT COALESCE(OWN_TRANS_ID, 'UNKNOWN') AS t FROM v_txn), "
        "k AS (SELECT t, CAST(row_number() OVER (ORDER BY t) - 1 AS INT) AS code FROM c) "
        "SELECT v.ACCT_NBR, round(v.TX_AMT, 6) AS TX_AMT, k.code AS OWN_TRANS_ID FROM v_txn v JOIN k ON COALESCE(v.OWN_TRANS_ID, 'UNKNOWN') = k.t",
        "v_txn",
    ),
)
def label_encode_q(spark, sf):
    t = fx.transactions(spark, sf).select("ACCT_NBR", "TX_AMT", "OWN_TRANS_ID")
    return rounded(label_encode(t, "OWN_TRANS_ID"))


@register(
    "dense_id",
    with_views(
        f"WITH acc AS ({osql.account_cte()}) SELECT ACCT_NBR, row_number() OVER (ORDER BY ACCT_NBR) - 1 AS ACCT_IDX FROM acc",
        "v_accounts", "v_identity",
    ),
)
def dense_id(spark, sf):
    from riskframe.operators.ordering import row_index

    keys = _acc(spark, sf).select("ACCT_NBR").distinct()
    return row_index(keys, ["ACCT_NBR"], name="ACCT_IDX").select("ACCT_NBR", (F.col("ACCT_IDX") - 1).alias("ACCT_IDX"))
