"""Registered queries: sources and sinks, each a write to a fresh path in the shared checkpoint folder and a
re-read (A1-A8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.defaults import PROFILE_COLUMNS
from riskframe.functions import bands
from riskframe.operators import joins, metrics, sampling
from riskframe.plans import oracle_sql as osql
from riskframe.plans.common import rounded
from riskframe.plans.registry import register
from riskframe.session import scratch_path
from riskframe.sources import files
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import with_views

KEY = "ACCT_NBR"
_TXN_SCHEMA = (
    "ACCT_NBR bigint, TX_DATE int, TX_TIME int, DRCR int, TX_AMT double, PB_BAL double, OWN_TRANS_ID string, CHANNEL_CODE int, "
    "TRN_CODE int, mb_check int, eb_check int, SAME_NUMBER_IP int, SAME_NUMBER_UUID int, DAY_OF_WEEK string, BRANCH_NO bigint, EMP_NO bigint"
)
_TXN_COLS = [c.split()[0] for c in _TXN_SCHEMA.split(", ")]


@register("scan_tables", with_views(f"SELECT {', '.join(f'round({c}, 6) AS {c}' if c in ('TX_AMT', 'PB_BAL') else c for c in _TXN_COLS)} FROM v_txn", "v_txn"))
def scan_tables(spark, sf):
    """A1: transactions written as CSV with header, read back with an explicit schema."""
    path = files.write_csv(fx.transactions(spark, sf), scratch_path(spark, "txn-csv"))
    return rounded(files.read_table(spark, path, _TXN_SCHEMA))


_PROFILE_COLS = list(PROFILE_COLUMNS)


def _scan_profile_sql() -> str:
    from riskframe.plans.account_queries import unrounded_profile_sql

    cols = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in _PROFILE_COLS)
    return f"SELECT CAST(ACCT_NBR AS VARCHAR) AS ACCT_NBR, {cols} FROM ({unrounded_profile_sql()}) prof"


@register("scan_profile_csv", with_views(_scan_profile_sql(), "v_accounts", "v_identity", "v_txn"))
def scan_profile_csv(spark, sf):
    """A2: the account profile written as CSV under an untidy header (' acct_nbr ', padded names), read back
    header-driven: key found case-insensitively, names trimmed, numbers parsed."""
    from riskframe.plans.account_queries import _profile

    prof = _profile(spark, sf)
    messy = prof.select(*[F.col(c).alias(" acct_nbr " if c == KEY else f" {c} ") for c in prof.columns])
    path = files.write_csv(messy, scratch_path(spark, "profile-csv"))
    return rounded(files.read_profile_csv(spark, path))


_RESULT_SQL = (
    "SELECT ACCT_NBR AS account_id, round(SCORE, 6) AS fraud_probability, CASE WHEN SCORE > 0.5 THEN 1 ELSE 0 END AS fraud_prediction, "
    "CASE WHEN SCORE > 0.0 AND SCORE <= 0.3 THEN 'Low' WHEN SCORE > 0.3 AND SCORE <= 0.6 THEN 'Medium' WHEN SCORE > 0.6 AND SCORE <= 1.0 THEN 'High' END AS risk_level FROM v_scored"
)


@register("write_results", with_views(_RESULT_SQL, "v_scored"))
def write_results(spark, sf):
    """A3: the scored-account table written as CSV and read back."""
    s = fx.scored(spark, sf)
    res = s.select(
        F.col(KEY).alias("account_id"), F.col("SCORE").alias("fraud_probability"),
        bands.apply_threshold("SCORE", 0.5).alias("fraud_prediction"), bands.risk_band_cut("SCORE").alias("risk_level"),
    )
    path = files.write_csv(res, scratch_path(spark, "results"))
    schema = "account_id bigint, fraud_probability double, fraud_prediction int, risk_level string"
    return rounded(files.read_table(spark, path, schema))


_SHEET_SQL = (
    "WITH p AS (SELECT ACCT_NBR, max(CASE WHEN SCORE > 0.6 THEN 1 ELSE 0 END) AS PRED FROM v_scored GROUP BY ACCT_NBR) "
    "SELECT CAST(n.ACCT_NBR AS VARCHAR) AS ACCT_NBR, CASE WHEN p.PRED = 1 THEN '1' ELSE '' END AS Y FROM v_sheet n LEFT JOIN p ON n.ACCT_NBR = p.ACCT_NBR"
)


@register("fill_answer_sheet", with_views(_SHEET_SQL, "v_sheet", "v_scored"))
def fill_answer_sheet(spark, sf):
    """A4: answer sheet (every account, repeats and unknown accounts included) filled from predictions at 0.6, written
    to a new path and read back (keys as text)."""
    sheet = fx.answer_sheet(spark, sf)
    preds = fx.scored(spark, sf).select(KEY, bands.apply_threshold("SCORE", 0.6).alias("PRED"))
    path = files.write_sheet(files.fill_answer_sheet(sheet, preds), scratch_path(spark, "sheet"))
    return files.read_sheet(spark, path)


@register("clear_answer_sheet", with_views("SELECT CAST(ACCT_NBR AS VARCHAR) AS ACCT_NBR, '' AS Y FROM v_sheet", "v_sheet"))
def clear_answer_sheet(spark, sf):
    """A5: a filled sheet cleared, written and read back."""
    sheet = fx.answer_sheet(spark, sf).withColumn("Y", F.lit("1"))
    path = files.write_sheet(files.clear_answer_sheet(sheet), scratch_path(spark, "sheet-clear"))
    return files.read_sheet(spark, path)


def _three_way_sql() -> str:
    from riskframe.plans.sample_queries import _LAB

    return _LAB + (
        "SELECT ACCT_NBR, LABEL, CASE WHEN rn <= ceil(0.15 * nc) THEN 'test' WHEN rn <= ceil(0.3 * nc) THEN 'validation' "
        "ELSE 'train' END AS SPLIT FROM r"
    )


@register("write_splits", with_views(_three_way_sql(), "v_accounts", "v_identity", "v_notices"))
def write_splits(spark, sf):
    """Train / validation / test written as one folder per split and read back."""
    from riskframe.plans.account_queries import _acc

    lab = joins.label_accounts(_acc(spark, sf), fx.notices(spark, sf)).select(KEY, "LABEL")
    path = files.write_splits(sampling.split_three_way(lab), scratch_path(spark, "splits"))
    return spark.read.parquet(path).select(KEY, "LABEL", "SPLIT")


_HYPER = {"objective": "binary", "max_depth": 5, "eta": 0.05, "subsample": 0.8, "num_round": 1000}


def _metrics_sql() -> str:
    d = lambda a, b: f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"
    cm = (
        "SELECT count(CASE WHEN SCORE > 0.5 AND LABEL = 1 THEN 1 END) AS TP, count(CASE WHEN SCORE > 0.5 AND LABEL = 0 THEN 1 END) AS FP, "
        "count(CASE WHEN SCORE <= 0.5 AND LABEL = 1 THEN 1 END) AS FN FROM v_scored"
    )
    return (
        f"WITH c AS ({cm}), m AS (SELECT {d('TP', 'TP + FP')} AS P, {d('TP', 'TP + FN')} AS R FROM c) "
        "SELECT 'validation:precision' AS NAME, round(P, 6) AS VALUE FROM m UNION ALL SELECT 'validation:recall', round(R, 6) FROM m "
        f"UNION ALL SELECT 'validation:f1', round({d('2 * P * R', 'P + R')}, 6) FROM m"
    )


@register("metrics_json", with_views(_metrics_sql(), "v_scored"))
def metrics_json(spark, sf):
    """{hyperparameters, binary_classification_metrics: {name: {value}}} written as a JSON text file and read back as rows."""
    m = metrics.binary_metrics(fx.scored(spark, sf)).select(
        F.col("PRECISION").alias("validation:precision"), F.col("RECALL").alias("validation:recall"), F.col("F1").alias("validation:f1")
    )
    path = files.write_text(files.metrics_document(m, _HYPER), scratch_path(spark, "metrics-json"))
    return rounded(files.read_metrics_document(spark, path))


def _catalog_sql() -> str:
    """The feature table's names in order, with their types in the test views."""
    names = osql.ACCOUNT_COLS[1:] + osql.agg_columns()[1:] + osql.slot_columns()
    doubles = set(osql.feature_doubles())
    kinds = ["double" if n in doubles else "bigint" if n.endswith("TRN_COUNT") or n == "DATE_OF_BIRTH" else "int" for n in names]
    rows = ", ".join(f"({i}, '{n}', '{k}')" for i, (n, k) in enumerate(zip(names, kinds)))
    return f"SELECT CAST(POSITION AS INT) AS POSITION, NAME, TYPE FROM (VALUES {rows}) v(POSITION, NAME, TYPE)"


@register("feature_catalog", _catalog_sql())
def feature_catalog(spark, sf):
    """Ordered feature names and types of the labelled account feature table."""
    from riskframe.operators import features
    from riskframe.sources.fixtures import FIXTURE_CUTS, FIXTURE_TODAY

    ft = features.feature_table(
        fx.accounts(spark, sf), fx.identity(spark, sf), fx.transactions(spark, sf), fx.notices(spark, sf),
        today=FIXTURE_TODAY, cuts=FIXTURE_CUTS,
    )
    return files.feature_catalog(spark, ft, exclude=[KEY, "LABEL"])
