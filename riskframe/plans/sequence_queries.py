"""Registered queries: transaction sequences for sequence models."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.defaults import SEED
from riskframe.functions.hashing import sql_hash_order
from riskframe.operators import sampling, sequence
from riskframe.plans import oracle_sql as osql
from riskframe.plans.account_queries import _acc, _tx_sql, _txn
from riskframe.plans.common import rounded
from riskframe.plans.registry import register
from riskframe.sources.fixtures import with_views

_ROW_COLS = ["CANCEL_NO_CONTACT", "IS_DIGITAL", "ACCT_OPEN_DT", "AUM_AMT", "DATE_OF_BIRTH", "YEARLYINCOMELEVEL", "CNTY_CD"]


def _row_std_sql() -> str:
    n = len(_ROW_COLS)
    mean = "(" + " + ".join(f"CAST({c} AS DOUBLE)" for c in _ROW_COLS) + f") / {n}"
    var = "(" + " + ".join(f"pow({c} - m, 2)" for c in _ROW_COLS) + f") / {n}"
    z = ", ".join(f"round(({c} - m) / CASE WHEN s = 0 THEN 1.0 ELSE s END, 6) AS Z_{c}" for c in sorted(_ROW_COLS))
    return (
        f"WITH acc AS ({osql.account_cte()}), a AS (SELECT *, {mean} AS m FROM acc), b AS (SELECT *, sqrt({var}) AS s FROM a) "
        f"SELECT ACCT_NBR, {z} FROM b"
    )


@register("row_standardize", with_views(_row_std_sql(), "v_accounts", "v_identity"))
def row_standardize(spark, sf):
    return rounded(sequence.row_standardize(_acc(spark, sf), _ROW_COLS))


_SEQ_ORDER = "ORDER BY TX_DATE DESC, TX_AMT DESC, PB_BAL DESC"


def _seq_order():
    return [F.col("TX_DATE").desc(), F.col("TX_AMT").desc(), F.col("PB_BAL").desc()]


@register(
    "txn_sequence",
    _tx_sql(
        f"SELECT ACCT_NBR, row_number() OVER (PARTITION BY ACCT_NBR {_SEQ_ORDER}) AS POS, TX_DATE, round(TX_AMT, 6) AS TX_AMT, "
        "round(PB_BAL, 6) AS PB_BAL FROM tx"
    ),
)
def txn_sequence(spark, sf):
    t = _txn(spark, sf).select("ACCT_NBR", "TX_DATE", "TX_AMT", "PB_BAL")
    return rounded(sequence.txn_sequence(t, _seq_order()))


_PAD_CTES = (
    ", st AS (SELECT ACCT_NBR, avg(TX_AMT) AS m, stddev_pop(TX_AMT) AS s FROM tx GROUP BY ACCT_NBR), "
    f"seq AS (SELECT tx.ACCT_NBR, row_number() OVER (PARTITION BY tx.ACCT_NBR {_SEQ_ORDER}) AS POS, "
    "(TX_AMT - st.m) / CASE WHEN st.s = 0 THEN 1.0 ELSE st.s END AS Z_TX_AMT FROM tx JOIN st ON tx.ACCT_NBR = st.ACCT_NBR), "
    f"b AS (SELECT ACCT_NBR, (row_number() OVER (ORDER BY {sql_hash_order('ACCT_NBR', SEED)}, ACCT_NBR) - 1) // 32 AS BATCH FROM acc), "
    "lens AS (SELECT b.ACCT_NBR, b.BATCH, COALESCE(max(seq.POS), 0) AS len FROM b LEFT JOIN seq ON b.ACCT_NBR = seq.ACCT_NBR GROUP BY b.ACCT_NBR, b.BATCH), "
    "bm AS (SELECT BATCH, max(len) AS mx FROM lens GROUP BY BATCH), "
    "pad AS (SELECT seq.ACCT_NBR, lens.BATCH, seq.POS, false AS MASK, seq.Z_TX_AMT FROM seq JOIN lens ON seq.ACCT_NBR = lens.ACCT_NBR "
    "UNION ALL SELECT l.ACCT_NBR, l.BATCH, unnest(range(l.len + 1, bm.mx + 1)) AS POS, true AS MASK, 0.0 AS Z_TX_AMT "
    "FROM lens l JOIN bm ON l.BATCH = bm.BATCH WHERE l.len < bm.mx), "
    "imp AS (SELECT *, CASE WHEN MASK THEN 0.0 ELSE abs(Z_TX_AMT) END AS raw FROM pad), "
    "ist AS (SELECT BATCH, min(raw) AS mn, max(raw) AS mx FROM imp GROUP BY BATCH), "
    "bp AS (SELECT l.BATCH, min(l.len) < max(l.len) AS BATCH_PADDED FROM lens l GROUP BY l.BATCH), "
    "fin AS (SELECT imp.ACCT_NBR, imp.BATCH, imp.POS, imp.MASK, lens.len AS LEN, bm.mx AS BATCH_LEN, bp.BATCH_PADDED, imp.Z_TX_AMT, "
    "(raw - ist.mn) / (ist.mx - ist.mn + 1e-6) AS IMPORTANCE FROM imp JOIN ist ON imp.BATCH = ist.BATCH JOIN lens ON imp.ACCT_NBR = lens.ACCT_NBR "
    "JOIN bm ON imp.BATCH = bm.BATCH JOIN bp ON imp.BATCH = bp.BATCH) "
)
_REAL = "SELECT ACCT_NBR, BATCH, POS, LEN, BATCH_LEN, BATCH_PADDED, round(Z_TX_AMT, 6) AS Z_TX_AMT "


def _padded(spark, sf):
    acc = _acc(spark, sf)
    t = _txn(spark, sf).select("ACCT_NBR", "TX_DATE", "TX_AMT", "PB_BAL")
    seq = sequence.standardized_sequence(t, ["TX_AMT"], _seq_order())
    batches = sampling.mini_batches(acc.select("ACCT_NBR"))
    return sequence.pad_and_mask(seq, batches, ["Z_TX_AMT"])


@register("pad_and_mask", _tx_sql(_PAD_CTES + _REAL + "FROM fin WHERE NOT MASK"))
def pad_and_mask(spark, sf):
    return rounded(_padded(spark, sf))


@register(
    "sequence_importance",
    _tx_sql(_PAD_CTES + _REAL + ", round(IMPORTANCE, 6) AS IMPORTANCE FROM fin WHERE NOT MASK"),
)
def sequence_importance(spark, sf):
    return rounded(sequence.sequence_importance(_padded(spark, sf), "Z_TX_AMT"))


@register(
    "scale_by_importance",
    _tx_sql(
        _PAD_CTES + _REAL + ", round(IMPORTANCE, 6) AS IMPORTANCE, "
        "round(Z_TX_AMT * (1 + IMPORTANCE), 6) AS SCALED_Z_TX_AMT FROM fin WHERE NOT MASK"
    ),
)
def scale_by_importance(spark, sf):
    imp = sequence.sequence_importance(_padded(spark, sf), "Z_TX_AMT")
    return rounded(sequence.scale_by_importance(imp, ["Z_TX_AMT"]))
