"""Builders for the DuckDB oracle text of the account path (policy tables, aggregates, slots).

They spell out, column by column, what the Spark operators compute, from the same fixed policy values.
"""

from __future__ import annotations

from riskframe.defaults import ACCOUNT_FILLS, AMOUNT_BANDS, TEMPO_SINGLE, TOP_K, TXN_CLASSES
from riskframe.sources.fixtures import FIXTURE_CUTS, FIXTURE_TODAY

# Values of the one-hot column DRCR in the fixture (1 = 'A', 2 = 'R'; 'N' is null).
FIXTURE_DRCR = (1, 2)


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _in(col: str, values) -> str:
    return f"CASE WHEN {col} IN ({', '.join(_lit(v) for v in values)}) THEN 1 ELSE 0 END"


def account_cte(today: int = FIXTURE_TODAY) -> str:
    f = ACCOUNT_FILLS
    return f"""SELECT a.ACCT_NBR,
  COALESCE(a.CANCEL_NO_CONTACT, {f['CANCEL_NO_CONTACT']}) AS CANCEL_NO_CONTACT,
  COALESCE(a.IS_DIGITAL, {f['IS_DIGITAL']}) AS IS_DIGITAL,
  COALESCE({today} - a.ACCT_OPEN_DT, {f['ACCT_OPEN_DT']}) AS ACCT_OPEN_DT,
  COALESCE(a.AUM_AMT, {f['AUM_AMT']}) AS AUM_AMT,
  COALESCE(i.DATE_OF_BIRTH, {f['DATE_OF_BIRTH']}) AS DATE_OF_BIRTH,
  COALESCE(i.YEARLYINCOMELEVEL, {f['YEARLYINCOMELEVEL']}) AS YEARLYINCOMELEVEL,
  {_in('i.CNTY_CD', [12])} AS CNTY_CD
FROM v_accounts a LEFT JOIN v_identity i ON a.CUST_ID = i.CUST_ID
WHERE a.ACCT_NBR IS NOT NULL"""


ACCOUNT_COLS = ["ACCT_NBR", "CANCEL_NO_CONTACT", "IS_DIGITAL", "ACCT_OPEN_DT", "AUM_AMT", "DATE_OF_BIRTH", "YEARLYINCOMELEVEL", "CNTY_CD"]
ACCOUNT_DOUBLES = ["AUM_AMT"]


def txn_columns() -> list[str]:
    return (
        ["ACCT_NBR", "TX_DATE", "TX_TIME", "TX_AMT", "PB_BAL", "OWN_TRANS_ID", "mb_check", "eb_check",
         "SAME_NUMBER_IP", "SAME_NUMBER_UUID", "DAY_OF_WEEK"]
        + [f"DRCR_{v}" for v in FIXTURE_DRCR]
        + [f"CHANNEL_CODE_class_{i}" for i in range(len(TXN_CLASSES["CHANNEL_CODE"]))]
        + [f"TRN_CODE_class_{i}" for i in range(len(TXN_CLASSES["TRN_CODE"]))]
    )


TXN_DOUBLES = ["TX_AMT", "PB_BAL"]


def txn_select(today: int = FIXTURE_TODAY, source: str = "v_txn") -> str:
    """Policy + fill-0 over deduplicated raw rows (no key restriction)."""
    c = TXN_CLASSES
    cols = [
        "ACCT_NBR",
        f"COALESCE({today} - TX_DATE, 0) AS TX_DATE",
        f"{_in('TX_TIME', c['TX_TIME'][0])} AS TX_TIME",
        "COALESCE(TX_AMT, 0) AS TX_AMT",
        "COALESCE(PB_BAL, 0) AS PB_BAL",
        f"{_in('OWN_TRANS_ID', c['OWN_TRANS_ID'][0])} AS OWN_TRANS_ID",
        "COALESCE(mb_check, 0) AS mb_check",
        "COALESCE(eb_check, 0) AS eb_check",
        "COALESCE(SAME_NUMBER_IP, 0) AS SAME_NUMBER_IP",
        "COALESCE(SAME_NUMBER_UUID, 0) AS SAME_NUMBER_UUID",
        f"{_in('DAY_OF_WEEK', c['DAY_OF_WEEK'][0])} AS DAY_OF_WEEK",
    ]
    cols += [f"CASE WHEN DRCR = {v} THEN 1 ELSE 0 END AS DRCR_{v}" for v in FIXTURE_DRCR]
    cols += [f"{_in('CHANNEL_CODE', lst)} AS CHANNEL_CODE_class_{i}" for i, lst in enumerate(c["CHANNEL_CODE"])]
    cols += [f"{_in('TRN_CODE', lst)} AS TRN_CODE_class_{i}" for i, lst in enumerate(c["TRN_CODE"])]
    return f"SELECT {', '.join(cols)} FROM (SELECT DISTINCT * FROM {source}) d WHERE ACCT_NBR IS NOT NULL"


def txn_cte(today: int = FIXTURE_TODAY, source: str = "v_txn") -> str:
    return f"SELECT * FROM ({txn_select(today, source)}) p WHERE ACCT_NBR IN (SELECT ACCT_NBR FROM acc)"


def band_case(col: str = "TX_AMT", cuts=FIXTURE_CUTS) -> list[tuple[str, str]]:
    bounds = list(cuts) + ["'inf'::DOUBLE"]
    out = []
    for lab, lo, hi in zip(AMOUNT_BANDS, bounds[:-1], bounds[1:]):
        out.append((lab.upper(), f"{col} > {lo} AND {col} <= {hi}"))
    return out


def mean_columns() -> list[str]:
    return [c for c in txn_columns() if c not in ("ACCT_NBR", "TX_DATE")]


def agg_cte(cuts=FIXTURE_CUTS) -> str:
    parts = [
        "ACCT_NBR",
        f"CASE WHEN count(*) > 1 THEN (max(TX_DATE) - min(TX_DATE)) / count(*) ELSE {float(TEMPO_SINGLE)} END AS TX_DATE",
    ]
    bands = band_case("TX_AMT", cuts)
    parts += [f"count(CASE WHEN {cond} THEN 1 END) AS {lab}_TRN_COUNT" for lab, cond in bands]
    total = " + ".join(f"count(CASE WHEN {cond} THEN 1 END)" for _, cond in bands)
    parts += [
        f"COALESCE(CAST(count(CASE WHEN {cond} THEN 1 END) AS DOUBLE) / NULLIF({total}, 0), 0.0) AS {lab}_TRN_RATIO"
        for lab, cond in bands
    ]
    parts += [f"avg({c}) AS {c}" for c in mean_columns()]
    parts.append("count(*) AS TRN_COUNT")
    return f"SELECT {', '.join(parts)} FROM tx GROUP BY ACCT_NBR"


AGG_COLS = (
    ["ACCT_NBR", "TX_DATE"]
    + [f"{b.upper()}_TRN_COUNT" for b in AMOUNT_BANDS]
    + [f"{b.upper()}_TRN_RATIO" for b in AMOUNT_BANDS]
)


def agg_columns() -> list[str]:
    return AGG_COLS + mean_columns() + ["TRN_COUNT"]


def agg_doubles() -> list[str]:
    return ["TX_DATE"] + [f"{b.upper()}_TRN_RATIO" for b in AMOUNT_BANDS] + mean_columns()


def topk_order_sql() -> str:
    rest = [c for c in txn_columns() if c not in ("ACCT_NBR", "TX_AMT", "TX_DATE")]
    return "TX_AMT DESC, TX_DATE ASC, " + ", ".join(f"{c} ASC" for c in rest)


def ranked_cte(k: int = TOP_K) -> str:
    return (
        f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ACCT_NBR ORDER BY {topk_order_sql()}) AS INT) AS TOP_N"
        f" FROM tx) r WHERE TOP_N <= {k}"
    )


def slot_columns(k: int = TOP_K) -> list[str]:
    base = [c for c in txn_columns() if c != "ACCT_NBR"] + ["TOP_N"]
    return [f"{c}_{n}" for n in range(1, k + 1) for c in base]


def slot_doubles(k: int = TOP_K) -> list[str]:
    return [f"{c}_{n}" for n in range(1, k + 1) for c in TXN_DOUBLES]


def slots_cte(k: int = TOP_K) -> str:
    base = [c for c in txn_columns() if c != "ACCT_NBR"] + ["TOP_N"]
    parts = [f"max(CASE WHEN TOP_N = {n} THEN {c} END) AS {c}_{n}" for n in range(1, k + 1) for c in base]
    return f"SELECT ACCT_NBR, {', '.join(parts)} FROM ranked GROUP BY ACCT_NBR"


def features_select(label: bool = True, k: int = TOP_K) -> str:
    """Final select of C5 (+ LABEL) over CTEs acc, agg, slots (and lab)."""
    cols = [f"acc.{c}" for c in ACCOUNT_COLS]
    means = set(mean_columns())
    for c in agg_columns():
        if c == "ACCT_NBR":
            continue
        if c == "TX_DATE":
            cols.append(f"COALESCE(agg.TX_DATE, {float(TEMPO_SINGLE)}) AS TX_DATE")
        elif c == "TRN_COUNT":
            cols.append("COALESCE(agg.TRN_COUNT, 0) AS TRN_COUNT")
        elif c in means:
            cols.append(f"COALESCE(agg.{c}, 0) AS {c}")
        else:
            cols.append(f"agg.{c}")
    cols += [f"COALESCE(slots.{c}, 0) AS {c}" for c in slot_columns(k)]
    if label:
        cols.append("CASE WHEN lab.ACCT_NBR IS NULL THEN 0 ELSE 1 END AS LABEL")
    joins = "acc LEFT JOIN agg ON acc.ACCT_NBR = agg.ACCT_NBR LEFT JOIN slots ON acc.ACCT_NBR = slots.ACCT_NBR"
    if label:
        joins += " LEFT JOIN lab ON acc.ACCT_NBR = lab.ACCT_NBR"
    return f"SELECT {', '.join(cols)} FROM {joins}"


def feature_doubles() -> list[str]:
    return ACCOUNT_DOUBLES + agg_doubles() + slot_doubles()


def feature_ctes(today: int = FIXTURE_TODAY, cuts=FIXTURE_CUTS, source: str = "v_txn") -> str:
    return (
        f"acc AS ({account_cte(today)}),\n tx AS ({txn_cte(today, source)}),\n agg AS ({agg_cte(cuts)}),\n"
        f" ranked AS ({ranked_cte()}),\n slots AS ({slots_cte()}),\n"
        " lab AS (SELECT DISTINCT ACCT_NBR FROM v_notices WHERE ACCT_NBR IS NOT NULL)"
    )
