"""Account profile (D14) and fitted min-max scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.defaults import PROFILE_DOMAINS
from riskframe.operators.windows import group_mode

KEY = "ACCT_NBR"
WEEKEND = ("Saturday", "Sunday")


def distinct_codes(df: DataFrame, key: str, col: str, name: str) -> DataFrame:
    """(key, name): exact number of different values, as two hash aggregates (no set per group is built)."""
    return df.where(F.col(col).isNotNull()).select(key, col).distinct().groupBy(key).agg(F.count(F.lit(1)).alias(name))


def _coded(col: str, size: int) -> Column:
    """The code where it is one of 0 .. size - 1, else null."""
    return F.when(F.col(col).between(0, size - 1), F.col(col).cast("int"))


def _outside(col: str, size: int) -> Column:
    return F.bool_or(F.col(col).isNotNull() & ~F.col(col).between(0, size - 1))


def _checked(value: Column, outside: str, col: str, size: int) -> Column:
    return F.when(F.col(outside), F.raise_error(f"{col} has codes outside of 0 to {size - 1}: declare a larger domain, or none")).otherwise(value)


def account_profile(accounts: DataFrame, raw_txn: DataFrame, key: str = KEY, domains: Mapping[str, int] = PROFILE_DOMAINS) -> DataFrame:
    """The 23-column profile per account from raw transactions.

    ``domains`` declares columns of small whole numbers, 0 to n - 1. With them the whole profile is one hash aggregate:
    different codes are the set bits of an ``or`` over shifted bits (n up to 63), and the modal hour comes from one count for
    each hour. A code outside its declared domain is an error, never a wrong number. A column that isn't declared takes two
    hash aggregates of its own, on (account, value) and on the account, joined on the account.

    TX_STD is the sample std (0 for a single row); MODE_TX_TIME takes the smallest hour on ties;
    IS_WEEKEND is the share of weekend transactions; accounts without transactions get zeros.
    """
    codes = {"CHANNEL_CODE": "UNIQUE_CHANNELS", "TRN_CODE": "UNIQUE_TRN_CODES"}
    aggs, finals, sides = [], {}, []
    hours = domains.get("TX_TIME")
    if hours:
        aggs += [F.count(F.when(F.col("TX_TIME") == h, 1)).alias(f"_rf_h{h}") for h in range(hours)]
        aggs.append(_outside("TX_TIME", hours).alias("_rf_o_TX_TIME"))
        counts = F.array(*[F.col(f"_rf_h{h}") for h in range(hours)])
        mode = F.when(F.array_max(counts) > 0, F.array_position(counts, F.array_max(counts)).cast("int") - 1)
        finals["MODE_TX_TIME"] = _checked(mode, "_rf_o_TX_TIME", "TX_TIME", hours)
    else:
        sides.append(group_mode(raw_txn, key, "TX_TIME", "MODE_TX_TIME"))
    for c, name in codes.items():
        size = domains.get(c)
        if size and size <= 63:
            aggs.append(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), _coded(c, size))).alias(f"_rf_b_{c}"))
            aggs.append(_outside(c, size).alias(f"_rf_o_{c}"))
            seen = F.coalesce(F.bit_count(f"_rf_b_{c}"), F.lit(0)).cast("bigint")
            finals[name] = _checked(seen, f"_rf_o_{c}", c, size)
        else:
            sides.append(distinct_codes(raw_txn, key, c, name))
    t = raw_txn.groupBy(key).agg(
        F.count(F.lit(1)).alias("TX_COUNT"),
        F.sum("TX_AMT").alias("TX_SUM"),
        F.avg("TX_AMT").alias("TX_MEAN"),
        F.coalesce(F.stddev_samp("TX_AMT"), F.lit(0.0)).alias("TX_STD"),
        F.max("TX_AMT").alias("TX_MAX"),
        F.min("TX_AMT").alias("TX_MIN"),
        F.avg("PB_BAL").alias("AVG_PB_BAL"),
        F.max("PB_BAL").alias("MAX_PB_BAL"),
        F.min("PB_BAL").alias("MIN_PB_BAL"),
        F.sum("mb_check").cast("bigint").alias("SUM_MB_CHECK"),
        F.sum("eb_check").cast("bigint").alias("SUM_EB_CHECK"),
        F.max("SAME_NUMBER_IP").alias("FLAG_SAME_IP"),
        F.max("SAME_NUMBER_UUID").alias("FLAG_SAME_UUID"),
        F.avg(F.when(F.col("DAY_OF_WEEK").isin(*WEEKEND), 1.0).otherwise(0.0)).alias("IS_WEEKEND"),
        *aggs,
    )
    if finals:
        t = t.select(*[c for c in t.columns if not c.startswith("_rf_")], *[v.alias(n) for n, v in finals.items()])
    for side in sides:
        t = t.join(side, key, "left")
    filled = ["TX_COUNT", "TX_SUM", "TX_MEAN", "TX_STD", "TX_MAX", "TX_MIN", "AVG_PB_BAL", "MAX_PB_BAL", "MIN_PB_BAL",
              "MODE_TX_TIME", "UNIQUE_CHANNELS", "UNIQUE_TRN_CODES", "SUM_MB_CHECK", "SUM_EB_CHECK", "FLAG_SAME_IP",
              "FLAG_SAME_UUID", "IS_WEEKEND"]
    a = accounts.select(key, "CANCEL_NO_CONTACT", "IS_DIGITAL", "AUM_AMT", "YEARLYINCOMELEVEL",
                        F.col("ACCT_OPEN_DT").alias("ACCOUNT_AGE"), F.col("DATE_OF_BIRTH").alias("AGE"))
    j = a.join(t, key, "left")
    return j.select(
        key, "CANCEL_NO_CONTACT", "IS_DIGITAL", "AUM_AMT", "YEARLYINCOMELEVEL",
        *[F.coalesce(F.col(c), F.lit(0).cast(t.schema[c].dataType)).alias(c) for c in filled],
        "ACCOUNT_AGE", "AGE",
    )


@dataclass(frozen=True)
class MinMaxScale:
    """Min-max scaling fitted once: the fit is one global aggregate (two numbers per column, bounded), the
    transform uses them as literals — no join, no broadcast of data. A constant column scales to 0."""

    columns: tuple[str, ...]
    mins: tuple[float, ...]
    maxs: tuple[float, ...]

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str]) -> MinMaxScale:
        row = df.agg(*[F.min(c).cast("double").alias(f"mn_{c}") for c in columns],
                     *[F.max(c).cast("double").alias(f"mx_{c}") for c in columns]).first()
        return MinMaxScale(tuple(columns), tuple(row[f"mn_{c}"] for c in columns), tuple(row[f"mx_{c}"] for c in columns))

    def transform(self, df: DataFrame) -> DataFrame:
        scaled = {}
        for c, mn, mx in zip(self.columns, self.mins, self.maxs):
            if mn is None or mx is None or mx == mn:
                scaled[c] = F.when(F.col(c).isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
            else:
                scaled[c] = (F.col(c) - F.lit(mn)) / F.lit(mx - mn)
        return df.select(*[scaled[c].alias(c) if c in scaled else F.col(c) for c in df.columns])
