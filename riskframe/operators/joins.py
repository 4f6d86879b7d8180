"""Joins on the account key.

No join here forces a broadcast: the dimension sides (identity, notices, aggregates) grow with the data, so the
strategy is left to AQE, which broadcasts a side only after measuring it below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps the sort-merge join (with skew splitting).
All feature joins share the key ``ACCT_NBR``; the per-account aggregates come out of their exchange already
hash-partitioned by it, so joining them needs no further shuffle of those sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "ACCT_NBR"


def join_identity(accounts: DataFrame, identity: DataFrame, on: str = "CUST_ID") -> DataFrame:
    """accounts LEFT JOIN identity on ``on`` (C1); duplicate identity rows multiply. A null matches nothing: accounts
    without a customer get no identity (matching null with null would pair all of them with all such identity rows)."""
    return accounts.join(identity, on, "left").select(*accounts.columns, *[c for c in identity.columns if c != on])


def restrict_to_known(rows: DataFrame, known: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key exists in ``known`` (C2): a left-semi join, so ``known`` is read for its key only."""
    return rows.join(known.select(key), key, "left_semi")


def orphan_rows(rows: DataFrame, known: DataFrame, key: str = KEY) -> DataFrame:
    """Rows whose key is unknown (C3): the rows C2 drops, as a data-quality report. Null keys are orphans."""
    return rows.join(known.select(key), rows[key].eqNullSafe(known[key]), "left_anti")


def label_accounts(accounts: DataFrame, notices: DataFrame, key: str = KEY, label: str = "LABEL") -> DataFrame:
    """label = 1 when the account appears in the notices (deduplicated on the key), else 0 (C4)."""
    marked = notices.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_rf_hit", F.lit(1))
    return accounts.join(marked, key, "left").withColumn(label, F.coalesce("_rf_hit", F.lit(0))).drop("_rf_hit")


def txn_with_account(txn: DataFrame, accounts: DataFrame, key: str = KEY) -> DataFrame:
    """transactions LEFT JOIN account attributes (C6); the account's label travels with it when present."""
    acc = accounts.select(key, *[F.col(c).alias(c) for c in accounts.columns if c != key and c not in txn.columns])
    return txn.join(acc, key, "left")


def profile_lookup(rows: DataFrame, table: DataFrame, key: str = KEY, columns: Sequence[str] | None = None) -> DataFrame:
    """Look values up through a keyed table (C8): left join, missing key gives null."""
    cols = columns if columns is not None else [c for c in table.columns if c != key]
    return rows.join(table.select(key, *cols), key, "left")
