"""Account feature table: per-account aggregates, amount bands, top-k spread and the joins.

Shape of the plan (one exchange per input side, all on the account key):

* ``txn_aggregates`` — one ``groupBy(key).agg`` with partial aggregation before the exchange: tempo, counts,
  band counts and ratios, means. A hot account costs one partial row per map task.
* ``topk_slots`` — ``row_number() <= k`` over ``partitionBy(key)``; Spark plans a *partial* ``WindowGroupLimit``
  before the exchange, so at most k rows per key leave each map task, then the first row looks ahead to the others and
  spreads them into columns (no self-join, no extra exchange or sort: its input is already partitioned and in order).
* ``account_features`` — accounts joined to both outputs on the key; the two aggregate sides arrive
  hash-partitioned by the key, only the account side is exchanged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.defaults import (
    ACCOUNT_ACTIONS,
    ACCOUNT_CLASSES,
    ACCOUNT_FILLS,
    AMOUNT_BANDS,
    AMOUNT_CUTS,
    TEMPO_SINGLE,
    TODAY,
    TOP_K,
    TXN_ACTIONS,
    TXN_CLASSES,
    UNKNOWN_TEXT,
)
from riskframe.functions.bands import amount_band
from riskframe.operators import clean, joins
from riskframe.operators.policy import ColumnPolicy, FittedPolicy

KEY = "ACCT_NBR"
BAND_COUNT_COLS = tuple(f"{b.upper()}_TRN_COUNT" for b in AMOUNT_BANDS)
BAND_RATIO_COLS = tuple(f"{b.upper()}_TRN_RATIO" for b in AMOUNT_BANDS)


# ---------------------------------------------------------------------------------------------- tables
def account_policy(today: int = TODAY) -> ColumnPolicy:
    return ColumnPolicy(ACCOUNT_ACTIONS, ACCOUNT_CLASSES, today)


def txn_policy(today: int = TODAY) -> ColumnPolicy:
    return ColumnPolicy(TXN_ACTIONS, TXN_CLASSES, today)


def account_table(
    accounts: DataFrame,
    identity: DataFrame,
    policy: ColumnPolicy | FittedPolicy | None = None,
    fills: Mapping[str, object] = ACCOUNT_FILLS,
    key: str = KEY,
) -> DataFrame:
    """accounts LEFT JOIN identity -> drop CUST_ID -> policy -> fills -> drop null keys (one row per account)."""
    policy = policy or account_policy()
    merged = clean.drop_columns(joins.join_identity(accounts, identity), ["CUST_ID"])
    shaped = policy.apply(merged) if isinstance(policy, ColumnPolicy) else policy.transform(merged)
    return clean.drop_null_key(clean.fill_by_column(shaped, fills), key)


def fit_txn_policy(txn: DataFrame, policy: ColumnPolicy | None = None) -> FittedPolicy:
    return (policy or txn_policy()).fit(txn)


def transaction_table(
    txn: DataFrame,
    known_accounts: DataFrame | None,
    policy: ColumnPolicy | FittedPolicy | None = None,
    key: str = KEY,
    by_key: bool = False,
) -> DataFrame:
    """dedup over all raw columns -> policy -> fill 0 -> keep rows of known accounts.

    With ``known_accounts=None`` the key restriction is left to the caller (see :func:`feature_table`). ``by_key``: the rows
    are dealt by the key, without further shuffles for what is done by account."""
    policy = policy or txn_policy()
    # one-hot lists are fitted on the raw column (dedup does not change the set of values): one small
    # distinct job instead of a full-row dedup just to read the categories
    fitted = policy.fit(txn) if isinstance(policy, ColumnPolicy) else policy
    shaped = fitted.transform(clean.distinct_rows(txn, key if by_key else None))
    filled = clean.drop_null_key(clean.fill_all_zero(shaped, exclude=[key]), key)
    return filled if known_accounts is None else joins.restrict_to_known(filled, known_accounts, key)


# ---------------------------------------------------------------------------------------------- aggregates
def tempo(date: str = "TX_DATE", single: float = TEMPO_SINGLE) -> Column:
    """(max - min) / n when an account has more than one row, else ``single``."""
    n = F.count(F.lit(1))
    return F.when(n > 1, (F.max(date) - F.min(date)) / n).otherwise(F.lit(float(single)))


def band_counts(amount: str = "TX_AMT", cuts=AMOUNT_CUTS, labels=AMOUNT_BANDS) -> list[Column]:
    """Rows per amount band; every band column exists; unbanded amounts count nowhere."""
    b = amount_band(amount, cuts, labels)
    return [F.count(F.when(b == F.lit(lab), 1)).alias(f"{lab.upper()}_TRN_COUNT") for lab in labels]


def band_ratios(labels=AMOUNT_BANDS) -> list[Column]:
    """Band count / sum of band counts; 0/0 gives 0."""
    total = sum((F.col(f"{lab.upper()}_TRN_COUNT") for lab in labels), F.lit(0))
    return [
        F.coalesce(F.try_divide(F.col(f"{lab.upper()}_TRN_COUNT").cast("double"), total), F.lit(0.0)).alias(
            f"{lab.upper()}_TRN_RATIO"
        )
        for lab in labels
    ]


def txn_aggregates(
    txn: DataFrame,
    key: str = KEY,
    date: str = "TX_DATE",
    amount: str = "TX_AMT",
    cuts=AMOUNT_CUTS,
    labels=AMOUNT_BANDS,
    aggs: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per account, in one aggregate (D1-D5): custom aggs (default: tempo of ``date``), band counts and
    ratios, the mean of every other column that isn't text, and ``TRN_COUNT``."""
    aggs = dict(aggs) if aggs is not None else {date: tempo(date)}
    mean_cols = [c for c in mean_columns(txn, key, skip=()) if c not in aggs]
    agg = txn.groupBy(key).agg(
        *[c.alias(n) for n, c in aggs.items()],
        *band_counts(amount, cuts, labels),
        *[F.avg(c).alias(c) for c in mean_cols],
        F.count(F.lit(1)).alias("TRN_COUNT"),
    )
    counts = [f"{lab.upper()}_TRN_COUNT" for lab in labels]
    return agg.select(key, *aggs.keys(), *counts, *band_ratios(labels), *mean_cols, "TRN_COUNT")


def mean_columns(txn: DataFrame, key: str = KEY, skip: Sequence[str] = ("TX_DATE",)) -> list[str]:
    """The columns that get a mean: all but the key, those in ``skip`` and texts."""
    return [f.name for f in txn.schema.fields if f.name != key and f.name not in skip and not isinstance(f.dataType, T.StringType)]


# ---------------------------------------------------------------------------------------------- top-k
def topk_order(amount: str = "TX_AMT", date: str = "TX_DATE", rest: Sequence[str] = ()) -> list[Column]:
    """Largest amount first; ties to the smaller ``date`` (days ago), then the remaining columns (total order)."""
    return [F.col(amount).desc(), F.col(date).asc(), *[F.col(c).asc() for c in rest]]


def topk_per_account(txn: DataFrame, k: int = TOP_K, key: str = KEY, order: Sequence[Column] | None = None) -> DataFrame:
    """the k largest transactions of each account with their rank ``TOP_N`` (1..k)."""
    order = order or topk_order(rest=[c for c in txn.columns if c not in (key, "TX_AMT", "TX_DATE")])
    w = Window.partitionBy(key).orderBy(*order)
    return txn.withColumn("TOP_N", F.row_number().over(w)).where(F.col("TOP_N") <= k)


def topk_wide(
    txn: DataFrame,
    k: int = TOP_K,
    key: str = KEY,
    order: Sequence[Column] | None = None,
    unknown: str = UNKNOWN_TEXT,
) -> DataFrame:
    """The top-k rows spread into ``{col}_{n}`` columns (n = 1..k, TOP_N included); absent slots are null.

    Text columns of the top-k rows are label-encoded first (sorted distinct texts of those rows -> 0..n-1)."""
    order = order or topk_order(rest=[c for c in txn.columns if c not in (key, "TX_AMT", "TX_DATE")])
    top = topk_per_account(txn, k, key, order)
    text_cols = [f.name for f in top.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key]
    if text_cols:
        from riskframe.operators.policy import label_encode

        fitted = top
        for c in text_cols:
            top = label_encode(top, c, fitted_on=fitted, unknown=unknown)
    cols = [c for c in top.columns if c != key]
    if text_cols:  # encoded by joins, which may leave the rows in another order
        slots = [F.max(F.when(F.col("TOP_N") == n, F.col(c))).alias(f"{c}_{n}") for n in range(1, k + 1) for c in cols]
        return top.groupBy(key).agg(*slots)
    # The rows still lie by account and in order: the first one looks ahead to the others, so no table of accounts is kept.
    ahead = Window.partitionBy(key).orderBy(*order)
    rows = top.withColumns({f"_rf_{n}": F.lead(F.struct(*cols), n - 1).over(ahead) for n in range(1, k + 1)}).where(F.col("TOP_N") == 1)
    return rows.select(key, *[F.col(f"_rf_{n}.{c}").alias(f"{c}_{n}") for n in range(1, k + 1) for c in cols])


# ---------------------------------------------------------------------------------------------- assembly
def account_features(
    accounts: DataFrame,
    txn: DataFrame,
    key: str = KEY,
    k: int = TOP_K,
    cuts=AMOUNT_CUTS,
    labels=AMOUNT_BANDS,
    date: str = "TX_DATE",
    single: float = TEMPO_SINGLE,
    aggs: Mapping[str, Column] | None = None,
    agg_fills: Mapping[str, object] | None = None,
) -> DataFrame:
    """Accounts LEFT JOIN per-account aggregates LEFT JOIN top-k slots, then the fills.

    Fills: the date aggregate -> ``single``, TRN_COUNT -> 0, means -> 0, slots -> 0. The six band columns of an
    account without transactions stay null (their fill belongs to the aggregate side). ``aggs`` replaces the
    customisable per-account aggregates (default: the tempo of ``date``) and ``agg_fills`` their fills."""
    agg = txn_aggregates(txn, key, date, cuts=cuts, labels=labels, aggs=aggs)
    slots = topk_wide(txn, k, key)
    joined = accounts.join(agg, key, "left").join(slots, key, "left")
    custom = list(aggs) if aggs is not None else [date]
    means = [c for c in mean_columns(txn, key, skip=()) if c not in custom]
    fills: dict[str, object] = dict(agg_fills) if agg_fills is not None else {date: float(single)}
    fills["TRN_COUNT"] = 0
    fills.update({c: 0 for c in means})
    fills.update({c: 0 for c in slots.columns if c != key})
    return clean.fill_by_column(joined, fills)


def feature_table(
    accounts: DataFrame,
    identity: DataFrame,
    txn: DataFrame,
    notices: DataFrame | None = None,
    today: int = TODAY,
    txn_fitted: FittedPolicy | None = None,
    key: str = KEY,
    cuts=AMOUNT_CUTS,
    acc_policy: ColumnPolicy | FittedPolicy | None = None,
    fills: Mapping[str, object] = ACCOUNT_FILLS,
) -> DataFrame:
    """Whole account path: account table, transaction table, C5 and, with notices, the LABEL column (C4)."""
    acc = account_table(accounts, identity, acc_policy or account_policy(today), fills, key=key)
    fitted = txn_fitted or fit_txn_policy(txn, txn_policy(today))
    tx = transaction_table(txn, None, fitted, key=key)
    if any(isinstance(f.dataType, T.StringType) for f in tx.schema.fields if f.name != key):
        # text columns are label-encoded on the top-k rows of known accounts only: restrict first
        feats = account_features(acc, joins.restrict_to_known(tx, acc, key), key, cuts=cuts)
    else:
        # Otherwise the restriction to known accounts (C2) happens in C5's left join from the account table, on
        # one aggregated row per account instead of on every transaction (no semi-join over the raw rows).
        # Transactions are shuffled once, by account; those of an account with very many are dealt over the tasks.
        hot = clean.hot_keys(txn, key)
        of = lambda df, cold: df.where(F.col(key).isin(hot) != cold) if hot else df
        feats = account_features(of(acc, True), transaction_table(of(txn, True), None, fitted, key=key, by_key=True), key, cuts=cuts)
        if hot:
            many = account_features(of(acc, False), transaction_table(of(txn, False), None, fitted, key=key), key, cuts=cuts)
            feats = feats.unionByName(many)
    return joins.label_accounts(feats, notices, key) if notices is not None else feats
