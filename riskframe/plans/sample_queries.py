"""Registered queries: splits, folds, bootstrap balance, synthetic rows, weights, mini-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.defaults import SEED, SMOTE_K
from riskframe.functions.hashing import sql_hash_order, sql_hash_u60
from riskframe.operators import joins, sampling
from riskframe.plans import oracle_sql as osql
from riskframe.plans.account_queries import _acc
from riskframe.plans.common import rounded
from riskframe.plans.registry import register
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import with_views

_H = sql_hash_order("ACCT_NBR", SEED)
_LAB = (
    f"WITH acc AS ({osql.account_cte()}), lab AS (SELECT DISTINCT ACCT_NBR FROM v_notices WHERE ACCT_NBR IS NOT NULL), "
    "lab_acc AS (SELECT acc.ACCT_NBR, CASE WHEN lab.ACCT_NBR IS NULL THEN 0 ELSE 1 END AS LABEL FROM acc LEFT JOIN lab ON acc.ACCT_NBR = lab.ACCT_NBR), "
    f"r AS (SELECT ACCT_NBR, LABEL, row_number() OVER (PARTITION BY LABEL ORDER BY {_H}, ACCT_NBR) AS rn, count(*) OVER (PARTITION BY LABEL) AS nc FROM lab_acc) "
)
_LAB_VIEWS = ("v_accounts", "v_identity", "v_notices")


def _labelled(spark, sf):
    return joins.label_accounts(_acc(spark, sf), fx.notices(spark, sf)).select("ACCT_NBR", "LABEL")


@register(
    "split_random",
    with_views(
        f"WITH acc AS ({osql.account_cte()}), r AS (SELECT ACCT_NBR, row_number() OVER (ORDER BY {_H}, ACCT_NBR) AS rn, count(*) OVER () AS n FROM acc) "
        "SELECT ACCT_NBR, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS SPLIT FROM r",
        "v_accounts", "v_identity",
    ),
)
def split_random(spark, sf):
    return sampling.split_random(_acc(spark, sf).select("ACCT_NBR"))


@register(
    "split_stratified",
    with_views(_LAB + "SELECT ACCT_NBR, LABEL, CASE WHEN rn <= ceil(0.2 * nc) THEN 'test' ELSE 'train' END AS SPLIT FROM r", *_LAB_VIEWS),
)
def split_stratified(spark, sf):
    return sampling.split_stratified(_labelled(spark, sf))


@register(
    "split_three_way",
    with_views(
        _LAB + "SELECT ACCT_NBR, LABEL, CASE WHEN rn <= ceil(0.15 * nc) THEN 'test' WHEN rn <= ceil(0.3 * nc) THEN 'validation' "
        "ELSE 'train' END AS SPLIT FROM r",
        *_LAB_VIEWS,
    ),
)
def split_three_way(spark, sf):
    return sampling.split_three_way(_labelled(spark, sf))


@register("stratified_folds", with_views(_LAB + "SELECT ACCT_NBR, LABEL, CAST((rn - 1) % 5 AS INT) AS FOLD FROM r", *_LAB_VIEWS))
def stratified_folds(spark, sf):
    return sampling.stratified_folds(_labelled(spark, sf))


_PICK = "CAST(c AS VARCHAR) || '-' || CAST(DRAW AS VARCHAR)"


@register(
    "balance_bootstrap",
    with_views(
        _LAB
        + ", num AS (SELECT ACCT_NBR, LABEL, row_number() OVER (PARTITION BY LABEL ORDER BY ACCT_NBR) AS i FROM lab_acc), "
        "cnt AS (SELECT count(CASE WHEN LABEL = 0 THEN 1 END) AS n0, count(CASE WHEN LABEL = 1 THEN 1 END) AS n1 FROM lab_acc), "
        "d AS (SELECT unnest(range(0, 2 * greatest(n0, n1))) AS id, greatest(n0, n1) AS m, n0, n1 FROM cnt), "
        "d2 AS (SELECT CAST(id // m AS INT) AS c, id % m AS DRAW, n0, n1 FROM d), "
        f"d3 AS (SELECT c, DRAW, {sql_hash_u60(_PICK, SEED)} % (CASE WHEN c = 0 THEN n0 ELSE n1 END) + 1 AS i FROM d2) "
        "SELECT num.ACCT_NBR, d3.DRAW, d3.c AS LABEL FROM d3 JOIN num ON num.LABEL = d3.c AND num.i = d3.i",
        *_LAB_VIEWS,
    ),
)
def balance_bootstrap(spark, sf):
    return sampling.balance_bootstrap(_labelled(spark, sf))


_SMOTE_COLS = osql.ACCOUNT_COLS[1:]


def _smote_sql() -> str:
    """Brute force: every row of the smaller class against every other one."""
    d2 = " + ".join(f"(CAST(a.{c} AS DOUBLE) - CAST(b.{c} AS DOUBLE)) * (CAST(a.{c} AS DOUBLE) - CAST(b.{c} AS DOUBLE))" for c in _SMOTE_COLS)
    chance = lambda what: sql_hash_u60(f"'{what}-' || CAST(j AS VARCHAR)", SEED)
    between = ", ".join(f"round(CAST(x.{c} AS DOUBLE) + U * (CAST(y.{c} AS DOUBLE) - CAST(x.{c} AS DOUBLE)), 6) AS {c}" for c in _SMOTE_COLS)
    return _LAB + (
        ", m AS (SELECT acc.*, row_number() OVER (ORDER BY acc.ACCT_NBR) AS i, count(*) OVER () AS n FROM acc JOIN lab_acc l ON acc.ACCT_NBR = l.ACCT_NBR WHERE l.LABEL = 1), "
        f"nn AS (SELECT a.ACCT_NBR, b.ACCT_NBR AS other, row_number() OVER (PARTITION BY a.ACCT_NBR ORDER BY {d2}, b.ACCT_NBR) AS rk FROM m a JOIN m b ON a.ACCT_NBR <> b.ACCT_NBR QUALIFY rk <= {SMOTE_K}), "
        "c AS (SELECT count(CASE WHEN LABEL = 0 THEN 1 END) AS n0, count(CASE WHEN LABEL = 1 THEN 1 END) AS n1 FROM lab_acc), "
        "j AS (SELECT unnest(range(0, n0 - n1)) AS j FROM c), "
        f"d AS (SELECT j AS DRAW, {chance('base')} % (SELECT n1 FROM c) + 1 AS i, {chance('near')} AS near, CAST({chance('place')} AS DOUBLE) / 1152921504606846976.0 AS U FROM j) "
        f"SELECT DRAW, x.ACCT_NBR AS BASE, y.ACCT_NBR AS NEIGHBOUR, round(U, 6) AS U, {between}, 1 AS LABEL FROM d JOIN m x ON x.i = d.i "
        f"JOIN nn ON nn.ACCT_NBR = x.ACCT_NBR AND nn.rk = d.near % least({SMOTE_K}, x.n - 1) + 1 JOIN m y ON y.ACCT_NBR = nn.other"
    )


@register("smote", with_views(_smote_sql(), *_LAB_VIEWS))
def smote(spark, sf):
    """Synthetic notice accounts over the account attributes, up to the number of the others."""
    lab = joins.label_accounts(_acc(spark, sf), fx.notices(spark, sf))
    return rounded(sampling.smote(lab.select("ACCT_NBR", *_SMOTE_COLS, "LABEL"), _SMOTE_COLS))


@register(
    "class_weights",
    with_views(
        _LAB + ", cnt AS (SELECT count(CASE WHEN LABEL = 0 THEN 1 END) AS n0, count(CASE WHEN LABEL = 1 THEN 1 END) AS n1 FROM lab_acc) "
        "SELECT ACCT_NBR, LABEL, round(CASE WHEN LABEL = 1 THEN (CASE WHEN n1 > 0 THEN n0 / n1 ELSE 1.0 END) ELSE 1.0 END, 6) AS WEIGHT FROM lab_acc, cnt",
        *_LAB_VIEWS,
    ),
)
def class_weights(spark, sf):
    return rounded(sampling.class_weights(_labelled(spark, sf)))


@register(
    "mini_batches",
    with_views(
        f"WITH acc AS ({osql.account_cte()}), r AS (SELECT ACCT_NBR, row_number() OVER (ORDER BY {_H}, ACCT_NBR) AS rn, count(*) OVER () AS n FROM acc), "
        "s AS (SELECT ACCT_NBR, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS SPLIT FROM r) "
        f"SELECT ACCT_NBR, SPLIT, (row_number() OVER (PARTITION BY SPLIT ORDER BY {_H}, ACCT_NBR) - 1) // 32 AS BATCH FROM s",
        "v_accounts", "v_identity",
    ),
)
def mini_batches(spark, sf):
    s = sampling.split_random(_acc(spark, sf).select("ACCT_NBR"))
    return sampling.mini_batches(s, by=["SPLIT"])
