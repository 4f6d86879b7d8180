"""Account / transaction views over the driver's star-schema tables.

The library works on account, identity, transaction and notice tables. The test data holds orders, customers,
line items and events instead; these views shape them into the library's tables (FIXTURES.md). Each view exists
twice: as a Spark DataFrame (used by the registered queries) and as DuckDB text (used by the oracle SQL).
All rows of the base tables flow through; modulo expressions only *shape values* (nulls, codes, duplicates).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.defaults import AMOUNT_CUTS

# "today" of the views: 2002-01-01 as a day serial.
FIXTURE_TODAY = 11688
# Amount cuts: the default ones (the transaction view has amounts in all three bands and below the first cut).
FIXTURE_CUTS = AMOUNT_CUTS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day_serial(c: Column) -> Column:
    return F.unix_date(F.to_date(c))


# English day names indexed by dayofweek() (1 = Sunday ... 7 = Saturday).
_DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def _day_name(c: str) -> Column:
    """Same text as ``date_format(c, 'EEEE')``, without a per-row formatter."""
    return F.element_at(F.array(*[F.lit(d) for d in _DAY_NAMES]), F.dayofweek(F.col(c)))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("ACCT_NBR"),
        F.when(F.col("o_orderkey") % 29 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("CUST_ID"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("CANCEL_NO_CONTACT"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1)
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise(0)
        .alias("IS_DIGITAL"),
        F.when(F.col("o_orderkey") % 23 == 0, F.lit(None)).otherwise(_day_serial("o_orderdate")).alias("ACCT_OPEN_DT"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("AUM_AMT"),
    )


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.when(F.col("c_custkey") == 7, F.lit(None))
        .when(F.col("c_custkey") % 50 == 0, -F.col("c_custkey"))
        .otherwise(F.col("c_custkey"))
        .alias("CUST_ID"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(20 + F.col("c_custkey") % 60).alias("DATE_OF_BIRTH"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .when(F.col("c_acctbal") < 3000, 1)
        .when(F.col("c_acctbal") < 6000, 2)
        .otherwise(3)
        .alias("YEARLYINCOMELEVEL"),
        F.when(F.col("c_nationkey") == 7, F.lit(None)).otherwise(F.col("c_nationkey")).alias("CNTY_CD"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a transaction, an exact copy of each tenth account's rows, and each thirteenth account's rows
    once more under a number that no account has. Amounts lie in all three bands, and some below the first cut."""
    base = _transactions(spark, sf_dir)
    unknown = base.where(F.col("ACCT_NBR") % 13 == 0).withColumn("ACCT_NBR", -F.col("ACCT_NBR"))
    return base.unionByName(base.where(F.col("ACCT_NBR") % 10 == 0)).unionByName(unknown)


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    amount = (
        F.when(F.col("l_partkey") % 97 == 0, F.lit(0.5))
        .when(F.col("l_partkey") % 4 == 1, F.floor(F.col("l_extendedprice") / 200).cast("double"))
        .when(F.col("l_partkey") % 9 == 2, F.col("l_extendedprice") * 3)
        .otherwise(F.col("l_extendedprice"))
    )
    return li.select(
        F.col("l_orderkey").alias("ACCT_NBR"),
        _day_serial("l_shipdate").alias("TX_DATE"),
        (F.col("l_partkey") % 24).cast("int").alias("TX_TIME"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "R", 2).alias("DRCR"),
        amount.alias("TX_AMT"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None)).otherwise(F.col("l_quantity")).alias("PB_BAL"),
        F.when(F.col("l_suppkey") % 3 == 0, F.lit("ID99999"))
        .otherwise(F.concat(F.lit("ID"), F.col("l_suppkey").cast("string")))
        .alias("OWN_TRANS_ID"),
        (F.col("l_suppkey") % 19 + 1).cast("int").alias("CHANNEL_CODE"),
        (F.col("l_partkey") % 54 + 1).cast("int").alias("TRN_CODE"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("mb_check"),
        F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("eb_check"),
        (F.col("l_linenumber") % 2).cast("int").alias("SAME_NUMBER_IP"),
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("SAME_NUMBER_UUID"),
        _day_name("l_shipdate").alias("DAY_OF_WEEK"),
        F.col("l_partkey").alias("BRANCH_NO"),
        F.col("l_suppkey").alias("EMP_NO"),
    )


def transactions_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions plus an exact copy of every tenth account's rows (duplicate input for deduplication)."""
    t = transactions(spark, sf_dir)
    return t.unionByName(t.where(F.col("ACCT_NBR") % 10 == 0))


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
    base = o.select(
        F.col("o_custkey").alias("CUST_ID"), F.col("o_orderkey").alias("ACCT_NBR"), _day_serial("o_orderdate").alias("DATA_DT")
    )
    again = o.where(F.col("o_orderkey") % 5 == 0).select(
        F.col("o_custkey").alias("CUST_ID"), F.col("o_orderkey").alias("ACCT_NBR"), (_day_serial("o_orderdate") + 1).alias("DATA_DT")
    )
    unknown = o.where(F.col("o_orderkey") % 7 == 0).select(
        F.col("o_custkey").alias("CUST_ID"), (-F.col("o_orderkey")).alias("ACCT_NBR"), _day_serial("o_orderdate").alias("DATA_DT")
    )
    return base.unionByName(again).unionByName(unknown)


def answer_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every account, each fifth one twice, and each seventh one's number negated (unknown)."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ACCT_NBR"))
    unknown = o.where(F.col("ACCT_NBR") % 7 == 0).select((-F.col("ACCT_NBR")).alias("ACCT_NBR"))
    rows = o.unionByName(o.where(F.col("ACCT_NBR") % 5 == 0)).unionByName(unknown)
    return rows.withColumn("Y", F.lit(""))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("ACCT_NBR"),
        F.col("event_id").alias("SEQ"),
        F.col("ts").alias("TS"),
        _day_serial("ts").alias("TX_DATE"),
        F.col("value").alias("TX_AMT"),
        F.col("event_type").alias("CHANNEL"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed (account, score, label) rows for evaluation operators; many tied scores and an exact 0 in 1 %."""
    o = table(spark, sf_dir, "orders")
    s = o.select(
        F.col("o_orderkey").alias("ACCT_NBR"),
        F.when(F.col("o_orderkey") % 101 == 0, F.lit(0.0))
        .otherwise(
            F.floor(1000 * F.col("o_totalprice") / (F.col("o_totalprice") + 100000)).cast("double") / F.lit(1000.0)
        )
        .alias("SCORE"),
    )
    return s.select(
        "ACCT_NBR",
        "SCORE",
        F.when((F.col("ACCT_NBR") * 7919) % 1000 < 1000 * F.pow(F.col("SCORE"), 4), 1).otherwise(0).alias("LABEL"),
    )


def scored_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored rows, with NaN for each 37th account's score."""
    nan = F.lit(float("nan"))
    return scored(spark, sf_dir).withColumn("SCORE", F.when(F.col("ACCT_NBR") % 37 == 0, nan).otherwise(F.col("SCORE")))


# --------------------------------------------------------------------------------------------------
# DuckDB text of the same views (oracle side). Only the base tables are registered there.

DUCK_VIEWS = {
    "v_accounts": """
SELECT o_orderkey AS ACCT_NBR, CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_custkey END AS CUST_ID,
  CASE WHEN o_orderstatus='P' THEN 1 ELSE 0 END AS CANCEL_NO_CONTACT,
  CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 WHEN o_orderpriority='5-LOW' THEN NULL ELSE 0 END AS IS_DIGITAL,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) END AS ACCT_OPEN_DT,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_totalprice END AS AUM_AMT FROM orders""",
    "v_identity": """
SELECT CASE WHEN c_custkey = 7 THEN NULL WHEN c_custkey % 50 = 0 THEN -c_custkey ELSE c_custkey END AS CUST_ID,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 20 + c_custkey % 60 END AS DATE_OF_BIRTH,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN 1 WHEN c_acctbal < 6000 THEN 2 ELSE 3 END AS YEARLYINCOMELEVEL,
  CASE WHEN c_nationkey = 7 THEN NULL ELSE c_nationkey END AS CNTY_CD FROM customer""",
    "v_txn": """
SELECT * FROM v_txn_base UNION ALL SELECT * FROM v_txn_base WHERE ACCT_NBR % 10 = 0
 UNION ALL SELECT * REPLACE (-ACCT_NBR AS ACCT_NBR) FROM v_txn_base WHERE ACCT_NBR % 13 = 0""",
    "v_txn_base": """
SELECT l_orderkey AS ACCT_NBR, CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS INT) AS TX_DATE,
  CAST(l_partkey % 24 AS INT) AS TX_TIME,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 END AS DRCR,
  CASE WHEN l_partkey % 97 = 0 THEN CAST(0.5 AS DOUBLE) WHEN l_partkey % 4 = 1 THEN CAST(floor(l_extendedprice / 200) AS DOUBLE)
    WHEN l_partkey % 9 = 2 THEN l_extendedprice * 3 ELSE l_extendedprice END AS TX_AMT,
  CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_quantity END AS PB_BAL,
  CASE WHEN l_suppkey % 3 = 0 THEN 'ID99999' ELSE concat('ID', CAST(l_suppkey AS VARCHAR)) END AS OWN_TRANS_ID,
  CAST(l_suppkey % 19 + 1 AS INT) AS CHANNEL_CODE, CAST(l_partkey % 54 + 1 AS INT) AS TRN_CODE,
  CASE WHEN l_linestatus='O' THEN 1 ELSE 0 END AS mb_check, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS eb_check,
  CAST(l_linenumber % 2 AS INT) AS SAME_NUMBER_IP, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS SAME_NUMBER_UUID,
  dayname(l_shipdate) AS DAY_OF_WEEK, l_partkey AS BRANCH_NO, l_suppkey AS EMP_NO FROM lineitem""",
    "v_txn_rep": """
SELECT * FROM v_txn UNION ALL SELECT * FROM v_txn WHERE ACCT_NBR % 10 = 0""",
    "v_notices": """
SELECT o_custkey AS CUST_ID, o_orderkey AS ACCT_NBR, CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) AS DATA_DT
  FROM orders WHERE o_orderstatus='F' AND o_orderpriority='1-URGENT'
 UNION ALL SELECT o_custkey, o_orderkey, CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) + 1
  FROM orders WHERE o_orderstatus='F' AND o_orderpriority='1-URGENT' AND o_orderkey % 5 = 0
 UNION ALL SELECT o_custkey, -o_orderkey, CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT)
  FROM orders WHERE o_orderstatus='F' AND o_orderpriority='1-URGENT' AND o_orderkey % 7 = 0""",
    "v_sheet": """
SELECT o_orderkey AS ACCT_NBR, '' AS Y FROM orders UNION ALL SELECT o_orderkey, '' FROM orders WHERE o_orderkey % 5 = 0
 UNION ALL SELECT -o_orderkey, '' FROM orders WHERE o_orderkey % 7 = 0""",
    "v_scored_nan": """
SELECT ACCT_NBR, CASE WHEN ACCT_NBR % 37 = 0 THEN CAST('nan' AS DOUBLE) ELSE SCORE END AS SCORE, LABEL FROM v_scored""",
    "v_etxn": """
SELECT user_id AS ACCT_NBR, event_id AS SEQ, ts AS TS, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INT) AS TX_DATE,
  value AS TX_AMT, event_type AS CHANNEL FROM events""",
    "v_scored": """
SELECT ACCT_NBR, SCORE, CASE WHEN (ACCT_NBR * 7919) % 1000 < 1000 * SCORE * SCORE * SCORE * SCORE THEN 1 ELSE 0 END AS LABEL FROM
 (SELECT o_orderkey AS ACCT_NBR, CASE WHEN o_orderkey % 101 = 0 THEN CAST(0 AS DOUBLE)
   ELSE CAST(floor(1000 * o_totalprice / (o_totalprice + 100000)) AS DOUBLE) / CAST(1000 AS DOUBLE) END AS SCORE FROM orders) t""",
}

_VIEW_DEPS = {"v_txn": ["v_txn_base"], "v_txn_rep": ["v_txn"], "v_scored_nan": ["v_scored"]}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with a WITH clause holding the named views (and what they depend on)."""
    ordered: list[str] = []

    def add(v: str) -> None:
        for d in _VIEW_DEPS.get(v, []):
            add(d)
        if v not in ordered:
            ordered.append(v)

    for v in views:
        add(v)
    ctes = ",\n".join(f"{v} AS ({DUCK_VIEWS[v].strip()})" for v in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
