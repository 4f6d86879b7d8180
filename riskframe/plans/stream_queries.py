"""Registered queries: streaming upsert of scored events and running risk counts (M1, M2).

The event table is cut into three parquet slices (by ``SEQ % 3``, so an account's rows arrive out of order
across files); a file stream processes them one file per micro-batch (``availableNow``). A slice's rows come together
before they are written, in files as large as AQE's partitions, so there are as many micro-batches as the data need, not as
the reader had tasks. The result equals the batch answer: each account's latest successfully scored event.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.plans.common import rounded
from riskframe.plans.registry import register
from riskframe.session import scratch_path
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import with_views
from riskframe.streaming import upsert

KEY = "ACCT_NBR"
_SCHEMA = "ACCT_NBR bigint, SEQ bigint, TS timestamp_ntz, TX_DATE int, TX_AMT double, CHANNEL string"
_SLICES = 3


def score_events(rows):
    """Score = amount / (amount + 100); events of type 'error' fail to score (null)."""
    s = F.when(F.col("CHANNEL") == "error", F.lit(None).cast("double")).otherwise(F.col("TX_AMT") / (F.col("TX_AMT") + 100.0))
    return rows.withColumn("SCORE", s)


def _run(spark, sf):
    src = scratch_path(spark, "stream-src")
    e = fx.event_transactions(spark, sf)
    sliced = e.withColumn("slice", F.col("SEQ") % _SLICES).where(F.col("slice").between(0, _SLICES - 1))
    sliced.hint("rebalance", "slice").write.partitionBy("slice").parquet(src)
    sink = scratch_path(spark, "stream-sink")
    ck = scratch_path(spark, "stream-ckpt")
    upsert.run_upsert_stream(spark, f"{src}/slice=*", _SCHEMA, sink, ck, score_events, files_per_trigger=1)
    return sink


_LATEST = (
    "WITH s AS (SELECT ACCT_NBR, SEQ, CASE WHEN CHANNEL = 'error' THEN NULL ELSE TX_AMT / (TX_AMT + 100.0) END AS SCORE FROM v_etxn), "
    "ok AS (SELECT * FROM s WHERE SCORE IS NOT NULL), "
    "l AS (SELECT ACCT_NBR, SEQ, SCORE FROM (SELECT *, row_number() OVER (PARTITION BY ACCT_NBR ORDER BY SEQ DESC) AS rn FROM ok) x WHERE rn = 1) "
)
_LEVEL = "CASE WHEN SCORE >= 0.75 THEN 'high' WHEN SCORE >= 0.5 THEN 'medium' ELSE 'low' END"


@register("stream_scored_upsert", with_views(_LATEST + f"SELECT ACCT_NBR, SEQ, round(SCORE, 6) AS SCORE, {_LEVEL} AS LEVEL FROM l", "v_etxn"))
def stream_scored_upsert(spark, sf):
    """M1: latest scored event per account after streaming all files."""
    sink = _run(spark, sf)
    return rounded(upsert.current_table(spark, sink).select(KEY, "SEQ", "SCORE", "LEVEL"))


@register(
    "stream_risk_counts",
    with_views(
        _LATEST
        + f", lv AS (SELECT {_LEVEL} AS LEVEL, SCORE FROM l) "
        "SELECT 'high' AS NAME, count(CASE WHEN LEVEL = 'high' THEN 1 END) AS N FROM lv "
        "UNION ALL SELECT 'medium', count(CASE WHEN LEVEL = 'medium' THEN 1 END) FROM lv "
        "UNION ALL SELECT 'low', count(CASE WHEN LEVEL = 'low' THEN 1 END) FROM lv "
        "UNION ALL SELECT 'stored', count(*) FROM lv "
        "UNION ALL SELECT 'flagged', count(CASE WHEN SCORE >= 0.5 THEN 1 END) FROM lv "
        "UNION ALL SELECT 'processed', (SELECT count(*) FROM v_etxn)",
        "v_etxn",
    ),
)
def stream_risk_counts(spark, sf):
    """M2: counts by level, stored, flagged and processed rows, over the state that the stream left."""
    sink = _run(spark, sf)
    return upsert.latest_counts(spark, sink)
