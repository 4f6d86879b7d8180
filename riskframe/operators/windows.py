"""Per-group row operators (F2-F6) written so that a hot key never lands whole in one task.

* group statistics (mode, count, mean/std) are combinable aggregates joined back on the key — the aggregate
  side holds one row per key, so AQE's skew-join split handles a hot key on the row side;
* "previous row in order" (lag) is computed over range partitions of (key, order): a hot key spans several
  ranges, and the first row of each range takes its predecessor from the last row of the range before it
  (one row per range, broadcast);
* "latest row per key" is ``max_by`` — an aggregate with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.defaults import FIRST_GAP
from riskframe.operators.ordering import _MID, _PID, _ranged


def lag_in_order(df: DataFrame, key: str, order: Sequence[str], col: str, name: str, partitions: int | None = None) -> DataFrame:
    """``name`` = value of ``col`` on the previous row of the same key in ``order`` (null for the first)."""
    s = _ranged(df, [key], order, partitions)
    inside = Window.partitionBy(key, _PID).orderBy(_MID)  # a hot key stays split by range, the others spread by key
    s = s.withColumn("_rf_pk", F.lag(_MID).over(inside)).withColumn("_rf_pv", F.lag(col).over(inside))
    last = s.groupBy(_PID).agg(F.max_by(F.struct(F.col(key).alias("k"), F.col(col).alias("v")), F.col(_MID)).alias("_rf_last"))
    prev_range = Window.orderBy(_PID)
    last = last.select(_PID, F.lag("_rf_last").over(prev_range).alias("_rf_edge"))
    out = s.join(F.broadcast(last), _PID, "left")
    # only a key's first row in its range has no row before it there; the range before may end with the same key
    prev = F.when(F.col("_rf_pk").isNotNull(), F.col("_rf_pv")).when(F.col("_rf_edge.k") == F.col(key), F.col("_rf_edge.v"))
    return out.select(*df.columns, prev.alias(name))


def txn_gap(df: DataFrame, key: str, order: str, date: str, first: int = FIRST_GAP, name: str = "GAP") -> DataFrame:
    """``date`` minus the previous ``date`` of the account in ``order``; the first row gets ``first``."""
    lagged = lag_in_order(df, key, [order], date, "_rf_prev")
    return lagged.select(*df.columns, F.coalesce(F.col(date) - F.col("_rf_prev"), F.lit(first)).alias(name))


def group_mode(df: DataFrame, key: str, col: str, name: str = "GROUP_MODE") -> DataFrame:
    """(key, name): the group's most frequent value, the smallest on ties. Values are counted by a hash aggregate first,
    so no group's values are gathered."""
    counts = df.where(F.col(col).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("_rf_c"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("_rf_c")).alias("c"), F.col(col).alias("v"))).alias("_rf_b"))
    return best.select(key, F.col("_rf_b.v").alias(name))


def group_mode_broadcast(df: DataFrame, key: str, col: str, name: str = "GROUP_MODE") -> DataFrame:
    """the group's mode (smallest on ties) attached to every row of the group."""
    return df.join(group_mode(df, key, col, name), key, "left")


def duplicate_flag(df: DataFrame, key: str, name: str = "DUPLICATE") -> DataFrame:
    """1 on every row whose key occurs more than once, else 0."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rf_c"))
    return df.join(counts, key, "left").withColumn(name, F.when(F.col("_rf_c") > 1, 1).otherwise(0)).drop("_rf_c")


def last_write_wins(df: DataFrame, key: str, seq: str) -> DataFrame:
    """per key, the row with the largest ``seq`` (a later write replaces the earlier one)."""
    others = [c for c in df.columns if c != key]
    latest = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(seq)).alias("_rf_row"))
    return latest.select(key, *[F.col(f"_rf_row.{c}").alias(c) for c in others])


def standardize_within(df: DataFrame, key: str, cols: Sequence[str], prefix: str = "Z_") -> DataFrame:
    """(x - group mean) / group population std per column; a zero std divides by 1."""
    stats = df.groupBy(key).agg(
        *[F.avg(c).alias(f"_rf_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_rf_s_{c}") for c in cols]
    )
    j = df.join(stats, key, "left")
    z = [
        ((F.col(c) - F.col(f"_rf_m_{c}")) / F.when(F.col(f"_rf_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_rf_s_{c}"))).alias(
            f"{prefix}{c}"
        )
        for c in cols
    ]
    return j.select(*df.columns, *z)
