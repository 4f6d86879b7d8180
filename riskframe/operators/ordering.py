"""Distributed ordering helpers: global row numbers and prefix sums without a single-partition window.

``Window.orderBy(..)`` with no ``partitionBy`` moves every row into one task. At scale the two-level form is
used instead:

1. ``repartitionByRange`` on (group, order) spreads the rows into balanced, ordered ranges;
2. ``sortWithinPartitions`` + ``monotonically_increasing_id`` number the rows inside each range (the id is
   ``partition_id << 33 | position`` and grows with the sorted position, no extra shuffle);
3. a per-(partition, group) summary (at most partitions x groups rows) gives each range its offset;
4. the summary goes back to the rows — as a broadcast when it is bounded by the partition count (no groups), as an
   ordinary join sized by AQE when there are groups.

The range bounds come from a sample taken when the exchange is planned, so two plans over the same input may
cut the ranges differently. The ranged rows, with their range id and in-range number as columns, are therefore
written once as a parquet table under ``spark.checkpoint.dir`` (lineage cut): the summary and the numbering read
the same materialised rows, and a lost executor cannot change them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir, materialize

_PID, _MID = "_rf_pid", "_rf_mid"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranged(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], partitions: int | None, drop: Sequence[str] = ()) -> DataFrame:
    keys = _cols(by) + _cols(order)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(_partitions(df, partitions), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_MID, F.monotonically_increasing_id())
        .drop(*drop)
    )
    return materialize(ranged, "ranged")


def row_index(
    df: DataFrame,
    order: Sequence[Column | str],
    by: Sequence[str] = (),
    name: str = "ROW_IDX",
    partitions: int | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` within its ``by`` group. Columns of ``drop`` serve the order
    only (an expression there is computed again for each comparison).

    The per-(range, group) summary has at most ranges + groups rows. It is broadcast only when that is bounded by the
    number of ranges (no ``by``). With groups it is joined like any other table, so AQE broadcasts it only after
    measuring it."""
    s = _ranged(df, by, order, partitions, drop)
    stats = s.groupBy(_PID, *by).agg(F.min(_MID).alias("_rf_first"), F.count(F.lit(1)).alias("_rf_n"))
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_rf_off", F.coalesce(F.sum("_rf_n").over(before), F.lit(0)))
    stats = stats.select(_PID, *by, "_rf_first", "_rf_off")
    # Null is a group like any other.
    theirs = {c: f"_rf_b{i}" for i, c in enumerate(by)}
    here = F.col(_PID) == F.col("_rf_p")
    for c, t in theirs.items():
        here = here & F.col(c).eqNullSafe(F.col(t))
    stats = stats.withColumnsRenamed({_PID: "_rf_p", **theirs})
    out = s.join(stats if by else F.broadcast(stats), here)
    return out.withColumn(name, F.col(_MID) - F.col("_rf_first") + F.col("_rf_off") + 1).drop(
        _PID, _MID, "_rf_p", "_rf_first", "_rf_off", *theirs.values()
    )


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Sequence[str],
    partitions: int | None = None,
    inclusive: bool = True,
) -> DataFrame:
    """Running totals of ``sums`` along ``order`` (a total order over ``df``'s rows), named ``cum_{col}``.

    Inside a range the running sum is a window over the range id; each range then adds the totals of all
    ranges before it (a broadcast of one row per range).
    """
    s = _ranged(df, (), order, partitions)
    totals = s.groupBy(_PID).agg(*[F.sum(c).alias(f"_rf_t_{c}") for c in sums])
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        _PID, *[F.coalesce(F.sum(f"_rf_t_{c}").over(before), F.lit(0)).alias(f"_rf_o_{c}") for c in sums]
    )
    upto = Window.partitionBy(_PID).orderBy(_MID)
    frame = upto.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = s.select(
        "*", *[F.coalesce(F.sum(c).over(frame), F.lit(0)).alias(f"_rf_w_{c}") for c in sums]
    ).join(F.broadcast(totals), _PID)
    return out.select(
        *[c for c in df.columns],
        *[(F.col(f"_rf_w_{c}") + F.col(f"_rf_o_{c}")).alias(f"cum_{c}") for c in sums],
    )
