"""Per-account transaction sequences for sequence models (I9-I13), in long form.

A sequence is kept as rows (ACCT_NBR, POS, values...) rather than one array per account: an account with
a huge history stays spread over many tasks (positions come from the range-partitioned numbering), and
padding and masks are two lengths beside each row. No account's history is ever gathered into one array or one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.defaults import IMPORTANCE_EPS
from riskframe.operators.ordering import row_index
from riskframe.operators.windows import standardize_within

KEY = "ACCT_NBR"


def row_standardize(df: DataFrame, cols: Sequence[str], key: str = KEY, prefix: str = "Z_") -> DataFrame:
    """Standardise each row's values across the given columns (population std; zero std -> divide by 1)."""
    n = len(cols)
    mean = sum((F.col(c).cast("double") for c in cols), F.lit(0.0)) / n
    df2 = df.select(key, *cols, mean.alias("_rf_m"))
    var = sum(((F.col(c) - F.col("_rf_m")) ** 2 for c in cols), F.lit(0.0)) / n
    df3 = df2.withColumn("_rf_s", F.sqrt(var))
    scale = F.when(F.col("_rf_s") == 0, F.lit(1.0)).otherwise(F.col("_rf_s"))
    return df3.select(key, *[((F.col(c) - F.col("_rf_m")) / scale).alias(f"{prefix}{c}") for c in sorted(cols)])


def txn_sequence(txn: DataFrame, order: Sequence[Column], key: str = KEY, name: str = "POS") -> DataFrame:
    """Each account's transactions numbered 1.. in ``order`` (e.g. days-ago descending = oldest first)."""
    return row_index(txn, order, by=[key], name=name)


def pad_and_mask(seq: DataFrame, batches: DataFrame, cols: Sequence[str], key: str = KEY, pos: str = "POS", batch: str = "BATCH") -> DataFrame:
    """I11 in run-length form: every real row with its account's length LEN and the longest length BATCH_LEN of its batch.

    An account's padding is the zero rows at positions LEN + 1 to BATCH_LEN, and its mask is true there; both follow from
    the two numbers, so no padding row is ever written (a hot account would add as many to each of its batch's accounts).
    ``batches`` maps each account to its batch; an account without transactions has no row here, only padding."""
    lens = seq.groupBy(key).agg(F.max(pos).alias("LEN"))
    acc = batches.select(key, batch).join(lens, key, "left").withColumn("LEN", F.coalesce("LEN", F.lit(0)))
    longest = acc.groupBy(batch).agg(F.max("LEN").alias("BATCH_LEN"), F.min("LEN").alias("_rf_short"))
    acc = acc.join(longest, batch)
    padded = (F.col("_rf_short") < F.col("BATCH_LEN")).alias("BATCH_PADDED")
    return seq.join(acc.select(key, batch, "LEN", "BATCH_LEN", padded), key).select(
        key, batch, pos, "LEN", "BATCH_LEN", "BATCH_PADDED", *[F.col(c).cast("double").alias(c) for c in cols]
    )


def sequence_importance(padded: DataFrame, col: str, batch: str = "BATCH", eps: float = IMPORTANCE_EPS, name: str = "IMPORTANCE") -> DataFrame:
    """|value| of ``col``, min-max scaled over the batch with ``eps`` in the divisor. Padding counts as 0: it enters
    the minimum wherever an account of the batch is shorter than the longest."""
    raw = F.abs(F.col(col))
    stats = padded.groupBy(batch).agg(F.min(F.when(F.col("BATCH_PADDED"), F.lit(0.0)).otherwise(raw)).alias("_rf_mn"), F.max(raw).alias("_rf_mx"))
    out = padded.join(stats, batch)
    return out.withColumn(name, (raw - F.col("_rf_mn")) / (F.col("_rf_mx") - F.col("_rf_mn") + F.lit(eps))).drop("_rf_mn", "_rf_mx")


def scale_by_importance(df: DataFrame, cols: Sequence[str], importance: str = "IMPORTANCE", prefix: str = "SCALED_") -> DataFrame:
    """X * (1 + importance) for each sequence value."""
    return df.select("*", *[(F.col(c) * (1 + F.col(importance))).alias(f"{prefix}{c}") for c in cols])


def standardized_sequence(txn: DataFrame, cols: Sequence[str], order: Sequence[Column], key: str = KEY) -> DataFrame:
    """I10 + F6: the ordered sequence with each value standardised within its account."""
    z = standardize_within(txn, key, cols)
    return txn_sequence(z, order, key)
