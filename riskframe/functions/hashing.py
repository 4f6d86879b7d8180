"""Seeded, engine-independent chance: md5 of ``seed-key`` read as a number.

The same text gives the same md5 in Spark and in SQL engines, so random-looking choices (splits, folds,
bootstrap draws, samples) are reproducible and checkable, and need no driver-side random state.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def seeded_text(key: Column | str, seed: int | str) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(f"{seed}-"), k.cast("string"))


def hash_order(key: Column | str, seed: int | str) -> Column:
    """The md5 hex of ``seed-key`` (sorts like a uniform random number)."""
    return F.md5(seeded_text(key, seed))


def hash_u60(key: Column | str, seed: int | str) -> Column:
    """First 60 bits of md5(``seed-key``) as a bigint in [0, 2^60): wide enough to pick one of any number of rows."""
    return F.conv(F.substring(hash_order(key, seed), 1, 15), 16, 10).cast("bigint")


def sql_hash_u60(key_sql: str, seed: int | str) -> str:
    """DuckDB text of :func:`hash_u60`."""
    return f"CAST('0x' || substr(md5(concat('{seed}-', CAST({key_sql} AS VARCHAR))), 1, 15) AS BIGINT)"


def sql_hash_order(key_sql: str, seed: int | str) -> str:
    return f"md5(concat('{seed}-', CAST({key_sql} AS VARCHAR)))"
