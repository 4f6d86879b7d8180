"""Shared helpers for the registered queries: fixture loading and result normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Doubles are compared after rounding to this many places on both sides (Spark and the DuckDB oracle).
PLACES = 6


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Round every double column (result normalisation for the value comparison)."""
    return df.select(
        *[
            F.round(F.col(f.name), places).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def sql_round(cols: Sequence[str], doubles: Sequence[str], places: int = PLACES, prefix: str = "") -> str:
    """Select list that rounds the named double columns, for the oracle SQL."""
    out = []
    for c in cols:
        ref = f"{prefix}{c}"
        out.append(f"round({ref}, {places}) AS {c}" if c in doubles else f"{ref} AS {c}")
    return ", ".join(out)
