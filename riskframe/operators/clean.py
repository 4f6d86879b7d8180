"""Cleaning operators: fills, key checks, deduplication, feature alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_KEYS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.StringType, T.BooleanType, T.DateType, T.TimestampType)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop by name; absent names are ignored (B2)."""
    return df.drop(*[c for c in columns if c in df.columns])


def fill_by_column(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Fill nulls per column where the column exists (B7). A fill value keeps the column's type."""
    present = {c: v for c, v in fills.items() if c in df.columns}
    if not present:
        return df
    return df.select(
        *[
            F.coalesce(F.col(c), F.lit(present[c]).cast(df.schema[c].dataType)).alias(c) if c in present else F.col(c)
            for c in df.columns
        ]
    )


def fill_all_zero(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Fill every null with zero (B8): numeric 0, text '0', boolean false."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in exclude:
            out.append(c)
        elif isinstance(f.dataType, _NUMERIC):
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(c, F.lit("0")).alias(f.name))
        elif isinstance(f.dataType, T.BooleanType):
            out.append(F.coalesce(c, F.lit(False)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is normalised to NULL (one notion of missing)."""
    return df.select(
        *[
            F.when(F.isnan(F.col(f.name)), F.lit(None)).otherwise(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.FloatType, T.DoubleType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_null_key(df: DataFrame, key: str = "ACCT_NBR") -> DataFrame:
    """Drop rows whose key is null."""
    return df.where(F.col(key).isNotNull())


def filter_known(df: DataFrame, column: str) -> DataFrame:
    """Keep rows with a finite-or-+inf result, i.e. ``column > -inf`` (B10); null and NaN rows go."""
    return df.where((F.col(column) > F.lit(float("-inf"))) & ~F.isnan(F.col(column)))


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Match a feature list (B11): missing features become 0, order is the list's, extra columns go."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in features])


def cast_int(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Cast numeric columns to bigint, truncating toward zero."""
    return df.select(
        *[
            F.col(f.name).cast("bigint").alias(f.name)
            if f.name not in exclude and isinstance(f.dataType, _NUMERIC)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def distinct_rows(df: DataFrame, near: str | None = None) -> DataFrame:
    """Drop rows equal in every column (D7), before any column is dropped.

    With ``near``, rows are dealt by that column alone: equal rows still meet, and what follows by it needs no further shuffle.
    That is for keys without very many rows each (see :func:`hot_keys`), else one task gets all of a key's.

    Equal rows come together by a shuffle on the columns other than floating-point numbers (those have more than one form
    of zero and NaN) and are compared only there: a task that reads the input would keep all rows of its split, which grow
    with the files, to find few equal ones."""
    by = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, _KEYS) and near in (None, f.name)]
    return (df.repartition(*by) if by else df).dropDuplicates()


#: Rows of a key above which they are dealt over the tasks.
HOT_ROWS = 1 << 20


def hot_keys(df: DataFrame, key: str) -> list:
    """The keys with more than ``HOT_ROWS`` rows: as many as that number goes into the rows come to the driver at most."""
    return [r[key] for r in df.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > HOT_ROWS).collect()]


def distinct_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep one row per key (D8): the first by ``order`` (made explicit; files have no order at scale).

    ``min_by`` over a struct is a combinable aggregate: one row per key leaves each map task.
    """
    others = [c for c in df.columns if c != key]
    ordkey = F.struct(*[F.col(c) for c in order])
    return (
        df.groupBy(key)
        .agg(F.min_by(F.struct(*[F.col(c) for c in others]), ordkey).alias("_first"))
        .select(key, *[F.col(f"_first.{c}").alias(c) for c in others])
    )
