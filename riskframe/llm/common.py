"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import materialize

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` bigint and ``text`` (null: empty), whatever else the table holds."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def unused(df: DataFrame, prefix: str) -> str:
    """``prefix``, made longer until no column of ``df`` starts with it: for columns that an operator adds and drops."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix += "_"
    return prefix


def sized(df: DataFrame, name: str, rows: int = 100_000) -> DataFrame:
    """``df`` written to the shared folder, marked for broadcast where it has at most ``rows`` rows (of a few numbers or
    short names each); a larger one joins by a shuffle like any other table."""
    df = materialize(df, name)
    return F.broadcast(df) if df.count() <= rows else df


def held_out(id_col: Column) -> Column:
    """crc32 of the id's decimal text mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
