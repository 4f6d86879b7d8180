"""Registry of named queries (one per operator key of SURVEY §2) and their DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every query module so that the registry is filled."""
    from riskframe.plans import (  # noqa: F401
        account_queries,
        eval_queries,
        io_queries,
        model_queries,
        sample_queries,
        scoring_queries,
        sequence_queries,
        stream_queries,
    )
