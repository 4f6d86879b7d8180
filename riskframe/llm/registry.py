"""Registry of this package's queries and their DuckDB text."""

from __future__ import annotations

from importlib import import_module

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

MODULES = [
    "simhash",
    "language_id",
    "minhash",
    "mixing",
    "bpe",
    "sharding",
    "suffix_dedup",
    "toxicity",
    "token_files",
    "exact_dedup",
    "manifest",
    "divergence",
    "topk",
]


def register(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key!r}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco


def load_all() -> None:
    for m in MODULES:
        import_module(f"riskframe.llm.{m}")
