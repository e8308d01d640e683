"""Registry of named queries and their DuckDB oracle text.

A query is a callable ``(spark, sf_dir) -> DataFrame``.  The oracle text is
an independent formulation of the same result in DuckDB SQL over the raw
tables (staged views are inlined as CTEs).
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco
