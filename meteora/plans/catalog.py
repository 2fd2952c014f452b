"""Registry of named queries and their DuckDB oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables;
each oracle is DuckDB SQL over the same tables with the same column names.
Columns holding wall-clock stamps are left out of oracle-checked outputs.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from meteora.plans import q_anomalies, q_clustering, q_forecast, q_ingest, q_ops, q_serving, q_silver  # noqa: F401
