"""Registered queries over the driver tables, each with its SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL`` (DuckDB dialect, over the
driver's pre-registered views). Every query reads whole tables; nothing is capped or sampled.
Modules add entries with ``register``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from snapmart.plans import queries_checks, queries_jobs, queries_landing, queries_models, queries_upsert  # noqa: F401,E501
