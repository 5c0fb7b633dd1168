"""Registry of query keys: Spark callable + DuckDB oracle SQL.

A query callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame. The
oracle is optional: iterative or randomised operators (forests, k-means) have
none and are checked by invariants in the tests instead.

Calling a query builds its DataFrame. Queries of models, loads, streams, quantiles and
stored slices run Spark jobs while they build it; the others are lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}
IDS: dict[str, str] = {}  # key -> SURVEY operator ids it covers


def register(key: str, ids: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        IDS[key] = ids
        if oracle is not None:
            ORACLE[key] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from branchbook.plans import (  # noqa: F401
        analytical,
        bi,
        enrichment,
        ml_jobs,
        quality_jobs,
        stats_jobs,
        warehouse_jobs,
    )
    from branchbook.streaming import adjustments, incremental  # noqa: F401
