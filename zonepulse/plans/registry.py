"""Registry of named queries: Spark callable + DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame built from the
driver tables (or views derived from them), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn`` under ``key``; ``sql`` is its DuckDB oracle (None = rows-only)."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_views(sql, *views) if views else sql
        return fn
    return deco


def load_all() -> None:
    """Import every query module so that the registry is filled."""
    from . import (q_calendar, q_clean, q_metrics, q_models, q_pipes,  # noqa: F401
                   q_prep, q_sources, q_spatial, q_summaries, q_windows)
