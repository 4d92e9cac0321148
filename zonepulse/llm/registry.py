"""Queries of this package: name -> Spark callable, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


def documents(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def load_all() -> None:
    from . import queries  # noqa: F401
