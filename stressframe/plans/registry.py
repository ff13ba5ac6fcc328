"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``sql`` is
    the equivalent DuckDB statement (None: no SQL form, rows-only check)."""

    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def stored(build):
    """Keep ``build(spark, sf_dir)``'s result (checkpointed tables, fitted models) for
    the application, so recipes that share it train once."""
    kept: dict = {}

    @functools.wraps(build)
    def get(spark, sf_dir):
        key = (spark.sparkContext.applicationId, str(sf_dir))
        if key not in kept:
            kept.clear()  # one input at a time
            kept[key] = build(spark, sf_dir)
        return kept[key]

    return get
