"""All sensor queries by name, each with its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import block_queries, document_queries, maintained_queries, model_queries, profile_queries, seasonal_queries, stored_queries, stream_queries, table_queries

MODULES = [profile_queries, table_queries, model_queries, stored_queries, seasonal_queries, stream_queries, maintained_queries, block_queries, document_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for m in MODULES for q in m.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items() if v}
