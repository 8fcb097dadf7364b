"""All queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import boilerplate_queries, history_queries, language_queries, packing_queries, representative_queries, token_queries, truncation_queries

_GROUPS = [boilerplate_queries, history_queries, language_queries, packing_queries, representative_queries, token_queries, truncation_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for group in _GROUPS for name, q in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for group in _GROUPS for name, sql in group.ORACLES.items()}
