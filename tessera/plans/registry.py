"""All registered queries of the engine and the DuckDB SQL that each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import record_queries, source_queries, stage_queries, text_queries, turn_queries

MODULES = (text_queries, turn_queries, record_queries, source_queries, stage_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
