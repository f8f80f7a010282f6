"""Name -> query and name -> the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import core_problems, core_queries, more_queries, pipelines, record_queries, report_queries, state_queries

_MODULES = [core_problems, core_queries, more_queries, pipelines, record_queries, report_queries, state_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLE.items()}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return core_queries.flagship(spark, sf)
