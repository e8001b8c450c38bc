"""Registered queries: for each operator a DataFrame and, where SQL can say it, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .registry import ORACLES, QUERIES
from . import aggregation, functions, further, language, pipelines, relational, scale, windowing  # noqa: F401  they register themselves


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
