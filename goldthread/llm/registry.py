"""The queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def register(name: str, sql: str | None = None):
    """Register ``function(spark, folder)`` under ``name``; ``sql`` states the expected rows."""

    def add(function: Callable[[SparkSession, str], DataFrame]):
        LLM_QUERIES[name] = function
        if sql is not None:
            LLM_ORACLES[name] = sql
        return function

    return add
