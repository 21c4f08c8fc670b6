"""The catalogue of runnable queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The tables of one scale, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str) -> DataFrame:
        """Run SQL that names the tables as ``{customer}``."""
        used = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, **used) if used else self.spark.sql(text)


def plain(text: str) -> str:
    """The same SQL with bare table names, for a database in which they are views."""
    return text.format_map({n: n for n in TABLES})


def query(name: str, sql: str | None = None):
    """Register ``function(tables)`` under ``name``; ``sql`` states the expected rows."""

    def add(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
