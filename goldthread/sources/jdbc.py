"""How to split a JDBC table into parallel reads, by the type of its key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

# Ids per slice, rows per fetch, least buckets of text keys, slices of uuid keys, rows per file.
IDS_PER_SLICE, FETCH_ROWS, TEXT_BUCKETS, UUID_SLICES, ROWS_PER_FILE = 200_000, 10_000, 16, 256, 500_000


@dataclass(frozen=True)
class ReadPlan:
    """Either bounds of an integer column, or one predicate per slice."""

    column: str | None = None
    lower: int = 0
    upper: int = 0
    partitions: int = 1
    predicates: Sequence[str] = field(default_factory=tuple)


def integer_plan(column: str, low: int, high: int, per_slice: int = IDS_PER_SLICE) -> ReadPlan:
    """Bounds for Spark's own partitioned read; as many slices as the id range needs (the cluster's cores limit connections)."""
    return ReadPlan(column, low, high + 1, (high - low) // per_slice + 1)


def output_partitions(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_FILE))


def text_plan(column: str, buckets: int | None = None, rows: int = 0) -> ReadPlan:
    """Hash buckets over all rows, as many as ``rows`` needs; null keys fall into bucket 0."""
    buckets = buckets or max(TEXT_BUCKETS, -(-rows // IDS_PER_SLICE))
    return ReadPlan(predicates=tuple(f"MOD(CRC32(COALESCE({column}, '')), {buckets}) = {i}" for i in range(buckets)))


def time_plan(column: str, start: date, end: date, days: int) -> ReadPlan:
    """Slices of some days from ``start`` to ``end``; rows outside (or without a time) go to the edges."""
    cuts, at = [], start + timedelta(days=days)
    while at < end:
        cuts.append(at)
        at += timedelta(days=days)
    if not cuts:
        return ReadPlan(predicates=("1 = 1",))
    marks = [f"TIMESTAMP '{c} 00:00:00'" for c in cuts]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])]
    return ReadPlan(predicates=(f"{column} < {marks[0]} OR {column} IS NULL", *middle, f"{column} >= {marks[-1]}"))


def uuid_plan(column: str, slices: int = UUID_SLICES) -> ReadPlan:
    """Ranges of the leading hex digits (16 or 256 slices)."""
    digits = 1 if slices == 16 else 2
    marks = [format(i, f"0{digits}x") for i in range(1, 16 ** digits)]
    middle = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(marks, marks[1:])]
    return ReadPlan(predicates=(f"{column} < '{marks[0]}' OR {column} IS NULL", *middle, f"{column} >= '{marks[-1]}'"))


def plan_for(column: str, sql_type: str, stats: Mapping) -> ReadPlan:
    """The plan that fits the key's type: integer, time, uuid (36 characters) or any other text."""
    kind = sql_type.lower()
    if any(k in kind for k in ("int", "serial", "long")):
        return integer_plan(column, stats["min"], stats["max"])
    if any(k in kind for k in ("date", "time")):
        return time_plan(column, stats["start"], stats["end"], stats.get("days", 30))
    if "uuid" in kind or kind.replace(" ", "") in ("char(36)", "varchar(36)"):
        return uuid_plan(column)
    return text_plan(column, rows=stats.get("rows", 0))


def read(spark: SparkSession, url: str, table: str, plan: ReadPlan, properties: Mapping[str, str]) -> DataFrame:
    """Read with the plan's slices. User, password and driver come in ``properties``."""
    options = {"fetchsize": str(FETCH_ROWS), **properties}
    if plan.predicates:
        return spark.read.jdbc(url, table, predicates=list(plan.predicates), properties=options)
    return spark.read.jdbc(url, table, plan.column, plan.lower, plan.upper, plan.partitions, properties=options)


def write_history(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
