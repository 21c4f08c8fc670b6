"""Run and batch logs: one row per step, and the gate that lets a batch through once."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldthread.operators.dedup import latest_per_key

STEP_SCHEMA = "task_id string, step string, status string, message string, start_time timestamp, end_time timestamp"


class StepLog:
    """Context manager that appends one row per step: SUCCESS, WARNING (set by the step) or FAILED."""

    def __init__(self, spark: SparkSession, path: str, task_id: str, step: str):
        self.spark, self.path, self.task_id, self.step = spark, path, task_id, step
        self.status, self.message = "SUCCESS", ""

    def warn(self, message: str) -> None:
        self.status, self.message = "WARNING", message

    def __enter__(self) -> StepLog:
        self.start = datetime.now(timezone.utc)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        if kind is not None:
            self.status, self.message = "FAILED", f"{kind.__name__}: {error}"
        row = (self.task_id, self.step, self.status, self.message, self.start, datetime.now(timezone.utc))
        self.spark.createDataFrame([row], STEP_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return False


def batch_states(events: DataFrame, keys: list[str], ts: str = "event_time") -> DataFrame:
    """Current state of each batch out of an append-only log (STARTED, then COMPLETED or FAILED)."""
    rank = F.when(F.col("status") == "STARTED", 0).otherwise(1)
    return latest_per_key(events, keys, [F.col(ts).desc(), rank.desc()])


def ready_batches(landed: DataFrame, parsed: DataFrame, domain: str = "domain_code", batch: str = "batch_id") -> DataFrame:
    """The latest completed batch per domain that is not parsed yet: a batch is processed once."""
    done = landed.filter("status = 'COMPLETED'")
    latest = latest_per_key(done, [domain], [F.col(batch).desc()])
    finished = parsed.filter("status = 'COMPLETED'").select(domain, batch).distinct()
    return latest.join(finished, [domain, batch], "left_anti")
