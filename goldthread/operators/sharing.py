"""Sharing changes with receivers, sending again, and allocating batches to tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.operators.changes import collapse_versions
from goldthread.operators.dedup import latest_per_key
from goldthread.operators.ordering import batch_numbers, number_rows, running_sum
from goldthread.operators.projection import SinkSpec, project_for_sink
from goldthread.session import stage


def share_window(changes: DataFrame, op_time: str, first: Column | None = None, second: Column | None = None) -> DataFrame:
    """Changes with ``first < op_time <= second``; an open end is not tested."""
    if first is not None:
        changes = changes.filter(F.col(op_time) > first)
    return changes if second is None else changes.filter(F.col(op_time) <= second)


def incremental_share(
    changes: DataFrame, snapshot: DataFrame, log: DataFrame, config_id: str, keys: Sequence[str], op_time: str, spec: SinkSpec,
    full: bool = False,
) -> DataFrame:
    """Rows for one receiver: everything, the snapshot on the first run, or the changes since the last run.

    The log row with the largest ``second_time`` of the receiver is the watermark; several versions of a
    key collapse to the newest one.
    """
    if full:
        return project_for_sink(snapshot, spec)
    last = log.filter(F.col("config_id") == config_id).agg(F.max("second_time").alias("t")).first()["t"]
    data = snapshot if last is None else collapse_versions(share_window(changes, op_time, F.lit(last)), keys, op_time)
    return project_for_sink(data, spec)


def share_log_row(shared: DataFrame, config_id: str, op_time: str) -> DataFrame:
    """The log row to append after a share: receiver and newest time sent."""
    return shared.agg(F.max(op_time).alias("second_time")).select(F.lit(config_id).alias("config_id"), "second_time").filter("second_time IS NOT NULL")


def lookup_with_fallback(wanted: DataFrame, first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``first`` for the wanted keys, and of ``second`` for those it lacks."""
    hits = wanted.join(first, list(keys))
    misses = wanted.join(first.select(*keys), list(keys), "left_anti")
    return hits.unionByName(misses.join(second, list(keys)))


def redrive_sources(landing: DataFrame, wanted: DataFrame, keys: Sequence[str], order: Sequence[str], batch_size: int,
                    latest_only: bool = True, id: str = "landing_id") -> DataFrame:
    """Landed documents of the wanted keys to be processed again, with new batch numbers."""
    hit = landing.join(wanted.select(*keys).distinct(), list(keys), "left_semi")
    if latest_only:
        hit = latest_per_key(hit, keys, [F.col(c).desc() for c in order])
    return batch_numbers(hit, batch_size, [*order, id])


def resend_to_source_topic(documents: DataFrame, topic: str, suffix: str, payload: Column, key: Column) -> DataFrame:
    """``topic, key, value``: the embedded source document back to its topic, without the suffix."""
    bare = F.regexp_replace(F.col(topic), f"{suffix}$", "")
    return documents.select(bare.alias("topic"), key.cast("string").alias("key"), payload.alias("value"))


def resend_outputs(wanted: DataFrame, datasets: DataFrame, snapshot: DataFrame, keys: Sequence[str], topics: DataFrame,
                   topic_keys: Sequence[str], template: str, body: str) -> DataFrame:
    """``topic, key, value`` of output documents, the topic filled from a template by configuration rows.

    The template holds ``{column}`` placeholders of the topic table.
    """
    found = lookup_with_fallback(wanted.select(*keys), datasets.select(*keys, body), snapshot.select(*keys, body), keys)
    return topics_of(found, topics, topic_keys, template).select(
        "topic", F.concat_ws("|", *keys).alias("key"), F.col(body).alias("value"))


def topics_of(df: DataFrame, topics: DataFrame, topic_keys: Sequence[str], template: str) -> DataFrame:
    """Add ``topic``: the template filled from the configuration row of the record."""
    import re
    parts = [F.col(p[1:-1]).cast("string") if p.startswith("{") else F.lit(p) for p in re.split(r"(\{\w+\})", template) if p]
    return df.join(topics, list(topic_keys)).withColumn("topic", F.concat(*parts))


def clear_sent(wanted: DataFrame, sent: DataFrame, keys: Sequence[str]) -> DataFrame:
    return wanted.join(sent.select(*keys).distinct(), list(keys), "left_anti")


def spread_to_topics(documents: DataFrame, topics: Column, key: Column, body: str) -> DataFrame:
    """One row per topic of a comma list."""
    each = F.explode(F.transform(F.split(topics, ","), lambda p: F.trim(p)))
    return documents.select(each.alias("topic"), key.cast("string").alias("key"), F.col(body).alias("value"))


def allocate_batches(log: DataFrame, priority: DataFrame, max_rows: int, topic: str = "topic", created: str = "creation_time",
                     batch: str = "batch_number", rows: str = "read_record_count", done: str = "is_handle") -> DataFrame:
    """Batches for the next task: per round each active topic gives up to ``priority`` batches, oldest
    first, higher priority first, until its own quota and the total are used up.

    A topic stops at its first batch that does not fit its quota or the room left in the task; such a batch uses up
    no room, so other topics go on. ``task_rows`` is the running total of the task. Each pass takes what fits in order and
    closes every topic whose next batch is larger than the room left; room only shrinks, so that is final.
    """
    active = priority.filter("is_active").select(topic, "priority", "topic_quota")
    open_batches = log.filter(~F.col(done).cast("boolean")).join(active, topic)
    numbered = running_sum(open_batches, rows, [created, batch], [topic], "_topic_rows").filter(
        F.col("_topic_rows") <= F.col("topic_quota"))
    placed = number_rows(numbered, [created, batch], [topic], "_seq").withColumn(
        "round", F.ceil(F.col("_seq") / F.col("priority")).cast("bigint"))
    order = ["round", F.col("priority").desc(), topic, "_seq"]
    waiting = stage(number_rows(placed, order, (), "_at"), "batches")
    taken, used = [], 0
    while True:
        ran = stage(running_sum(waiting, rows, ["_at"], (), "task_rows").withColumn("task_rows", F.col("task_rows") + used), "batches")
        fits = F.col("task_rows") <= max_rows
        taken.append(ran.filter(fits))
        used = max(used, ran.agg(F.max(F.when(fits, F.col("task_rows")))).first()[0] or 0)
        rest = ran.filter(~fits).drop("task_rows")
        following = rest.groupBy(topic).agg(F.min_by(rows, "_at").alias("_next"))
        waiting = rest.join(following.filter(F.col("_next") <= max_rows - used).select(topic), topic, "left_semi")
        if waiting.isEmpty():
            break
    return union_all(taken).drop("_seq", "_at", "_topic_rows")


def task_summary(allocated: DataFrame, task_id: str, topic: str = "topic", rows: str = "read_record_count") -> DataFrame:
    """Batches and rows per topic of the task."""
    return allocated.groupBy(topic).agg(F.count(F.lit(1)).alias("batches"), F.sum(rows).alias("rows")).withColumn("task_id", F.lit(task_id))


def number_files(df: DataFrame, rows_per_file: int, order: Sequence[Column | str]) -> DataFrame:
    """File number of every row for output files of a fixed size."""
    numbered = number_rows(df, order, (), "_n")
    return numbered.withColumn("file_no", F.ceil(F.col("_n") / rows_per_file).cast("bigint")).drop("_n")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
