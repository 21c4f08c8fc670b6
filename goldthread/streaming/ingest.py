"""One-shot stream ingestion with checkpointed progress and idempotent inserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StringType, StructType

from goldthread.operators.changes import snapshot_diff
from goldthread.operators.dedup import latest_per_key
from goldthread.operators.merge import upsert_newer
from goldthread.operators.skew import null_safe
from goldthread.session import stage

BATCH, DAY, VERSION = "ingest_batch", "ingest_day", "state_version"


def file_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None,
                archive: str | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; processed files move to ``archive`` when given."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path)


def run_once(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there and stop; the checkpoint makes the next run go on from here."""
    query = (
        stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """The batch's name over all queries: the id that the checkpoint gives its query, and the batch number."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def insert_batch(target: str, keys: Sequence[str], order: Sequence[str] = (), day: str | None = None) -> Callable[[DataFrame, int], None]:
    """Write the batch's new rows to partitions of ``target`` that only this batch of this query has.

    A replayed batch overwrites its partitions, and rows that any other batch holds are left out, so a message is stored
    once however often it is delivered and by however many queries (checkpoints) one after the other. Of several rows for a
    key the first in ``order`` wins. With ``day``, a timestamp that a message never changes, the target is partitioned by day
    and a batch is compared only with the days that it holds.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(batch, batch_id)
        fresh = latest_per_key(batch, keys, [F.col(c) for c in dict.fromkeys([*order, *batch.columns])])
        days = F.to_date(day) if day else F.lit(None).cast("date")
        fresh = stage(fresh.withColumn(DAY, days), "batch")
        seen = read_target(spark, target, batch.schema)
        if seen is not None:
            seen = seen.filter(F.col(BATCH) != name)
            span = fresh.agg(F.min(DAY).alias("low"), F.max(DAY).alias("high")).first()
            if span["low"] is not None:
                seen = seen.filter(F.col(DAY).between(F.lit(span["low"]), F.lit(span["high"])) | F.col(DAY).isNull())
            fresh = fresh.alias("f").join(seen.select(*keys).alias("s"), null_safe("f", "s", keys), "left_anti")
        rows = fresh.withColumn(BATCH, F.lit(name)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        rows.partitionBy(DAY, BATCH).parquet(target)

    return write


def read_target(spark: SparkSession, target: str, schema: StructType) -> DataFrame | None:
    """The rows of an insert-only target with the day and batch that stored them; None before the first batch."""
    whole = StructType(list(schema)).add(DAY, DateType()).add(BATCH, StringType())
    try:
        return spark.read.schema(whole).parquet(target)
    except AnalysisException:  # nothing written yet
        return None


def current_rows(spark: SparkSession, target: str, schema: StructType, keys: Sequence[str], ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest row per key of an insert-only target: the merged state as a view.

    For a state too large to be rewritten by every batch: ``insert_batch`` only adds the new rows, late
    ones lose here, and only readers pay for the ranking.
    """
    rows = read_target(spark, target, schema)
    return latest_per_key(rows, keys, [F.col(ts).desc(), *[F.col(c).desc() for c in ties]]).drop(BATCH, DAY)


_VERSIONS = "version bigint, batch string"


def state_versions(spark: SparkSession, target: str) -> DataFrame | None:
    """``version, batch`` of the finished versions of a merged state; None before the first."""
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{target}/versions")
    except AnalysisException:
        return None


def merge_batch(
    target: str, keys: Sequence[str], ts: str, ties: Sequence[str] = (), changes: str | None = None, gone: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """Merge each batch into the state, newest row per key; late rows lose. A newest row that meets ``gone`` removes its key.

    For states of moderate size; ``current_rows`` serves larger ones. Every batch writes the next ``version=N`` of the state and
    then notes which batch made it, so a replayed batch writes its own version again, and a query with a new checkpoint
    goes on from the newest one. With ``changes`` the I/U/D rows of every version are kept too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(batch, batch_id)
        newest = latest_per_key(batch, keys, [F.col(ts).desc(), *[F.col(c).desc() for c in ties]])
        log = state_versions(spark, target)
        found = log.agg(F.max("version").alias("last"), F.max(F.when(F.col("batch") == name, F.col("version"))).alias("own")).first() if log else None
        last = -1 if found is None else found["last"]
        version = last + 1 if found is None or found["own"] is None else found["own"]
        if version == 0:
            old, state = newest.limit(0), newest
        else:
            old = spark.read.schema(batch.schema).parquet(f"{target}/version={version - 1}")
            state = upsert_newer(old, newest, keys, ts)
        if gone is not None:
            state = state.filter(~F.coalesce(gone, F.lit(False)))
        state.write.mode("overwrite").parquet(f"{target}/version={version}")
        if changes:
            new = spark.read.schema(batch.schema).parquet(f"{target}/version={version}")
            snapshot_diff(old, new, keys).write.mode("overwrite").parquet(f"{changes}/{VERSION}={version}")
        if version > last:
            spark.sql(f"SELECT {version}L AS version, '{name}' AS batch").coalesce(1).write.mode("append").parquet(f"{target}/versions")

    return write
