"""Event time: duplicates dropped within a watermark, volumes per window, and what came too late.

State is bounded by the watermark: a key or a window is forgotten once no row that may still come can touch it. Results go to append-only
folders (``state.append_changes``), so a batch neither scans nor rewrites what earlier ones stored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from goldthread.streaming.ingest import BATCH, batch_name
from goldthread.streaming.state import append_changes

_TIME = "event_time"


def _watched(stream: DataFrame, ts: str, late: str) -> DataFrame:
    return stream.withColumn(_TIME, F.col(ts).cast("timestamp")).withWatermark(_TIME, late)


def dedup_within(stream: DataFrame, keys: Sequence[str], ts: str, late: str) -> DataFrame:
    """Each message once, however often it comes within ``late`` of its first copy; rows that come later than ``late`` are dropped."""
    return _watched(stream, ts, late).dropDuplicatesWithinWatermark(list(keys)).select(*stream.columns)


def volumes(stream: DataFrame, ts: str, width: str, keys: Sequence[str], late: str) -> DataFrame:
    """``window_start, keys, rows``: the running volume of each tumbling window that a batch touches (output mode update).

    A window takes rows until the watermark, ``late`` behind the newest time, passes its end.
    """
    counted = _watched(stream, ts, late).groupBy(F.window(_TIME, width), *keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "rows")


def run_available(frame: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process what is there and stop; the checkpoint keeps progress and state for the next run."""
    writer = frame.writeStream.outputMode(mode).foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def store_messages(stream: DataFrame, checkpoint: str, target: str, keys: Sequence[str], ts: str, late: str) -> None:
    """Append each message of the stream once to ``target``, by the state of the query instead of a look at the target."""
    run_available(dedup_within(stream, keys, ts, late), checkpoint, append_changes(target))


def store_volumes(stream: DataFrame, checkpoint: str, target: str, ts: str, width: str, keys: Sequence[str], late: str) -> None:
    run_available(volumes(stream, ts, width, keys, late), checkpoint, append_changes(target), "update")


def current_volumes(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The volume of each window: the largest that was stored, as a window only grows."""
    return spark.read.parquet(target).groupBy("window_start", *keys).agg(F.max("rows").alias("rows"))


_LOG = "batch_no bigint, n_rows bigint, n_late bigint, newest timestamp"


def log_arrivals(target: str, ts: str, late: Column, end: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Note for each batch its rows, how many came too late, and the newest time so far.

    Too late is what a watermark of ``late`` (an interval) leaves out: rows whose ``end`` (of their window; the row's own time if missing) is
    not after the newest time of all earlier batches less ``late``. One row per batch; a replayed batch writes its row again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(batch, batch_id)
        earlier = arrivals(spark, target)
        newest = None if earlier is None else earlier.filter(F.col("batch_no") < batch_id).agg(F.max("newest")).first()[0]
        mark = F.lit(newest).cast("timestamp")
        time = F.col(ts).cast("timestamp")
        behind = (time if end is None else end.cast("timestamp")) <= F.date_trunc("millisecond", mark) - late
        row = batch.agg(
            F.lit(batch_id).cast("bigint").alias("batch_no"), F.count(F.lit(1)).alias("n_rows"), F.count_if(behind).alias("n_late"),
            F.greatest(F.max(time), mark).alias("newest"))
        rows = row.withColumn(BATCH, F.lit(name)).coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        rows.partitionBy(BATCH).parquet(target)

    return write


def arrivals(spark: SparkSession, target: str) -> DataFrame | None:
    """The log of ``log_arrivals``; None before the first batch."""
    try:
        return spark.read.schema(StructType.fromDDL(f"{_LOG}, {BATCH} string")).parquet(target)
    except AnalysisException:
        return None
