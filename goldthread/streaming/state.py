"""Newest row per key kept in a state store, and event-time counts.

``newest_changes`` keeps one row per key in the state store of the query, so a batch touches only the keys that it holds: nothing is rewritten
and no history is scanned. What changes goes to an append-only change table (``append_changes``), and ``current_state`` reads the state
from it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from goldthread.operators.dedup import latest_per_key
from goldthread.streaming.ingest import BATCH, batch_name

CODE = "change_code"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestRow(StatefulProcessor):
    """Per key: when its newest row was, and whether that row removed it.

    A removed key stays as a mark, so that late rows do not bring it back, until the watermark passes it: rows that late are
    dropped before they come here. Then the mark expires by a timer and the store forgets the key.
    """

    def init(self, handle) -> None:
        self.handle = handle
        place = StructType([StructField("at", LongType()), StructField("tie", StringType()), StructField("gone", BooleanType())])
        self.newest = handle.getValueState("newest", place)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best, place = None, None
        for batch in rows:
            for i, (at, tie) in enumerate(zip(batch["at"], batch["tie"])):
                if place is None or (at, tie) > place:
                    best, place = batch.iloc[i:i + 1], (at, tie)
        known = self.newest.get() if self.newest.exists() else None
        if known is not None and place <= (known[0], known[1]):
            return
        gone, was = bool(best["gone"].iloc[0]), known is not None and not known[2]
        self.newest.update((int(place[0]), place[1], gone))
        if gone:
            self.handle.registerTimer(int(place[0]) // 1000 + 1)
        if was or not gone:
            code = "D" if gone else "U" if was else "I"
            yield best.drop(columns=["at", "tie", "gone", "time"]).assign(code=code)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            at, _, gone = self.newest.get()
            if gone and at // 1000 + 1 <= expiredTimerInfo.getExpiryTimeInMs():
                self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass


@contextmanager
def rocks_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def newest_changes(stream: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str] = (), gone: Column | None = None, late: str = "30 days") -> DataFrame:
    """The changes of the newest row per key: the stream's columns and ``change_code`` (I, U or D).

    Newest is by ``ts``, then by ``ties`` as texts padded to one length (numbers that are not negative keep their order); a newest row that meets ``gone`` removes its key. Rows that come more than
    ``late`` behind the newest ``ts`` of earlier batches are dropped, rows without a ``ts`` too. Start the query inside
    ``rocks_store`` with output mode update.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    tie = F.concat_ws("|", *[F.lpad(text(c), F.greatest(F.lit(40), F.char_length(text(c))), F.lit(" ")) for c in ties])
    named = {n: f"c{i}" for i, n in enumerate(stream.columns)}  # Python gets rows whose columns have plain names
    marked = stream.filter(F.col(ts).isNotNull()).select(
        *[F.col(n).alias(c) for n, c in named.items()], F.unix_micros(F.col(ts).cast("timestamp")).alias("at"), tie.alias("tie"),
        (F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)).alias("gone"), F.col(ts).cast("timestamp").alias("time"))
    out = StructType([*(StructField(named[f.name], f.dataType) for f in stream.schema), StructField("code", StringType())])
    changes = marked.withWatermark("time", late).groupBy(*[named[k] for k in keys]).transformWithStateInPandas(NewestRow(), out, "Update", "EventTime")
    return changes.toDF(*stream.columns, CODE)


def append_changes(target: str) -> Callable[[DataFrame, int], None]:
    """Write a batch's changes to the partition of ``target`` that only this batch of this query has; a replay writes it again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(BATCH, F.lit(batch_name(batch, batch_id))).write.mode("overwrite")
        rows.option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(target)

    return write


def keep_newest(stream: DataFrame, checkpoint: str, target: str, keys: Sequence[str], ts: str, ties: Sequence[str] = (),
                gone: Column | None = None, late: str = "30 days") -> None:
    """Process what is there, append the changes to ``target`` and stop; the next run goes on from the state store in ``checkpoint``."""
    spark = stream.sparkSession
    changes = newest_changes(stream, keys, ts, ties, gone, late)
    with rocks_store(spark):
        query = changes.writeStream.outputMode("update").foreachBatch(append_changes(target)).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()


def current_state(spark: SparkSession, target: str, schema: StructType, keys: Sequence[str], ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """The newest rows, from the change table: a key's last change, unless that removed it."""
    whole = StructType([*schema.fields, StructField(CODE, StringType()), StructField(BATCH, StringType())])
    changes = spark.read.schema(whole).parquet(target)
    last = latest_per_key(changes, keys, [F.col(ts).desc(), *[F.col(c).desc() for c in ties]])
    return last.filter(F.col(CODE) != "D").drop(CODE, BATCH)
