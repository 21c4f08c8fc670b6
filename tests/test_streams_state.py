"""Keyed state of a stream: late rows, replays, removed keys and their expiry."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from goldthread.session import new_path
from goldthread.streaming import ingest, state as st

START = datetime(2024, 1, 1)


def at(days):
    return START + timedelta(days=days)


class Feed:
    def __init__(self, spark, late):
        self.spark, self.late = spark, late
        self.source, self.target, self.checkpoint = (new_path(spark, n) for n in ("in", "out", "checkpoint"))
        self.schema = spark.createDataFrame([], "_k string, at timestamp, n int, kind string").schema

    def send(self, *rows):
        self.spark.createDataFrame(list(rows), self.schema).coalesce(1).write.mode("append").parquet(self.source)
        stream = ingest.file_stream(self.spark, self.source, self.schema)
        st.keep_newest(stream, self.checkpoint, self.target, ["_k"], "at", ["n"], F.col("kind") == "gone", late=self.late)

    def state(self):
        return sorted((r["_k"] or "", r["n"]) for r in st.current_state(self.spark, self.target, self.schema, ["_k"], "at", ["n"]).collect())

    def codes(self):
        return sorted(r[st.CODE] for r in self.spark.read.parquet(self.target).collect())

    def stored(self):
        reader = self.spark.read.format("statestore").option("stateVarName", "newest")
        with st.rocks_store(self.spark):
            return sorted(str(r["key"][0]) for r in reader.load(self.checkpoint).select("key").collect())


def test_late_rows_ties_and_replays(spark):
    feed = Feed(spark, "30 days")
    feed.send(("a", at(5), 1, "x"), ("a", at(5), 10, "x"), ("b", at(5), 1, "x"), (None, at(1), 3, "x"), ("c", None, 1, "x"))
    assert feed.state() == [("", 3), ("a", 10), ("b", 1)]
    feed.send(("a", at(4), 99, "x"), ("b", at(6), 2, "x"), ("a", at(5), 10, "x"))  # late, newer, delivered again
    assert feed.state() == [("", 3), ("a", 10), ("b", 2)] and feed.codes() == ["I", "I", "I", "U"]


def test_removed_keys_stay_removed_until_the_watermark(spark):
    feed = Feed(spark, "10 days")
    feed.send(("a", at(5), 1, "x"), ("b", at(5), 1, "x"))
    feed.send(("a", at(6), 2, "gone"), ("d", at(6), 1, "gone"))
    assert feed.state() == [("b", 1)] and feed.codes() == ["D", "I", "I"]
    feed.send(("a", at(5.5), 3, "x"))  # before the removal
    assert feed.state() == [("b", 1)] and feed.stored() == ["a", "b", "d"]
    feed.send(("b", at(40), 2, "x"))
    feed.send(("b", at(41), 3, "x"))  # the watermark has passed the marks of a and d
    assert feed.stored() == ["b"] and feed.state() == [("b", 3)]
    feed.send(("a", at(5.7), 4, "x"))  # too late
    assert feed.state() == [("b", 3)]
    feed.send(("a", at(42), 5, "x"))
    assert feed.state() == [("a", 5), ("b", 3)]
