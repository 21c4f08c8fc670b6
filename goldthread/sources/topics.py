"""Message topics: options for a broker, and a folder per topic where there is none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def batch_options(servers: str, topics: Sequence[str], start_ms: int, end_ms: int) -> dict[str, str]:
    """Options of ``read.format("kafka")`` for a bounded read by time."""
    return {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics),
        "startingTimestamp": str(start_ms), "endingTimestamp": str(end_ms), "failOnDataLoss": "false",
    }


def messages(df: DataFrame, topic: Column, key: Column, value: Column) -> DataFrame:
    """``topic, key, value`` rows, the topic chosen per row."""
    return df.select(topic.alias("topic"), key.cast("string").alias("key"), value.cast("string").alias("value"))


def send(df: DataFrame, servers: str, **options: str) -> None:
    df.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save()


def send_to_folder(df: DataFrame, path: str) -> None:
    """The same messages as files, one folder per topic."""
    df.select("topic", "key", "value").write.mode("append").partitionBy("topic").parquet(path)


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, value string, topic string").parquet(path).withColumn("topic", F.col("topic").cast("string"))
