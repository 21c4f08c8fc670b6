"""File sources: whole-file JSON documents, CSV extracts, newest file by name, landing bookkeeping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldthread.operators.dedup import latest_per_key


def read_documents(spark: SparkSession, path: str, payload: str = "raw_payload") -> DataFrame:
    """One row per file: its whole text, name and modification time."""
    return spark.read.option("wholetext", True).text(path).select(
        F.col("value").alias(payload), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("file_time"))


def land(documents: DataFrame, domain: str, batch_id: int, document_ids: Sequence[str], payload: str = "raw_payload") -> DataFrame:
    """Add lineage: domain, batch and the first document id found at the given JSON paths."""
    ids = [F.get_json_object(payload, p) for p in document_ids]
    return documents.withColumns({
        "domain_code": F.lit(domain), "batch_id": F.lit(batch_id).cast("bigint"), "document_uuid": F.coalesce(*ids)})


def land_domains(spark: SparkSession, domains: Sequence[Mapping], batch_id: int) -> DataFrame:
    """Landing rows of all active domains (``domain_code, path, document_ids, active_flag``)."""
    parts = [
        land(read_documents(spark, d["path"]), d["domain_code"], batch_id, d["document_ids"])
        for d in domains if d["active_flag"]
    ]
    return reduce(DataFrame.unionByName, parts)


def skip_landed(fresh: DataFrame, landed: DataFrame, file: str = "source_file") -> DataFrame:
    """Files not landed before."""
    return fresh.join(landed.select(file).distinct(), file, "left_anti")


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """CSV with a header; types are inferred when no schema is given."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, modificationTime, length`` of the files, without reading them."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder).select(
        "path", "modificationTime", "length")


def newest_file(files: DataFrame, by: Column, *group: Column) -> DataFrame:
    """The newest file (per group), by a date in its name or its modification time."""
    keyed = files.withColumn("file_order", by).filter("file_order IS NOT NULL")
    names = []
    for i, g in enumerate(group):
        keyed = keyed.withColumn(f"_g{i}", g)
        names.append(f"_g{i}")
    order = [F.col("file_order").desc(), F.col("path").desc()]
    if not names:
        return keyed.orderBy(*order).limit(1)
    return latest_per_key(keyed, names, order).drop(*names)


def date_in_name(path: Column, pattern: str = r"_(\d{4}-\d{2}-\d{2})") -> Column:
    return F.try_to_date(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), "yyyy-MM-dd")


def project_csv(df: DataFrame, names: Mapping[str, str], **lineage: Column) -> DataFrame:
    """Rename source headings to columns and add lineage columns."""
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()], *[v.alias(k) for k, v in lineage.items()])


def read_markets(spark: SparkSession, paths: Mapping[str, str], tag: str = "market_code") -> DataFrame:
    """Union of one snapshot per market, tagged with the market."""
    return reduce(DataFrame.unionByName, [spark.read.parquet(p).withColumn(tag, F.lit(m)) for m, p in paths.items()])


def rows_with_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a source table for a list of keys: a semi join, whatever the length of the list."""
    return df.join(wanted.select(*keys).distinct(), list(keys), "left_semi")


# --- bounded reads of a topic by time, and the marks that bound them

def read_since(messages: DataFrame, marks: DataFrame, topics: Sequence[str], topic: str, ts: str, now: Column) -> DataFrame:
    """Messages with ``last_end <= ts < now`` per topic; a topic without a mark is read from its start."""
    latest = marks.groupBy(topic).agg(F.max("end_time").alias("_last"))
    scoped = messages.filter(F.col(topic).isin(*topics) & (F.col(ts) < now)).join(latest, topic, "left")
    return scoped.filter(F.col("_last").isNull() | (F.col(ts) >= F.col("_last"))).drop("_last")


def next_marks(read: DataFrame, topics: DataFrame, topic: str, now: Column, task_id: str) -> DataFrame:
    """The marks to append: each topic's new end and how many rows were read (0 when none)."""
    counts = read.groupBy(topic).agg(F.count(F.lit(1)).alias("read_record_count"))
    return topics.select(topic).join(counts, topic, "left").select(
        topic, F.coalesce("read_record_count", F.lit(0)).cast("bigint").alias("read_record_count"), now.alias("end_time"),
        F.lit(task_id).alias("task_id"))
