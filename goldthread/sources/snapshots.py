"""Versioned snapshots of a table as plain folders (``<table>/version=N``), and partition-wise updates.

A version counts once its row is in the version log, so a write that did not finish is never read and
can be repeated. That gives reads at a version or a time, change feeds, restores and copies without a
table format.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldthread.operators.changes import first_version, snapshot_diff
from goldthread.operators.merge import merge
from goldthread.operators.skew import null_safe
from goldthread.session import stage

_LOG = "versions"


def history(spark: SparkSession, table: str) -> DataFrame:
    """``version, committed_at`` of the finished versions, one row per version."""
    return spark.read.schema("version bigint, committed_at timestamp").parquet(f"{table}/{_LOG}")


def _is_published(spark: SparkSession, table: str, version: int) -> bool:
    try:
        return not history(spark, table).filter(F.col("version") == version).isEmpty()
    except AnalysisException:  # no log yet
        return False


def _publish(spark: SparkSession, table: str, version: int, committed_at: Column | None) -> None:
    stamp = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        (F.current_timestamp() if committed_at is None else committed_at).cast("timestamp").alias("committed_at"))
    stamp.coalesce(1).write.mode("append").parquet(f"{table}/{_LOG}")


def commit(df: DataFrame, table: str, version: int, committed_at: Column | None = None) -> int:
    """Write ``df`` as a new version, then publish it."""
    return commit_together({table: df}, version, committed_at)


def commit_together(tables: Mapping[str, DataFrame], version: int, committed_at: Column | None = None) -> int:
    """Write the same version of several tables (a parent and its children) and publish them only when
    all are written: a failure in between leaves no half-loaded batch to be read."""
    for table, df in tables.items():
        if _is_published(df.sparkSession, table, version):
            raise ValueError(f"{table} has version {version} already")
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{table}/version={version}")
    for table, df in tables.items():
        _publish(df.sparkSession, table, version, committed_at)
    return version


def merge_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str], **options) -> None:
    """Merge into a partitioned table, reading and rewriting only the partitions the source touches.

    ``keys`` must hold the partition columns, as a row cannot change its partition here. The merged rows
    are written aside first; running the same merge again after a failure gives the same table.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError("the keys must hold the partition columns")
    touched = source.select(*partition_by).distinct().alias("touched")
    here = null_safe("target", "touched", partition_by)  # a null is a partition too
    target = spark.read.schema(source.schema).parquet(path).alias("target").join(touched, here, "left_semi")
    merged = stage(merge(target.select(*source.columns), source, keys, **options), "merged-partitions")
    left = merged.select(*partition_by).distinct().alias("left")
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder")
    rows = spark.read.schema(source.schema).parquet(path).select(*partition_by, folder).distinct().alias("target")
    emptied = rows.join(touched, here, "left_semi").alias("target").join(left, null_safe("target", "left", partition_by), "left_anti")
    emptied = [r["_folder"] for r in emptied.select("_folder").collect()]  # folders of partitions without a row left
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    for name in emptied:  # an overwrite replaces only partitions that it has rows for
        _delete_folder(spark, name)


def _delete_folder(spark: SparkSession, uri: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def latest_version(spark: SparkSession, table: str) -> int:
    return history(spark, table).agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    version = latest_version(spark, table) if version is None else version
    return spark.read.parquet(f"{table}/version={version}")


def version_before(spark: SparkSession, table: str, cutoff: Column) -> int:
    """The newest version committed strictly before ``cutoff``."""
    found = history(spark, table).filter(F.col("committed_at") < cutoff).agg(F.max_by("version", "committed_at")).first()[0]
    if found is None:
        raise ValueError(f"{table} has no version before the cutoff")
    return found


def restore(spark: SparkSession, table: str, cutoff: Column, committed_at: Column | None = None) -> int:
    """Publish the state before ``cutoff`` as a new version."""
    old = read_version(spark, table, version_before(spark, table, cutoff))
    return commit(old, table, latest_version(spark, table) + 1, committed_at)


def changes_of(spark: SparkSession, table: str, version: int, keys: list[str]) -> DataFrame:
    """Change rows of one version against the one before it (all inserts for the first one)."""
    at = F.lit(history(spark, table).filter(F.col("version") == version).first()["committed_at"])
    earlier = history(spark, table).filter(F.col("version") < version).agg(F.max("version")).first()[0]
    new = read_version(spark, table, version)
    if earlier is None:
        return first_version(new, at, version)
    return snapshot_diff(read_version(spark, table, earlier), new, keys, op_time=at, version=version)


def copy_tables(spark: SparkSession, tables: dict[str, str], target: str) -> None:
    """Copy the latest version of each table to ``<target>/<name>`` as its version 0."""
    for name, table in tables.items():
        commit(read_version(spark, table), f"{target}/{name}", 0)


def reload_guarded(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """The reloaded table; the old one when there is nothing to load."""
    return old.limit(0).unionByName(fresh) if not fresh.isEmpty() else old
