"""Checks, monitors and reconciliation. Each gives one DataFrame; nothing is counted only for a log line."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.operators.dedup import top_per_key


def orphans(children: Mapping[str, tuple[DataFrame, str]], parent: DataFrame, key: str) -> DataFrame:
    """``check, bad_rows``: children whose parent does not exist, per child table."""
    keys = parent.select(key)
    parts = []
    for name, (df, fk) in children.items():
        used = df.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias(key)).agg(F.count(F.lit(1)).alias("n"))
        lost = used.join(keys, key, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad_rows"))
        parts.append(lost.select(F.lit(name).alias("check"), "bad_rows"))
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def must_be_zero(duplicates: Mapping[str, tuple[DataFrame, Sequence[str]]], rows: Mapping[str, tuple[DataFrame, Column]]) -> DataFrame:
    """``check, bad_rows`` of duplicate keys and of rows that meet a forbidden condition."""
    parts = [
        duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("bad_rows")).select(F.lit(name).alias("check"), "bad_rows")
        for name, (df, keys) in duplicates.items()
    ] + [
        df.agg(F.count(F.when(bad, 1)).alias("bad_rows")).select(F.lit(name).alias("check"), "bad_rows")
        for name, (df, bad) in rows.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def missing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys (batches, ids) that did not arrive."""
    return expected.join(actual.select(*keys).distinct(), list(keys), "left_anti")


def oversized_documents(tables: Mapping[str, tuple[DataFrame, Sequence[str], str]], limit: int) -> DataFrame:
    """Documents above ``limit`` UTF-8 bytes, largest first."""
    parts = [
        df.select(F.lit(name).alias("dataset"), F.concat_ws("|", *keys).alias("key"), F.octet_length(body).cast("bigint").alias("bytes"))
        for name, (df, keys, body) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).filter(F.col("bytes") > limit).orderBy(F.desc("bytes"), "dataset", "key")


def sample_per_type(df: DataFrame, kind: str, order: Sequence[Column], n: int) -> DataFrame:
    """Up to ``n`` rows of each invalid type."""
    return top_per_key(df.filter(F.col(kind).isNotNull()), [kind], order, n)


def hourly_volume(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows per key in 24 hour columns and in total."""
    hour = F.hour(ts)
    return df.groupBy(*keys).agg(
        *[F.count(F.when(hour == h, 1)).alias(f"h{h:02d}") for h in range(24)], F.count(F.lit(1)).alias("total"))


def histogram(df: DataFrame, column: str, width: float) -> DataFrame:
    bucket = (F.floor(F.col(column) / F.lit(width)) * F.lit(width)).cast("bigint")
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def fill_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``column_name, total_rows, filled, filled_share`` of every column, from a single pass."""
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != ""), 1)).alias(f"_{c}") for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("filled")) for c in columns])
    return counts.select(*by, "total_rows", F.explode(rows).alias("_r")).select(
        *by, "_r.column_name", "total_rows", "_r.filled", (F.col("_r.filled") / F.col("total_rows")).alias("filled_share"))


def compare_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on both sides, and whether they agree."""
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("left_rows"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("right_rows"))
    joined = a.join(b, list(keys), "full_outer").na.fill(0, ["left_rows", "right_rows"])
    return joined.withColumn("is_equal", F.col("left_rows") == F.col("right_rows"))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()])


def two_sided_counts(rows: DataFrame, keys: Sequence[str], is_raw: Column, limit: float) -> DataFrame:
    """``keys, raw_rows, valid_rows, gap, is_alert`` of rows that stand on one of two sides, in one aggregate.

    ``n`` is how many messages a row stands for. ``gap`` is the difference as a share of the raw side (null without raw
    rows); the alert is raised when exactly one side is empty or the gap reaches ``limit``.
    """
    side = lambda test: F.sum(F.when(test, F.col("n")).otherwise(0))
    sums = rows.groupBy(*keys).agg(side(is_raw).alias("raw_rows"), side(~is_raw).alias("valid_rows"))
    gap = F.try_divide(F.abs(F.col("raw_rows") - F.col("valid_rows")), F.col("raw_rows"))
    one_empty = (F.col("raw_rows") > 0) != (F.col("valid_rows") > 0)
    return sums.withColumn("gap", gap).withColumn("is_alert", one_empty | (F.coalesce("gap", F.lit(0.0)) >= limit))


def ratio_alert(raw: DataFrame, valid: DataFrame, keys: Sequence[str], limit: float) -> DataFrame:
    """Raw and valid rows per key, compared by ``two_sided_counts``."""
    side = lambda df, is_raw: df.select(*keys, F.lit(is_raw).alias("_raw"), F.lit(1).alias("n"))
    return two_sided_counts(side(raw, True).unionByName(side(valid, False)), keys, F.col("_raw"), limit)


def topic_pair_alert(messages: DataFrame, pairs: DataFrame, topic: str, limit: float) -> DataFrame:
    """The same for pairs of ``raw_topic`` and ``valid_topic``: each pair becomes two rows, one per topic."""
    names = ["raw_topic", "valid_topic"]
    sides = pairs.select(*names, F.explode(F.array(*[F.struct(F.col(c).alias(topic), F.lit(c == "raw_topic").alias("_raw")) for c in names])).alias("_s"))
    volume = messages.groupBy(topic).agg(F.count(F.lit(1)).alias("n"))
    rows = sides.select(*names, "_s.*").join(volume, topic, "left").na.fill(0, ["n"])
    return two_sided_counts(rows, names, F.col("_raw"), limit)


def topic_volume(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("messages"), F.min(ts).alias("first_time"), F.max(ts).alias("last_time"))


def no_log_alert(log: DataFrame, ts: str, start: Column, end: Column) -> DataFrame:
    """One row: rows logged in the window, and whether there were none."""
    inside = log.filter((F.col(ts) >= start) & (F.col(ts) < end))
    return inside.agg(F.count(F.lit(1)).alias("log_rows")).withColumn("is_alert", F.col("log_rows") == 0)


def keep_home_market(rows: DataFrame, keys: Sequence[str], found_in: str, home: str, markets: Sequence | None = None) -> DataFrame:
    """Rows of an extract with ``is_retained``: a row found in another market's extract is kept only when
    its home market's extract lacks it; a row of an unknown market is not. One join for all markets."""
    at_home = rows.filter(F.col(found_in) == F.col(home)).select(*keys, home).distinct().withColumn("_at_home", F.lit(True))
    joined = rows.join(at_home, [*keys, home], "left")
    keep = (F.col(found_in) == F.col(home)) | F.col("_at_home").isNull()
    if markets is not None:
        keep = keep & F.coalesce(F.col(home).isin(*markets), F.lit(False))
    return joined.withColumn("is_retained", keep).drop("_at_home")


def market_match_counts(rows: DataFrame, found_in: str, home: str) -> DataFrame:
    """Rows per (extract market, record market) and whether they match."""
    return rows.groupBy(found_in, home).agg(F.count(F.lit(1)).alias("rows")).withColumn("is_match", F.col(found_in) == F.col(home))
