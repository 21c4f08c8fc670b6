"""Joins and group values that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.session import stage

ROWS_PER_TASK = 1_000_000  # a key with more rows is cut into as many tasks as it needs; shapes the plan, never the rows


def hot_keys(counts: DataFrame, keys: Sequence[str], size: str = "_rows", rows_per_task: int | None = None) -> DataFrame:
    """``keys, _salts``: into how many parts each key with more than ``rows_per_task`` rows is cut.

    Every such key is listed; there are at most rows / rows_per_task of them. Written once, so that Spark knows the size
    and picks the join.
    """
    limit = ROWS_PER_TASK if rows_per_task is None else rows_per_task
    hot = counts.filter(F.col(size) > limit).select(*keys, F.ceil(F.col(size) / F.lit(limit)).cast("int").alias("_salts"))
    return stage(hot, "hot-keys")


def salted_join(
    big: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    size: str = "_rows",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Join ``big`` to a side with one row per key, cutting each hot key into parts by a hash of ``spread_by``.

    ``counts`` has the rows of ``big`` per key (counted here when missing). The row of a hot key is copied once per part: at
    most rows / rows_per_task copies in all. ``how`` is ``inner`` or ``left`` with ``big`` on the left.
    """
    keys = list(keys)
    if counts is None:
        counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias(size))
    hot = hot_keys(counts, keys, size, rows_per_task)
    if hot.isEmpty():
        return big.join(unique, keys, how)
    parts = F.coalesce("_salts", F.lit(1))
    left = big.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), parts).cast("int")).drop("_salts")
    right = unique.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], spread_by: Sequence[str], how: str = "inner", size: str = "_rows",
    rows_per_task: int | None = None,
) -> DataFrame:
    """Join rows to values aggregated from them. ``groups`` has one row per key and its row count in ``size``.

    The aggregate is written once, so the rows are aggregated once and read once more; the written counts name the hot keys.
    """
    groups = stage(groups, "groups")
    return salted_join(rows, groups.drop(size), keys, spread_by, how, groups, size, rows_per_task)


def group_values(df: DataFrame, keys: Sequence[str], **values: Column) -> DataFrame:
    """Aggregates per group with the group's row count; ``_k`` holds the keys, null ones included."""
    keyed = df.groupBy(F.struct(*[F.col(k) for k in keys]).alias("_k"))
    return keyed.agg(F.count(F.lit(1)).alias("_rows"), *[v.alias(n) for n, v in values.items()])


def with_group_values(
    df: DataFrame, keys: Sequence[str], spread_by: Sequence[str], **values: Column
) -> DataFrame:
    """Add per-group aggregates to every row: partial aggregation, then a join back that splits hot groups.

    The same result as ``agg.over(partitionBy(keys))`` without one task holding a whole group.
    Rows with a null key are kept and form their own group.
    """
    rows = df.withColumn("_k", F.struct(*[F.col(k) for k in keys]))
    return join_groups(rows, group_values(df, keys, **values), ["_k"], spread_by, "left").drop("_k")


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``left.key`` and ``right.key`` for every key."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])
