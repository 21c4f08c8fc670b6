"""Ranking inside a key: latest row, best row, first n rows.

``row_number() <= n`` lets Spark keep at most n rows per key in every map task before the shuffle
(window group limit), so a key with a third of all rows costs no more than any other key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

ACTION_RANK: Mapping[str, int] = {"DELETE": 1, "CHANGE": 2}


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (usually newest first, ties broken by an id)."""
    return top_per_key(df, keys, order, 1)


def latest_with_count(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "duplicate_count") -> DataFrame:
    """Latest row per key and how many rows the key had. Both sides of the join have one row per key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return latest_per_key(df, keys, order).join(counts, list(keys))


def action_priority(action: Column, rank: Mapping[str, int] = ACTION_RANK) -> Column:
    """DELETE before CHANGE before anything else."""
    out = F.lit(max(rank.values()) + 1)
    for name, position in rank.items():
        out = F.when(action == name, position).otherwise(out)
    return out


def latest_action(df: DataFrame, keys: Sequence[str], ts: str, action: str, *ties: Column) -> DataFrame:
    """Newest row per key; at equal timestamps DELETE wins over CHANGE over CREATE."""
    order = [F.col(ts).desc_nulls_last(), action_priority(F.col(action)).asc(), *ties]
    return latest_per_key(df, keys, order)


def drop_duplicates(df: DataFrame, keys: Sequence[str], ties: Sequence[Column]) -> DataFrame:
    """``dropDuplicates`` with a stated winner."""
    return latest_per_key(df, keys, ties)
