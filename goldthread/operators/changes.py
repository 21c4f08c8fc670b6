"""Change tables: the difference of two snapshots, and ways to read several versions of it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.operators.dedup import latest_per_key
from goldthread.operators.skew import null_safe

# Net effect of the first and the last change of a key.
NET_CODES = {
    "II": "I", "IU": "I", "ID": "IGNORE", "UI": "U", "UU": "U", "UD": "D", "DI": "U", "DU": "U", "DD": "D",
}


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None,
    op_time: Column | None = None, version: int | None = None,
) -> DataFrame:
    """Changed rows with ``CDC_CODE`` I, U or D. Deleted rows carry their last values."""
    columns = new.columns
    compare = [c for c in columns if c not in set(keys)] if compare is None else compare
    o = old.select(F.struct(*columns).alias("_o"))
    n = new.select(F.struct(*columns).alias("_n"))
    joined = o.join(n, null_safe("_o", "_n", keys), "full_outer")
    differs = reduce(
        lambda a, b: a | b, [~F.col(f"_o.{c}").eqNullSafe(F.col(f"_n.{c}")) for c in compare], F.lit(False)
    )
    code = F.when(F.col("_o").isNull(), "I").when(F.col("_n").isNull(), "D").when(differs, "U")
    out = joined.withColumn("CDC_CODE", code).filter("CDC_CODE IS NOT NULL")
    out = out.select(F.coalesce("_n", "_o").alias("_r"), "CDC_CODE").select("_r.*", "CDC_CODE")
    return _stamp(out, op_time, version)


def first_version(snapshot: DataFrame, op_time: Column | None = None, version: int | None = None) -> DataFrame:
    """Change table of the first snapshot: every row is an insert."""
    return _stamp(snapshot.withColumn("CDC_CODE", F.lit("I")), op_time, version)


def _stamp(df: DataFrame, op_time: Column | None, version: int | None) -> DataFrame:
    if op_time is not None:
        df = df.withColumn("CDC_OperationTime", op_time)
    if version is not None:
        df = df.withColumn("CDC_OperationVersion", F.lit(version).cast("bigint"))
    return df


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The next snapshot: the old one without the changed keys, plus their inserted and updated rows."""
    c, s = changes.alias("_c"), snapshot.alias("_s")
    kept = s.join(c, null_safe("_s", "_c", keys), "left_anti")
    return kept.unionByName(changes.filter("CDC_CODE <> 'D'").select(*snapshot.columns))


def collapse_versions(changes: DataFrame, keys: Sequence[str], ts: str, *ties: Column) -> DataFrame:
    """Latest change per key; without keys every version is kept."""
    return latest_per_key(changes, keys, [F.col(ts).desc(), *ties]) if keys else changes


def net_changes(changes: DataFrame, keys: Sequence[str], ts: str, code: str = "CDC_CODE", *ties: str) -> DataFrame:
    """Latest row per key with the net effect of its first and last change; insert + delete vanishes.

    One aggregate: ``min_by`` and ``max_by`` combine in the map tasks.
    """
    order = F.struct(ts, *ties)
    columns = changes.columns
    ends = changes.groupBy(*keys).agg(
        F.min_by(code, order).alias("_first"), F.max_by(F.struct(*columns), order).alias("_last")
    )
    net = ends.withColumn("_pair", F.concat("_first", f"_last.{code}"))
    table = F.create_map(*[F.lit(x) for kv in NET_CODES.items() for x in kv])
    net = net.withColumn("_net", F.try_element_at(table, F.col("_pair"))).filter("_net <> 'IGNORE'")
    return net.select("_last.*", "_net").withColumn(code, F.col("_net")).select(*columns)
