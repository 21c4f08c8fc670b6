"""Row numbers and running sums over global or very large groups, computed in parallel.

A window without partitions, or over one huge group, runs in a single task. Here the rows are range
partitioned by (group, order); every task numbers its own slice and a small table of slice totals
gives the offsets. That table has one row per slice and group, never one per input row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from goldthread.session import stage

_SLICE_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _slices(df: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    ordering = [*group, *order]
    ranged = df.repartitionByRange(*ordering).sortWithinPartitions(*ordering)
    ranged = ranged.withColumn("_mono", F.monotonically_increasing_id())
    ranged = stage(ranged, "ranged")
    return ranged.select(
        "*",
        F.shiftright("_mono", _SLICE_BITS).cast("int").alias("_slice"),
        F.col("_mono").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1)).alias("_pos"),
        F.struct(*[F.col(g) for g in group]).alias("_g") if group else F.lit(0).alias("_g"),
    ).drop("_mono")


def _offsets(totals: DataFrame) -> DataFrame:
    before = Window.partitionBy("_g").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_before", F.coalesce(F.sum("_total").over(before), F.lit(0)))


def number_rows(
    df: DataFrame, order: Sequence[Column | str], group: Sequence[str] = (), name: str = "row_no"
) -> DataFrame:
    """Number the rows 1, 2, … in ``order`` within ``group`` (whole table when empty).

    ``order`` must be total, otherwise ties are numbered in an arbitrary order.
    """
    sliced = _slices(df, group, order)
    totals = sliced.groupBy("_slice", "_g").agg(F.count(F.lit(1)).alias("_total"), F.min("_pos").alias("_first"))
    joined = sliced.join(_offsets(totals), ["_slice", "_g"])
    number = (F.col("_before") + F.col("_pos") - F.col("_first") + 1).cast("bigint")
    return joined.withColumn(name, number).drop("_slice", "_pos", "_g", "_total", "_first", "_before")


def running_sum(
    df: DataFrame, value: str, order: Sequence[Column | str], group: Sequence[str] = (), name: str = "running"
) -> DataFrame:
    """Inclusive running sum of ``value`` in ``order`` within ``group``."""
    sliced = _slices(df, group, order)
    totals = sliced.groupBy("_slice", "_g").agg(F.sum(value).alias("_total"))
    inside = Window.partitionBy("_slice", "_g").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumn("_local", F.sum(value).over(inside))
    joined = local.join(_offsets(totals), ["_slice", "_g"])
    return joined.withColumn(name, F.col("_before") + F.col("_local")).drop(
        "_slice", "_pos", "_g", "_total", "_before", "_local"
    )


def batch_numbers(
    df: DataFrame, size: int, order: Sequence[Column | str], group: Sequence[str] = (), name: str = "batch_number",
    width: int = 4,
) -> DataFrame:
    """Cut each group into consecutive batches of ``size`` rows, labelled ``0001``, ``0002``, …"""
    numbered = number_rows(df, order, group, "_n")
    label = F.format_string(f"%0{width}d", F.ceil(F.col("_n") / F.lit(size)).cast("bigint"))
    return numbered.withColumn(name, label).drop("_n")


def surrogate_ids(df: DataFrame, order: Sequence[Column | str], start: int = 0, name: str = "id") -> DataFrame:
    """Dense ids ``start + 1, start + 2, …`` in ``order``."""
    return number_rows(df, order, (), "_n").withColumn(name, F.col("_n") + F.lit(start)).drop("_n")
