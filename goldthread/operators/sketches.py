"""Mergeable sketches: counts of distinct values, overlaps and quantiles from stored summaries, without another scan.

A batch is summarised once, per group; the summaries of all batches merge to those of the whole, of a month, or of several groups. A summary has a
bounded size, whatever it stands for. Errors (three standard deviations, for the sizes here): ``DISTINCT_ERROR`` of the count,
``OVERLAP_ERROR`` of the union's count for an overlap, ``RANK_ERROR`` of all rows for a quantile's rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

NOMINAL = 14  # 2 ** 14 entries
QUANTILE_SIZE = 800
DISTINCT_ERROR = 3 / 2 ** (NOMINAL / 2)
OVERLAP_ERROR = 2 * DISTINCT_ERROR
RANK_ERROR = 0.01


def batch_sketches(df: DataFrame, groups: Sequence[str], key: str | None = None, value: str | None = None) -> DataFrame:
    """``groups, n, keys, key_bits, values``: rows, sketches of the distinct ``key`` (theta and HLL) and of the numbers ``value`` per group.

    Nulls are counted as rows and not sketched; a group without any has null sketches.
    """
    parts = [F.count(F.lit(1)).alias("n")]
    if key:
        parts += [F.theta_sketch_agg(key, NOMINAL).alias("keys"), F.hll_sketch_agg(key, NOMINAL).alias("key_bits")]
    if value:
        parts.append(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(QUANTILE_SIZE)).alias("values"))
    return df.groupBy(*groups).agg(*parts)


def merge_sketches(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The sketches of coarser ``groups`` from stored ones: rows are sketches, never the data."""
    merged = {
        "n": F.sum("n"), "keys": F.theta_union_agg("keys", NOMINAL), "key_bits": F.hll_union_agg("key_bits"),
        "values": F.kll_merge_agg_double("values", QUANTILE_SIZE)}
    return sketches.groupBy(*groups).agg(*[merged[c].alias(c) for c in sketches.columns if c in merged])


def distinct_count(keys: str | Column = "keys") -> Column:
    return F.theta_sketch_estimate(keys)


def distinct_count_hll(bits: str | Column = "key_bits") -> Column:
    return F.hll_sketch_estimate(bits)


def approx_distinct(value: str | Column, error: float) -> Column:
    """Aggregate: about how many distinct values, nulls left out, to a relative standard deviation of ``error``.

    The sketch has as many registers as ``approx_count_distinct`` takes for this error, but starts as a list of the values seen: a group of few values has
    a few bytes, not all registers, so there may be any number of groups. Values are sketched by their 64-bit hash.
    """
    value = F.col(value) if isinstance(value, str) else value
    bits = min(max(math.ceil(2 * math.log2(1.106 / error)), 4), 21)
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), bits)), F.lit(0))


def overlap(a: str | Column, b: str | Column) -> Column:
    """How many distinct keys two groups share."""
    return F.theta_sketch_estimate(F.theta_intersection(a, b))


def only_left(a: str | Column, b: str | Column) -> Column:
    """How many distinct keys the first group has and the second one lacks."""
    return F.theta_sketch_estimate(F.theta_difference(a, b))


def quantile(values: str | Column, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(values, F.lit(rank))
