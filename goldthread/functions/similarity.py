"""Name similarity."""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.types import DoubleType

# The usual prefix weight, prefix length and boost threshold of Jaro-Winkler.
PREFIX_WEIGHT, PREFIX_LENGTH, BOOST_ABOVE = 0.1, 4, 0.7


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; two empty texts are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(a, b) / longest)


@lru_cache(maxsize=1 << 16)  # names repeat; the cache belongs to a Python worker and is bounded
def _jaro_winkler(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = [True] * len(b)
    left = []
    for i, ch in enumerate(a):
        j = b.find(ch, max(0, i - reach), i + reach + 1)
        while j >= 0 and not free[j]:
            j = b.find(ch, j + 1, i + reach + 1)
        if j >= 0:
            free[j] = False
            left.append(ch)
    if not left:
        return 0.0
    right = [ch for ch, unused in zip(b, free) if not unused]
    m = len(left)
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= BOOST_ABOVE:
        return jaro
    prefix = 0
    for x, y in zip(a[:PREFIX_LENGTH], b[:PREFIX_LENGTH]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * PREFIX_WEIGHT * (1 - jaro)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity; 0 when a side is null or empty. Spark has no built-in for it."""
    return pd.Series([_jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


def register(spark: SparkSession) -> None:
    """Make ``jaro_sim`` and ``gen_uuid`` callable from SQL."""
    spark.udf.register("jaro_sim", jaro_winkler)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION gen_uuid() RETURNS STRING NOT DETERMINISTIC RETURN uuid()")
