"""A bitmap of hashed keys in front of a join: rows that cannot match never move.

The bitmap has one bit per hash value and a bounded size, whatever the number of keys; a key's bit is always set, other rows pass by chance
and are removed by the join behind it. With very many keys it fills up and lets more through, which costs time and changes no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MAX_BITS = 24  # 2 ** 24 places, 2 MB
MIN_BITS = 16
PLACES_PER_KEY = 32
_CHUNK = 15  # 2 ** 15 places per bitmap of the aggregate


def _place(columns: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits)


def key_bitmap(keys: DataFrame, columns: Sequence[str]) -> tuple[bytes, int]:
    """The bitmap of the keys, built by partial aggregates, and the number of its hash bits."""
    n = keys.count()
    bits = min(MAX_BITS, max(MIN_BITS, (max(n, 1) * PLACES_PER_KEY - 1).bit_length()))
    place = _place(columns, bits)
    marks = keys.select(F.shiftright(place, _CHUNK).alias("chunk"), place.bitwiseAND(F.lit((1 << _CHUNK) - 1)).alias("bit"))
    chunks = marks.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect()  # at most 2 ** (MAX_BITS - 15) rows
    held = {r["chunk"]: bytes(r["bitmap"]) for r in chunks}
    return b"".join(held.get(i, bytes(1 << _CHUNK - 3)) for i in range(1 << bits - _CHUNK)), bits


def may_be_in(bitmap: tuple[bytes, int], columns: Sequence[str]) -> Column:
    """Whether a row's key is marked: true for every key of the bitmap, and for some others."""
    data, bits = bitmap
    place = _place(columns, bits)
    byte = F.conv(F.hex(F.substring(F.lit(data), F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1


def semi_by_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows whose key is listed; of the others only false hits are shuffled. Null keys match nothing."""
    listed = keys.select(*on).na.drop().distinct()
    return rows.filter(may_be_in(key_bitmap(listed, on), on)).join(listed, list(on), "left_semi").select(*rows.columns)


def without_keys(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows whose key is not listed. Those that the bitmap clears stay where they are; the others meet the keys."""
    listed = keys.select(*on).na.drop().distinct()
    maybe = F.coalesce(may_be_in(key_bitmap(listed, on), on), F.lit(False))
    return rows.filter(~maybe).unionByName(rows.filter(maybe).join(listed, list(on), "left_anti").select(*rows.columns))
