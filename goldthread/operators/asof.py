"""As-of joins: for each row the last value known at its time, also where one key holds a large share of all rows.

Both sides are sorted together by (key, time) in range slices. Inside a slice a running "last value" answers; what a slice knows at its end is
carried into the next ones. The carried table has one row per slice. No task holds a key, and nothing is paired.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from goldthread.operators.ordering import _slices


def as_of_join(
    rows: DataFrame, values: DataFrame, keys: Sequence[str], at: str, since: str, take: Mapping[str, str | Column],
    strict: bool = False, forward: bool = False, ties: Sequence[str] = (),
) -> DataFrame:
    """``rows`` with the columns ``take`` of the last row of ``values`` that has the same ``keys`` and ``since`` <= ``at``.

    ``strict`` wants ``since`` < ``at``; ``forward`` looks for the first value at or after ``at`` instead (``strict``: after). Of several
    values at one time the last in order of ``ties`` counts. Rows without a value, with a null key or a null time get nulls; null
    keys match nothing, as in any join. Every row stays once.
    """
    keys = list(keys)
    known = F.col("_since").isNotNull()
    for key in keys:
        known = known & F.col(key).isNotNull()
    taken = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in take.items()])
    tie = F.struct(*ties) if ties else F.lit(0)
    right = values.select(*keys, F.col(since).alias("_since"), tie.alias("_tie"), taken.alias("_value")).filter(known)
    right = right.withColumnRenamed("_since", "_time").withColumn("_asks", F.lit(False))
    left = rows.select(*keys, F.col(at).alias("_time"), F.struct(*rows.columns).alias("_row")).withColumn("_asks", F.lit(True))
    both = left.unionByName(right, allowMissingColumns=True)
    first = F.col("_asks") if not strict else ~F.col("_asks")  # at one time: values before the rows that may see them
    order = [F.col("_time").desc() if forward else F.col("_time").asc(), first]
    if ties:
        order.append(F.col("_tie"))
    both = both.withColumn("_answer", F.when(~F.col("_asks"), F.struct(F.struct(*keys).alias("g"), F.col("_value").alias("v"))))
    sliced = _slices(both, keys, order)
    inside = Window.partitionBy("_slice", "_g").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    answered = sliced.withColumn("_answer", F.last("_answer", ignorenulls=True).over(inside)).filter("_asks")
    ends = sliced.groupBy("_slice").agg(F.max_by("_answer", F.when(F.col("_answer").isNotNull(), F.col("_pos"))).alias("_end"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # one row per slice
    carried = ends.select(F.col("_slice"), F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    joined = answered.join(F.broadcast(carried), "_slice")  # as many rows as slices, so as shuffle partitions
    usable = F.col("_carried.g") == F.col("_g")
    answer = F.when(F.col("_time").isNotNull(), F.coalesce(F.col("_answer.v"), F.when(usable, F.col("_carried.v"))))
    return joined.select("_row.*", answer.alias("_answer")).select(*rows.columns, *[F.col(f"_answer.{n}").alias(n) for n in take])
