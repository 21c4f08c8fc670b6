"""Candidate pairs inside buckets, without all pairs of a bucket, and the components of confirmed links.

First every member of a bucket is paired with its leader, the member most like the others. Confirmed links give
components; where a bucket still holds more than one, the members outside its largest component are compared with the
members of other components. So every pair that shares a bucket is either tested or already connected, and a bucket of
copies costs as many tests as it has members.

What is known of a bucket returns to its members by a join; with ``hot``, buckets of more members than that are cut in parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldthread.operators.components import connected_components
from goldthread.operators.skew import salted_join
from goldthread.session import stage


def _of_bucket(members: DataFrame, buckets: DataFrame, hot: int | None) -> DataFrame:
    """``members`` with the columns of their bucket; ``buckets`` has one row per bucket with the number ``n`` of its members."""
    mine = [c for c in buckets.columns if c == "bucket" or c not in members.columns]
    if hot is None:
        return members.join(buckets.select(mine), "bucket")
    buckets = stage(buckets, "bucket-values")
    return salted_join(members, buckets.select(mine), ["bucket"], ["node"], counts=buckets, size="n", rows_per_task=hot)


def crowded(members: DataFrame, hot: int | None = None) -> DataFrame:
    """Members ``(bucket, node, ...)`` of buckets of two or more, with their number ``n``."""
    counts = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _of_bucket(members, counts, hot)


def degrees(crowd: DataFrame) -> DataFrame:
    """``(node, degree)``: how much company a node has over all its buckets."""
    return crowd.groupBy("node").agg(F.sum("n").alias("degree"))


def led(crowd: DataFrame, hot: int | None = None) -> DataFrame:
    """Members (with ``degree``) of buckets of two or more, with their number ``n`` and the ``lead`` of the bucket: its member of
    highest degree, the smallest of equal ones.

    Of a group of copies that is the one most like the others, so most members link with it at once.
    """
    best = crowd.groupBy("bucket").agg(F.max(F.struct("degree", -F.col("node"))).alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _of_bucket(crowd, best.select("bucket", "n", (-F.col("best")["col2"]).alias("lead")), hot)


def star_pairs(led_members: DataFrame) -> DataFrame:
    """``(a, b)``: each member with its leader."""
    return led_members.filter("node <> lead").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")).distinct()


def components_of(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, root)`` for all ``nodes``; ``links`` has ``(a, b)``."""
    found = connected_components(links, "a", "b").withColumnRenamed("node", "_node")
    out = nodes.select("node").join(found, F.col("node") == F.col("_node"), "left")
    return stage(out.select("node", F.coalesce("root", "node").alias("root")), "components")


def joined_roots(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``roots`` (``node, root``) after the links ``more`` (``a, b``) between roots: only the graph of roots is resolved."""
    moves = stage(connected_components(more, "a", "b").toDF("root", "new_root"), "moves")
    return stage(salted_join(roots, moves, ["root"], ["node"], "left").select("node", F.coalesce("new_root", "root").alias("root")), "components")


def open_members(members: DataFrame, roots: DataFrame, hot: int | None = None) -> DataFrame:
    """Members of buckets with several components, with ``root`` and ``main``, the bucket's largest component."""
    at = members.select("bucket", "node").join(roots, "node")
    sizes = at.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("roots"), F.max(F.struct("n", "root")).getField("root").alias("main"), F.sum("n").alias("n")
    ).filter("roots > 1")
    return stage(_of_bucket(at, main.select("bucket", "main", "n"), hot).drop("n"), "open")


def open_blocks(members: DataFrame, roots: DataFrame, query_rows: int, block_rows: int) -> DataFrame:
    """``(main, i, j, query, node, root)``: what has to be compared, in blocks of bounded size, without any pair.

    For each component that is the largest of some bucket: the other members of those buckets are queries, its own
    members and the queries are the rows to search; block (i, j) holds the i-th part of the queries and the j-th of the rows.
    """
    at = open_members(members, roots)
    queries = at.filter("root <> main").select("main", "node", "root").distinct()
    rows = roots.withColumn("main", F.col("root")).join(queries.select("main").distinct(), "main", "left_semi")
    rows = rows.select("main", "node", "root").unionByName(queries)
    shape = queries.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("n_i")).join(
        rows.groupBy("main").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("n_j")), "main")
    shape = stage(shape, "shape")
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = queries.join(shape, "main").withColumn("i", part("n_i")).withColumn("j", every("n_j")).withColumn("query", F.lit(True))
    r = rows.join(shape, "main").withColumn("j", part("n_j")).withColumn("i", every("n_i")).withColumn("query", F.lit(False))
    names = ["main", "i", "j", "query", "node", "root"]
    return q.select(names).unionByName(r.select(names))


def parts_of(nodes: DataFrame, block_rows: int) -> DataFrame:
    """``(node, root, part)`` of ``nodes`` (``node, root``) in parts of about ``block_rows``: a large component is cut, small ones share a
    part; written. ``part`` names its component, or -1 for small ones."""
    sizes = stage(nodes.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "sizes")
    total = sizes.agg(F.coalesce(F.sum(F.when(F.col("n") < block_rows, F.col("n"))), F.lit(0))).first()[0]
    few = max(1, -(-total // block_rows))
    own = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / F.lit(block_rows))).cast("int")
    small = F.struct(F.lit(-1).cast("bigint").alias("root"), F.pmod(F.xxhash64("root"), F.lit(few)).cast("int").alias("k"))
    part = F.when(F.col("n") < block_rows, small).otherwise(F.struct(F.col("root").cast("bigint").alias("root"), own.alias("k")))
    sized = salted_join(nodes, sizes, ["root"], ["node"], counts=sizes, size="n")
    return stage(sized.select("node", "root", part.alias("part")), "parts")


def part_blocks(asked: DataFrame, parts: DataFrame, query_rows: int) -> DataFrame:
    """``(part, i, query, node, root)``: the queries ``asked`` of parts (``part, node``) and the rows of these, as blocks of bounded size.

    Of a part's queries block i holds the i-th share.
    """
    asked = stage(asked, "asked")
    shape = stage(asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / query_rows).cast("int").alias("n_i")), "shape")
    share = F.pmod(F.xxhash64("node"), F.col("n_i")).cast("int")
    names = ["part", "i", "query", "node", "root"]
    queries = asked.join(shape, "part").withColumn("i", share).join(parts.select("node", "root"), "node")
    rows = parts.join(shape, "part").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_i") - 1)))
    return queries.withColumn("query", F.lit(True)).select(names).unionByName(rows.withColumn("query", F.lit(False)).select(names))
