"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is a partially aggregated minimum per node and one join with that minimum. Nodes with very
many neighbours are spread over many tasks. A chain of n nodes needs O(log n) rounds.

Tables of nodes and edges grow with the graph, but their files are so dense that Spark would take them for small and send each, in
each round, through the driver. They are always joined by shuffles (:func:`_shuffled`).
"""

from __future__ import annotations

import logging
import time

from pyspark.sql import DataFrame, functions as F

from goldthread.operators import skew
from goldthread.operators.skew import salted_join, with_group_values
from goldthread.session import release, stage

log = logging.getLogger(__name__)


class NotConverged(RuntimeError):
    """The round limit was reached before every component became a star."""


def _shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is shuffled and merged, never broadcast."""
    return df.hint("merge")


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct edges ``(u, v)`` with ``u > v``, loops dropped."""
    return (
        edges.filter(F.col(src) != F.col(dst))
        .select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
        .distinct()
    )


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _neighbourhood(edges: DataFrame) -> DataFrame:
    """``u, m, _rows, up, down`` per node: its smallest neighbour or itself, and how many neighbours, smaller and larger ones."""
    both = _both_ways(edges)
    return both.groupBy("u").agg(
        F.least("u", F.min("v")).alias("m"), F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("v") < F.col("u")).alias("up"), F.count_if(F.col("v") > F.col("u")).alias("down"),
    )


def _progress(nodes: DataFrame) -> tuple[bool, int]:
    """Whether every node has either one parent and no child, or no parent; and the rows of the node with the most neighbours."""
    loose = F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))
    found = nodes.agg(loose.alias("loose"), F.max("_rows").alias("most")).first()
    return not found["loose"], found["most"] or 0


def _large_star(edges: DataFrame, nodes: DataFrame, most: int, rows_per_task: int | None) -> DataFrame:
    """Larger neighbours move to the node's smallest neighbour; nodes with more than ``rows_per_task`` neighbours are cut."""
    larger = _both_ways(edges).filter("v > u")
    if most <= (skew.ROWS_PER_TASK if rows_per_task is None else rows_per_task):
        joined = larger.join(_shuffled(nodes.select("u", "m")), "u")
    else:
        joined = salted_join(larger, _shuffled(nodes.select("u", "m")), ["u"], ["v"], counts=nodes, rows_per_task=rows_per_task)
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours, and the node itself, move to the node's smallest neighbour (hot nodes: split by Spark's skew join)."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(_shuffled(lowest), "u")
    return joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()


def connected_components(
    edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 50, rows_per_task: int | None = None
) -> DataFrame:
    """``(node, root)`` for every node of an edge; the root is the smallest node of the component.

    A round makes one aggregate over the edges; it gives the minima and, written once per round, the test whether the
    graph is done. Rounds and their seconds are logged.
    """
    current = stage(canonical_edges(edges, src, dst), "edges")
    for turn in range(max_rounds + 1):
        began = time.perf_counter()
        nodes = stage(_neighbourhood(current), "nodes")
        done, most = _progress(nodes)
        if done:
            return nodes.select(F.col("u").alias("node"), F.col("m").alias("root"))
        if turn == max_rounds:
            break
        used, current = (current, nodes), stage(_small_star(_large_star(current, nodes, most, rows_per_task)), "edges")
        release(current.sparkSession, *used)
        log.info("round %d of the components took %.1f s", turn + 1, time.perf_counter() - began)
    raise NotConverged(f"no star forest after {max_rounds} rounds")


def root_moves(roots: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> tuple[DataFrame, DataFrame]:
    """What new ``edges`` change in known components: ``(root, new_root)`` of joined ones, and ``(node, root)`` of new nodes.

    Edges are relabelled by the current roots and only the contracted graph is resolved, so the cost grows with the batch: the known nodes
    are read once, to find the roots of its ends. ``roots`` has ``node`` and ``root`` (the smallest node).
    """
    ends = edges.select(F.col(src).alias("node")).union(edges.select(F.col(dst).alias("node"))).filter("node IS NOT NULL").distinct()
    ends = stage(ends.join(_shuffled(roots.select("node", "root")), "node", "left").select("node", F.coalesce("root", "node").alias("at"), F.col("root").isNull().alias("new")), "ends")
    side = lambda name, to: _shuffled(ends.select(F.col("node").alias(name), F.col("at").alias(to)))
    contracted = edges.join(side(src, "_u"), src).join(side(dst, "_v"), dst).select(F.col("_u").alias("src"), F.col("_v").alias("dst"))
    joined = stage(connected_components(contracted).toDF("root", "new_root"), "moves")
    fresh = ends.filter("new").join(_shuffled(joined.withColumnRenamed("root", "node")), "node", "left").select("node", F.coalesce("new_root", "node").alias("root"))
    return joined.join(_shuffled(ends.filter("new").select(F.col("node").alias("root"))), "root", "left_anti").filter("root <> new_root"), fresh


def add_edges(roots: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``roots`` after new ``edges``: the same as resolving all edges again."""
    moves, fresh = root_moves(roots, edges, src, dst)
    kept = salted_join(roots.select("node", "root"), _shuffled(moves), ["root"], ["node"], "left").select("node", F.coalesce("new_root", "root").alias("root"))
    return kept.unionByName(fresh)


def remove_edges(roots: DataFrame, left: DataFrame, removed: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``roots`` after ``removed`` edges went and the edges ``left`` remain: only components that lost an edge are resolved again.

    A node without edges stays as its own root.
    """
    ends = removed.select(F.col(src).alias("node")).union(removed.select(F.col(dst).alias("node"))).distinct()
    hurt = stage(ends.join(_shuffled(roots.select("node", "root")), "node").select("root").distinct(), "hurt")
    nodes = stage(roots.select("node", "root").join(_shuffled(hurt), "root", "left_semi").select("node"), "hurt-nodes")
    inside = left.join(_shuffled(nodes.withColumnRenamed("node", src)), src, "left_semi")  # both ends of an edge are in one component
    again = with_singletons(connected_components(inside, src, dst), nodes)
    return roots.select("node", "root").join(_shuffled(hurt), "root", "left_anti").select("node", "root").unionByName(again.select("node", "root"))


def with_singletons(components: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """All ``nodes`` with their root; a node without edges is its own root."""
    found = components.select(F.col("node").alias(node), "root")
    return nodes.select(node).distinct().join(_shuffled(found), node, "left").withColumn("root", F.coalesce("root", F.col(node)))


def with_group_size(members: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    """Add ``group_size``, the number of members, to every member."""
    return with_group_values(members, [root], [node], group_size=F.count(F.lit(1)))


def component_sizes(members: DataFrame, node: str = "node", root: str = "root") -> DataFrame:
    return members.groupBy(root).agg(F.countDistinct(node).alias("group_size"))
