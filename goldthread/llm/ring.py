"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

Every shard owns ``nodes`` points of a ring. A row hashes to a point of the ring and belongs to the arc
that ends at the next virtual node clockwise. Each arc prefers the shards in the order in which their
nodes follow. A shard takes rows until it is full; what an arc cannot place goes on clockwise to the
next shard of its preference.

What overflows is decided per arc, from the load of every arc: a table of ``shards * nodes`` rows, whatever
the size of the input. Rows find their place by a running load inside their arc, computed over range
slices, so an arc or a key with a third of all rows is spread over many tasks.

Defined cases: a null id or text is an ordinary value (size of a null text: 1); repeated rows are placed one by one;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldthread.operators.ordering import number_rows, running_sum
from goldthread.session import stage

SPACE_BITS = 63
CELL_BITS = 12  # the ring is cut in 4,096 cells to look an arc up by an equi-join


def ring_nodes(shards: int, nodes: int) -> list[tuple[int, int]]:
    """``(position, shard)`` of every virtual node in ring order. A node's place depends on its shard and number alone."""
    place = lambda s, v: int.from_bytes(hashlib.sha256(f"shard {s} node {v}".encode()).digest()[:8], "big") >> 1
    return sorted((place(s, v), s) for s in range(shards) for v in range(nodes))


def preferences(ring: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """For the arc that ends at each node: the shards in the order in which they follow clockwise."""
    out = []
    for i in range(len(ring)):
        seen: dict[int, None] = {}
        for j in range(len(ring)):
            seen.setdefault(ring[(i + j) % len(ring)][1])
            if len(seen) == shards:
                break
        out.append(list(seen))
    return out


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Load limits that add up to at least ``total``; without slack they differ by one at most."""
    if slack:
        return [-int(-total * (1 + slack) // shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def place_arcs(loads: dict[int, int], prefer: list[list[int]], limits: list[int]) -> list[tuple[int, int, int, int]]:
    """Pieces ``(arc, from, to, shard)``: the load of each arc cut where a shard is full, the rest going on clockwise."""
    free, done, pieces = list(limits), dict.fromkeys(loads, 0), []
    for turn in range(len(limits)):
        for arc in sorted(loads):
            shard = prefer[arc][turn]
            take = min(loads[arc] - done[arc], free[shard])
            if take > 0:
                pieces.append((arc, done[arc], done[arc] + take, shard))
                done[arc] += take
                free[shard] -= take
    return pieces


def _rows(spark: SparkSession, rows: list[tuple[int, ...]], names: str) -> DataFrame:
    """A literal table of longs."""
    values = ", ".join(f"({', '.join(f'{v}L' for v in r)})" for r in rows) or f"({', '.join('0L' for _ in names.split(','))})"
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})").filter("true" if rows else "false")


def _arc_cells(ring: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """``(cell, low, high, arc)``: positions ``low <= p <= high`` of a cell that belong to an arc."""
    width = 1 << (SPACE_BITS - CELL_BITS)
    out, low = [], 0
    for arc, high in [*((i, p) for i, (p, _) in enumerate(ring)), (0, (1 << SPACE_BITS) - 1)]:
        for cell in range(low // width, high // width + 1):
            a, b = max(low, cell * width), min(high, (cell + 1) * width - 1)
            if a <= b:
                out.append((cell, a, b, arc))
        low = high + 1
    return out


def assign_shards(
    rows: DataFrame, id: str, load: str, shards: int = 8, nodes: int = 64, slack: float = 0.0, order: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard) to ``rows``; ``load`` is a column of positive longs.

    ``slack`` is how far a shard may exceed the mean load; 0 makes the loads equal (differing by one when
    every load is 1), a larger value moves fewer rows when a shard is added. ``order`` names columns that
    tell rows of one id apart. A row that straddles a limit counts where it begins.
    """
    spark = rows.sparkSession
    ring = ring_nodes(shards, nodes)
    width = SPACE_BITS - CELL_BITS
    cells = F.broadcast(_rows(spark, _arc_cells(ring), "_cell, _low, _high, _arc"))  # 4,096 + shards * nodes rows
    placed = rows.withColumns({
        "_at": F.shiftrightunsigned(F.xxhash64(F.col(id)), 1), "_tie": F.monotonically_increasing_id(),
    }).withColumn("_cell", F.shiftright("_at", width))
    placed = placed.join(cells, (placed["_cell"] == cells["_cell"]) & F.col("_at").between(F.col("_low"), F.col("_high")))
    placed = placed.drop("_cell", "_low", "_high")
    sequence = ["_at", id, *order, "_tie"]
    placed = stage(running_sum(placed, load, sequence, ["_arc"], "_until"), "ring")
    loads = {r["_arc"]: r["n"] for r in placed.groupBy("_arc").agg(F.sum(load).alias("n")).collect()}  # a row per arc
    limits = capacities(sum(loads.values()), shards, slack)
    pieces = place_arcs(loads, preferences(ring, shards), limits)
    plan = F.broadcast(_rows(spark, pieces, "_of, _from, _to, _shard"))  # shards * (nodes + shards) rows at most
    start = F.col("_until") - F.col(load)
    out = placed.join(plan, (F.col("_arc") == F.col("_of")) & (start >= F.col("_from")) & (start < F.col("_to")))
    out = out.withColumn("shard", F.col("_shard").cast("int"))
    out = number_rows(out, ["_arc", "_until", "_tie"], ["shard"], "_n")
    return out.withColumn("slot", F.col("_n") - 1).drop("_n", "_at", "_tie", "_arc", "_until", "_of", "_from", "_to", "_shard")


def shard_documents(docs: DataFrame, shards: int = 8, nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """Documents in ``shards`` shards whose row counts differ by one at most (law ``rows``).

    One row per input row: doc_id, size (UTF-8 bytes of the text, plus one), text_crc32, law, shard, slot and
    grown_shard, which is null because bounded loads move rows between old shards too.
    """
    rows = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(1).cast("bigint").alias("_one"),
    )
    rows = stage(rows, "sizes")  # texts are read once
    out = assign_shards(rows, "doc_id", "_one", shards, nodes, slack, ("size", "text_crc32"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
