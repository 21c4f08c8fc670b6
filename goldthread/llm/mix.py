"""Mixing sources to target weights by cube-method balanced sampling.

Each source gets a target number of words. Target over size gives the rate of a source: its whole part is
the number of copies every document gets, its fraction the inclusion probability of one more copy. The cube
method turns these probabilities into zeros and ones: in the flight phase a vector of three probabilities
moves along the null space of the constraints (documents and words taken), in a random direction and until
one of them is 0 or 1, so both totals stay exact at every step. Blocks of documents fly in parallel; each
leaves two open probabilities and a small reserve, which form the blocks of the next level. In the last block of
a source two open probabilities remain: the landing problem, solved for the nearest total.

Defined cases: a null text has size 0; null is a source of its own, the last one; a source without words is
not taken; rows that agree in id, source and size are drawn together and get the same number of copies; an
empty table gives an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from goldthread.llm.rows import free_name
from goldthread.operators.ordering import number_rows
from goldthread.session import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK_ROWS = 4096
RESERVE = 16  # documents of a block that fly in the next level, so that the last one has many to balance with
UNIT = ["source", "doc_id", "size"]


def text_size(text: str = "text") -> Column:
    """Number of words; 0 for a null text."""
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``(source, rank, source_size, target)`` for rows with ``source`` and ``size``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A target
    stops at ``most`` times its source's size; the excess is shared again by weight until none is above.
    """
    sums = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = number_rows(sums, [F.col("source").asc_nulls_last()], (), "rank")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = stage(ranked.withColumn("weight", turn).withColumn("most", F.col("source_size") * F.lit(most)), "sources")
    whole = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, None
    while True:
        above = F.col("weight") * F.lit(level) > F.col("most")
        row = ranked.agg(
            F.count_if(above).alias("n"), F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("free"),
        ).first()
        if row["n"] == capped or not row["free"]:
            break
        capped, level = row["n"], (whole - row["full"]) / row["free"]
    target = F.least(F.col("weight") * F.lit(level), F.col("most")) if level else F.lit(0.0)
    return ranked.select("source", "rank", "source_size", target.alias("target"))


def fly(units: list[list[float]], rng: random.Random) -> list[list[float]]:
    """Flight phase over ``[probability, rows, words]``; changes the probabilities in place, returns the open ones."""
    near = 1e-9
    held: list[list[float]] = []
    for unit in units:
        if not near < unit[0] < 1 - near:
            unit[0] = round(unit[0])
            continue
        held.append(unit)
        while True:
            step = _null_vector(held)
            if step is None:
                break
            up = min((1 - u[0]) / v if v > 0 else u[0] / -v for u, v in zip(held, step) if v)
            down = min(u[0] / v if v > 0 else (1 - u[0]) / -v for u, v in zip(held, step) if v)
            by = up if rng.random() * (up + down) < down else -down
            for u, v in zip(held, step):
                u[0] += by * v
                if not near < u[0] < 1 - near:
                    u[0] = round(u[0])
            held = [u for u in held if near < u[0] < 1 - near]
    return held


def _null_vector(held: list[list[float]]) -> list[float] | None:
    """A direction that keeps the sums of rows and words, or None when the units fix them."""
    if len(held) < 2:
        return None
    (_, m1, w1), (_, m2, w2) = held[:2]
    if m1 * w2 == m2 * w1:
        return [m2, -m1] + [0.0] * (len(held) - 2)
    if len(held) < 3:
        return None
    _, m3, w3 = held[2]
    step = [m2 * w3 - m3 * w2, m3 * w1 - m1 * w3, m1 * w2 - m2 * w1]
    longest = max(map(abs, step))
    return [v / longest for v in step] + [0.0] * (len(held) - 3)


def land(units: list[list[float]], held: list[list[float]], due: float) -> None:
    """Round the last open probabilities, then flip up to two units so that the words taken come nearest to ``due``.

    Flight keeps both totals but a long document can stay open to the end; the flips make up for its rounding.
    """
    for unit in held:
        unit[0] = round(unit[0])
    gap = due - sum(u[0] * u[2] for u in units)
    flips = sorted((u[2] * (1 - 2 * u[0]), i) for i, u in enumerate(units))
    best, chosen = abs(gap), ()
    for change, i in flips:
        if abs(gap - change) < best:
            best, chosen = abs(gap - change), (i,)
    low, high = 0, len(flips) - 1
    while low < high:
        change = flips[low][0] + flips[high][0]
        if abs(gap - change) < best:
            best, chosen = abs(gap - change), (flips[low][1], flips[high][1])
        low, high = (low + 1, high) if change < gap else (low, high - 1)
    for i in chosen:
        units[i][0] = 1 - units[i][0]


def _fly_block(level: int, seed: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "doc_id"], ascending=False, kind="stable", na_position="last")
        first = block.iloc[0]
        units = [[p, float(n), float(n * s)] for p, n, s in zip(block["p"], block["n_rows"], block["size"])]
        rng = random.Random(f"{seed} {level} {first['rank']} {first['block']}")
        if first["blocks"] == 1:
            due = sum(u[0] * u[2] for u in units)
            land(units, fly(units, rng), due)
        else:
            kept = max(2, len(units) // RESERVE)
            fly([u for i, u in enumerate(units) if i % kept], rng)
        return block.assign(p=[float(u[0]) for u in units])

    return run


def sample(units: DataFrame, block_rows: int = BLOCK_ROWS, seed: int = 17) -> DataFrame:
    """Turn the probabilities ``p`` of ``units`` (rank, doc_id, size, n_rows, p) into zeros and ones, per ``rank``."""
    done: list[DataFrame] = []
    level, names = 0, units.columns
    whole = F.col("p").isin(0.0, 1.0)
    open_units = units
    while True:
        counts = open_units.filter(~whole).groupBy("rank").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("bigint").alias("blocks"))
        blocked = open_units.filter(~whole).join(counts, "rank")
        place = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed + level)), F.col("blocks"))
        blocked = blocked.withColumn("block", place)
        schema = blocked.select(*names, "blocks", "block").schema
        flown = blocked.select(*schema.names).groupBy("rank", "block").applyInPandas(_fly_block(level, seed), schema)
        now = stage(open_units.filter(whole).select(*names).unionByName(flown.select(*names)), "flight")
        done.append(now.filter(whole))
        open_units = now.filter(~whole)
        level += 1
        if open_units.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def draw_copies(docs: DataFrame, seed: int = 17, **rules) -> DataFrame:
    """Per distinct (source, doc_id, size): n_rows, source_size, target and the number of ``copies`` of each row."""
    sized = docs.select("source", F.col("doc_id"), text_size().alias("size"))
    units = stage(sized.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("n_rows")), "units")
    spread = units.select("source", (F.col("size") * F.col("n_rows")).alias("size"))
    targets = stage(source_targets(spread, **rules), "targets")
    named = targets.withColumnRenamed("source", "_source")
    joined = units.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = joined.withColumn("base", F.floor(rate + 1e-12).cast("bigint"))
    fraction = F.greatest(rate - F.col("base"), F.lit(0.0))
    rated = stage(rated.withColumn("p", F.when(fraction < 1e-9, F.lit(0.0)).otherwise(fraction)), "rated")
    drawn = sample(rated, seed=seed)
    return drawn.withColumn("copies", F.col("base") + F.col("p").cast("bigint")).drop("base", "p", "rank")


def mix_report(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken (words the mix takes), and source, copies."""
    units = draw_copies(docs)
    rows = units.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def mix_documents(docs: DataFrame, **rules) -> DataFrame:
    """The documents of the mix with the columns of ``docs``; a document taken twice is two rows."""
    units = draw_copies(docs, **rules).filter("copies > 0")
    key, of, copy = (free_name(docs, n) for n in ("_unit", "_of", "_copy"))
    taken = units.select(F.struct(*UNIT).alias(of), F.sequence(F.lit(1).cast("bigint"), F.col("copies")).alias(copy))
    mixed = docs.withColumn(key, F.struct("source", "doc_id", text_size().alias("size"))).join(taken, F.col(key) == F.col(of))
    return mixed.withColumn(copy, F.explode(copy)).select(*docs.columns)
