"""From components to stable keys: assignment, conflicts, attaching, rebinding, re-keying, splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.operators.asof import as_of_join
from goldthread.operators.dedup import latest_per_key
from goldthread.operators.merge import check_unique
from goldthread.operators.skew import group_values, join_groups, salted_join
from goldthread.session import stage

HISTORY_ID_LENGTH = 36  # ids shorter than a uuid come from the first load and are the oldest


def derived_key(root: Column, domain: str = "") -> Column:
    """A key that depends only on the component: a recomputation gives the same one."""
    return F.sha2(F.concat_ws("|", F.lit(domain), root.cast("string")), 256)


def earliest_first(id: str, created: str) -> list[Column]:
    """First-load records before all others, then by creation time and id."""
    history = F.length(F.col(id).cast("string")) < HISTORY_ID_LENGTH
    return [F.when(history, 0).otherwise(1), F.when(~history, F.col(created)), F.col(id)]


def assign_keys(
    members: DataFrame, known: DataFrame, key: str, order: Sequence[Column | str], domain: str = "", node: str = "node",
) -> DataFrame:
    """``node, root, group_key, is_new``: the first known key of the component, else a derived one.

    ``members`` has ``node, root``; ``known`` has ``node``, ``key`` and the columns of ``order`` for the
    records that already carry a key.
    """
    carried = members.join(known.select(node, F.struct(*order).alias("_order"), F.col(key).alias("_key")), node, "left")
    first = carried.groupBy("root").agg(
        F.min_by("_key", F.when(F.col("_key").isNotNull(), F.col("_order"))).alias("_known"), F.count(F.lit(1)).alias("_rows"))
    joined = join_groups(members, first, ["root"], [node])
    return joined.select(
        node, "root", F.coalesce("_known", derived_key(F.col("root"), domain)).alias("group_key"),
        F.col("_known").isNull().alias("is_new"),
    )


def final_assignment(assigned: DataFrame, best: DataFrame, node: str = "node") -> DataFrame:
    """Add the best rule and its score; a record no rule matched is labelled NEW with full score."""
    joined = assigned.join(best.withColumnRenamed("id", node), node, "left")
    return joined.withColumn("match_type", F.coalesce("match_type", F.lit("NEW"))).withColumn(
        "confidence_score", F.coalesce("confidence_score", F.lit(100.0))
    )


def flag_conflicts(df: DataFrame, new_key: str, checks: Mapping[str, Sequence[str]], spread_by: Sequence[str]) -> DataFrame:
    """One boolean per check: the same old key (or business id) has several new keys."""
    out = df
    for flag, keys in checks.items():
        groups = group_values(df, keys, _low=F.min(new_key), _high=F.max(new_key))
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        out = join_groups(out.withColumn("_k", F.struct(*keys)), groups, ["_k"], spread_by)
        out = out.withColumn(flag, F.coalesce(complete & (F.col("_low") != F.col("_high")), F.lit(False))).drop("_k", "_low", "_high")
    return out


def quarantine(df: DataFrame, flags: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined) rows."""
    bad = F.lit(False)
    for f in flags:
        bad = bad | F.col(f)
    return df.filter(~bad), df.filter(bad)


def mark_excluded(records: DataFrame, bad: DataFrame, keys: Sequence[str], reason: str) -> DataFrame:
    """Set ``is_include`` to false and the reason on the quarantined records."""
    marks = bad.select(*keys).distinct().withColumn("_bad", F.lit(True))
    joined = records.join(marks, list(keys), "left")
    hit = F.col("_bad").isNotNull()
    return joined.withColumn("is_include", ~hit & F.col("is_include")).withColumn(
        "exclude_type", F.when(hit, reason).otherwise(F.col("exclude_type"))
    ).select(*records.columns)


def attach_by_lookup(
    records: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], Sequence[Column]]], value: str,
    name: str = "attached_key",
) -> DataFrame:
    """Take ``value`` from the first lookup that knows the record, trying them in order.

    Each lookup is ``(table, keys, order)``; of several rows for its keys the first in ``order`` counts.
    """
    out = records
    found = []
    for i, (table, keys, order) in enumerate(lookups):
        one = latest_per_key(table.filter(F.col(value).isNotNull()), keys, order).select(*keys, F.col(value).alias(f"_v{i}"))
        out = out.join(one, list(keys), "left")
        found.append(f"_v{i}")
    return out.withColumn(name, F.coalesce(*found)).drop(*found)


def final_keys(moves: DataFrame, run: str = "run", max_rounds: int = 64) -> DataFrame:
    """``old_key, new_key`` over several runs of re-keying: where a key that stood before the first run is after the last one.

    ``moves`` has ``run, old_key, new_key``. One run is a simultaneous map; only a later run moves a key on. A to B in run 1 and B to C in run 2
    take A to C; in the other order A ends at B, and a swap stays a swap. Two moves of a key in one run are refused. A move is followed
    by the first later move of its new key (an as-of join); the chain's length is bounded by the runs, and each round doubles the steps.
    """
    given = stage(moves.select(F.col(run).alias("run"), "old_key", "new_key").distinct(), "moves")
    check_unique(given, ["run", "old_key"])
    onward = given.select(F.col("old_key").alias("key"), F.col("run").alias("_at"), F.struct("run", "old_key").alias("_move"))
    linked = as_of_join(given.withColumn("key", F.col("new_key")), onward, ["key"], "run", "_at", {"next": "_move"}, strict=True, forward=True)
    now = stage(linked.select(F.struct("run", "old_key").alias("move"), "next", "new_key"), "moves")
    for _ in range(max_rounds):
        if now.filter("next IS NOT NULL").isEmpty():
            first = now.groupBy("move.old_key").agg(F.min_by("new_key", "move.run").alias("new_key"))
            return first.select("old_key", "new_key")
        ahead = now.select(F.col("move").alias("next"), F.col("next").alias("_next"), F.col("new_key").alias("_key"))
        step = salted_join(now, ahead, ["next"], ["move"], "left")
        now = stage(step.select("move", F.col("_next").alias("next"), F.coalesce("_key", "new_key").alias("new_key")), "moves")
    raise ValueError(f"the moves are not followed to their end after {max_rounds} rounds")


def repoint(df: DataFrame, key: str, key_map: DataFrame) -> DataFrame:
    """Replace ``key`` by its successor, one step: ``key_map`` (``old_key, new_key``) is what one run of re-keying did, all at once.

    A to B and B to A is a swap. Two successors of one key are refused. For several runs give ``final_keys`` of their moves. A
    key with very many rows is cut.
    """
    step = stage(key_map.select(F.col("old_key").alias(key), F.col("new_key").alias("_new")).distinct(), "key-map")
    check_unique(step, [key])
    return salted_join(df, step, [key], df.columns, "left").withColumn(key, F.coalesce("_new", key)).select(*df.columns)


def key_changes(assigned: DataFrame, old: str, new: str, order: Sequence[Column]) -> DataFrame:
    """``old_key -> new_key`` for records whose key changed, one row per old key."""
    moved = assigned.filter(F.col(old).isNotNull() & (F.col(old) != F.col(new)))
    return latest_per_key(moved, [old], order).select(F.col(old).alias("old_key"), F.col(new).alias("new_key"))


def rebind_orphans(orphans: DataFrame, owners: DataFrame, on: Sequence[str], key: str, order: Sequence[Column]) -> DataFrame:
    """Give rows without a key the key of the newest owner seen with the same contact."""
    lost = orphans.filter(F.col(key).isNull() | (F.trim(key) == "")).drop(key)
    newest = latest_per_key(owners.filter(F.col(key).isNotNull()), on, order).select(*on, key)
    return lost.join(newest, list(on))


def check_no_empty(df: DataFrame, column: str) -> DataFrame:
    """Raise when a row has no value: re-keying must not lose keys."""
    if not df.filter(F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")).isEmpty():
        raise ValueError(f"rows without {column}")
    return df


def correct_keys(table: DataFrame, corrections: DataFrame, keys: Sequence[str], key: str) -> tuple[DataFrame, DataFrame]:
    """(corrected table, corrections not applied). Equal corrections count once.

    The second result has ``keys``, ``key`` and ``reason``: ``blank`` when a field is empty, ``clash`` when the same row is
    to get several keys (none of them is applied), ``unmatched`` when the table has no such row.
    """
    filled = [F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") for c in (*keys, key)]
    given = corrections.select(*keys, key).distinct().withColumn("_blank", ~reduce(lambda a, b: a & b, filled))
    full = given.filter(~F.col("_blank")).drop("_blank")
    clashing = full.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    once = full.join(clashing, list(keys), "left_anti").select(*keys, F.col(key).alias("_to"))
    fixed = table.join(once, list(keys), "left").withColumn(key, F.coalesce("_to", key)).select(*table.columns)
    unmatched = once.join(table.select(*keys).distinct(), list(keys), "left_anti").withColumnRenamed("_to", key)
    refused = (
        given.filter("_blank").drop("_blank").withColumn("reason", F.lit("blank"))
        .unionByName(full.join(clashing, list(keys), "left_semi").withColumn("reason", F.lit("clash")))
        .unionByName(unmatched.withColumn("reason", F.lit("unmatched")))
    )
    return fixed, refused


def membership_mapping(
    current: DataFrame, previous: DataFrame, deleted: DataFrame, owner: Sequence[str], program: Sequence[str],
) -> DataFrame:
    """Mapping rows to send: current programs, programs that vanished from a touched owner, and all
    programs of deleted owners. Vanished is decided per owner, not per market."""
    columns = [*owner, *program]
    gone_owner = deleted.select(*owner).distinct()
    now = current.select(*columns).distinct().join(gone_owner, list(owner), "left_anti")
    touched = previous.select(*columns).distinct().join(current.select(*owner).distinct(), list(owner), "left_semi")
    vanished = touched.join(now, columns, "left_anti").join(gone_owner, list(owner), "left_anti")
    removed = previous.select(*columns).distinct().join(gone_owner, list(owner), "left_semi")
    return (
        now.withColumn("mapping_action", F.lit("CREATE"))
        .unionByName(vanished.withColumn("mapping_action", F.lit("DELETE")))
        .unionByName(removed.withColumn("mapping_action", F.lit("DELETE")))
    )


def reemit_touched(transactions: DataFrame, touched: DataFrame, keys: Sequence[str], body: Column, name: str = "document") -> DataFrame:
    """Documents of the transactions whose mapping changed."""
    return transactions.join(touched.select(*keys).distinct(), list(keys), "left_semi").withColumn(name, body)
