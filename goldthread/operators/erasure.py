"""Deletion requests, limits, backups, cascading deletion, retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldthread.operators.dedup import top_per_key
from goldthread.operators.keys import derived_key
from goldthread.operators.merge import delete_where, update_where
from goldthread.operators.ordering import number_rows
from goldthread.operators.projection import encrypt
from goldthread.session import stage


def due_requests(requests: DataFrame, now: Column, grace: str = "grace_date", completed: DataFrame | None = None,
                 keys: Sequence[str] = (), ids: str | None = None) -> DataFrame:
    """Requests past their grace date, one row per id of the id map, without completed ones."""
    due = requests.filter(F.col(grace) <= now)
    if ids:
        due = due.select(*[c for c in due.columns if c != ids], F.explode_outer(ids).alias("entity_id", "entity_source"))
    if completed is not None:
        due = due.join(completed.select(*keys).distinct(), list(keys), "left_anti")
    return due


def rate_limit(df: DataFrame, quotas: DataFrame, group: str, unit: Sequence[str], order: Sequence[str], quota: str = "quota") -> DataFrame:
    """All rows of the first ``quota`` units (e.g. requests) per group, oldest first.

    ``quotas`` is the small table (group, quota); a null quota means no limit, a group that is not in it
    passes nothing. ``order`` are columns of the unit's first row.
    """
    open_groups = quotas.filter(F.col(quota).isNull()).select(group)
    first = df.groupBy(group, *unit).agg(F.min(F.struct(*order)).alias("_o"))
    limited = first.join(quotas.filter(F.col(quota).isNotNull()).select(group, F.col(quota).cast("bigint")), group)
    ranked = number_rows(limited, ["_o", *unit], [group], "_n")
    allowed = ranked.filter(F.col("_n") <= F.col(quota)).select(group, *unit)
    within = df.join(allowed, [group, *unit], "left_semi")
    return within.unionByName(df.join(open_groups, group, "left_semi"))


def same_members(left: DataFrame, right: DataFrame, group: Sequence[str], member: Sequence[str]) -> DataFrame:
    """Groups of ``left`` with flags: the member sets are equal; left holds all of right's; right holds all of left's.

    One aggregate says for each member on which sides it stands, a second counts per group: no group is ever collected into a set, and
    no side is sorted. A null is never a common member.
    """
    side = lambda df, l, r: df.select(*group, *member, F.lit(l).alias("_l"), F.lit(r).alias("_r"))
    both = side(left, True, False).union(side(right, False, True)).groupBy(*group, *member).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*group, *member)])
    flags = both.groupBy(*group).agg(
        F.count_if("_l").alias("left_members"), F.count_if("_r").alias("right_members"),
        F.count_if(F.col("_l") & F.col("_r") & known).alias("common_members"),
    ).filter("left_members > 0")
    return flags.select(
        *group, ((F.col("common_members") == F.col("left_members")) & (F.col("common_members") == F.col("right_members"))).alias("is_equal"),
        (F.col("common_members") == F.col("right_members")).alias("left_contains_right"),
        (F.col("common_members") == F.col("left_members")).alias("right_contains_left"),
    )


def member_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows on one side only, as ``keys, side``."""
    a = left.select(*keys).distinct().withColumn("_l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    joined = a.join(b, list(keys), "full_outer").filter("_l IS NULL OR _r IS NULL")
    return joined.select(*keys, F.when(F.col("_l"), "left").otherwise("right").alias("side"))


def key_strategy(requests: DataFrame, master: DataFrame, key: str, brand: str, scope: Sequence[str] = (), domain: str = "erased") -> DataFrame:
    """``scope, key, new_key, strategy``: a new key when brands outside the request remain, else the same key."""
    by = [*scope, key]
    asked = requests.select(*by, brand).distinct()
    held = master.select(*by, brand).distinct().join(asked.select(*by).distinct(), by, "left_semi")
    rest = held.join(asked, [*by, brand], "left_anti").select(*by).distinct().withColumn("_more", F.lit(True))
    out = asked.select(*by).distinct().join(rest, by, "left")
    split = F.col("_more").isNotNull()
    return out.select(
        *by, F.when(split, derived_key(F.col(key), domain)).otherwise(F.col(key)).alias("new_key"),
        F.when(split, "NEW").otherwise("SAME").alias("strategy"))


def blank_personal(table: DataFrame, keys: DataFrame, on: Sequence[str], personal: Sequence[str], values: Mapping[str, Column] | None = None) -> DataFrame:
    """Null the personal columns of the listed rows, and set further columns (flags, times)."""
    marks = keys.select(*on).distinct().withColumn("_hit", F.lit(True))
    joined = table.join(marks, list(on), "left")
    sets = {c: F.lit(None) for c in personal} | dict(values or {})
    return update_where(joined, F.col("_hit"), sets).select(*table.columns)


def backup_rows(table: DataFrame, keys: DataFrame, on: Sequence[str], task_id: str, now: Column, keep_days: int) -> DataFrame:
    """Copy of the rows about to change, with the task and the day the copy expires."""
    hit = table.join(keys.select(*on).distinct(), list(on), "left_semi")
    return hit.withColumns({"task_id": F.lit(task_id), "expired_date": F.date_add(now, keep_days)})


def purge_expired(backups: DataFrame, now: Column, expiry: str = "expired_date") -> DataFrame:
    return delete_where(backups, F.col(expiry) < now)


@dataclass(frozen=True)
class Cascade:
    """A table that loses rows with the deleted keys: its own columns matched to the key columns."""

    table: DataFrame
    on: Mapping[str, str]  # table column -> key column


def cascade_delete(keys: DataFrame, tables: Mapping[str, Cascade]) -> dict[str, DataFrame]:
    """Every table without the rows of the deleted keys."""
    out = {}
    for name, c in tables.items():
        gone = keys.select(*[F.col(k).alias(own) for own, k in c.on.items()]).distinct()
        out[name] = c.table.join(gone, list(c.on), "left_anti")
    return out


@dataclass(frozen=True)
class KeyLink:
    """Rows of ``child`` go with the rows of ``parent`` that they point to: child column -> parent column."""

    parent: str
    child: str
    on: Mapping[str, str]


def _parents_first(links: Sequence[KeyLink]) -> list[str]:
    ahead = {name: {k.parent for k in links if k.child == name} for k in links for name in (k.parent, k.child)}
    try:
        return list(TopologicalSorter(ahead).static_order())
    except CycleError as circle:
        raise ValueError(f"the key links go round in a circle: {circle.args[1]}") from None


def cascade_graph(tables: Mapping[str, DataFrame], links: Sequence[KeyLink], seeds: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every table without the rows that the ``seeds`` reach over the ``links``.

    ``seeds`` name the rows to delete in some tables by columns of these. Tables are taken parents first. Of the rows a table
    loses only the columns that its children point to are written, so a layer that is reached through the ids of another one needs no
    keys from the caller. A null points to nothing. Links that go round in a circle are refused.
    """
    out = dict(tables)
    lost: dict[str, list[DataFrame]] = {name: [rows.distinct()] for name, rows in seeds.items()}
    for name in [*(n for n in seeds if all(n not in (k.parent, k.child) for k in links)), *_parents_first(links)]:
        gone = lost.get(name, [])
        for keys in gone:
            out[name] = out[name].join(keys, keys.columns, "left_anti").select(*tables[name].columns)
        for link in (k for k in links if k.parent == name and gone):
            hit = reduce(DataFrame.unionByName, [tables[name].join(keys, keys.columns, "left_semi").select(*link.on.values()) for keys in gone])
            keys = stage(hit.na.drop().distinct().select(*[F.col(theirs).alias(own) for own, theirs in link.on.items()]), "gone-keys")
            lost.setdefault(link.child, []).append(keys)
    return out


def split_by_retention(table: DataFrame, ts: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to archive, rows to keep). A row without a timestamp is kept."""
    old = F.coalesce(F.col(ts) < cutoff, F.lit(False))
    return table.filter(old), table.filter(~old)


@dataclass(frozen=True)
class ArchiveRule:
    """A group of rows that leave ``table`` for the archive ``keep_days`` after ``ts``."""

    group: str
    table: DataFrame
    ts: str
    keep_days: int


def archive_run(spark: SparkSession, rules: Sequence[ArchiveRule], now: Column, folder: str, dry_run: bool = False) -> DataFrame:
    """``group, status, archived, kept, message``, one row per group.

    The rules are checked first. Per group the archive is written to ``folder/archive/<group>`` and counted before the rows that
    stay are written to ``folder/kept/<group>``, so no row is ever in neither. A group that fails is reported (FAILED) and the
    next one goes on; a dry run only counts.
    """
    twice = {r.group for r in rules if sum(o.group == r.group for o in rules) > 1}
    if twice or any(not r.group or r.keep_days < 0 for r in rules):
        raise ValueError(f"groups need different names and a retention of 0 days or more: {sorted(twice)}")
    results = []
    for rule in rules:
        try:
            old, rest = split_by_retention(rule.table, rule.ts, F.date_sub(now, rule.keep_days))
            counts = rule.table.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(rule.ts) < F.date_sub(now, rule.keep_days)).alias("old")).first()
            if not dry_run:
                old.write.mode("overwrite").parquet(f"{folder}/archive/{rule.group}")
                found = spark.read.schema(old.schema).parquet(f"{folder}/archive/{rule.group}").count()
                if found != counts["old"]:
                    raise RuntimeError(f"the archive holds {found} rows instead of {counts['old']}")
                rest.write.mode("overwrite").parquet(f"{folder}/kept/{rule.group}")
            results.append((rule.group, "DRY_RUN" if dry_run else "SUCCESS", counts["old"], counts["n"] - counts["old"], ""))
        except Exception as error:  # one group must not stop the others; the error is in its row
            results.append((rule.group, "FAILED", 0, 0, f"{type(error).__name__}: {error}"))
    return spark.createDataFrame(results, "group string, status string, archived bigint, kept bigint, message string")


def expired_keys(datasets: DataFrame, master: DataFrame, keys: Sequence[str], ts: str, cutoff: Column) -> DataFrame:
    """Keys whose latest document is older than the cutoff and that left the master."""
    latest = datasets.groupBy(*keys).agg(F.max(ts).alias("last_time")).filter(F.col("last_time") < cutoff)
    return latest.join(master.select(*keys).distinct(), list(keys), "left_anti")


def hash_and_complete(log: DataFrame, done: DataFrame, on: Sequence[str], id: str, key: Column, status: str = "status", mode: str = "GCM") -> DataFrame:
    """Encrypt the id and mark the request complete, for the processed rows."""
    marks = done.select(*on).distinct().withColumn("_hit", F.lit(True))
    joined = log.join(marks, list(on), "left")
    return update_where(joined, F.col("_hit"), {id: encrypt(F.col(id), key, mode), status: F.lit("COMPLETE")}).select(*log.columns)
