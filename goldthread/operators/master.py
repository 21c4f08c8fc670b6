"""Keeping master tables: parents, children, bindings, deletions, derived attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.operators.dedup import latest_per_key
from goldthread.operators.merge import changed, merge


def upsert_parents(
    master: DataFrame, batch: DataFrame, keys: Sequence[str], ts: str, action: str, personal: Sequence[str],
    keep: Sequence[str] = (), tie: str | None = None,
) -> DataFrame:
    """Upsert the newest row per key when it is not older. UNBIND rows do not count, DELETE blanks the
    personal columns, and ``keep`` columns (id, creation audit) stay as first written."""
    order = [F.col(ts).desc_nulls_last()] + ([F.col(tie).desc()] if tie else [])
    newest = latest_per_key(batch.filter(F.coalesce(F.col(action) != "UNBIND", F.lit(True))), keys, order)
    newest = newest.withColumns({c: F.when(F.col(action) != "DELETE", F.col(c)) for c in personal})
    update = [c for c in master.columns if c not in set(keys) | set(keep)]
    return merge(master, newest, keys, update=update,
                 update_when=lambda t, s: t[ts].isNull() | (s[ts] >= t[ts]), null_safe_keys=True)


def replace_changed_children(
    master: DataFrame, batch: DataFrame, keys: Sequence[str], compare: Sequence[str], also: Column | None = None,
    deleted: Column | None = None, blank: Sequence[str] = (), ts: str | None = None, deleted_at: str | None = None,
    unbound: DataFrame | None = None, unbound_at: str = "unbound_at",
) -> DataFrame:
    """Insert new children, and swap a child for its new row when a compared column differs (null and
    the empty text are equal).

    ``also`` (over the batch row) forces the swap, e.g. for a sibling's update flag or a listed source.
    Where the parent is ``deleted``, the ``blank`` columns become empty and ``ts`` the parent's time. ``unbound`` (keys and
    ``unbound_at``) does the same to a child that was unbound after its ``ts``; the latest unbinding of a child counts.
    """
    differs = changed(compare, blank_is_null=True)
    if deleted is not None:
        gone = F.coalesce(deleted, F.lit(False))
        sets = {c: F.when(gone, "").otherwise(F.col(c)) for c in blank}
        if ts and deleted_at:
            sets[ts] = F.when(gone, F.col(deleted_at)).otherwise(F.col(ts))
        batch = batch.withColumns(sets)
    if unbound is not None:
        last = unbound.groupBy(*keys).agg(F.max(unbound_at).alias("_unbound"))
        later = F.coalesce(F.col("_unbound") > F.col(ts), F.lit(False))
        joined = batch.join(last, list(keys), "left")
        empty = {c: F.when(later, "").otherwise(F.col(c)) for c in blank}
        batch = joined.withColumns({**empty, ts: F.when(later, F.col("_unbound")).otherwise(F.col(ts))}).select(*batch.columns)
    source = batch if also is None else batch.withColumn("_also", F.coalesce(also, F.lit(False)))
    test = differs if also is None else (lambda t, s: differs(t, s) | s["_also"])
    return merge(master, source, keys, update_when=test, null_safe_keys=True)


def replace_children(master: DataFrame, batch: DataFrame, parent: Sequence[str], parents: DataFrame | None = None) -> DataFrame:
    """All children of the parents in the batch are replaced by the batch's children.

    ``parents`` names the batch's parents when a parent may have lost all of its children.
    """
    touched = (batch if parents is None else parents).select(*parent).distinct()
    return master.join(touched, list(parent), "left_anti").unionByName(batch.select(*master.columns))


def blank_deleted_children(children: DataFrame, deletions: DataFrame, parent: Sequence[str], personal: Sequence[str], ts: str) -> DataFrame:
    """Blank the personal columns of deleted parents' children and stamp the latest deletion time."""
    last = deletions.groupBy(*parent).agg(F.max(ts).alias("_deleted"))
    joined = children.join(last, list(parent), "left")
    hit = F.col("_deleted").isNotNull()
    blank = {c: F.when(~hit, F.col(c)) for c in personal}
    return joined.withColumns({**blank, ts: F.coalesce("_deleted", ts)}).select(*children.columns)


def unbind(bindings: DataFrame, unbinds: DataFrame, value: Sequence[str], ts: str, blank: Sequence[str], owner: str) -> tuple[DataFrame, DataFrame]:
    """(bindings after unbinding, owners touched). The latest unbind per value clears every older binding."""
    last = unbinds.groupBy(*value).agg(F.max(ts).alias("_at"))
    joined = bindings.join(last, list(value), "left")
    hit = F.coalesce(F.col("_at") > F.col(ts), F.lit(False))
    after = joined.withColumns({c: F.when(~hit, F.col(c)) for c in blank}).select(*bindings.columns)
    return after, joined.filter(hit).select(owner).distinct()


def touch_sharers(contacts: DataFrame, changed_owners: DataFrame, owner: str, value: Sequence[str], *excluded: DataFrame) -> DataFrame:
    """Other owners of a contact value that a changed owner has, without excluded owners.

    Values are made distinct first; owners are not paired with each other.
    """
    values = contacts.join(changed_owners.select(owner).distinct(), owner, "left_semi").select(*value).distinct()
    sharers = contacts.join(values, list(value), "left_semi").select(owner).distinct()
    for listed in (changed_owners, *excluded):
        sharers = sharers.join(listed.select(owner).distinct(), owner, "left_anti")
    return sharers


def requeue(records: DataFrame, touched: DataFrame, keys: Sequence[str], column: str, value: Column) -> DataFrame:
    """Stamp the touched records with a new task id."""
    marks = touched.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return records.join(marks, list(keys), "left").withColumn(
        column, F.when(F.col("_hit"), value).otherwise(F.col(column))).select(*records.columns)


def expire_vanished(programs: DataFrame, current: DataFrame, keys: Sequence[str], scope: Sequence[str], end: str, at: Column) -> DataFrame:
    """End programs of owners in the batch that the batch no longer lists."""
    now = current.select(*keys).distinct().withColumn("_still", F.lit(True))
    owners = current.select(*scope).distinct().withColumn("_owner", F.lit(True))
    joined = programs.join(owners, list(scope), "left").join(now, list(keys), "left")
    gone = F.col("_owner").isNotNull() & F.col("_still").isNull()
    return joined.withColumn(end, F.when(gone, at).otherwise(F.col(end))).select(*programs.columns)


def fill_in_order(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of several sources where a later one only fills keys the earlier ones lack. One shuffle."""
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    union = reduce(DataFrame.unionByName, tagged)
    rest = [F.col(c) for c in union.columns if c not in (*keys, "_source")]
    return latest_per_key(union, keys, [F.col("_source"), *rest]).drop("_source")


def reference_master(
    master: DataFrame, stage: DataFrame, keys: Sequence[str], order: Sequence[Column], dimension: DataFrame,
    dimension_keys: Sequence[str], dimension_order: Sequence[Column], compare: Sequence[str],
) -> DataFrame:
    """Reference data: newest staged row per key, enriched from the newest dimension row, merged when changed."""
    newest = latest_per_key(stage, keys, order)
    dim = latest_per_key(dimension, dimension_keys, dimension_order)
    enriched = newest.join(dim, list(dimension_keys), "left")
    return merge(master, enriched.select(*master.columns), keys, update_when=changed(compare))


def combine_lists(parent: Sequence[str], lists: Mapping[str, DataFrame]) -> DataFrame:
    """Combinations of a parent's lists (every value of one with every value of the others)."""
    frames = [df.select(*parent, F.col(c)) for c, df in lists.items()]
    return reduce(lambda a, b: a.join(b, list(parent)), frames)
