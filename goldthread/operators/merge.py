"""Table mutation as DataFrame rewrites: merge, guarded upserts, deletes, schema alignment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from goldthread.operators.dedup import latest_per_key
from goldthread.operators.skew import null_safe
from goldthread.session import fits_broadcast, stage

Row = Column  # a struct column; ``row["name"]`` is a field
Test = Callable[[Row, Row], Column]  # (target row, source row) -> condition


class DuplicateKeys(ValueError):
    """The source of a merge has more than one row for a key."""


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` when every key occurs once, else raise (one partially aggregated pass)."""
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(5).collect()
    if twice:
        raise DuplicateKeys(f"several source rows for one key: {[tuple(r)[:-1] for r in twice]}")
    return df


def _equal(keys: Sequence[str], safe: bool) -> Column:
    if safe:
        return null_safe("_t", "_s", keys)
    return reduce(lambda a, b: a & b, [F.col(f"_t.{k}") == F.col(f"_s.{k}") for k in keys])


def changed(columns: Sequence[str], blank_is_null: bool = False) -> Test:
    """Any of ``columns`` differs, null-safely; optionally with the empty text equal to null."""
    def value(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("")) if blank_is_null else c

    return lambda t, s: reduce(lambda a, b: a | b, [~value(t[c]).eqNullSafe(value(s[c])) for c in columns])


def newer(ts: str, strict: bool = True) -> Test:
    """Source is newer than the target, or the target has no timestamp."""
    return lambda t, s: t[ts].isNull() | ((s[ts] > t[ts]) if strict else (s[ts] >= t[ts]))


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    update_when: Test | None = None,
    update: Sequence[str] | Mapping[str, Callable[[Row, Row], Column]] | None = None,
    update_rows: bool = True,
    insert: bool = True,
    insert_when: Callable[[Row], Column] | None = None,
    delete_when: Test | None = None,
    null_safe_keys: bool = False,
) -> DataFrame:
    """The target after merging ``source`` into it. A source with two rows for a key is refused (``DuplicateKeys``).

    The source is written once, then checked and joined from there. ``update`` names the columns taken from the source (all common ones by default) or maps a column
    to an expression of both rows. A source within the broadcast limit is joined to the target without
    moving the target (one scan, and one of the key columns); a larger one costs one full outer join.
    """
    sets = _assignments(target, source, update)
    match = _equal(keys, null_safe_keys)
    source = stage(source, "merge-source")  # read several times below, and its real size replaces the estimate
    check_unique(source if null_safe_keys else source.na.drop(subset=list(keys)), keys)
    small = fits_broadcast(source, expansion=4)
    t = target.select(F.struct(*target.columns).alias("_t"))
    s = source.select(F.struct(*source.columns).alias("_s"))
    if small:
        hit = F.broadcast(target.select(*keys).select(F.struct(*keys).alias("_t")).join(
            F.broadcast(source.select(F.struct(*keys).alias("_s"))), match, "left_semi").distinct())
        fresh = s.join(hit, match, "left_anti").select(F.lit(None).cast(t.schema["_t"].dataType).alias("_t"), "_s")
        joined = t.join(F.broadcast(s), match, "left").unionByName(fresh)
    else:
        joined = t.join(s, match, "full_outer")
    rows_t, rows_s = F.col("_t"), F.col("_s")
    both = rows_t.isNotNull() & rows_s.isNotNull()
    if not insert:
        joined = joined.filter(rows_t.isNotNull())
    elif insert_when is not None:
        joined = joined.filter(rows_t.isNotNull() | insert_when(rows_s))
    if delete_when is not None:
        joined = joined.filter(~F.coalesce(both & delete_when(rows_t, rows_s), F.lit(False)))
    apply = (both & F.coalesce(update_when(rows_t, rows_s), F.lit(False))) if update_when else both
    if not update_rows:
        apply = F.lit(False)
    source_names = set(source.columns)
    out = []
    for c in target.columns:
        fresh_value = rows_s[c] if c in source_names else F.lit(None)
        value = F.when(apply, sets[c](rows_t, rows_s)).otherwise(rows_t[c]) if c in sets else rows_t[c]
        out.append(F.when(rows_t.isNull(), fresh_value).otherwise(value).alias(c))
    return joined.select(*out)


def _assignments(target: DataFrame, source: DataFrame, update) -> dict[str, Callable[[Row, Row], Column]]:
    if isinstance(update, Mapping):
        return dict(update)
    names = update if update is not None else [c for c in target.columns if c in set(source.columns)]
    return {c: (lambda t, s, c=c: s[c]) for c in names}


def upsert_newer(target: DataFrame, source: DataFrame, keys: Sequence[str], ts: str, strict: bool = True) -> DataFrame:
    """Insert new keys; replace a row only with a newer one (late rows do not win)."""
    return merge(target, source, keys, update_when=newer(ts, strict), null_safe_keys=True)


def route_actions(
    target: DataFrame, source: DataFrame, keys: Sequence[str], ts: str, action: str, personal: Sequence[str],
    deleted_flag: str = "is_deleted",
) -> DataFrame:
    """CREATE/CHANGE insert or replace an older row; DELETE blanks the personal columns at any time.

    A DELETE for an unknown key does nothing. ``source`` has one row per key (``latest_action``).
    """
    source = source.withColumn(deleted_flag, F.lit(False))
    older = newer(ts)

    def assign(c: str):
        if c == deleted_flag:
            return lambda t, s: s[action] == "DELETE"
        if c == action:
            return lambda t, s: s[action]
        if c in personal:
            return lambda t, s: F.when(s[action] != "DELETE", s[c])
        return lambda t, s: F.when(s[action] == "DELETE", t[c]).otherwise(s[c])

    return merge(
        target, source, keys,
        update_when=lambda t, s: (s[action] == "DELETE") | older(t, s),
        update={c: assign(c) for c in target.columns if c not in keys},
        insert_when=lambda s: s[action] != "DELETE",
        null_safe_keys=True,
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Rows of ``source`` whose key the target lacks, one per key: what an insert-only merge appends.

    Of several rows for a key the first in ``order`` wins, then the smallest by all columns, so every run inserts the same.
    Nulls in keys are values, so a second run inserts nothing.
    """
    fresh = latest_per_key(source, keys, [*order, *[F.col(c).asc() for c in source.columns]])
    return fresh.alias("s").join(target.select(*keys).alias("t"), null_safe("s", "t", keys), "left_anti").select(*source.columns)


def delete_keys(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the listed keys."""
    return target.join(gone.select(*keys).distinct(), list(keys), "left_anti")


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Target without the rows for which ``condition`` is true (rows where it is null stay)."""
    return target.filter(~F.coalesce(condition, F.lit(False)))


def update_where(target: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return target.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def replace_slice(target: DataFrame, fresh: DataFrame, condition: Column) -> DataFrame:
    """Target with the rows that meet ``condition`` replaced by ``fresh``; running it twice changes nothing."""
    return delete_where(target, condition).unionByName(fresh.select(*target.columns))


def merge_two_keys(
    target: DataFrame, first: DataFrame, first_keys: Sequence[str], second: DataFrame, second_keys: Sequence[str],
    column: str,
) -> DataFrame:
    """Update ``column`` from two sources with different keys (first wins): two equi-joins, no OR join.

    Equal rows of a source count once; two values for a key are refused (``DuplicateKeys``).
    """
    joined = target
    for source, keys, name in ((first, first_keys, "_a"), (second, second_keys, "_b")):
        once = stage(source.select(*keys, F.col(column).alias(name)).na.drop(subset=list(keys)).distinct(), "merge-source")
        joined = joined.join(check_unique(once, keys), list(keys), "left")
    return joined.withColumn(column, F.coalesce("_a", "_b", column)).select(*target.columns)


def align_schema(df: DataFrame, schema: StructType, fill_missing: bool = True) -> DataFrame:
    """Columns of ``schema`` in its order, matched without regard to case and cast; unknown ones dropped."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in schema:
        name = have.get(field.name.lower())
        if name is not None:
            out.append(F.col(name).try_cast(field.dataType).alias(field.name))
        elif fill_missing:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*out)


def cast_losses(df: DataFrame, schema: StructType) -> DataFrame:
    """``column_name, filled, lost``: values that ``align_schema`` turns into null because they cannot be cast."""
    have = {c.lower(): c for c in df.columns}
    fields = [(f, have[f.name.lower()]) for f in schema if f.name.lower() in have]
    sums = [(F.count(c), F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(f.dataType).isNull())) for f, c in fields]
    row = df.agg(*[x.alias(f"{k}{i}") for i, (n, lost) in enumerate(sums) for k, x in (("n", n), ("l", lost))])
    each = [F.struct(F.lit(f.name).alias("column_name"), F.col(f"n{i}").alias("filled"), F.col(f"l{i}").alias("lost")) for i, (f, _) in enumerate(fields)]
    return row.select(F.inline(F.array(*each)))


def schema_report(df: DataFrame, schema: StructType) -> DataFrame:
    """One row per column: on both sides, only in the source, only in the target, or of another type."""
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    want = {f.name.lower(): f.dataType.simpleString() for f in schema}
    rows = []
    for name in sorted(have.keys() | want.keys()):
        s, t = have.get(name), want.get(name)
        status = "extra" if t is None else "missing" if s is None else "same" if s == t else "type_differs"
        rows.append((name, s, t, status))
    return df.sparkSession.createDataFrame(rows, "column_name string, source_type string, target_type string, status string")


def append_evolving(target: DataFrame, fresh: DataFrame) -> DataFrame:
    """Append with the target's types; columns new in ``fresh`` are added and null in the old rows."""
    known = {c.lower() for c in target.columns}
    extra = [c for c in fresh.columns if c.lower() not in known]
    aligned = align_schema(fresh, StructType(list(target.schema) + [fresh.schema[c] for c in extra]))
    return target.unionByName(aligned, allowMissingColumns=True)
