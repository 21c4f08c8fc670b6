"""Survivorship: which record, contact, consent and attribute stands for a person."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.operators.dedup import latest_per_key
from goldthread.operators.skew import salted_join, with_group_values
from goldthread.session import stage


def priority_value(conditions: Sequence[Column | None], value: Column, pick=F.max) -> Column:
    """Aggregate: the maximum over rows that meet the first condition any row meets (None: all rows)."""
    return F.coalesce(*[pick(value if c is None else F.when(c, value)) for c in conditions])


def priority_max(df: DataFrame, keys: Sequence[str], conditions: Sequence[Column | None], value: str, name: str) -> DataFrame:
    """One row per key with the prioritised maximum of ``value``, in a single aggregation."""
    return df.groupBy(*keys).agg(priority_value(conditions, F.col(value)).alias(name))


def with_priority_max(
    df: DataFrame, keys: Sequence[str], conditions: Sequence[Column | None], value: str, name: str, spread_by: Sequence[str],
) -> DataFrame:
    """The same on every row of the group."""
    return with_group_values(df, keys, spread_by, **{name: priority_value(conditions, F.col(value))})


@dataclass(frozen=True)
class Facet:
    """Columns taken together from the record that is last (or first) in ``order`` among those that qualify."""

    name: str
    columns: tuple[str, ...]
    order: tuple[Column | str, ...]
    condition: Column | None = None
    latest: bool = True


def best_record(df: DataFrame, keys: Sequence[str], facets: Sequence[Facet], **extra: Column) -> DataFrame:
    """One row per key whose facets come from possibly different records.

    All facets and ``extra`` aggregates share one partially aggregated pass. A key without a qualifying
    record has nulls for the facet. Ties are settled by ``order``, which should end with an id.
    """
    picks = []
    for f in facets:
        order = F.struct(*f.order)
        order = order if f.condition is None else F.when(f.condition, order)
        pick = F.max_by if f.latest else F.min_by
        picks.append(pick(F.struct(*f.columns), order).alias(f"_{f.name}"))
    grouped = df.groupBy(*keys).agg(*picks, *[c.alias(n) for n, c in extra.items()])
    chosen = [F.col(f"_{f.name}.{c}").alias(f"{f.name}_{c}") for f in facets for c in f.columns]
    return grouped.select(*keys, *chosen, *extra)


def max_over_sources(sources: Sequence[tuple[DataFrame, str]], keys: Sequence[str], name: str) -> DataFrame:
    """Latest timestamp per key over several tables; each is reduced before the union."""
    parts = [df.groupBy(*keys).agg(F.max(ts).alias(name)) for df, ts in sources]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.max(name).alias(name))


def group_action(action: Column) -> Column:
    """Aggregate: DELETE only when every row of the group is deleted, else CREATE."""
    return F.when(F.count(F.when(F.coalesce(action, F.lit("")) != "DELETE", 1)) > 0, "CREATE").otherwise("DELETE")


def blank_when_mixed(
    df: DataFrame, keys: Sequence[str], member: Column, columns: Sequence[str], spread_by: Sequence[str],
) -> DataFrame:
    """In groups with both kinds of rows, null the columns of the ``member`` kind."""
    kept = df.columns
    df = with_group_values(df.withColumn("_member", F.coalesce(member, F.lit(False))), keys, spread_by,
                           _some=F.bool_or("_member"), _all=F.bool_and("_member"))
    hide = F.col("_member") & F.col("_some") & ~F.col("_all")
    return df.withColumns({c: F.when(~hide, F.col(c)) for c in columns}).select(*kept)


def drop_when_mixed(df: DataFrame, keys: Sequence[str], weak: Column, strong: Column, spread_by: Sequence[str]) -> DataFrame:
    """Drop rows of the weak kind from groups that also have a strong one."""
    kept = df.columns
    flagged = df.withColumns({"_weak": F.coalesce(weak, F.lit(False)), "_strong": F.coalesce(strong, F.lit(False))})
    flagged = with_group_values(flagged, keys, spread_by, _has=F.bool_or("_strong"))
    return flagged.filter(~(F.col("_weak") & F.col("_has"))).select(*kept)


def best_by_class(df: DataFrame, keys: Sequence[str], classes: Sequence[Column], *ties: Column) -> DataFrame:
    """One row per key from the first quality class that has one."""
    rank = F.lit(len(classes))
    for i, c in reversed(list(enumerate(classes))):
        rank = F.when(c, i).otherwise(rank)
    return latest_per_key(df, keys, [rank.asc(), *ties])


def golden_rollup(
    contributors: DataFrame, keys: Sequence[str], deleted: str, ts: str, id: str, touched: str, columns: Sequence[str],
) -> DataFrame:
    """One golden row per key: the newest live contributor and how many there are; for a key whose
    contributors are all deleted, the one touched last, marked deleted. One aggregation."""
    live = ~F.col(deleted)
    row = F.struct(F.col(id).alias("primary_id"), *columns)
    newest = F.struct(F.col(ts).isNotNull(), ts, id)
    grouped = contributors.groupBy(*keys).agg(
        F.max_by(row, F.when(live, newest)).alias("_live"),
        F.max_by(row, F.struct(touched, id)).alias("_any"),
        F.count(F.when(live, 1)).alias("contributor_count"),
    )
    return grouped.select(*keys, F.coalesce("_live", "_any").alias("_r"), "contributor_count").select(
        *keys, "_r.*", "contributor_count", (F.col("contributor_count") == 0).alias("is_deleted")
    )


def best_contact(contacts: DataFrame, keys: Sequence[str], valid: str, touched: str, id: str) -> DataFrame:
    """Best contact per key and type: valid before invalid before unknown, then newest."""
    return latest_per_key(contacts, keys, [F.col(valid).desc_nulls_last(), F.col(touched).desc(), F.col(id).desc()])


@dataclass(frozen=True)
class ContactRules:
    """Which sources count less, and which quality codes are valid."""

    weak_sources: tuple[str, ...] = ()
    valid_quality: tuple[str, ...] = ("ok",)


def campaign_override(base: DataFrame, campaign: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Quality and consent of the latest campaign, where it is not older than the row's own consent.

    ``campaign`` rows hold ``quality, optin_date, optin_flag`` for the same contact value and channel.
    """
    values = ("quality", "optin_date", "optin_flag")
    newest = campaign.filter(F.col("optin_date").isNotNull()).groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.struct("optin_date", "optin_flag", "quality")).alias("_c")
    )
    joined = base.join(newest, list(keys), "left")
    use = F.coalesce(F.col("optin_date") <= F.col("_c.optin_date"), F.lit(False))
    return joined.withColumns({c: F.when(use, F.coalesce(F.col(f"_c.{c}"), F.col(c))).otherwise(F.col(c)) for c in values}).select(*base.columns)


def contact_survivor(contacts: DataFrame, keys: Sequence[str], rules: ContactRules) -> DataFrame:
    """The surviving contact per (keys, type_code).

    Expected columns: type_code, value, source_code, is_deleted, quality, optin_date, optin_flag,
    source_timestamp, update_dt, record_id, contact_id. Consent dates decide first (per value, then per
    type), then timestamps of the rows with the deciding date, then update time and ids.
    """
    trusted = ~F.col("source_code").isin(*rules.weak_sources) if rules.weak_sources else F.lit(True)
    alive = ~F.col("is_deleted")
    valid = F.col("quality").isin(*rules.valid_quality)
    agreed = F.col("optin_flag") == 1
    by_type = [*keys, "type_code"]
    # In falling strictness; every row meets the last condition.
    value_levels = [trusted & alive, trusted, alive, F.lit(True)]
    type_levels = [trusted & valid & agreed, trusted & valid, trusted & agreed, trusted, valid & agreed, valid, agreed, F.lit(True)]
    time_levels = [trusted & alive & valid, trusted & alive, alive & valid, alive, F.lit(True)]

    def some(prefix: str, levels: Sequence[Column]) -> list[Column]:
        return [F.bool_or(F.coalesce(c, F.lit(False))).alias(f"{prefix}{i}") for i, c in enumerate(levels)]

    def first_level(prefix: str, n: int, value: Column) -> Column:
        return F.coalesce(*[F.max(F.when(F.col(f"{prefix}{i}"), value)) for i in range(n)])

    times = [F.max(F.when(c, F.col("source_timestamp"))).alias(f"t{i}") for i, c in enumerate(time_levels)]
    ts = F.max("source_timestamp").alias("ts")
    # Rows with the same value and date are interchangeable for the dates, so they are merged first.
    dates = contacts.groupBy(*by_type, "value", "optin_date").agg(*some("v", value_levels), *some("k", type_levels), *times, ts)
    dates = stage(dates, "dates")  # read by both ways to decide, which no longer see the contacts
    flags = [f"k{i}" for i in range(len(type_levels))]
    dated = dates.filter(F.col("optin_date").isNotNull())
    per_value = dated.groupBy(*by_type, "value").agg(
        first_level("v", len(value_levels), F.struct("optin_date", *flags, "ts")).alias("d"))
    per_date = per_value.select(*by_type, "d.*").groupBy(*by_type, "optin_date").agg(*[F.bool_or(f).alias(f) for f in flags], F.max("ts").alias("ts"))
    decided = per_date.groupBy(*by_type).agg(first_level("k", len(flags), F.struct("optin_date", "ts")).alias("d"))
    fallback = dates.groupBy(*by_type).agg(F.coalesce(*[F.max(f"t{i}") for i in range(len(time_levels))]).alias("_by_time"))
    chosen = fallback.select(F.struct(*by_type).alias("_k"), "_by_time").join(
        decided.select(F.struct(*by_type).alias("_k"), F.col("d.ts").alias("_by_date")), "_k", "left"
    )
    chosen = stage(chosen.select("_k", F.coalesce("_by_date", "_by_time").alias("_ts")), "chosen")
    # The best row of every timestamp, then the best of those.
    rest = [c for c in contacts.columns if c not in by_type]
    order = ("update_dt", "record_id", "contact_id")
    per_time = contacts.groupBy(F.struct(*by_type).alias("_k"), F.col("source_timestamp").alias("_at")).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    per_time = stage(per_time, "per-time")
    joined = salted_join(per_time, chosen, ["_k"], ["_at"])
    hit = F.coalesce(F.col("_at") == F.col("_ts"), F.lit(False))
    picked = joined.groupBy("_k").agg(F.max_by("_r", F.struct(hit, *[f"_r.{c}" for c in order])).alias("_r"))
    return picked.select("_k.*", "_r.*").select(*contacts.columns)


def merge_consents(derived: DataFrame, own: DataFrame, keys: Sequence[str], date: str, *ties: str) -> DataFrame:
    """Consents derived from surviving contacts win; the record's own ones fill in missing channels."""
    tagged = derived.select("*", F.lit(1).alias("_from")).unionByName(own.select("*", F.lit(0).alias("_from")))
    order = [F.col("_from").desc(), F.col(date).desc(), *[F.col(c).desc() for c in ties]]
    return latest_per_key(tagged, keys, order).drop("_from")


def merge_attributes(
    attributes: DataFrame, keys: Sequence[str], name: str, value: str, ts: str, take_max: Sequence[str],
    flags: Mapping[str, Column] | None = None, groups: DataFrame | None = None,
) -> DataFrame:
    """One value per key and attribute name: the largest for ``take_max`` names, else the newest;
    derived flags of ``groups`` are added as further name/value rows."""
    largest = F.col(name).isin(*take_max)
    picked = attributes.groupBy(*keys, name).agg(
        F.max(F.when(largest, F.col(value))).alias("_max"), F.max_by(value, F.struct(ts, value)).alias("_new")
    ).select(*keys, name, F.when(largest, F.col("_max")).otherwise(F.col("_new")).alias(value))
    if flags and groups is not None:
        rows = F.array(*[F.struct(F.lit(n).alias(name), c.cast("string").alias(value)) for n, c in flags.items()])
        extra = groups.select(*keys, F.explode(rows).alias("_f")).select(*keys, "_f.*").filter(F.col(value).isNotNull())
        picked = picked.unionByName(extra)
    return picked


def touched_scope(
    records: DataFrame, touched: DataFrame, keys: Sequence[str], max_rows: int, excluded: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(records of the touched keys without excluded keys and without keys of more than ``max_rows`` records; the keys left out for
    their size, with ``rows``)."""
    scoped = records.join(touched.select(*keys).distinct(), list(keys), "left_semi")
    if excluded is not None:
        scoped = scoped.join(excluded.select(*keys).distinct(), list(keys), "left_anti")
    large = stage(oversized_keys(scoped, keys, max_rows), "oversized")
    return scoped.join(large.select(*keys), list(keys), "left_anti"), large


def oversized_keys(records: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    return records.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > max_rows)
