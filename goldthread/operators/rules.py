"""Match rules as data, compiled to equi-joins.

An exact rule is an equivalence on its key, so every record is linked to the smallest id of its block
instead of to every other record: n - 1 links where a self join gives n * (n - 1) / 2, with the same
components. Fuzzy rules link distinct names (``similar``), never all records of a block.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.functions import text as tx
from goldthread.operators.similar import edit_similar, jaro_candidates, weighted_name_score
from goldthread.operators.skew import join_groups
from goldthread.session import stage

LINK_COLUMNS = ["id", "anchor", "rule", "priority", "score", "similarity", "review"]


@dataclass(frozen=True)
class ExactRule:
    """Records with the same key match; a record with a null part does not take part."""

    name: str
    key: tuple[Column, ...]
    priority: int = 1
    score: float = 100.0
    review: bool = False


@dataclass(frozen=True)
class EditRule:
    """Records of a block match when the edit similarity of ``text`` reaches the threshold."""

    name: str
    block: tuple[Column, ...]
    text: Column
    threshold: float = 0.85
    priority: int = 1
    review: bool = False


@dataclass(frozen=True)
class NameRule:
    """Weighted Jaro-Winkler score of first and last name (either order) or of one full name, per block."""

    name: str
    block: tuple[Column, ...]
    names: tuple[Column, ...]
    weights: tuple[float, ...]
    contact_weight: float
    threshold: float = 0.85
    priority: int = 1
    review: bool = False


Rule = ExactRule | EditRule | NameRule


def rules_from_config(rows: Iterable[Mapping], market: str = "market_code", first: str = "first_name_match_key",
                      last: str = "last_name_match_key", full: str = "full_name_match_key") -> list[Rule]:
    """Rules from configuration rows (enabled ones, in priority order).

    Categories: ``deterministic`` (two equal fields), ``name_key`` (first and last name in either order
    plus a contact) and ``full_name_key`` (full name or its reversed tokens plus a contact); mode
    ``EXACT`` or ``FUZZY``. A rule whose full score misses its own threshold can never match.
    """
    out: list[Rule] = []
    for row in sorted((r for r in rows if r["enabled"]), key=lambda r: r["priority"]):
        common = {"name": row["match_type"], "priority": row["priority"], "review": bool(row["requires_review"])}
        weights = [w or 0 for w in (row["weight_component_a"], row["weight_component_b"], row["weight_contact"])]
        score = float(sum(weights))
        if score / 100.0 < row["threshold"]:
            continue
        category = row["match_category"]
        if category == "deterministic":
            key = (F.col(row["deterministic_field_a"]), F.col(row["deterministic_field_b"]))
            out.append(ExactRule(key=key, score=score, **common))
            continue
        block = (F.col(market), F.col(row["secondary_key"]))
        names = (F.col(first), F.col(last)) if category == "name_key" else (F.col(full),)
        if (row["comparison_mode"] or "EXACT").upper() == "EXACT":
            either = names if len(names) == 2 else (names[0], tx.reverse_tokens(names[0]))
            known = reduce(lambda a, b: a & b, [n.isNotNull() for n in names])
            pair = (F.when(known, F.least(*either)), F.when(known, F.greatest(*either)))
            out.append(ExactRule(key=(*block, *pair), score=score, **common))
        else:
            out.append(NameRule(
                block=block, names=names, weights=tuple(weights[: len(names)]), contact_weight=weights[2],
                threshold=row["threshold"], **common,
            ))
    return out


def _key(parts: Sequence[Column]) -> Column:
    """Array of the parts as text, null when a part is null."""
    known = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(known, F.array(*[p.cast("string") for p in parts]))


def exact_links(records: DataFrame, rules: Sequence[ExactRule], id: str = "id", batch: str | None = None) -> DataFrame:
    """Links of all exact rules in one pass: one aggregate per (rule, key) and one join back.

    With ``batch`` (a boolean column) blocks without a batch record are left out, as nothing new can
    match there. An id with several rows may be linked several times.
    """
    is_new = F.col(batch) if batch else F.lit(True)
    entries = F.filter(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), _key(r.key).alias("key")) for r in rules]),
        lambda e: e["key"].isNotNull(),
    )
    keyed = records.select(F.col(id).alias("id"), is_new.alias("_new"), F.explode(entries).alias("_e"))
    keyed = keyed.select("id", "_new", "_e.rule", "_e.key")
    blocks = keyed.groupBy("rule", "key").agg(
        F.min("id").alias("anchor"), F.max("id").alias("_last"), F.bool_or("_new").alias("_any"),
        F.count(F.lit(1)).alias("_rows"),
    ).filter("anchor < _last AND _any")
    joined = join_groups(keyed.drop("_new"), blocks.select("rule", "key", "anchor", "_rows"), ["rule", "key"], ["id"])
    info = {r.name: r for r in rules}

    def attribute(get) -> Column:
        return F.create_map(*[F.lit(x) for n, r in info.items() for x in (n, get(r))])[F.col("rule")]

    return joined.select(
        "id", "anchor", "rule",
        attribute(lambda r: r.priority).alias("priority"), attribute(lambda r: r.score).alias("score"),
        F.lit(1.0).alias("similarity"), attribute(lambda r: r.review).alias("review"),
    )


def _named_groups(records: DataFrame, id: str, batch: str | None, block: Column, names: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """Records with their block and names, and the distinct names of each block with a representative id."""
    is_new = F.col(batch) if batch else F.lit(True)
    cols = [n.alias(f"n{i}") for i, n in enumerate(names)]
    keyed = records.select(F.col(id).alias("id"), is_new.alias("_new"), block.alias("block"), *cols)
    keyed = keyed.filter(reduce(lambda a, b: a & b, [F.col(f"n{i}").isNotNull() for i in range(len(names))]))
    keyed = keyed.filter("block IS NOT NULL")
    by = ["block", *[f"n{i}" for i in range(len(names))]]
    groups = keyed.groupBy(*by).agg(
        F.min("id").alias("anchor"), F.max("id").alias("_last"), F.bool_or("_new").alias("_any"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return keyed, stage(groups, "names")  # read several times by the callers


def _same_name_links(keyed: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    several = groups.filter("anchor < _last AND _any")
    return join_groups(keyed.drop("_new"), several.select(*by, "anchor", "_rows"), by, ["id"]).select("id", "anchor")


def _finish(df: DataFrame, rule: EditRule | NameRule) -> DataFrame:
    return df.withColumns({
        "rule": F.lit(rule.name), "priority": F.lit(rule.priority), "review": F.lit(rule.review),
    }).select(*LINK_COLUMNS).distinct()


def _both_ways(pairs: DataFrame) -> DataFrame:
    """A pair as two links, so that each end knows the rule that matched it."""
    return pairs.select(
        F.explode(F.array(
            F.struct(F.col("x").alias("id"), F.col("y").alias("anchor")),
            F.struct(F.col("y").alias("id"), F.col("x").alias("anchor")),
        )).alias("_p"), "score", "similarity",
    ).select("_p.*", "score", "similarity")


def edit_links(records: DataFrame, rule: EditRule, id: str = "id", batch: str | None = None) -> DataFrame:
    keyed, groups = _named_groups(records, id, batch, _key(rule.block), [rule.text])
    same = _same_name_links(keyed, groups, ["block", "n0"]).withColumns({"score": F.lit(100.0), "similarity": F.lit(1.0)})
    pairs = edit_similar(groups.select("block", F.col("n0").alias("text")), rule.threshold)
    ends = groups.select("block", "n0", "anchor", "_any")
    found = (
        pairs.join(ends.select("block", F.col("n0").alias("a"), F.col("anchor").alias("x"), F.col("_any").alias("_xa")), ["block", "a"])
        .join(ends.select("block", F.col("n0").alias("b"), F.col("anchor").alias("y"), F.col("_any").alias("_ya")), ["block", "b"])
        .filter("_xa OR _ya")
        .withColumn("score", F.lit(100.0))
    )
    return _finish(same.unionByName(_both_ways(found)), rule)


def name_links(records: DataFrame, rule: NameRule, id: str = "id", batch: str | None = None) -> DataFrame:
    keyed, groups = _named_groups(records, id, batch, _key(rule.block), rule.names)
    by = ["block", *[f"n{i}" for i in range(len(rule.names))]]
    full = float(sum(rule.weights) + rule.contact_weight)
    same = _same_name_links(keyed, groups, by).withColumns({"score": F.lit(full), "similarity": F.lit(1.0)})
    if len(rule.names) == 1:
        groups = groups.withColumn("n1", tx.reverse_tokens(F.col("n0")))
    floor = (100.0 * rule.threshold - rule.contact_weight) / sum(rule.weights)
    texts = groups.select("block", F.col("anchor").alias("id"), F.explode(F.array("n0", "n1")).alias("text"))
    pairs = jaro_candidates(texts, floor)
    a = groups.select("block", F.col("anchor").alias("id_a"), F.col("n0").alias("a0"), F.col("n1").alias("a1"), F.col("_any").alias("_xa"))
    b = groups.select("block", F.col("anchor").alias("id_b"), F.col("n0").alias("b0"), F.col("n1").alias("b1"), F.col("_any").alias("_ya"))
    named = pairs.join(a, ["block", "id_a"]).join(b, ["block", "id_b"]).filter("_xa OR _ya")
    left = ("a0", "a1")[: len(rule.names)]
    scored = weighted_name_score(named, left, ("b0", "b1"), rule.weights)
    found = scored.withColumn("score", F.col("name_score") + F.lit(float(rule.contact_weight))).filter(
        F.col("score") / 100.0 >= rule.threshold
    ).withColumnsRenamed({"id_a": "x", "id_b": "y"})
    return _finish(same.unionByName(_both_ways(found)), rule)


def match_links(records: DataFrame, rules: Sequence[Rule], id: str = "id", batch: str | None = None) -> DataFrame:
    """Links of all rules: ``id`` matched ``anchor`` by ``rule``. An anchor is linked to itself."""
    parts = []
    exact = [r for r in rules if isinstance(r, ExactRule)]
    if exact:
        parts.append(exact_links(records, exact, id, batch))
    for rule in rules:
        if isinstance(rule, EditRule):
            parts.append(edit_links(records, rule, id, batch))
        elif isinstance(rule, NameRule):
            parts.append(name_links(records, rule, id, batch))
    return reduce(DataFrame.unionByName, parts)


def auto_edges(links: DataFrame) -> DataFrame:
    """Edges for grouping: links that need no review. They may repeat; the components step makes them distinct."""
    return links.filter(~F.col("review") & (F.col("id") != F.col("anchor"))).select(
        F.col("id").alias("src"), F.col("anchor").alias("dst")
    )


def edge_labels(links: DataFrame) -> DataFrame:
    """Rules per (id, anchor) as one comma list; the rule set is small, so the list is."""
    return links.groupBy("id", "anchor").agg(
        F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("match_types")
    )


def best_rule(links: DataFrame) -> DataFrame:
    """The rule of highest priority that matched each record, and its score."""
    order = F.struct("priority", (-F.col("score")).alias("s"), "rule")
    return links.filter(~F.col("review")).groupBy("id").agg(
        F.min_by(F.struct("rule", "score"), order).alias("_b")
    ).select("id", F.col("_b.rule").alias("match_type"), F.col("_b.score").alias("confidence_score"))


@dataclass(frozen=True)
class PersonRules:
    """Rule set over (blocking class, market): each contact with each name form, ids, and known keys."""

    market: str = "market_code"
    blocking: str | None = "blocking_class"
    contacts: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {
        "Email": ("email_key",), "Phone": ("phone_key",), "Address": ("address_key",)})
    name_asc: str = "name_asc"
    name_desc: str | None = None
    local: tuple[str, str] | None = None
    local2: tuple[str, str] | None = None
    english: tuple[str, str] | None = None  # (last, first): equal last name, similar first name
    business_id: tuple[str, ...] = ()
    known_key: str | None = None

    def build(self) -> list[Rule]:
        base = (F.col(self.market),) if self.blocking is None else (F.col(self.blocking), F.col(self.market))
        out: list[Rule] = []
        for label, contacts in self.contacts.items():
            block = (*base, *[tx.blank_to_null(F.col(c)) for c in contacts])
            out.append(ExactRule(f"FullName_{label}_Match", (*block, F.col(self.name_asc))))
            if self.name_desc:
                out.append(ExactRule(f"FullNameDesc_{label}_Match", (*block, F.col(self.name_desc)), 4))
            for name, cols, priority in (("LocalName", self.local, 2), ("LocalName2", self.local2, 3)):
                if cols:
                    first, last = (F.coalesce(F.col(c), F.lit("")) for c in cols)
                    some = F.concat(first, last) != ""
                    out.append(ExactRule(f"{name}_{label}_Match", (*block, F.when(some, first), F.when(some, last)), priority))
            if self.english:
                last, first = (F.coalesce(F.col(c), F.lit("")) for c in self.english)
                some = F.concat(first, last) != ""
                out.append(EditRule(f"EnglishName_{label}_Match", (*block, F.when(some, last)), first, priority=5))
        if self.business_id:
            out.append(ExactRule("ConsumerId_Match", (*base, *[F.col(c) for c in self.business_id]), 6))
        if self.known_key:
            out.append(ExactRule("MasterKey_Match", (*base, F.col(self.known_key)), 7))
        return out


def transaction_rules(names: PersonRules, order_key: Sequence[str] = (), mapping_id: str | None = None, is_master: str | None = None) -> list[Rule]:
    """Person rules (with a contact made of e-mail and phone together), the order id, and the mapping id
    that two already mapped records share."""
    out = names.build()
    market = F.col(names.market)
    if order_key:
        out.append(ExactRule("OrderId_Match", (market, *[F.col(c) for c in order_key]), 6))
    if mapping_id:
        known = F.col(mapping_id) if is_master is None else F.when(F.col(is_master), F.col(mapping_id))
        out.append(ExactRule("MappingId_Match", (market, known), 7))
    return out


def blocking_class(market: Column, brand: Column, group: Column, plain_markets: Sequence[str],
                   special: Mapping[tuple[str, str], str], staff_brand: str, staff_group: str) -> Column:
    """Class that only matches itself: a special (market, brand), staff of one brand, else ``Normal``."""
    out = F.when(market.isin(*plain_markets), "Normal") if plain_markets else F.when(F.lit(False), "Normal")
    for (m, b), name in special.items():
        out = out.when((market == m) & (F.coalesce(brand, F.lit("")) == b), name)
    staff = (F.coalesce(brand, F.lit("")) == staff_brand) & (F.coalesce(group, F.lit("")) == staff_group)
    return out.when(staff, "Staff").otherwise("Normal")


def contact_candidates(persons: DataFrame, phones: DataFrame, emails: DataFrame, addresses: DataFrame | None = None,
                       id: str = "id") -> DataFrame:
    """One row per record with its matching contact values: the primary valid one, else any valid one.

    Each contact table is reduced to one row per record before the join, so nothing fans out.
    """
    def reduce_to(df: DataFrame, key: str, prefer_primary: bool) -> DataFrame:
        valid = F.col("valid_contact")
        any_valid = F.max(F.when(valid, F.col(key)))
        first = F.coalesce(F.max(F.when(valid & F.col("is_primary"), F.col(key))), any_valid) if prefer_primary else any_valid
        return df.groupBy(id).agg(first.alias(key), F.bool_or(valid).alias(f"valid_{key.removesuffix('_match_key')}"))

    out = persons.join(reduce_to(phones, "phone_match_key", True), id, "left")
    out = out.join(reduce_to(emails, "email_match_key", False), id, "left")
    if addresses is not None:
        out = out.join(reduce_to(addresses, "address_match_key", False), id, "left")
    return out


def scope_master(master: DataFrame, batch: DataFrame, keys: Sequence[str], id: str = "id") -> DataFrame:
    """Master rows that share at least one blocking value with the batch (semi joins, nothing collected)."""
    hits = [
        master.filter(F.col(k).isNotNull()).join(batch.select(k).filter(F.col(k).isNotNull()).distinct(), k, "left_semi").select(id)
        for k in keys
    ]
    return master.join(reduce(DataFrame.unionByName, hits).distinct(), id, "left_semi")


def exclude_keys(df: DataFrame, *lists: tuple[DataFrame, Sequence[str]]) -> DataFrame:
    """Rows that are on none of the exclusion lists."""
    for listed, keys in lists:
        df = df.join(listed.select(*keys).distinct(), list(keys), "left_anti")
    return df


def exclude_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose upper-cased value is not listed; null stays."""
    return df.filter(~F.coalesce(F.upper(F.col(column)).isin(*values), F.lit(False)))
