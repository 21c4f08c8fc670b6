"""Projections, filters and expressions driven by configuration."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def project_json(df: DataFrame, json: str, schema: str, columns: Mapping[str, str | Column], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns of a JSON column, parsed once with a declared schema.

    A column is a path below the document, or an expression over ``doc``.
    """
    parsed = df.select(*keep, F.from_json(json, schema).alias("doc"))
    picked = [(F.col(f"doc.{c}") if isinstance(c, str) else c).alias(n) for n, c in columns.items()]
    return parsed.select(*keep, *picked)


def project_domains(frames: Mapping[str, DataFrame], names: Mapping[str, Mapping[str, str]], tag: str) -> DataFrame:
    """Bring several domains to common column names by a field map, tagged with the domain."""
    parts = [
        df.select(*[F.col(c).alias(n) for n, c in names[domain].items()], F.lit(domain).alias(tag))
        for domain, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def rule_condition(market: str, rules: Sequence[tuple[str, str]]) -> Column:
    """One condition out of (market, SQL predicate) rows; a predicate that is null does not hit."""
    hits = [F.coalesce((F.col(market) == m) & F.expr(p), F.lit(False)) for m, p in rules]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def rows_hit_by_rules(df: DataFrame, market: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    return df.filter(rule_condition(market, rules))


def failing_keys(tables: Mapping[str, tuple[DataFrame, str, str]], rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Distinct ``(market, id)`` that break a rule in any of their tables.

    ``tables`` maps a kind to (table, market column, id column); a rule is (market, kind, predicate).
    """
    parts = [
        rows_hit_by_rules(df, market, [(m, p) for m, k, p in rules if k == kind]).select(F.col(market).alias("market"), F.col(id).alias("id"))
        for kind, (df, market, id) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def classify_rows(df: DataFrame, classes: Sequence[tuple[str, Column]]) -> DataFrame:
    """``exclude_type``: the first class whose condition holds; ``is_include``: none holds."""
    kind = F.lit(None).cast("string")
    for name, condition in reversed(list(classes)):
        kind = F.when(condition, name).otherwise(kind)
    return df.withColumn("exclude_type", kind).withColumn("is_include", F.col("exclude_type").isNull())


def by_group(group: Column, choices: Mapping[str, Column], default: Column) -> Column:
    """The expression configured for the row's group."""
    out = default
    for name, expression in choices.items():
        out = F.when(group == name, expression).otherwise(out)
    return out


@dataclass(frozen=True)
class SinkSpec:
    """What one receiver gets: derived columns, row filters, and columns to keep or to drop."""

    value_map: Mapping[str, str] = field(default_factory=dict)
    market: str | None = None
    brand: str | None = None
    condition: str | None = None
    include: Sequence[str] = ()
    exclude: Sequence[str] = ()
    market_column: str = "MarketCode"
    brand_column: str = "BrandCode"


def project_for_sink(df: DataFrame, spec: SinkSpec) -> DataFrame:
    for name, expression in spec.value_map.items():  # in order: a later one may use an earlier one
        df = df.withColumn(name, F.expr(expression))
    if spec.market:
        df = df.filter(F.col(spec.market_column) == spec.market)
    if spec.brand:
        df = df.filter(F.col(spec.brand_column) == spec.brand)
    if spec.condition:
        df = df.filter(spec.condition)
    if spec.include:
        return df.select(*spec.include)
    return df.drop(*spec.exclude)


def find_column(df: DataFrame, candidates: Sequence[str]) -> str:
    """The first candidate the table has, whatever the case of its letters."""
    have = {c.lower(): c for c in df.columns}
    for name in candidates:
        if name.lower() in have:
            return have[name.lower()]
    raise KeyError(f"none of {list(candidates)} in {df.columns}")


def expand_path(template: str, ts: Column, values: Mapping[str, Column] | None = None) -> Column:
    """Fill ``{uuid}``, date patterns such as ``{yyyyMMdd}`` and named values into a path template."""
    values = values or {}
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        name = piece[1:-1] if piece.startswith("{") else None
        if name is None:
            parts.append(F.lit(piece))
        elif name in values:
            parts.append(values[name])
        elif name == "uuid":
            parts.append(F.uuid())
        else:
            parts.append(F.date_format(ts, name))
    return F.concat(*parts)


def whitelist(df: DataFrame, codes: DataFrame, keys: Sequence[str], id: str, text: Column, prefix: str, suffix: str) -> DataFrame:
    """Rows of listed sources, and rows whose text has both the prefix and the suffix."""
    pattern = F.coalesce(text.startswith(prefix) & text.endswith(suffix), F.lit(False))
    return df.filter(pattern).unionByName(df.filter(~pattern).join(codes.select(*keys).distinct(), list(keys), "left_semi"))


def downgrade_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str], column: str, value: str = "inv") -> DataFrame:
    """Keep every row; rows on the list get ``value`` in the quality column."""
    marks = listed.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = df.join(marks, list(keys), "left")
    return joined.withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column))).select(*df.columns)


def split_rows(df: DataFrame, text: Column, name: str, separator: str = ",") -> DataFrame:
    """One row per trimmed part of a separated list."""
    return df.withColumn(name, F.explode(F.transform(F.split(text, re.escape(separator)), lambda p: F.trim(p))))


def encrypt(c: Column, key: Column, mode: str = "GCM") -> Column:
    """Hex text that ``decrypt`` reverses. GCM gives a new text every time, ECB a fixed one."""
    return F.hex(F.aes_encrypt(c.cast("string"), key, F.lit(mode)))


def decrypt(c: Column, key: Column, mode: str = "GCM") -> Column:
    return F.aes_decrypt(F.unhex(c), key, F.lit(mode)).cast("string")
