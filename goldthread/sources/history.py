"""Loading history extracts: new ids, inherited markets, back-filled columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from goldthread.functions.text import padded_id
from goldthread.operators.merge import align_schema


def rekey_parents(parents: DataFrame, id: str, market: str, reject: Column | None = None) -> DataFrame:
    """Parents with ids such as ``MKT-000000001``; the old id is kept as ``legacy_id``. Rejected ones go."""
    kept = parents if reject is None else parents.filter(~F.coalesce(reject, F.lit(False)))
    new_id = F.concat(F.col(market), F.lit("-"), padded_id(F.col(id)))
    return kept.withColumn("legacy_id", F.col(id)).withColumn(id, new_id)


def load_children(
    children: DataFrame, parents: DataFrame, id: str, parent_id: str, market: str, schema: StructType,
    renames: Mapping[str, str] = {}, constants: Mapping[str, Column] = {},
) -> DataFrame:
    """Children in the target's schema: market and new id from their parent, children of missing parents dropped."""
    keys = parents.select(F.col("legacy_id").alias(parent_id), F.col(id).alias("_new"), market)
    joined = children.drop(market).join(keys, parent_id).withColumn(parent_id, F.col("_new")).drop("_new")
    return align_schema(joined.withColumnsRenamed(dict(renames)).withColumns(dict(constants)), schema)


def backfill(rows: DataFrame, landed: DataFrame, keys: Sequence[str], json: str, paths: Mapping[str, str]) -> DataFrame:
    """Fill columns that are null from the landed JSON of the same key (``landed`` unique per key)."""
    extra = landed.select(*keys, *[F.get_json_object(json, p).alias(f"_{c}") for c, p in paths.items()])
    joined = rows.join(extra, list(keys), "left")
    filled = {c: F.coalesce(F.col(c).cast("string"), F.col(f"_{c}")) for c in paths}
    return joined.withColumns(filled).drop(*[f"_{c}" for c in paths])


def only_if_absent(home: DataFrame, foreign: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Home rows, and rows found in the other extract that home lacks."""
    missing = foreign.join(home.select(*keys).distinct(), list(keys), "left_anti")
    return home.unionByName(missing)
