"""Filtering whole documents by decisions that were made on narrow rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def text_key(text: str = "text") -> Column:
    """A 64-bit hash of the text; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, or the first ``wish_`` that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def id_text() -> Column:
    """doc_id as text, for functions on pandas batches, where a null would turn integers into floats."""
    return F.col("doc_id").cast("bigint").cast("string").alias("doc_id")


def with_id(df: DataFrame, *names: str) -> DataFrame:
    """``doc_id`` (or ``names``) as bigint again."""
    return df.withColumns({n: F.col(n).cast("bigint") for n in names or ("doc_id",)})


def key_of(names: Sequence[str] = ("doc_id",)) -> Column:
    """What identifies a document: ``names`` and its text. Equal rows have equal keys; nulls are values."""
    return F.struct(*[F.col(n) for n in names], text_key().alias("text_key"))


def without(docs: DataFrame, keys: DataFrame, names: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The rows of ``docs`` whose :func:`key_of` is not in ``keys`` (one struct column), with all their columns."""
    name, other = free_name(docs, "_key"), free_name(docs, "_listed")
    listed = keys.toDF(other).distinct()
    return docs.withColumn(name, key_of(names)).join(listed, F.col(name) == F.col(other), "left_anti").drop(name)


def only(docs: DataFrame, keys: DataFrame, names: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row of ``docs`` for each key of ``keys`` (one struct column), with all the columns of ``docs``."""
    name, other = free_name(docs, "_key"), free_name(docs, "_listed")
    listed = keys.toDF(other).distinct()
    kept = docs.withColumn(name, key_of(names)).join(listed, F.col(name) == F.col(other), "left_semi")
    return kept.dropDuplicates([name]).drop(name)
