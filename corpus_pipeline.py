"""The corpus pipeline: documents through quality rules, near-dedup, decontamination, mixing and sharding.

Each stage is a function of (spark, documents, folder of the tables) that calls one operator of ``goldthread.llm``.
What a stage returns is written as Parquet and read again as the documents of the next one. All but the last return
the columns of ``documents``:

1. quality rules: rejected documents go;
2. near-dedup: of each group of near duplicates (similarity ``NEAR_PERCENT`` and more) the document with the smallest id stays;
3. decontamination: documents that hold a benchmark passage go;
4. mixing: a document appears as often as the mix takes it;
5. sharding: doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of the mix.

What a stage staged for itself, and the documents that it read, are removed once its result is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from goldthread.llm import decontaminate, line_rules, mix, near_dup, ring
from goldthread.session import new_path, release, work_scope

NEAR_PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_rules.keep_good(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs, NEAR_PERCENT)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mix_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ring.shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality), ("near-dedup", dedup), ("decontamination", clean), ("mixing", mixed), ("sharding", sharded),
]

ORACLE_SQL: str | None = None  # the cube method and the forest are not SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in STAGES[:-1]:
        path = new_path(spark, name.replace(" ", "-"))
        with work_scope(spark):
            found = step(spark, docs, sf_dir)
            found.write.parquet(path)
        release(spark, *read)
        docs, read = spark.read.schema(found.schema).parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
