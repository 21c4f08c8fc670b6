"""Quality rules: text statistics, and lines that too many documents of a host share.

Lines are normalised (A-Z lower, white space single) and hashed; a line that more distinct documents of a host
hold than the limit is removed from all of them but the one with the smallest id. The limit is a number of documents, whatever
the size of the host. A document that loses most of its words this way is depleted and rejected, as is one that fails the
statistics. Copies with the very same text count as one document.

Counting is partially aggregated and keyed by (host, line, text), so neither a hot host nor a hot line gathers in
one task; the lines meet the frequent ones with hot lines cut in parts. Texts are read once and only hashes are shuffled.

Defined cases: a null text has no words (and fails the statistics); null is a host of its own; a null id counts as
the smallest; repeated rows are judged one by one, alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from goldthread.llm.rows import id_text, text_key, with_id, without
from goldthread.llm.words import hash_runs, hashed_texts, pieces, words_of
from goldthread.operators.skew import salted_join
from goldthread.session import stage

MIN_WORDS = 50
MIN_DOCS = 20
KEEP_SHARE = 0.3
SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
_SCHEMA = (
    "_row bigint, doc_id string, host string, text_key bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, lines array<bigint>, line_words array<int>"
)


def repeat_words(hashes: np.ndarray, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words which the text holds twice or more."""
    runs = hash_runs(hashes, size)
    if len(runs) < 2:
        return 0
    _, which, counts = np.unique(runs, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    hit = np.zeros(len(hashes), bool)
    for k in range(size):
        hit[k:k + len(again)] |= again
    return int(hit.sum())


def _measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in (piece for whole in batches for piece in pieces(whole)):
        texts = [t or "" for t in batch["text"]]
        words = [words_of(t) for t in texts]
        raw = [[line for line in t.split("\n") if words_of(line)] for t in texts]
        normal = [[words_of(line.encode().lower().decode()) for line in lines] for lines in raw]
        keys = hashed_texts([[b" ".join(w) for w in lines] for lines in normal])
        yield pd.DataFrame({
            "_row": batch["_row"], "doc_id": batch["doc_id"], "host": batch["host"],
            "text_key": batch["text_key"],
            "n_words": [len(w) for w in words],
            "word_chars": [len(t) - sum(map(t.count, SPACES)) for t in texts],
            "n_symbols": [sum(map(t.count, SYMBOLS)) for t in texts],
            "n_dup_lines": [len(lines) - len(set(lines)) for lines in raw],
            "n_repeat_words": [repeat_words(h) for h in hashed_texts(words)],
            "lines": [k.view(np.int64) for k in keys],
            "line_words": [np.array([len(w) for w in lines], np.int32) for lines in normal],
        })


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """A row per document with its statistics and the hashes and word counts of its lines that have a word."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), id_text(),
        F.col(host).cast("string").alias("host"), text_key().alias("text_key"), "text",
    )
    return with_id(rows.mapInPandas(_measure, _SCHEMA))


def judge(
    docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, host_share: float = 0.0,
    keep_share: float = KEEP_SHARE, min_words: int = MIN_WORDS,
) -> DataFrame:
    """Statistics, ``removed_words``, ``removed_lines`` (numbers of the lines with words, from 0), ``base_failed`` and ``kept``.

    A line goes when more than ``min_docs`` of the host's documents hold it; a document stays when at least ``keep_share`` of its
    words remain. A ``host_share`` above 0 spares lines that no larger share of the host holds: then the limit grows with the host.
    """
    measured = stage(measure(docs, host).withColumn("_host", F.struct("host")), "measured")
    lines = measured.select(
        "_row", "_host", "text_key", "doc_id", F.posexplode(F.arrays_zip("lines", "line_words")).alias("pos", "line"),
    ).select("_row", "_host", "text_key", "doc_id", "pos", F.col("line.lines").alias("line"), F.col("line.line_words").alias("words"))
    owned = lines.groupBy("_host", "line", "text_key").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.count(F.lit(1)).alias("_rows"))
    shared = owned.groupBy("_host", "line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("first").alias("first"), F.sum("_rows").alias("_rows"))
    frequent = shared.filter(F.col("n_docs") > min_docs)
    if host_share > 0:
        hosts = measured.select("_host", "text_key").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("host_docs"))
        frequent = frequent.join(hosts, "_host").filter(F.col("n_docs") > F.col("host_docs") * host_share)
    frequent = stage(frequent.select("_host", "line", F.col("first.text_key").alias("owner"), "_rows"), "frequent")
    found = salted_join(lines, frequent.drop("_rows"), ["_host", "line"], ["_row", "pos"], counts=frequent)
    removed = found.filter("text_key <> owner").groupBy("_row").agg(
        F.sum("words").alias("removed_words"), F.array_sort(F.collect_set("pos")).alias("removed_lines"),
    )
    out = measured.drop("lines", "line_words").join(removed, "_row", "left")
    out = out.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("bigint")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    remains = (F.col("n_words") - F.col("removed_words")) >= F.col("n_words") * keep_share
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & remains)


def without_lines(text: Column, removed: Column) -> Column:
    """``text`` without the lines that ``removed_lines`` of :func:`judge` names (lines without a word go too)."""
    full = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    left = F.filter(full, lambda line, i: ~F.array_contains(F.coalesce(removed, F.array().cast("array<int>")), i))
    return F.array_join(left, "\n")


def quality_report(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words",
    )


def keep_good(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that pass, with all their columns. Rows that agree in id, host and text share a verdict."""
    judged = judge(docs, host, **limits)
    bad = judged.filter(~F.col("kept")).select(F.struct("doc_id", F.col("host").alias(host), "text_key"))
    return without(docs, bad, ("doc_id", host))
