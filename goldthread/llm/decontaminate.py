"""Benchmark decontamination by a prefix-filtered set join.

A window is ``size`` consecutive words of a benchmark item (or a shorter item as a whole). It occurs in a
document where all its shingles do, in line. So of each window only the shingle that is rarest in the corpus
(its necessary prefix at full containment) is joined with the documents; the shingle's place in the window
gives the place of the window in the document, bounds on length and position drop windows that cannot fit, and the
words are compared one by one.

Documents are scanned once. The scan keeps only runs of consecutive shingles that some benchmark window holds,
and only runs long enough for a window, so the join sees a small part of the corpus. Which shingles the
benchmark holds is broadcast as a bitmap of fixed size; its false hits are removed by the join. Shingle frequencies are
counted over all documents.

Defined cases: null or wordless texts have no words and no hits; a wordless item has no windows; equal items each count;
rows of one item id are windows of one item; repeated document rows are judged one by one; empty tables give clean documents
or an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from goldthread.llm.rows import id_text, text_key, with_id, without
from goldthread.llm.words import hash_runs, hashed_texts, lowered, pieces
from goldthread.session import stage

WINDOW = 10
SHINGLE = 5
BITMAP_BITS = 24
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text: str | None) -> list[str]:
    """Runs of ASCII letters and digits (A-Z lowered) and of other characters beyond ASCII."""
    return WORD.findall(lowered(text)) if text else []


def _shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    return hash_runs(hashes, size) + np.uint64(size)


def windows(items: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``(item_id, words, shingles, width)`` of each distinct window of each item; ``width`` words make a shingle."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (piece for whole in batches for piece in pieces(whole)):
            texts = [plain_words(t) for t in batch["text"]]
            rows = []
            for item, words, hashes in zip(batch["item_id"], texts, hashed_texts(texts)):
                length = min(size, len(words))
                width = min(shingle, length)
                for start in range(len(words) - length + 1 if length else 0):
                    part = _shingles(hashes[start:start + length], width).view(np.int64)
                    rows.append((item, words[start:start + length], part, width))
            yield pd.DataFrame(rows, columns=["item_id", "words", "shingles", "width"])

    schema = "item_id string, words array<string>, shingles array<bigint>, width int"
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInPandas(cut, schema)
    return rows.dropDuplicates(["item_id", "words"])


def shingle_bitmap(shingles: DataFrame, bits: int = BITMAP_BITS) -> bytes:
    """A bitmap of ``2 ** bits`` places that marks the ``shingle`` values: 2 MB, whatever the size of the benchmark."""
    place = F.shiftrightunsigned("shingle", 64 - bits)
    marks = shingles.select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(F.lit(32767)).alias("bit"))
    whole = np.zeros(2 ** bits // 8, np.uint8)
    for row in marks.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap")).toLocalIterator():
        whole[row["bucket"] * 4096:(row["bucket"] + 1) * 4096] = np.frombuffer(bytes(row["bitmap"]), np.uint8)
    return whole.tobytes()


def _long_runs(hit: np.ndarray, least: int) -> list[tuple[int, int]]:
    """``(first, after)`` of the stretches of at least ``least`` marks."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= least]


def _scan(shared, bits: int, needs: dict[int, int]):
    """Rows with ``n_words`` and the runs of known shingles; ``needs`` is the least run per shingle width."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").view(bool)
        for batch in (piece for whole in batches for piece in pieces(whole)):
            texts = [plain_words(t) for t in batch["text"]]
            found = []
            for words, hashes in zip(texts, hashed_texts(texts)):
                runs = []
                for width, least in needs.items():
                    marks = _shingles(hashes, width)
                    for a, b in _long_runs(known[marks >> np.uint64(64 - bits)], least):
                        runs.append({"start": a, "width": width, "words": words[a:b + width - 1], "shingles": marks[a:b].view(np.int64)})
                found.append(runs)
            yield pd.DataFrame({
                "_row": batch["_row"], "doc_id": batch["doc_id"], "text_key": batch["text_key"],
                "n_words": [len(w) for w in texts], "runs": found,
            })

    return run


_SCANNED = (
    "_row bigint, doc_id string, text_key bigint, n_words bigint, "
    "runs array<struct<start:int,width:int,words:array<string>,shingles:array<bigint>>>"
)


def find_windows(docs: DataFrame, items: DataFrame, size: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """``(documents, matches)``: every document with ``_row`` and ``n_words``; ``(_row, start, length, item_id)`` of each occurrence."""
    spark = docs.sparkSession
    cut = stage(windows(items, size, shingle), "windows")
    texts = cut.groupBy("words").agg(F.first("shingles").alias("shingles"), F.first("width").alias("width"))
    texts = texts.withColumn("length", F.size("words"))
    needs = {r["width"]: r["least"] - r["width"] + 1 for r in texts.groupBy("width").agg(F.min("length").alias("least")).collect()}
    shared = spark.sparkContext.broadcast(shingle_bitmap(texts.select(F.explode("shingles").alias("shingle")).distinct()))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), id_text(), text_key().alias("text_key"), "text",
    )
    scanned = stage(with_id(rows.mapInPandas(_scan(shared, BITMAP_BITS, needs), _SCANNED)), "scanned")
    runs = scanned.select("_row", F.explode("runs").alias("run")).select("_row", "run.*")
    spots = runs.select("_row", "start", "width", F.size("words").alias("n"), F.posexplode("shingles").alias("at", "shingle"))

    seen = spots.groupBy("shingle").agg(F.count(F.lit(1)).alias("frequency"))
    parts = texts.select("words", "width", "length", F.posexplode("shingles").alias("offset", "shingle"))
    rarity = F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "shingle", "offset")
    prefix = parts.join(seen, "shingle", "left").groupBy("words", "width", "length").agg(F.min(rarity).alias("rare"))
    prefix = prefix.filter("rare.frequency > 0").select(
        F.col("words").alias("window"), "width", "length", F.col("rare.shingle").alias("shingle"), F.col("rare.offset").alias("offset"),
    )
    fits = (F.col("at") >= F.col("offset")) & (F.col("at") - F.col("offset") + F.col("length") <= F.col("n"))
    candidates = spots.join(prefix, ["shingle", "width"]).filter(fits).select(
        "_row", "start", "width", "window", "length", (F.col("at") - F.col("offset")).alias("inside"),
    )
    same = F.slice("words", F.col("inside") + 1, F.col("length")) == F.col("window")
    hits = candidates.join(runs.select("_row", "start", "width", "words"), ["_row", "start", "width"]).filter(same)
    hits = stage(hits.select("_row", (F.col("start") + F.col("inside")).alias("start"), "length", "window"), "hits")
    matches = hits.join(cut.select("item_id", F.col("words").alias("window")), "window").drop("window")
    return scanned.drop("runs"), matches


def contamination(docs: DataFrame, items: DataFrame, **sizes) -> DataFrame:
    """A row per document: doc_id, n_words, n_hit (words inside an occurrence), n_items, items_sha256, contaminated."""
    scanned, matches = find_windows(docs, items, **sizes)
    places = matches.select("_row", "start", "length").distinct()
    word = F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1))
    hit = places.select("_row", word.alias("word")).distinct().groupBy("_row").agg(F.count(F.lit(1)).alias("n_hit"))
    named = matches.select("_row", "item_id").distinct().groupBy("_row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    out = scanned.join(hit, "_row", "left").join(named, "_row", "left")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "text_key",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **sizes) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    scanned, matches = find_windows(docs, items, **sizes)
    bad = scanned.join(matches.select("_row").distinct(), "_row").select(F.struct("doc_id", "text_key"))
    return without(docs, bad)
