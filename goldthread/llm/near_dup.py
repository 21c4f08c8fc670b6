"""Near-duplicate documents by an LSH forest on MinHash signatures, links confirmed on the full shingle sets.

Every document has several labels, each a sequence of MinHash values. A tree of the forest is the documents in the
order of one label; documents with a long common prefix are neighbours there. A region (documents with a common prefix
of ``BASE`` values) is cut deeper as long as it has company: a document meets the leader of its region at each depth, so
a sparse region is searched at the base depth and a crowded one down to the whole label. Estimates from the
signatures drop clearly different neighbours, and the closest neighbour of each document is confirmed first. The documents of
regions that still hold several components are joined by their rarest shingles: as many of each as similar sets must
share one of, bounded by sizes and places. In a cloud of documents just below the limit these are the ones that few share, so its
cost grows with its members.

Documents with the same shingle set are one node from the start. A pair at similarity 0.85 shares no region with
probability (1 - 0.85 ** BASE) ** TREES, below 1 in 100,000; above it less.

Defined cases: a document without words or text is linked with nothing and kept; null ids belong to their component
but name it only when all its ids are null; repeated rows are copies of each other; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from goldthread.llm.linking import components_of, crowded, degrees, joined_roots, led, open_members, part_blocks, parts_of, star_pairs
from goldthread.llm.rows import id_text, only, text_key, with_id
from goldthread.llm.words import hash_runs, hashed_texts, pieces, words_of
from goldthread.session import stage

SHINGLE = 5
TREES = 16
DEPTH = 8
BASE = 4
PERCENT = 85
DOUBT = 0.15  # an estimate further below the limit than this (nearly five standard deviations) is no candidate
BLOCK = 2048
QUERY_ROWS = 256
BLOCK_ROWS = 512
HOT_ROWS = 1024
SLOTS = 1 << 20  # counters of shingles, whatever their number: they order shingles by rarity and decide nothing
_FACTORS = np.random.default_rng(20).integers(1, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; a shorter text is one run."""
    return np.unique(hash_runs(hashes, min(size, len(hashes)))) if len(hashes) else np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The MinHash values, 32 bits each."""
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), BLOCK):
        least = np.minimum(least, np.multiply.outer(_FACTORS, shingles[start:start + BLOCK]).min(axis=1))
    return (least >> np.uint64(32)).astype(">u4")


def _lower_words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in (piece for whole in batches for piece in pieces(whole)):
        sets = [shingle_set(h) for h in hashed_texts([_lower_words(t) for t in batch["text"]])]
        yield pd.DataFrame({
            "doc_id": batch["doc_id"], "text_key": batch["text_key"], "n_shingles": [len(s) for s in sets],
            "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "labels": [signature(s).tobytes() if len(s) else None for s in sets],
        })


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, digest (of the shingle set) and labels of every document."""
    rows = docs.select(id_text(), text_key().alias("text_key"), "text")
    return with_id(rows.mapInPandas(_sketch, "doc_id string, text_key bigint, n_shingles bigint, digest binary, labels binary"))


def _estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            a, b = (np.frombuffer(b"".join(batch[c]), ">u4").reshape(len(batch), -1) for c in ("labels_a", "labels_b"))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "likeness": (a == b).mean(axis=1)})


def likely(pairs: DataFrame, nodes: DataFrame, least: float, percent: int = PERCENT) -> DataFrame:
    """``(a, b, likeness)`` of the pairs whose sizes allow a link and whose estimated similarity is at least ``least``."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("labels").alias(f"labels_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return both.select("a", "b", "labels_a", "labels_b").mapInPandas(_estimate, "a bigint, b bigint, likeness double").filter(
        F.col("likeness") >= least
    )


def _confirm(percent: int, names: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, np.ndarray] = {}
        for batch in (piece for whole in batches for piece in pieces(whole)):
            new = {n: t for c in "ab" for n, t in zip(batch[c], batch[f"text_{c}"]) if n not in kept}
            sets = dict(zip(new, (shingle_set(h) for h in hashed_texts([_lower_words(t) for t in new.values()]))))
            kept = {n: kept.get(n, sets.get(n)) for c in "ab" for n in batch[c]}
            good = []
            for a, b in zip(batch["a"], batch["b"]):
                shared = len(np.intersect1d(kept[a], kept[b], assume_unique=True))
                good.append(100 * shared >= percent * (len(kept[a]) + len(kept[b]) - shared))
            yield batch.loc[good, names]

    return run


def confirm(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT, names: tuple[str, ...] = ("a", "b")) -> DataFrame:
    """The pairs whose full shingle sets are similar enough, with the columns ``names``."""
    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select(*dict.fromkeys(["a", "b", *names]), "text_a", "text_b")
    return both.mapInPandas(_confirm(percent, list(names)), ", ".join(f"{n} bigint" for n in names))


def _search(percent: int, least: float):
    """Links ``(a, b)`` between the roots of a block's queries and of its rows, as few as connect what is similar (exact, on full sets)."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        asked, rows = block[block["query"]], block[~block["query"]]
        sets = [shingle_set(h) for h in hashed_texts([_lower_words(t) for t in rows["text"]])]
        if not len(asked) or not sets:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        known, places = np.unique(np.concatenate(sets), return_inverse=True)
        sizes = np.array([len(s) for s in sets])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        table = np.frombuffer(b"".join(rows["labels"]), ">u4").reshape(len(rows), -1)
        owner = rows["root"].to_numpy().copy()
        links, joined = [], {}
        own = [shingle_set(h) for h in hashed_texts([_lower_words(t) for t in asked["text"]])]
        for root, label, mine in zip(asked["root"], asked["labels"], own):
            while root in joined:
                root = joined[root]
            maybe = (100 * np.minimum(sizes, len(mine)) >= percent * np.maximum(sizes, len(mine))) & (owner != root)
            maybe &= (table == np.frombuffer(label, ">u4")).mean(axis=1) >= least
            if not maybe.any():
                continue
            shared = np.add.reduceat(np.isin(known, mine, assume_unique=True)[places], starts)
            found = np.flatnonzero(maybe & (100 * shared >= percent * (sizes + len(mine) - shared)))
            for other in np.unique(owner[found]):  # one link per component is enough
                links.append((root, other))
                joined[other] = root
                owner[owner == other] = root
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return run


def _slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(SLOTS, np.int64)
    for batch in (piece for whole in batches for piece in pieces(whole)):
        for hashes in hashed_texts([_lower_words(t) for t in batch["text"]]):
            np.add.at(counts, (shingle_set(hashes) % np.uint64(SLOTS)).astype(np.int64), 1)
    used = np.flatnonzero(counts)
    yield pd.DataFrame({"slot": used.astype(np.int32), "n": counts[used]})


def _rarest(counts: np.ndarray, percent: int):
    """The shingles of each text that come first, rare ones before common ones, as far as a similar text must share one of them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (piece for whole in batches for piece in pieces(whole)):
            out = []
            for hashes in hashed_texts([_lower_words(t) for t in batch["text"]]):
                shingles = shingle_set(hashes)
                order = np.lexsort((shingles, counts[(shingles % np.uint64(SLOTS)).astype(np.int64)]))
                out.append(shingles[order[:len(shingles) - -(-percent * len(shingles) // 100) + 1]])
            sizes = [len(o) for o in out]
            yield pd.DataFrame({
                "node": np.repeat(batch["node"].to_numpy(), sizes), "shingle": np.concatenate([*out, np.zeros(0, np.uint64)]).view(np.int64),
                "at": np.concatenate([*(np.arange(n) for n in sizes), np.zeros(0, np.int64)]).astype(np.int32),
            })

    return run


def open_blocks(regions: DataFrame, roots: DataFrame, texts: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """``(part, i, query, node, root)``: the members of regions with several components, in blocks where a link is possible.

    The members outside the largest component of a region ask those parts (of about ``BLOCK_ROWS`` members) in which another text has one of
    their rarest shingles and a fitting size. A shingle stands once per part, so neither pairs of texts nor of copies are made.
    """
    at = open_members(regions, roots, HOT_ROWS)
    asked = at.filter("root <> main").select("node").distinct().withColumn("asks", F.lit(True))
    inside = at.select("node", "root").distinct().join(asked, "node", "left").join(nodes.select("node", F.col("n_shingles").alias("n")), "node")
    inside = stage(inside.join(texts, "node"), "open-texts")
    parts = parts_of(inside.select("node", "root"), BLOCK_ROWS)
    counts = np.zeros(SLOTS, np.int64)
    used = inside.select("text").mapInPandas(_slots, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts[used["slot"].to_numpy()] = used["n"].to_numpy()
    rare = inside.select("node", "text").mapInPandas(_rarest(counts, percent), "node bigint, shingle bigint, at int")
    rare = stage(rare.join(inside.drop("text"), "node").join(parts.select("node", "part"), "node"), "rarest")
    held = rare.groupBy("shingle", "part").agg(
        F.count(F.lit(1)).alias("holders"), F.min("node").alias("holder"), F.min("n").alias("low"), F.max("n").alias("high"),
        F.max(F.col("n") - F.col("at")).alias("left"))
    met = rare.filter("asks").drop("part").join(held, "shingle").filter("part.root <> root AND (holders > 1 OR holder <> node)")
    met = met.filter((100 * F.col("n") >= percent * F.col("low")) & (100 * F.col("high") >= percent * F.col("n")))
    least = F.greatest(F.col("low"), F.ceil(F.lit(percent) * F.col("n") / F.lit(100) - F.lit(1e-9)))
    needed = F.ceil(F.lit(percent) * (F.col("n") + least) / F.lit(100 + percent) - F.lit(1e-9))
    met = met.filter(F.least(F.col("n") - F.col("at"), F.col("left")) >= needed)
    return part_blocks(met.select("part", "node").distinct(), parts, QUERY_ROWS)


def find_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """A row per document: doc_id, text_key, n_shingles, root (of its component, null without words), component_id."""
    sketched = stage(sketch(docs), "sketches")
    full = sketched.filter(F.col("n_shingles") > 0)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    nodes = full.groupBy("digest", "n_shingles").agg(F.first("labels").alias("labels"), first)
    nodes = stage(nodes.select(
        F.monotonically_increasing_id().alias("node"), "digest", "n_shingles", "labels", "first.doc_id", "first.text_key",
    ), "nodes")

    trees = nodes.select("node", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "labels")
    label = F.substring("labels", F.col("tree") * (4 * DEPTH) + 1, F.lit(4 * DEPTH))
    rows = trees.select("node", "tree", label.alias("label"))
    prefix = lambda depth: F.xxhash64("tree", F.substring("label", F.lit(1), 4 * depth))
    crowd = stage(crowded(rows.withColumn("bucket", prefix(F.lit(BASE))), HOT_ROWS), "crowd")
    regions = stage(led(crowd.join(degrees(crowd), "node"), HOT_ROWS), "regions")
    # A region of two has the same pair at every depth; the deeper ones of all others are led at once, a row per depth.
    deeper = regions.filter("n > 2").withColumn("depth", F.explode(F.sequence(F.lit(BASE + 1), F.lit(DEPTH))))
    deeper = led(deeper.select("node", "degree", prefix(F.col("depth")).alias("bucket")), HOT_ROWS)
    pairs = star_pairs(regions.select("node", "lead").unionByName(deeper.select("node", "lead")))
    least = percent / 100 - DOUBT
    pairs = stage(likely(pairs, nodes, least, percent), "likely")

    members = regions.select("node").distinct()
    keys = nodes.join(members, "node").select("node", F.struct("doc_id", "text_key").alias("_k"))
    texts = docs.select(F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key")).alias("_k"), "text")
    texts = stage(texts.join(keys, "_k").groupBy("node").agg(F.first("text").alias("text")), "texts")

    both_ways = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "likeness"))
    closest = both_ways.groupBy("b").agg(F.max(F.struct("likeness", -F.col("a"))).alias("best"))
    closest = closest.select((-F.col("best").getField("col2")).alias("a"), "b")
    tried = closest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stage(confirm(tried, texts, percent), "links")
    roots = components_of(links, members)
    rest = pairs.select("a", "b").join(tried, ["a", "b"], "left_anti")
    between = lambda p: p.join(roots.toDF("a", "_ra"), "a").join(roots.toDF("b", "_rb"), "b").filter("_ra <> _rb")
    blocks = open_blocks(regions.filter("n > 2"), roots, texts, nodes, percent)
    blocks = blocks.join(texts, "node").join(nodes.select("node", "labels"), "node")
    searched = blocks.groupBy("part", "i").applyInPandas(_search(percent, least), "a bigint, b bigint")
    more = confirm(between(rest), texts, percent, ("_ra", "_rb")).toDF("a", "b").unionByName(searched)
    roots = joined_roots(roots, stage(more, "links")).toDF("_node", "root")

    named = nodes.join(roots, F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("root", "node"))
    named = stage(named.select("digest", "n_shingles", "root", "doc_id"), "named")
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.drop("doc_id").join(smallest, "root")
    out = full.select("doc_id", "text_key", "digest", "n_shingles").join(named, ["digest", "n_shingles"]).drop("digest")
    empty = sketched.filter(F.col("n_shingles") == 0).select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("bigint").alias("root"), F.col("doc_id").alias("component_id"),
    )
    return out.select("doc_id", "text_key", "n_shingles", "root", "component_id").unionByName(empty)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of the component) and kept (doc_id = component_id) of every document."""
    found = find_groups(docs)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id, and all texts without words (repeated rows once)."""
    found = find_groups(docs, percent)
    id_type = docs.schema["doc_id"].dataType
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast(id_type).alias("doc_id"), "text_key")).alias("first")
    grouped = found.filter("root is not null").groupBy("root").agg(first)
    keys = grouped.select(F.struct("first.doc_id", "first.text_key").alias("k")).unionByName(
        found.filter("root is null").select(F.struct(F.col("doc_id").cast(id_type).alias("doc_id"), "text_key").alias("k")))
    return only(docs, keys)
