"""Ranked lexical search by presence masks.

A query's documents are grouped by their mask, the set of the query's terms that they hold. All documents of a mask share
one upper bound, the sum of the highest gains of its terms, so masks are evaluated by descending bound, and a query is
done when its last place scores more than the next mask can.

1. *Code.* Documents are read once per block of queries (``VOCABULARY`` terms at most; usually there is one block) and
   written as numbers of the block's terms with their counts. Lengths and document frequencies are partial aggregates of that.
2. *Floors.* The search runs over a hashed part of the documents; what stands in a query's last place there is a lower bound
   for its last place over all. It saves work and output, never a row.
3. *Search.* A task gathers documents in slices of ``SLICE_POSTINGS`` postings. In a slice, common terms have a bitmap. For
   a query, terms that cannot lift a document to the floor together are set aside; the documents with any other term are
   grouped by mask with bitmap operations and evaluated in order, exactly, in integers.
4. *Merge.* Each task returns at most ``top`` documents of a query; the best of them are ranked.

No posting is shuffled, and no task holds more than a slice and the best documents so far. What every task gets is a block of queries
with the weights of its terms, bounded by ``VOCABULARY`` and ``QUERIES`` (a single query with more terms is a block of its own).

Defined cases: null and empty texts have no terms, match nothing and do not count as documents; queries without terms or hits have no
rows; rows of one item id are one query with the terms of all; a null id is the largest and ranks last among equal scores; repeated rows are
ranked each; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from goldthread.llm.words import pieces
from goldthread.session import stage

TOP = 50
VOCABULARY = 1_000_000
QUERIES = 10_000
SLICE_DOCS = 65_536
SLICE_POSTINGS = 8_000_000
FLOOR_PART = 64  # one in so many documents sets the floors
COMMON = 32  # a term in more than one in so many documents of a slice gets a bitmap
FIRST_DOCS = 128
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

Query = tuple[str | None, np.ndarray]


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and characters beyond ASCII, A-Z in lower case, in UTF-8."""
    return text.encode().translate(_LETTERS).split() if text else []


def _code(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (piece for whole in batches for piece in pieces(whole)):
            lengths, held, counts = [], [], []
            for text in batch["text"]:
                words = terms_of(text)
                found = [(vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary]
                lengths.append(len(words))
                held.append(np.array([t for t, _ in found], np.int32))
                counts.append(np.array([c for _, c in found], np.int32))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "no_id": batch["no_id"], "n": lengths, "terms": held, "counts": counts})

    return run


def code_documents(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, no_id, n, terms, counts`` of every document: its length and its terms of the vocabulary; written."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")
    return stage(rows.mapInPandas(_code(vocabulary), "doc_id bigint, no_id boolean, n bigint, terms array<int>, counts array<int>"), "coded")


class Slice:
    """Documents of a task with their postings by term."""

    def __init__(self, parts: list[pd.DataFrame], weights: np.ndarray, n_docs: int, n_terms: int):
        rows = pd.concat(parts, ignore_index=True)
        self.ids, self.no_id = rows["doc_id"].to_numpy(), rows["no_id"].to_numpy(bool)
        sizes = rows["terms"].map(len).to_numpy()
        terms, counts = (np.concatenate([*rows[c], np.zeros(0, np.int32)]).astype(np.int64) for c in ("terms", "counts"))
        docs = np.repeat(np.arange(len(rows)), sizes)
        scale = 50 + (50 * rows["n"].to_numpy(np.int64) * n_docs) // max(n_terms, 1)
        gains = weights[terms] * ((1_000_000_000 * counts) // np.maximum(1000 * counts + 20 * scale[docs], 1))
        order = np.argsort(terms, kind="stable")  # documents stay in order inside a term
        self.docs, self.gains = docs[order], gains[order]
        known, starts = np.unique(terms[order], return_index=True)
        self.spans = dict(zip(known.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(terms)])))
        self.highest = dict(zip(known.tolist(), np.maximum.reduceat(self.gains, starts).tolist())) if len(known) else {}
        self.bitmaps: dict[int, np.ndarray] = {}

    def holders(self, term: int) -> np.ndarray:
        start, end = self.spans[term]
        return self.docs[start:end]

    def bitmap(self, term: int) -> np.ndarray | None:
        """One bit per document for a common term; None for a rare one."""
        if term not in self.bitmaps and len(self.holders(term)) * COMMON > len(self.ids):
            marks = np.zeros(len(self.ids), bool)
            marks[self.holders(term)] = True
            self.bitmaps[term] = np.packbits(marks, bitorder="little")
        return self.bitmaps.get(term)

    def presence(self, terms: list[int], docs: np.ndarray) -> np.ndarray:
        """For each term (rows) and each of ``docs`` (ascending) whether the document holds the term."""
        out = np.zeros((len(terms), len(docs)), bool)
        for row, term in zip(out, terms):
            bits = self.bitmap(term)
            if bits is None:
                held = self.holders(term)
                at = np.searchsorted(docs, held)
                at[at == len(docs)] = 0
                row[at[docs[at] == held]] = True
            else:
                row[:] = (bits[docs >> 3] >> (docs & 7).astype(np.uint8)) & 1
        return out

    def scores(self, terms: list[int], docs: np.ndarray, present: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for row, term in zip(present, terms):
            start, end = self.spans[term]
            out[row] += self.gains[start + np.searchsorted(self.docs[start:end], docs[row])]
        return out


def _masks(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first document of each distinct mask, and the mask's number of each document."""
    words = np.packbits(present, axis=0, bitorder="little").T
    words = np.pad(words, ((0, 0), (0, -words.shape[1] % 8)))
    words = np.ascontiguousarray(words).view("<u8" if words.shape[1] == 8 else [("", "<u8")] * (words.shape[1] // 8)).ravel()
    _, first, number = np.unique(words, return_index=True, return_inverse=True)
    return first, number


class Best:
    """The best documents of one query so far: at most ``top``, best first."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, floor
        self.scores, self.ids, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = scores >= self.floor
        scores, ids, no_id = (np.concatenate((a, b[good])) for a, b in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -scores))[:self.top]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]
        if len(order) == self.top:
            self.floor = max(self.floor, int(self.scores[-1]))


def search_slice(part: Slice, terms: np.ndarray, best: Best) -> None:
    """Evaluate the masks of one query by descending bound until none can reach the floor."""
    here = sorted((t for t in terms.tolist() if t in part.spans), key=lambda t: part.highest[t])
    highest = np.array([part.highest[t] for t in here], np.int64)
    needed = int(np.searchsorted(np.cumsum(highest), best.floor))  # the terms before cannot reach the floor together
    if needed == len(here):
        return
    marks = np.zeros(len(part.ids), bool)
    for t in here[needed:]:
        marks[part.holders(t)] = True
    docs = np.flatnonzero(marks)
    present = part.presence(here, docs)
    first, mask = _masks(present)
    bounds = highest @ present[:, first]
    order = np.argsort(-bounds[mask], kind="stable")  # documents by their mask's bound
    ordered, at, size = bounds[mask][order], 0, FIRST_DOCS
    while at < len(order) and ordered[at] >= best.floor:
        end = min(at + size, int(np.searchsorted(-ordered, -best.floor, side="right")))
        some = np.sort(order[at:end])
        best.add(part.scores(here, docs[some], present[:, some]), part.ids[docs[some]], part.no_id[docs[some]])
        at, size = end, size * 2


def _search(queries: list[Query], weights: np.ndarray, floors: list[int], n_docs: int, n_terms: int, top: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [Best(top, max(1, f)) for f in floors]
        held, docs, postings = [], 0, 0

        def search() -> None:
            part = Slice(held, weights, n_docs, n_terms)
            for (_, terms), b in zip(queries, best):
                search_slice(part, terms, b)

        for batch in (piece for whole in batches for piece in pieces(whole, 1024)):
            held.append(batch)
            docs, postings = docs + len(batch), postings + int(batch["terms"].map(len).sum())
            if docs >= SLICE_DOCS or postings >= SLICE_POSTINGS:
                search()
                held, docs, postings = [], 0, 0
        if held:
            search()
        for number, b in enumerate(best):
            if len(b.ids):
                yield pd.DataFrame({"query": number, "doc_id": b.ids, "no_id": b.no_id, "score": b.scores})

    return run


def query_blocks(items: DataFrame) -> Iterator[tuple[dict[bytes, int], list[Query]]]:
    """The queries in blocks of bounded size: the numbers of a block's terms, and for each query its id and terms."""
    texts = items.select(F.col("item_id").cast("string").alias("item_id"), "text").groupBy("item_id").agg(F.collect_list("text").alias("texts"))
    vocabulary: dict[bytes, int] = {}
    block: list[Query] = []
    for row in texts.orderBy("item_id").toLocalIterator():
        words = sorted({w for t in row["texts"] for w in terms_of(t)})
        if block and (len(vocabulary) + len(words) > VOCABULARY or len(block) == QUERIES):
            yield vocabulary, block
            vocabulary, block = {}, []
        if words:
            block.append((row["item_id"], np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words])))
    if block:
        yield vocabulary, block


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "no_id", "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, vocabulary: dict[bytes, int], queries: list[Query], top: int) -> DataFrame:
    spark, result = docs.sparkSession, "query int, doc_id bigint, no_id boolean, score bigint"
    coded = code_documents(docs, vocabulary)
    n_docs, n_terms = coded.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for row in coded.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        weights[row["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["df"] + 1)))

    def run(rows: DataFrame, floors: list[int]) -> DataFrame:
        return _ranked(rows.mapInPandas(_search(queries, weights, floors, n_docs, n_terms, top), result), top)

    floors = [0] * len(queries)
    part = coded.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FLOOR_PART)) == 0)
    for row in run(part, floors).filter(F.col("rank") == top).select("query", "score").collect():
        floors[row["query"]] = row["score"]
    names = F.broadcast(spark.createDataFrame([(i, name) for i, (name, _) in enumerate(queries)], "query int, item_id string"))
    out = run(coded, floors).join(names, "query")
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score: the ``top`` documents of each item with the highest scores above 0."""
    item_type = items.schema["item_id"].dataType
    out = docs.sparkSession.createDataFrame([], "item_id string, rank int, doc_id bigint, score bigint")
    for vocabulary, queries in query_blocks(items):
        out = out.unionByName(_search_block(docs, vocabulary, queries, top))
    return out.withColumn("item_id", F.col("item_id").cast(item_type))
