"""Spelling variants of words, found in k-d trees over letter-count vectors.

One edit changes a word's letter counts by little: a replaced letter takes one from a count and adds one to another (L1 distance
two at most), an inserted letter adds one to one count (distance one). So the words near a word of length L lie in a small box around its
vector, among the words of length L (replacements) and of length L + 1 (insertions; deletions are the same pairs seen from
the longer word). A box is searched in the k-d tree of each length; a subtree is pruned when its box needs more letters
added or removed than the edit may change. What remains is verified letter by letter.

1. *Count.* Words are counted in each task and then over all (partial aggregates; a task's table is flushed at ``FLUSH_WORDS``).
2. *Fit.* The upper part of each tree is fitted on at most about ``SAMPLE_WORDS`` words chosen by hash, down to cells of about
   ``CELL_WORDS`` words; every word is then placed, and the search is exact whatever the planes are.
3. *Route.* A word goes to its cell and, as a query, to every cell that its boxes touch. A crowded cell (many
   anagrams, or a coarse sample) is cut into blocks of ``BLOCK_WORDS`` members and ``BLOCK_QUERIES`` queries.
4. *Search.* A block builds the lower part of the tree and searches it.
5. *Name.* Partial aggregates choose each word's form; roots follow by pointer doubling (a form has at least twice the count, so
   there are no cycles and a chain is at most the logarithm of the largest count long).

Defined cases: null and empty texts have no words; a null id counts as an empty one in the hash; repeated rows count as often as they come;
equal counts are decided by code-point order; very long words are words; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from goldthread.llm.rows import id_text
from goldthread.llm.words import lowered, pieces
from goldthread.operators.skew import salted_join
from goldthread.session import release, stage

LEAST_LENGTH = 5
LEAST_COUNT = 3
NOISE = 97
FLUSH_WORDS = 500_000
SAMPLE_WORDS = 262_144
CELL_WORDS = 16_384
LEAF_WORDS = 64
BLOCK_WORDS = 32_768
BLOCK_QUERIES = 131_072
COMPARED = 4_000_000  # pairs of vectors compared at once
LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF
REPLACED, INSERTED = (1, 1), (1, 0)  # letters that the other word may have more, and fewer
_ORDERED = np.uint64((1 << 52) - 1)  # the marks of a-z: more letters, more marks
_RUNS = re.compile("[a-zÀ-ÿ]+")


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: Counter[str] = Counter()

    def flush() -> pd.DataFrame:
        return pd.DataFrame({"word": list(held), "n": list(held.values())})

    for batch in (piece for whole in batches for piece in pieces(whole)):
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            start = zlib.crc32(f"{doc_id or ''}:".encode())
            for word, n in Counter(_RUNS.findall(lowered(text) or "")).items():
                digest = zlib.crc32(word.encode(), start)
                if digest % NOISE == 0:
                    at = digest % len(word)
                    word = word[:at] + word[at + 1:]
                if len(word) >= LEAST_LENGTH:
                    held[word] += n
        if len(held) >= FLUSH_WORDS:
            yield flush()
            held.clear()
    if held:
        yield flush()


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words with at least ``LEAST_COUNT`` occurrences; written."""
    rows = docs.select(id_text(), "text").mapInPandas(_count, "word string, n bigint")
    return stage(rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT), "words")


def code_points(words: list[str]) -> np.ndarray:
    """A row of code points for each of some words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.int32)


def letter_counts(points: np.ndarray) -> np.ndarray:
    """The letter-count vector of each row."""
    letters = np.where(points < 0xC0, points - 97, points - 0xC0 + 26)
    places = np.arange(len(points))[:, None] * LETTERS + letters
    counts = np.bincount(places.ravel(), minlength=len(points) * LETTERS).reshape(-1, LETTERS)
    return counts.astype(np.int8 if points.shape[1] < 120 else np.int32)


class KdTree:
    """A tree over vectors of small counts. A leaf is a number, a node (letter, highest count on the left, left, right)."""

    def __init__(self, vectors: np.ndarray, leaf_size: int):
        self.leaves: list[np.ndarray] = []
        self.root = self._build(vectors, np.arange(len(vectors)), leaf_size)

    def _build(self, vectors: np.ndarray, rows: np.ndarray, leaf_size: int):
        if len(rows) > leaf_size:
            mine = vectors[rows]
            low, high = mine.min(axis=0), mine.max(axis=0)
            planes = [low, np.minimum(low + 1, high)]  # counts are small: one of the first planes is near the median
            if (high - low).max() > 3:
                planes.append(np.sort(mine, axis=0)[(len(rows) - 1) // 2])
            left = np.stack([(mine <= plane).sum(axis=0) for plane in planes])
            left[left == len(rows)] = 0  # both sides must get rows
            which, letter = np.unravel_index(np.argmax(np.minimum(left, len(rows) - left)), left.shape)
            if left[which, letter]:
                plane = int(planes[which][letter])
                side = mine[:, letter] <= plane
                return int(letter), plane, self._build(vectors, rows[side], leaf_size), self._build(vectors, rows[~side], leaf_size)
        self.leaves.append(rows)
        return len(self.leaves) - 1

    def search(self, queries: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(leaf, rows of queries)`` where the leaf's box has a vector with at most ``more`` letters added and ``fewer`` removed."""
        zero = np.zeros(len(queries), queries.dtype)
        stack = [(self.root, np.arange(len(queries)), zero, zero, {}, {})]
        while stack:
            node, rows, added, removed, low, high = stack.pop()
            if not len(rows):
                continue
            if not isinstance(node, tuple):
                yield node, rows
                continue
            letter, plane, left, right = node
            mine = queries[rows, letter]
            over = np.maximum(mine - plane, 0)
            down = removed + over - (np.maximum(mine - high[letter], 0) if letter in high else 0)
            under = np.maximum(plane + 1 - mine, 0)
            up = added + under - (np.maximum(low[letter] - mine, 0) if letter in low else 0)
            at = down <= fewer
            stack.append((left, rows[at], added[at], down[at], low, high | {letter: plane}))
            at = up <= more
            stack.append((right, rows[at], up[at], removed[at], low | {letter: plane + 1}, high))


class BoxedTree(KdTree):
    """A tree whose nodes know the box of their rows, as the marks (:func:`_marks`) that any and that all of them have."""

    def __init__(self, vectors: np.ndarray, marks: np.ndarray, leaf_size: int):
        super().__init__(vectors, leaf_size)
        self.marks = marks & _ORDERED
        self.boxes = self._box(self.root)

    def _box(self, node):
        if isinstance(node, tuple):
            left, right = self._box(node[2]), self._box(node[3])
            return left[0] | right[0], left[1] & right[1], left, right
        held = self.marks[self.leaves[node]]
        return np.bitwise_or.reduce(held, initial=0), np.bitwise_and.reduce(held) if len(held) else _ORDERED, node

    def search_boxes(self, queries: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """Like ``search``, for the marks of queries: a box is out of reach when it lacks, or adds, more than the edit may."""
        queries = queries & _ORDERED
        stack = [(self.boxes, np.arange(len(queries)))]
        while stack:
            (any_, all_, *below), rows = stack.pop()
            mine = queries[rows]
            near = (np.bitwise_count(mine & ~any_) <= fewer) & (np.bitwise_count(all_ & ~mine) <= more)
            rows = rows[near]
            if len(rows):
                if len(below) == 1:
                    yield below[0], rows
                else:
                    stack += [(child, rows) for child in below]


def fit_trees(words: DataFrame) -> dict[int, KdTree]:
    """The upper tree of each length of the sample, without the sample's rows."""
    share = min(1.0, SAMPLE_WORDS / max(1, words.count()))
    sample = words.filter(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))).select("word")
    by_length: dict[int, list[str]] = {}
    for row in sample.toLocalIterator():
        by_length.setdefault(len(row["word"]), []).append(row["word"])
    size = max(16, int(CELL_WORDS * share))
    trees = {n: KdTree(letter_counts(code_points(same)), size) for n, same in by_length.items() if len(same) > size}
    for tree in trees.values():
        tree.leaves = []
    return trees


def _route(trees: dict[int, KdTree]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, found = batch["word"].str.len().to_numpy(), []
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                vectors = letter_counts(code_points(batch["word"].iloc[own].tolist()))
                for to, more, fewer, query in ((length, 0, 0, False), (length, *REPLACED, True), (length + 1, *INSERTED, True)):
                    places = trees[to].search(vectors, more, fewer) if to in trees else [(0, np.arange(len(own)))]
                    found += [(own[rows], to, cell, query) for cell, rows in places]
            sizes = [len(rows) for rows, *_ in found]
            out = batch.iloc[np.concatenate([rows for rows, *_ in found])] if found else batch
            columns = {name: np.repeat([f[i + 1] for f in found], sizes) for i, name in enumerate(("length", "cell", "query"))}
            yield pd.DataFrame(columns | {"word": out["word"].to_numpy(), "n": out["n"].to_numpy()})

    return run


def _same_but_one(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the rows differ by one replaced code point, or ``b`` by one inserted one."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= a.shape[1]


def _marks(counts: np.ndarray) -> np.ndarray:
    """64 bits: two for each of a-z (at least one, at least two of it), twelve shared by the other letters (odd). A count that changes
    by one changes at most one bit, so the bits in which two words differ are at most their vectors' distance."""
    bit = np.uint64(1) << np.arange(64, dtype=np.uint64)
    plain, other = counts[:, :26], counts[:, 26:]
    marks = np.where(plain > 0, bit[:26], np.uint64(0)).sum(axis=1) | np.where(plain > 1, bit[26:52], np.uint64(0)).sum(axis=1)
    return marks | np.bitwise_xor.reduce(np.where(other & 1, bit[52 + np.arange(64) % 12], np.uint64(0)), axis=1)


def _halves(points: np.ndarray, size: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``half`` letters and of the last ``size - half`` ones. One edit of a word of ``size`` letters leaves one of them as it is."""
    factors = np.random.default_rng(7).integers(1, 1 << 62, size, dtype=np.uint64) | np.uint64(1)
    hashed = lambda part: (part.astype(np.uint64) * factors[:part.shape[1]]).sum(axis=1)
    return hashed(points[:, :half]), hashed(points[:, points.shape[1] - (size - half):])


def near_rows(asked: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of ``asked`` and ``held`` (code points, one length each) that are one edit apart.

    In a leaf that a box touches, vectors are compared by their marks, and the order of letters by halves, before the words
    themselves are.
    """
    queries, members = letter_counts(asked), letter_counts(held)
    marks, own_marks = _marks(queries), _marks(members)
    more, fewer = REPLACED if asked.shape[1] == held.shape[1] else INSERTED
    size, half = asked.shape[1], asked.shape[1] // 2
    (head, tail), (own_head, own_tail) = _halves(asked, size, half), _halves(held, size, half)
    tree = BoxedTree(members, own_marks, LEAF_WORDS)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for leaf, rows in tree.search_boxes(marks, more, fewer):
        mine = tree.leaves[leaf]
        for some in np.array_split(rows, -(-len(rows) * len(mine) // COMPARED)):
            near = np.bitwise_count(marks[some][:, None] ^ own_marks[mine]) <= more + fewer
            near &= (head[some][:, None] == own_head[mine]) | (tail[some][:, None] == own_tail[mine])
            q, m = np.nonzero(near)
            q, m = some[q], mine[m]
            good = _same_but_one(asked[q], held[m])
            found.append((q[good], m[good]))
    q, m = zip(*found)
    return np.concatenate(q), np.concatenate(m)


def _search(block: pd.DataFrame) -> pd.DataFrame:
    asked, held = block[block["query"]], block[~block["query"]]
    found = [pd.DataFrame({"a": [], "n_a": [], "b": [], "n_b": []})]
    words, counts = held["word"].to_numpy(), held["n"].to_numpy()
    for _, same in asked.groupby(asked["word"].str.len()) if len(held) else ():
        mine, n = same["word"].to_numpy(), same["n"].to_numpy()
        q, m = near_rows(code_points(mine.tolist()), code_points(words.tolist()))
        once = (mine[q] < words[m]) | (len(mine[0]) < len(words[0]))  # words of one length find each other twice
        q, m = q[once], m[once]
        found.append(pd.DataFrame({"a": mine[q], "n_a": n[q], "b": words[m], "n_b": counts[m]}))
    return pd.concat(found, ignore_index=True)


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``: each pair of near words once; written."""
    routed = words.select("word", "n").mapInPandas(_route(fit_trees(words)), "length int, cell int, query boolean, word string, n bigint")
    routed = stage(routed, "routed")
    parts = lambda what, size: F.greatest(F.lit(1), F.ceil(F.count_if(what) / F.lit(size))).cast("int")
    shape = routed.groupBy("length", "cell").agg(
        F.count_if(~F.col("query")).alias("members"), parts(F.col("query"), BLOCK_QUERIES).alias("n_i"), parts(~F.col("query"), BLOCK_WORDS).alias("n_j"))
    shape = stage(shape.filter("members > 0").drop("members"), "shape")
    part = lambda n: F.pmod(F.xxhash64("word"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    places = routed.join(shape, ["length", "cell"])
    own, others = (F.when(F.col("query"), F.array(part("n_i"))).otherwise(every("n_i")),
                   F.when(F.col("query"), every("n_j")).otherwise(F.array(part("n_j"))))
    blocks = places.withColumn("i", F.explode(own)).withColumn("j", F.explode(others))
    return stage(blocks.groupBy("length", "cell", "i", "j").applyInPandas(_search, "a string, n_a bigint, b string, n_b bigint"), "near")


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` (``word``, ``form``) with ``root``, the last word of the chain of forms."""
    now = stage(forms.withColumn("root", F.coalesce("form", "word")), "roots")
    while True:
        ahead = now.filter("form is not null").select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = stage(salted_join(now, ahead, ["root"], ["word"], "left"), "roots")
        release(forms.sparkSession, now)
        now = moved.withColumn("root", F.coalesce("_next", "root")).drop("_next")
        if moved.filter("_next is not null").isEmpty():
            return now.select(*forms.columns, "root")
        now._staged = moved._staged


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = count_words(docs)
    pairs = near_pairs(words)
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("form"), F.col("n_b").alias("form_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("form"), F.col("n_a").alias("form_n")))
    best = F.min(F.struct((-F.col("form_n")).alias("least"), F.col("form").alias("form"))).alias("best")
    near = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    named = words.join(near, "word", "left")
    larger = -F.col("best.least") >= 2 * F.col("n")
    named = named.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(larger, F.col("best.form")).alias("form"), F.when(larger, -F.col("best.least")).alias("form_n"))
    return with_roots(named).select("word", "form", "root", "n", "n_near", "form_n")
