"""op11 to op13: whole smallest tables against brute force, odd input, and the parts of the methods."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from goldthread.llm import lexical, piece_ids, spelling
from goldthread.llm.queries import LLM_QUERIES
from test_llm_queries import FOLDER, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()

ODD = [
    (1, None), (2, ""), (3, " "), (4, "   \n \n\n"), (5, "a"), (6, " lead  and trail  "), (None, "no id"), (7, "same text"), (7, "same text"),
    (8, "x" * 200_000), (9, "word " * 50_000), (10, "你好世界 é😀　▁mark▁▁ \x00\t\r\n<s></s><unk>"), (11, "▁"), (12, "\n"), (13, "no_blank" * 3000),
]


@pytest.fixture
def odd(spark):
    """Odd rows with more columns, named like those that the operators make."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    clash = {n: F.lit(None).cast("string") for n in ("slice", "bucket", "n", "no_id", "word", "form", "terms", "score", "rank", "query")}
    return docs.withColumns(clash)


def pieces_wanted(model, rows):
    out = []
    for doc_id, text in rows:
        ids = model.encode(text or "", add_eos=True)
        out.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(model.decode(ids))))
    return sorted(out, key=repr)


def test_pieces(spark):
    rows = LLM_QUERIES["op13_distinct_chunks"](spark, FOLDER).collect()
    want = pieces_wanted(SentencePieceProcessor(model_file=MODEL), [(r["doc_id"], r["text"]) for r in table("documents")])
    assert sorted(map(tuple, rows), key=repr) == want


def test_pieces_of_odd_texts(odd):
    got = piece_ids.encode_documents(odd, MODEL, buckets=3)
    assert sorted(map(tuple, got.collect()), key=repr) == pieces_wanted(SentencePieceProcessor(model_file=MODEL), ODD)
    assert piece_ids.encode_documents(odd.filter("false"), MODEL).count() == 0


def test_pieces_in_small_slices(spark, odd, monkeypatch):
    """Slices of a few characters, a table of two chunks, and whole texts as chunks give the same ids."""
    rows = [(f"id {i}", text) for i, (_, text) in enumerate(ODD)]
    want = pieces_wanted(SentencePieceProcessor(model_file=MODEL), rows)

    def run():
        cut = piece_ids.Slice(0, 4)
        model = piece_ids.Model.of(MODEL)
        for doc_id, text in rows:
            cut.add(doc_id, model.chunks(text or ""), len(text or ""))
        written = cut.rows()
        answers = list(piece_ids._segment(MODEL)([written[written["bucket"] >= 0]]))
        return sorted(map(tuple, piece_ids._look_up(2)(written[written["bucket"] < 0], pd.concat(answers)).itertuples(index=False)), key=repr)

    assert run() == want
    monkeypatch.setattr(piece_ids, "TABLE_CHUNKS", 2)
    assert run() == want
    monkeypatch.setattr(piece_ids.Model.of(MODEL), "cuts", False)
    assert run() == want


def brute_variants(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if digest % 97 == 0:
                run = run[:digest % len(run)] + run[digest % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = collections.defaultdict(set)
    cuts = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1:]
            cuts[i, rest].add(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for same in cuts.values():
        for a, b in itertools.combinations(same, 2):
            near[a].add(b)
            near[b].add(a)
    form = {w: min(near[w], key=lambda v: (-words[v], v)) if near[w] else None for w in words}
    form = {w: f if f and words[f] >= 2 * words[w] else None for w, f in form.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def test_spelling(spark):
    rows = LLM_QUERIES["op11_kd_spelling"](spark, FOLDER).collect()
    want = brute_variants([(r["doc_id"], r["text"]) for r in table("documents")])
    assert sorted(map(tuple, rows)) == want and any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


def test_spelling_in_small_cells(spark, monkeypatch):
    """Anagrams in one cell, many cells per length, blocks of a few words, long words, letters beyond ASCII, equal counts."""
    r = random.Random(4)
    words = ["".join(r.sample("abcdeé", 6)) for _ in range(150)] + ["".join(r.choice("abÿ") for _ in range(r.randint(5, 9))) for _ in range(150)]
    words += ["q" * 300, "q" * 299 + "r", "q" * 301]
    rows = [(i, " ".join(r.choice(words) for _ in range(60)) + " " + " ".join(words[-3:]) + " x÷y×z") for i in range(60)] + [(None, None), (None, "Abcde ABCDE abcde"), (90, ""), (91, " ".join(words)), (91, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "n": F.lit("x")})
    want = brute_variants(rows)
    assert sorted(map(tuple, spelling.variants(docs).collect())) == want
    for name, value in {"SAMPLE_WORDS": 64, "CELL_WORDS": 20, "BLOCK_WORDS": 7, "BLOCK_QUERIES": 11, "FLUSH_WORDS": 10}.items():
        monkeypatch.setattr(spelling, name, value)
    assert sorted(map(tuple, spelling.variants(docs).collect())) == want
    assert spelling.variants(docs.filter("false")).count() == 0


def test_kd_search_finds_the_box():
    r = np.random.default_rng(1)
    vectors = r.integers(0, 3, (500, spelling.LETTERS)) * (r.random((500, spelling.LETTERS)) < 0.1)
    tree = spelling.KdTree(vectors.astype(np.int32), 8)
    assert sorted(np.concatenate(tree.leaves)) == list(range(500)) and len(tree.leaves) > 30
    for more, fewer in ((1, 1), (1, 0), (0, 0)):
        found = {(int(q), int(m)) for leaf, rows in tree.search(vectors, more, fewer) for q in rows for m in tree.leaves[leaf]}
        apart = vectors[None, :, :] - vectors[:, None, :]
        up, down = np.maximum(apart, 0).sum(axis=2), np.maximum(-apart, 0).sum(axis=2)
        assert {(int(q), int(m)) for q, m in zip(*np.nonzero((up <= more) & (down <= fewer)))} <= found
        assert len(found) < 500 * 500 / 2


def brute_search(docs, items, top=50):
    terms = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or ""))).split(" ")
    held = [(d, collections.Counter(x for x in terms(t) if x)) for d, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = collections.Counter(t for _, c in held for t in c)
    queries = collections.defaultdict(set)
    for item, text in items:
        queries[item] |= {x for x in terms(text) if x}
    out = []
    for item, wanted in queries.items():
        scored = []
        for (d, c), size in zip(held, sizes):
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * (50 + 50 * size * n // total))) for t in wanted if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top])]
    return sorted(out, key=repr)


def test_search_of_odd_texts(spark, odd, monkeypatch):
    items = [(1, "same text no"), (2, None), (None, "word lead"), (3, "absent"), (4, ""), (5, "WORD x; a"), (5, "trail"), (6, "É 你好世界 mark"), (6, "É 你好世界 mark")]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("query", F.lit("x"))
    want = brute_search(ODD, items)
    assert sorted(map(tuple, lexical.search(odd, asked).collect()), key=repr) == want
    monkeypatch.setattr(lexical, "QUERIES", 1)  # a block per query
    assert sorted(map(tuple, lexical.search(odd, asked).collect()), key=repr) == want
    assert lexical.search(odd.filter("false"), asked).count() == 0 and lexical.search(odd, asked.filter("false")).count() == 0


def test_search_with_ties_many_masks_and_slices(spark, monkeypatch):
    r = random.Random(9)
    vocabulary = [f"t{i}" for i in range(90)]
    docs = [(i, " ".join(r.choices(vocabulary, weights=[1 + 200 // (k + 1) for k in range(90)], k=r.randint(1, 30)))) for i in range(700)]
    docs += [(1000 + i, docs[i % 5][1]) for i in range(120)] + [(1000, docs[0][1])]
    items = [(i, " ".join(r.sample(vocabulary, r.randint(1, 80)))) for i in range(12)] + [(99, docs[0][1])]
    want = brute_search(docs, items)
    frame, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, lexical.search(frame, asked).collect()), key=repr) == want
    monkeypatch.setattr(lexical, "FIRST_DOCS", 1)
    weights = np.full(90, 7, np.int64)
    rows = pd.DataFrame({"doc_id": range(40), "no_id": False, "n": 5, "terms": [np.array([0, i % 3 + 1]) for i in range(40)], "counts": [np.array([1, 1 + i % 2]) for i in range(40)]})
    best = lexical.Best(3, 1)
    part = lexical.Slice([rows], weights, 40, 200)
    lexical.search_slice(part, np.array([0, 1, 2]), best)
    scores = [sum(7 * (10**9 * c // (1000 * c + 20 * 100)) for t, c in zip(ts, cs) if t in (0, 1, 2)) for ts, cs in zip(rows["terms"], rows["counts"])]
    assert list(best.ids) == [i for _, i in sorted((-s, i) for i, s in enumerate(scores))[:3]] and part.bitmap(0) is not None
