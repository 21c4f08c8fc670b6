"""Every llm query over the whole smallest tables: against its SQL, or against a brute-force version."""

import base64
import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry_points
from goldthread.llm.queries import LLM_ORACLES, LLM_QUERIES
from oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"


def table(name):
    return pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()


def groups(sets, percent):
    """The smallest key reachable from each key over pairs of similar sets."""
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            holders[x].append(k)
    shared = collections.Counter(p for ks in holders.values() for p in itertools.combinations(sorted(ks), 2))
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in sets}


def five_words(text):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words)] if 0 < len(words) < 5 else zip(*[words[i:] for i in range(5)]))


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in LLM_QUERIES}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_sql(spark, name):
    assert compare(LLM_QUERIES[name](spark, FOLDER), duck(FOLDER), LLM_ORACLES[name]) is None


def test_mix(spark):
    rows = LLM_QUERIES["op1_cube_mix"](spark, FOLDER).collect()
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in table("documents")}
    source = {r["doc_id"]: r["source"] for r in table("documents")}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    total, per = sum(sizes.values()), collections.Counter()
    for d, s in source.items():
        per[s] += sizes[d]
    names = sorted(per, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full, level = set(), 0.0
    while True:
        level = (1.5 * total - sum(2 * per[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > 2 * per[s]}
        if not more:
            break
        full |= more
    target = {s: 2 * per[s] if s in full else weight[s] * level for s in names}
    taken = collections.Counter()
    for r in rows:
        assert r.target == pytest.approx(target[source[r.doc_id]], rel=1e-12) and r.source_size == per[source[r.doc_id]]
        assert r.taken in {0, r["size"], 2 * r["size"]}
        taken[source[r.doc_id]] += r.taken
    longest = {s: max(sizes[d] for d in sizes if source[d] == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= longest[s] / 2 + 1 for s in names)
    again = LLM_QUERIES["op1_cube_mix"](spark, FOLDER).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_lines(spark):
    """Shingles start at every character; a shorter line is one shingle."""
    first, where = {}, []
    for r in sorted(table("documents"), key=lambda r: r["doc_id"]):
        for i, line in enumerate((r["text"] or "").split("\n")):
            norm = re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")
            if norm:
                where.append((r["doc_id"], i, norm))
                first.setdefault(norm, (r["doc_id"], i))
    sets = {first[n]: frozenset(n[i:i + 8] for i in range(max(1, len(n) - 7))) for n in first}
    root = groups(sets, 80)
    want = {(d, i): root[first[n]] for d, i, n in where}
    rows = LLM_QUERIES["op2_fuzzy_lines"](spark, FOLDER).collect()
    assert {(r.doc_id, r.line_no): (r.first_doc, r.first_line) for r in rows} == want and len(rows) == len(want)
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.first_doc, r.first_line)) for r in rows)


def test_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, at = [], 0
    for r in sorted(table("documents"), key=lambda r: r["doc_id"]):
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    rows = LLM_QUERIES["op3_arrow_tokens"](spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == want


def test_pages(spark):
    def article(html):
        from html import unescape

        inside = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = (re.sub(r"<[^>]*>", lambda m: " " * ("br" in m[0]), b) for b in re.split(r"</?(?:p|h1)>", inside))
        return "\n".join(b for b in (" ".join(unescape(b).split()) for b in blocks) if b)

    want = {r["page_id"]: (r["url"], article(r["html"])) for r in table("pages")}
    rows = LLM_QUERIES["op5_tag_path_text"](spark, FOLDER).collect()
    assert {r.page_id: (r.url, r.text) for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)


def test_near_duplicates(spark):
    sets = {r["doc_id"]: five_words(r["text"]) for r in table("documents")}
    root = groups(sets, 85)
    rows = LLM_QUERIES["op6_lsh_forest"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


def test_archive(spark):
    pages = table("pages")
    largest = {}
    for r in pages:
        largest[r["html"] or ""] = max(r["page_id"], largest.get(r["html"] or "", r["page_id"]))
    want = {}
    for r in pages:
        payload, to = (r["html"] or "").encode(), largest[r["html"] or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want[r["page_id"]] = (len(payload), digest, *(("response", None) if to == r["page_id"] else ("revisit", to)))
    rows = LLM_QUERIES["op9_warc_shards"](spark, FOLDER).collect()
    assert {r.page_id: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


def test_shards(spark):
    rows = LLM_QUERIES["op10_ring_sharding"](spark, FOLDER).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table("documents")}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in texts.items()}
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_pipeline(spark):
    import corpus_pipeline

    docs = {r["doc_id"]: r for r in table("documents")}
    con = duck(FOLDER)
    kept = {d for d, in con.sql(f"SELECT doc_id FROM ({LLM_ORACLES['op8_line_frequency']}) WHERE kept").fetchall()}
    sets = {d: five_words(docs[d]["text"]) for d in kept}
    root = groups(sets, corpus_pipeline.NEAR_PERCENT)
    kept = {d for d in kept if root[d] == d}
    bad = {d for d, in con.sql(f"SELECT doc_id FROM ({LLM_ORACLES['op7_prefix_decontaminate']}) WHERE contaminated").fetchall()}
    kept -= bad
    frames = {"": spark.read.parquet(f"{FOLDER}/documents.parquet")}
    now = frames[""]
    for name, step in corpus_pipeline.STAGES[:3]:
        now = step(spark, now, FOLDER)
        assert now.columns == frames[""].columns
    assert sorted(r.doc_id for r in now.collect()) == sorted(kept)
    assert all(r.asDict() == docs[r.doc_id] for r in now.collect())
    assert corpus_pipeline.NEAR_PERCENT == 80
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    times = collections.Counter(r.doc_id for r in rows)
    assert set(times) <= kept and set(times.values()) <= {1, 2}
    words = {d: len(docs[d]["text"].encode().split()) for d in kept}
    assert sum(words[d] * n for d, n in times.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.02)
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
