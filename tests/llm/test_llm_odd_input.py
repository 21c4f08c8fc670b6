"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import collections
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from goldthread.llm import chat, decontaminate, line_dedup, line_rules, main_text, mix, near_dup, ring, token_files, warc

PROSE = " ".join(f"word{i}" for i in range(60))
OTHER = " ".join(f"term{i}" for i in range(80))
CLASHES = "_row long, _key string, _unit string, node long, size string, copies long, shard string, text_key string, _listed string"


def clash(df):
    """More columns, named like those that the operators make."""
    return df.select("*", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in CLASHES.split(", ")])


@pytest.fixture
def docs(spark):
    rows = [
        (1, PROSE, "a"), (2, PROSE.upper(), "a"), (3, None, "b"), (4, "", None), (5, " \n\t ", "b"), (6, PROSE + " extra", None),
        (None, OTHER, "a"), (7, OTHER, "c"), (8, OTHER + " more", "c"), (8, OTHER + " more", "c"), (9, "one two three", "c"),
        (10, "one two  three", None), (2**60 + 1, "line one is here\n" * 400, "d"), (11, "x" * 300_000 + " y", "d"),
        (12, "é ü ß 😀 " * 30, None),
    ]
    return clash(spark.createDataFrame(rows, "doc_id long, text string, source string"))


@pytest.fixture
def none(docs):
    return docs.filter("false")


def by_id(df, *names):
    return sorted(((r.doc_id is None, r.doc_id or 0), *[r[n] for n in names]) for r in df.collect())


def test_near_duplicates(docs, none):
    got = by_id(near_dup.near_duplicates(docs), "n_shingles", "component_id", "kept")
    want = {1: (56, 1, True), 2: (56, 1, False), 3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True), 6: (57, 1, False), 7: (76, 7, True),
            9: (1, 9, True), 10: (1, 9, False)}
    for (null, id_), *rest in got:
        if not null and id_ in want:
            assert tuple(rest) == want[id_]
    assert [tuple(r[1:]) for r in got if r[0][0]] == [(76, 7, False)] and sum(r[0][1] == 8 for r in got) == 2
    assert len(got) == 15 and near_dup.near_duplicates(none).count() == 0
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5, 7, 9, 11, 12, 2**60 + 1]


def test_copies_in_large_groups(spark):
    """A chain of near copies, many exact copies, and texts that share half of their words."""
    words = [f"w{i}" for i in range(200)]
    chain = [" ".join(words[:i] + [f"new{j}" for j in range(i)] + words[i:]) for i in range(0, 40)]
    half = [" ".join(words[:100] + [f"own{k}x{i}" for i in range(100)]) for k in range(60)]
    texts = chain + half + [PROSE] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [near_set(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(100):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if 100 * n >= 85 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = [min(x, y) if r in (x, y) else r for r in root]
    root = [100 if i >= 100 else r for i, r in enumerate(root)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == root


def test_a_cloud_below_the_limit(spark):
    """Texts that share three quarters of their shingles with all others, some near copies among them: candidates grow with the texts, not with their pairs."""
    base = [f"w{i}" for i in range(60)]
    text = lambda k: " ".join(base[:54] + [f"own{k}x{j}" for j in range(6)])
    def run(n):
        rows = [(k, text(k)) for k in range(n)] + [(n + k, text(k) + " tail") for k in range(0, n, 50)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        met = []
        real = near_dup.part_blocks
        near_dup.part_blocks = lambda asked, *rest: (met.append(asked.count()), real(asked, *rest))[1]
        try:
            got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
        finally:
            near_dup.part_blocks = real
        assert got == {d: d - n if d >= n else d for d, _ in rows}
        return sum(met)

    assert run(2000) <= 5 * max(run(500), 50)


def test_near_duplicates_below_the_default(spark):
    """At 80 percent a pair may differ in size by more than 85 percent allow: 80 of 96 shingles shared, similarity 0.83."""
    texts = [" ".join(f"k{k}w{i}" for i in range(n)) for k in range(20) for n in (100, 84)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dup.keep_one(df, 80).collect()) == list(range(0, 40, 2))
    assert near_dup.keep_one(df).count() == 40


def near_set(text):
    words = text.split()
    return set(zip(*[words[i:] for i in range(5)]))


def test_quality(docs, none):
    rows = {r.doc_id: r for r in line_rules.quality_report(docs).collect()}
    assert rows[3].n_words == rows[4].n_words == rows[5].n_words == 0 and rows[3].base_failed
    assert rows[1].kept and rows[1].word_chars == len(PROSE.replace(" ", ""))
    assert rows[2**60 + 1].n_dup_lines == 399 and rows[2**60 + 1].n_repeat_words == 1600 and not rows[2**60 + 1].kept
    assert rows[12].n_words == 120 and rows[12].word_chars == 120 and rows[12].n_repeat_words == 120
    assert line_rules.quality_report(none).count() == 0
    good = line_rules.keep_good(docs)
    assert good.columns == docs.columns and sorted(r.doc_id or 0 for r in good.collect()) == [0, 1, 2, 6, 7, 8, 8]


def test_frequent_lines(spark):
    body = lambda k: "\n".join(" ".join(f"t{k}x{i}y{j}" for j in range(12)) for i in range(5))
    common = "please accept our cookies " * 12
    rows = [(k, f"{common}\n{body(k)}", "h") for k in range(40)] + [(100 + k, f"{common.upper()}\nown {k} words", "h") for k in range(40)]
    rows += [(200 + k, f"{common}\nrare host {k}", "g") for k in range(5)] + [(300 + k, rows[0][1], "h") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = {r.doc_id: r for r in line_rules.judge(df, min_words=10).withColumn("kept", ~F.col("base_failed") & F.col("kept")).collect()}
    plain = line_rules.judge(df, min_words=10, host_share=0.3).drop("base_failed")
    removed = {r.doc_id: r.removed_words for r in plain.collect()}
    assert all(removed[k] == 0 for k in [0, *range(200, 205), *range(300, 330)])  # the owner and its copies, a host below the limit
    assert all(removed[k] == 48 for k in [*range(1, 40), *range(100, 140)])
    assert judged[5].removed_lines == [0]
    text = df.filter("doc_id = 5").select(line_rules.without_lines(F.col("text"), F.lit([0]).cast("array<int>")).alias("t")).first().t
    assert text == body(5)


def test_frequent_lines_of_a_large_host(spark, monkeypatch):
    """A banner of 100 documents goes, however many documents the host has; so it does where its rows are cut in parts."""
    from goldthread.operators import skew

    banner = "please accept our cookies " * 10
    rows = [(k, (f"{banner}\n" if k % 25 == 0 else "") + " ".join(f"w{k}x{j}" for j in range(60)), "h") for k in range(2500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {k: 40 if k % 25 == 0 and k else 0 for k in range(2500)}
    assert {r.doc_id: r.removed_words for r in line_rules.judge(df).collect()} == want
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 10)
    assert {r.doc_id: r.removed_words for r in line_rules.judge(df).collect()} == want


def test_decontamination(spark, docs, none):
    item = " ".join(f"word{i}" for i in range(5, 17))
    items = spark.createDataFrame([
        (1, item), (2, None), (3, ""), (4, "one two THREE"), (5, "😀"), (10, "term1, term2-term3"), (11, item), (4, "term7 term8 term9 term10 nothere"),
    ], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.contamination(docs, items).collect()}
    sha = lambda s: spark.sql(f"SELECT sha2('{s}', 256) AS s").first().s
    assert (rows[1].n_hit, rows[1].n_items, rows[1].items_sha256) == (12, 2, sha("1,11"))
    assert rows[2].n_hit == 12 and rows[3].n_words == 0 and not rows[3].contaminated and rows[3].items_sha256 == sha("")
    assert rows[9].n_hit == 3 and rows[9].items_sha256 == sha("4") and rows[7].n_hit == 3 and rows[12].n_hit == 30
    assert rows[11].n_words == 2 and not rows[11].contaminated
    assert decontaminate.contamination(none, items).count() == 0
    assert not decontaminate.contamination(docs, items.filter("false")).filter("contaminated").count()
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 11, 2**60 + 1]


def test_mix(docs, none):
    rows = mix.mix_report(docs).collect()
    assert len(rows) == 15 and all(r.taken <= 2 * r["size"] for r in rows)
    targets = {r.source: (r.source_size, r.target) for r in rows}
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
    total = sum(s for s, _ in targets.values())
    assert sum(t for _, t in targets.values()) == pytest.approx(1.5 * total) and targets["b"] == (0, 0.0)
    assert mix.mix_report(none).count() == 0
    mixed = mix.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = mixed.select(mix.text_size().alias("n")).agg(F.sum("n")).first()[0]
    assert words == sum(taken.values())


def test_flight_keeps_totals():
    import random

    sizes = [random.Random(1).randint(1, 900) for _ in range(500)]
    units = [[0.37, 1.0, float(s)] for s in sizes]
    held = mix.fly(units, random.Random(2))
    assert len(held) <= 2
    assert sum(u[0] for u in units) == pytest.approx(0.37 * 500) and sum(u[0] * u[2] for u in units) == pytest.approx(0.37 * sum(sizes))
    mix.land(units, held, 0.37 * sum(sizes))
    assert {u[0] for u in units} <= {0, 1} and abs(sum(u[0] * u[2] for u in units) - 0.37 * sum(sizes)) <= 2


def test_many_blocks(spark):
    rows = spark.range(3000).select(F.lit(1).alias("rank"), F.col("id").alias("doc_id"), (F.col("id") % 97 + 1).alias("size"),
                                    F.lit(1).cast("long").alias("n_rows"), F.lit(0.3).alias("p"))
    out = mix.sample(rows, block_rows=100).agg(F.count("*"), F.sum("p"), F.sum(F.col("p") * F.col("size")), F.sum("size")).first()
    assert out[0] == 3000 and abs(out[1] - 900) <= 3 and abs(out[2] - 0.3 * out[3]) <= 3


def test_shards(docs, none):
    rows = ring.shard_documents(docs).collect()
    assert len(rows) == 15 and ring.shard_documents(none).count() == 0
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min([counts[s] for s in range(8)]) <= 1
    assert next(r for r in rows if r.doc_id == 3)["size"] == 1 and next(r for r in rows if r.doc_id == 3).text_crc32 == 0


def test_bounded_loads(spark):
    """Loads stay below the limit; more slack moves fewer rows when a shard is added."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 + 1).alias("load"))
    moved = {}
    for slack in (0.0, 0.25):
        eight = {r.doc_id: (r.shard, r.load) for r in ring.assign_shards(rows, "doc_id", "load", 8, slack=slack).collect()}
        nine = {r.doc_id: r.shard for r in ring.assign_shards(rows, "doc_id", "load", 9, slack=slack).collect()}
        loads = collections.Counter()
        for shard, load in eight.values():
            loads[shard] += load
        assert max(loads.values()) <= (1 + slack) * sum(loads.values()) / 8 + 3 * 50
        moved[slack] = sum(eight[d][0] != nine[d] for d in eight) / 4000
    assert moved[0.25] < moved[0.0] < 0.5 and moved[0.25] < 0.25


def test_hot_id_is_spread(spark):
    rows = spark.range(900).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"))
    counts = [r["count"] for r in ring.shard_documents(rows).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1


def test_lines(docs, none):
    rows = line_dedup.find_lines(docs).collect()
    first = {(r.doc_id, r.line_no): (r.first_doc, r.first_line, r.kept) for r in rows}
    assert first[2, 0] == (1, 0, False) and first[6, 0] == (1, 0, False) and first[7, 0] == (7, 0, True) and first[None, 0] == (7, 0, False)
    assert first[10, 0] == (9, 0, False) and first[2**60 + 1, 399] == (2**60 + 1, 0, False) and (3, 0) not in first
    assert line_dedup.find_lines(none).count() == 0
    left = line_dedup.drop_lines(docs)
    texts = {r.doc_id: r.text for r in left.collect()}
    assert left.columns == docs.columns and left.count() == 15
    assert texts[1] == PROSE and texts[2] == "" and texts[3] is None and texts[5] == " \n\t " and texts[2**60 + 1] == "line one is here\n"


def test_lines_read_every_character(spark):
    """Lines that differ only behind the 8th character of a word, or have no spaces, are told apart; near copies of such lines are found."""
    poem = "床前明月光疑是地上霜举头望明月低头思故乡白日依山尽黄河入海流欲穷千里目更上一层楼"
    apart = [
        "https://example.com/products/shoes", "https://example.com/about", "user_id=1234", "user_id=99", "2024-01-05", "2024-01-17",
        poem[:8] + "春眠不觉晓处处闻啼鸟", poem[:8] + "红豆生南国春来发几枝", "internationalization matters", "internationally known",
    ]
    near = [(poem * 2 + "甲", poem * 2 + "乙"), ("x" + poem * 2, "y" + poem * 2), ("/".join(f"p{i}" for i in range(40)), "/".join(f"p{i}" for i in range(41)))]
    lines = apart + [line for pair in near for line in pair] + ["short", "SHORT"]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    n, first = len(apart), {r.doc_id: r.first_doc for r in line_dedup.find_lines(df).collect()}
    assert [first[i] for i in range(n)] == list(range(n))
    assert [first[i] for i in range(n, len(lines))] == [n + 0, n + 0, n + 0, n + 0, n + 4, n + 4, n + 6, n + 6]


def test_short_lines_share_a_band(spark):
    """The hash functions are independent: of 5,000 pairs of short lines about as many share no band as (1 - s ** 3) ** 8 says."""
    import random

    pick = random.Random(5)
    rows = []
    for i in range(10_000):
        text = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=17))
        rows += [(i, 0, text[:16 if i < 5000 else 15]), (i, 1, text)]  # 9 or 8 of 10 shingles
    lines = spark.createDataFrame(rows, "k1 long, k2 long, line string")
    bands = line_dedup.signatures(lines).withColumn("bands", F.array(*[f"b{i}" for i in range(line_dedup.BANDS)]))
    both = bands.filter("k2 = 0").select("k1", F.col("bands").alias("a")).join(bands.filter("k2 = 1").select("k1", F.col("bands").alias("b")), "k1")
    missed = [r.k1 < 5000 for r in both.filter(~F.arrays_overlap("a", "b")).select("k1").collect()]
    assert sum(missed) <= 2 and len(missed) - sum(missed) <= 30, (sum(missed), len(missed) - sum(missed))


def test_long_lines_share_a_band(spark):
    """Of 1,000 pairs of 200 shingles at similarity 0.82 about as many share no band of bins as (1 - s ** 3) ** 8 says; no list of pieces is made."""
    import random

    pick = random.Random(7)
    word = lambda n: "".join(pick.choices("abcdefghijklmnopqrstuvwxyzé😀", k=n))
    rows = []
    for i in range(1000):
        text = word(207)
        rows += [(i, 0, text, 207), (i, 1, text[20:] + word(20), 207)]  # 180 of 220 shingles
    lines = spark.createDataFrame(rows, "k1 long, k2 long, line string, n_chars long")
    found = line_dedup.buckets_of(lines)
    assert "regexp" not in line_dedup.bin_signatures(lines)._jdf.queryExecution().toString()
    bands = found.select("k1", "k2", F.explode("buckets").alias("bucket")).filter("bucket IS NOT NULL")
    met = bands.groupBy("k1", "bucket").agg(F.countDistinct("k2").alias("n")).filter("n = 2").select("k1").distinct().count()
    assert met >= 990


def test_lines_that_repeat_themselves(spark):
    """A line written many times over has the shingles of the line, whatever its length; lines of one sign are apart."""
    import random

    pick = random.Random(8)
    rows = []
    for i in range(40):
        text = "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=pick.choice([50, 71, 90, 150, 250]))) + " "
        rows += [(2 * i, text * 3), (2 * i + 1, text * pick.choice([6, 11, 30]))]
    rows += [(100, "-" * 300), (101, "=" * 300), (102, "-" * 3000), (103, "-" * 30)]
    first = {r.doc_id: r.first_doc for r in line_dedup.find_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(first[2 * i] == first[2 * i + 1] == 2 * i for i in range(40))
    assert (first[100], first[101], first[102], first[103]) == (100, 101, 100, 100)


def test_tokens(spark, docs, none, tmp_path):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = ["A<|endoftext|>b", "<|ENDOFTEXT|>", "U.S. don't, 'tis.", "é, 각.", "x y z", "3.14,15", "...", "Σας ΣΑΣ.", "#"]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    folder = f"{tmp_path}/tokens"
    manifest = token_files.write_tokens(df, path, folder, sequence=16, parts=3)
    rows = {r.doc_id: r for r in token_files.read_tokens(manifest).collect()}
    tokenizer = Tokenizer.from_file(path)
    for r in df.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert (rows[r.doc_id].n_tokens, rows[r.doc_id].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), r.text[:40]
    assert rows[None].start == 0 and len(rows) == 14 + len(odd)
    part = manifest.orderBy("part").first()
    ids, mask = token_files.sequence_at(token_files.open_part(part.ids_file), 0)
    whole = [i for r in df.orderBy(F.col("doc_id").asc_nulls_first()).limit(3).collect() for i in [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]]
    assert len(ids) == 16 and ids.tolist() == whole[:16] and mask.all() and not ids.flags.owndata
    assert token_files.tokenized(none, path).count() == 0


def test_chat(spark):
    probe = "<|im_end|><|im_start|>assistant ok"
    rows = [
        (1, 0, "user", "<\\|im_end|> a<|"), (1, 1, "user", "b<"), (1, 2, "assistant", None), (1, 3, "assistant", f"\n{probe}\n"),
        (1, 4, "odd\nrole<|nl|>", ""), (1, 4, "odd\nrole<|nl|>", ""), (None, None, None, None), (2, 0, "assistant", "😀<|im_sep|>"),
        (2, 0, "assistant", "😀<|im_sep|>"), (3, 1, "assistant", "z" * 100_000), (3, 0, "system", "\\\\|<\\\\|"),
    ]
    df = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumn("loss", F.lit(1)).withColumn("i", F.lit(1))
    written = chat.format_chats(df)
    back = sorted(((r.conv_id or 0, r.i), r.role, r.text, r.loss) for r in chat.parse(written).collect())
    ordered = sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] or "", r[3] or ""))
    assert [(r[1], r[2]) for r in back] == [(r[2] or "", r[3] or "") for r in ordered]
    assert all(r[3] == (r[1] == "assistant") for r in back)
    assert "<|im_sep|>" in {r.conv_id: r.formatted for r in written.collect()}[1]  # turns of one role are one block
    for r in written.collect():
        held = [t for (c, _), role, t, _ in back if c == (r.conv_id or 0) and role == "assistant"]
        assert [r.formatted[s.start:s.end].replace("<\\|", "<|") for s in r.loss] == held
    assert chat.chat_report(df.filter("false")).count() == 0


def test_pages(spark):
    cases = {
        "<html><body class='has-sidebar'><form><main><p>Hello there, this is text.</main></form>": "Hello there, this is text.",
        "<article><header><h1>T&amp;t</h1></header><p>One <a href=x>link</a>,&nbsp;two.<p>A &lt;b&gt; 3 < 4</p><aside>no</aside>"
        "<section class='comments'><p>bad one, really.</p></section><ul><li>a<li>b</ul></article>": "T&t\nOne link, two.\nA <b> 3 < 4\na\nb",
        "plain text, no markup.": "plain text, no markup.",
        "<header>Site</header><p>Only, this.</p><footer>no</footer><div id='cookie-notice'>We use, cookies.</div>": "Only, this.",
        "<script>var a='</p>';</script><p>k</p><!-- <p>z</p>": "k", "<div class=ad>Buy, now.<article><p>x y, z.</article>": "x y, z.",
        "<article><p>a<script>b</script>c</p><table><tr><td>1<td>2</table></article>": "ac\n1\n2", "": "", "<p></p>": "", "<": "<",
        "<article>" + "<b>" * 5000 + "deep, text" + "</article>": "deep, text", "<p>" + "long text, " * 30_000 + "</p>": ("long text, " * 30_000).strip(),
        "<article><p>kept, text</p></article><div class='reader-comments'><article class='comment'><p>not, this</p></article></div>": "kept, text",
    }
    rows = [(i, None if i == 0 else "u", h) for i, h in enumerate(cases)] + [(99, "u", None), (None, "u", "<p>x</p>"), (None, "u", "<p>x</p>")]
    df = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = collections.defaultdict(list)
    for r in main_text.extract(df).collect():
        got[r.page_id].append(r.text)
    assert [got[i][0] for i in range(len(cases))] == list(cases.values()) and got[99] == [""] and got[None] == ["x", "x"]
    assert main_text.extract(df.filter("false")).count() == 0


def test_ratios_drop_link_lists(spark):
    links = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(30))
    body = "<p>A long paragraph, with many words and marks, that goes on. And on, for a while.</p>" * 6
    assert main_text.main_text(f"<div><ul>{links}</ul></div><div>{body}</div>") == "\n".join(
        ["A long paragraph, with many words and marks, that goes on. And on, for a while."] * 6)
    listed = "<article><h1>A</h1><ul>" + "<li>1</li>" * 9 + f"</ul>{body}<p><a href='/x'>more</a></p></article>"
    assert main_text.main_text(listed).split("\n")[:10] == ["A"] + ["1"] * 9 and main_text.main_text(listed).endswith("\nmore")


def test_scores_decide_beside_markup():
    """Names and marked elements are terms of the score: teasers, a story outside its article, odd names, links inside an article."""
    story = "<p>A long paragraph, with many words and marks, that goes on. And on, for a while.</p>" * 6
    text = "\n".join(["A long paragraph, with many words and marks, that goes on. And on, for a while."] * 6)
    teaser = "<article><h3><a href='/x'>Another story</a></h3><p>It is short, read on.</p></article>"
    assert main_text.main_text(f"<body>{teaser}<div>{story}</div>{teaser}</body>") == text
    assert main_text.main_text(f"<article><h1>The heading of it</h1></article><div>{story}</div>") == f"The heading of it\n{text}"
    for name in ("class='share-price'", "id='notice-of-appeal'", "class='skip-list'"):
        assert main_text.main_text(f"<nav><a href='/'>Home</a></nav><article>{story.replace('<p>', f'<p {name}>')}</article>") == text
    links = "".join(f"<li><a href='/{i}'>Another story of the day, number {i}</a></li>" for i in range(12))
    assert main_text.main_text(f"<article>{story}<ul>{links}</ul><p><a href='/x'>more</a></p></article>") == f"{text}\nmore"
    inline = story.replace("many words", "<a href='/w'>many words</a>")
    assert main_text.main_text(f"<article>{inline}</article>") == text
    advert = "<div class='ad-slot'><p>Buy this, now. It is cheap, it is good, and it is here.</p></div><p class='advert'>Buy that, too. Cheap, good.</p>"
    comments = "<section id='reader-comments'><p>I do not think so, at all. Not for a while.</p></section>"
    assert main_text.main_text(f"<article>{story}{advert}{comments}</article>") == text
    assert main_text.main_text(f"<div>{story}</div>{comments}{advert}<footer>All rights, and so on.</footer>") == text
    assert main_text.main_text("<nav><a href='/'>Home</a></nav><article></article><footer>All rights.</footer>") == ""


def test_archive(spark, tmp_path):
    rows = [(1, None, None), (2, "http://x/\r\nWARC-Type: no", ""), (3, "u", "é<p>"), (5, "u", "é<p>"), (4, "u", "é<p>"), (6, "v", "x\r\n\r\ny"),
            (6, "v", "x\r\n\r\ny"), (None, "v", "alone"), (7, "w", "long " * 100_000), (2**60 + 1, "w", "é<p>")]
    df = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    manifest = warc.write_warc(df, f"{tmp_path}/a", shard_bytes=100_000, roll_bytes=400)
    read = warc.read_warc(manifest).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in read)
    big = 2**60 + 1
    assert kinds == [(0, "response", None), (1, "revisit", 2), (2, "response", None), (3, "revisit", big), (4, "revisit", big), (5, "revisit", big),
                     (6, "response", None), (6, "revisit", 6), (7, "response", None), (big, "response", None)]
    assert {r.html for r in read} - {None} == {"", "é<p>", "x\r\n\r\ny", "alone", "long " * 100_000}
    again = warc.write_warc(df, f"{tmp_path}/b", shard_bytes=100_000, roll_bytes=400, parts=2)
    name = lambda m: sorted((r.file.rsplit("/", 1)[1], r.sha1) for r in m.collect())
    assert name(manifest) == name(again)  # the files do not depend on the tasks
    assert warc.archive_report(df.filter("false")).count() == 0


def test_archive_ranges_are_even(spark, tmp_path):
    """One id far away, ids in two clusters, and many null ids: ranges are cut by bytes."""
    rows = [(i, "u", f"page {i} " * 40) for i in range(2000)] + [(10**15, "u", "far"), *((10**9 + i, "u", f"x{i} " * 60) for i in range(2000))]
    rows += [(None, "u", f"no id {i} " * 30) for i in range(4000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_warc(df, f"{tmp_path}/a", shard_bytes=300_000, roll_bytes=1 << 20)
    sizes = [r.n for r in manifest.groupBy("range").agg(F.sum("n_records").alias("n")).collect()]
    assert len(sizes) > 8 and max(sizes) < 2.5 * sum(sizes) / len(sizes) and sum(sizes) == len(rows)
    read = warc.read_warc(manifest)
    assert sorted(((r.page_id is None, r.page_id or 0, r.html) for r in read.collect())) == sorted((i is None, i or 0, h) for i, _, h in rows)


def test_pipeline_on_odd_rows(spark, docs, none):
    items = spark.createDataFrame([(1, "no such words are in it")], "item_id long, text string")
    import tempfile

    folder = tempfile.mkdtemp()
    items.write.parquet(f"{folder}/benchmark.parquet")
    for start in (docs, none):
        now = start
        for _, step in corpus_pipeline.STAGES[:-1]:
            now = step(spark, now, folder)
            assert now.columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, now, folder).count() == now.count()


@pytest.mark.parametrize("name,cuts", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_tokens_of_two_tokenizers(name, cuts):
    """Chunks are cached only where the tokenizer treats them on their own; the ids are those of the whole text."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    encoder, whole = token_files.Encoder(path), Tokenizer.from_file(path)
    texts = ["Two  WORDS", " a\n\nB\tc ", "d'été, 12.5%!", "", "The <|endoftext|> mark", PROSE, "x" * 5000 + " Y"] * 2
    assert encoder.cuts == cuts
    assert [i.tolist() for i in encoder.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_conversations(spark):
    """Time grows in proportion to the turns of one conversation; 100,000 turns come back whole."""
    import time

    def report(n):
        turns = spark.range(n).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn <|im_sep|> ', id) AS text")
        began = time.perf_counter()
        row = chat.chat_report(turns).first()
        assert row.n_turns == n and row.loss_chars == sum(len(f"turn <|im_sep|> {i}") for i in range(1, n, 2))
        return time.perf_counter() - began

    report(1000)
    short, long = report(10_000), report(100_000)
    assert long < 20 * short + 5 and long < 60
