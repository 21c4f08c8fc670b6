"""As-of joins, incremental components, re-keying in runs, key graphs, matching in rounds, name candidates at size."""

import json
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from goldthread.functions.similarity import _jaro_winkler
from goldthread.operators import components as cc, documents as dc, erasure as er, keys as ky, similar as sm, sketches as sk, skew
from goldthread.operators.asof import as_of_join
from goldthread.operators.merge import DuplicateKeys
from goldthread.session import stage


@pytest.mark.parametrize("strict,forward", [(False, False), (True, False), (False, True), (True, True)])
def test_as_of_join(spark, strict, forward):
    """A hot key, null keys and times, values at the same time, keys without values, over several slices."""
    r = random.Random(5)
    key = lambda: 0 if r.random() < 0.4 else r.choice([1, 2, 3, 4, 5, None])
    rows = [(i, key(), r.choice([None, *range(60)])) for i in range(400)]
    values = [(key() if i else 9, r.choice([None, *range(60)]), i) for i in range(250)]
    a, b = spark.createDataFrame(rows, "id long, k int, at int").repartition(7), spark.createDataFrame(values, "k int, since int, v int").repartition(5)
    out = as_of_join(a, b, ["k"], "at", "since", {"v": "v", "double": F.col("v") * 2}, strict, forward, ["v"])
    want = {}
    for i, k, t in rows:
        fits = [(s, v) for kk, s, v in values if kk == k and None not in (k, s, t) and (s < t if strict else s <= t)]
        if forward:
            fits = [(-s, v) for kk, s, v in values if kk == k and None not in (k, s, t) and (s > t if strict else s >= t)]
        want[i] = max(fits)[1] if fits else None
    got = out.collect()
    assert {x["id"]: x["v"] for x in got} == want and len(got) == 400
    assert all(x["double"] == (x["v"] and 2 * x["v"]) for x in got) and out.columns == ["id", "k", "at", "v", "double"]


def test_components_grow_and_shrink_like_a_full_run(spark, rows):
    r = random.Random(8)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)]
    frame = lambda e: spark.createDataFrame(e, "src long, dst long")
    full = lambda e, nodes: rows(cc.with_singletons(cc.connected_components(frame(e)), spark.createDataFrame([(n,) for n in nodes], "node long")), "node", "root")
    roots, seen = spark.createDataFrame([], "node long, root long"), []
    for batch in (edges[:20], edges[20:25], edges[25:]):
        roots, seen = cc.add_edges(roots, frame(batch)), seen + batch
        assert rows(roots, "node", "root") == full(seen, {n for e in seen for n in e})
    nodes = {n for e in edges for n in e}
    for gone in (edges[:10], edges[30:45]):
        seen = [e for e in seen if e not in gone]
        roots = cc.remove_edges(roots, frame(seen), frame(gone))
        assert rows(roots, "node", "root") == full(seen, nodes)


def test_a_batch_reads_only_what_it_joins(spark, rows):
    roots = spark.range(1000).select(F.col("id").alias("node"), (F.col("id") - F.col("id") % 10).alias("root"))
    moves, fresh = cc.root_moves(roots, spark.createDataFrame([(5, 25), (25, 2000), (7, 8), (3000, 3001)], "src long, dst long"))
    assert rows(moves) == [(20, 0)] and rows(fresh) == [(2000, 0), (3000, 3000), (3001, 3000)]


def test_keys_move_once_per_run(spark, rows):
    table = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, None), (5, "Z")], "id int, k string")
    moves = lambda *m: spark.createDataFrame(list(m), "run int, old_key string, new_key string")
    one = lambda *m: rows(ky.repoint(table, "k", moves(*m).drop("run")))
    assert one((1, "A", "B"), (1, "B", "C")) == [(1, "B"), (2, "C"), (3, "C"), (4, None), (5, "Z")]
    assert one((1, "A", "B"), (1, "B", "A"))[:2] == [(1, "B"), (2, "A")]
    with pytest.raises(DuplicateKeys):
        one((1, "A", "B"), (1, "A", "C"))
    several = lambda *m: rows(ky.final_keys(moves(*m)))
    assert several((1, "A", "B"), (2, "B", "C"), (3, "C", "A")) == [("A", "A"), ("B", "A"), ("C", "A")]
    assert several((2, "A", "B"), (1, "B", "C")) == [("A", "B"), ("B", "C")]
    assert several((1, "A", "B"), (1, "B", "A"), (2, "B", "X")) == [("A", "X"), ("B", "A")]
    chain = [(i, f"k{i}", f"k{i + 1}") for i in range(30)]
    assert several(*chain) == sorted((f"k{i}", "k30") for i in range(30))
    with pytest.raises(DuplicateKeys):
        several((1, "A", "B"), (1, "A", "C"))


def test_cascade_over_a_key_graph(spark, rows):
    t = lambda data, ddl: spark.createDataFrame(data, ddl)
    tables = {
        "person": t([(1,), (2,), (3,)], "p int"), "account": t([(10, 1), (20, 2), (30, None)], "a int, owner int"),
        "entry": t([(100, 10), (200, 20), (300, 30), (400, None)], "e int, acc int"), "note": t([(100, 1), (300, 3)], "entry int, person int"), "other": t([(1,)], "x int")}
    links = [er.KeyLink("entry", "note", {"entry": "e"}), er.KeyLink("account", "entry", {"acc": "a"}), er.KeyLink("person", "account", {"owner": "p"}), er.KeyLink("person", "note", {"person": "p"})]
    out = er.cascade_graph(tables, links, {"person": t([(1,), (None,)], "p int"), "other": t([(1,)], "x int")})
    assert {n: [r[0] for r in rows(d)] for n, d in out.items()} == {"person": [2, 3], "account": [20, 30], "entry": [200, 300, 400], "note": [300], "other": []}
    with pytest.raises(ValueError, match="circle"):
        er.cascade_graph(tables, [*links, er.KeyLink("note", "person", {"p": "person"})], {"person": t([(1,)], "p int")})


def matched(spark, lefts, rights):
    frame = lambda rows, side: spark.createDataFrame(rows, f"list int, {side} string, _leaf string")
    return {(r["_left"], r["_right"]) for r in dc.match_elements(frame(lefts, "_left"), frame(rights, "_right"), ["list"]).collect()}


def test_elements_that_share_most_leaves_are_paired(spark, monkeypatch):
    lefts = [(1, "a", x) for x in "pqr"] + [(1, "b", x) for x in "pxs"] + [(2, "a", "p")]
    rights = [(1, "A", x) for x in "pqz"] + [(1, "B", x) for x in "xsp"] + [(2, "C", "q")]
    assert matched(spark, lefts, rights) == {("a", "A"), ("b", "B")}
    monkeypatch.setattr(dc, "PAIRS_PER_LEAF", 0)  # all leaves count as common
    assert len(matched(spark, lefts, rights)) == 2


def test_a_long_list_with_a_common_leaf(spark):
    """100,000 changed elements that all share one leaf; half of them share a second one with one partner."""
    n = 100_000
    side = lambda name, own: spark.range(n).select(
        F.lit(1).alias("list"), F.concat(F.lit(own), "id").alias(name), F.explode(F.array(
            F.lit("common"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("pair"), "id")).otherwise(F.concat(F.lit(own), "id")))).alias("_leaf"))
    out = dc.match_elements(side("_left", "l"), side("_right", "r"), ["list"])
    assert out.count() == n == out.select("_left").distinct().count() == out.select("_right").distinct().count()
    own = F.substring("_left", 2, 9)
    assert out.filter((own.cast("int") % 2 == 0) & (own != F.substring("_right", 2, 9))).count() == 0


def test_documents_of_any_shape(spark, rows):
    def diff(left, right, **rules):
        frame = lambda bodies: spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(bodies)], "id long, j string")
        return [tuple(r) for r in rows(dc.document_diff(frame(left), frame(right), ["id"], "j", dc.CompareRules(**rules)))]

    assert diff([[1, 2]], [[1, 3]]) == [(0, "[1]", "value", "2", "3")]
    assert diff([[1, 2], 5], [[1], 6]) == [(0, "", "length", "2", "1"), (0, "[1]", "missing_right", "2", None), (1, "", "value", "5", "6")]
    a, b = {"a": {"x": 1, "y": {"z": [1, {"q": None}]}}}, {"a": {"y": {"z": [1, {"q": None}]}, "x": 1}}
    assert diff([a, {"a": 3}], [b, {"a": 3}]) == []
    b["a"]["y"]["z"][1] = {"q": "v"}
    assert diff([a, {"a": 3}], [b, {"a": "4"}]) == [(0, "a.y.z[1].q", "missing_left", None, "v"), (1, "a", "type", "3", "4")]
    assert diff([{"a": 1.5}, {"a": "t"}, {"a": []}], [{"a": 10.25}, {"a": "t"}, {"a": {}}]) == [(0, "a", "value", "1.5", "10.25"), (2, "a", "type", "0", "{}")]
    assert diff([{"a": [{"k": 1}]}, {"a": 1}], [{"a": {"k": 1}}, {"a": 1}], unwrap_single=True) == []
    left, right = {"l": [{"k": 1, "v": "x"}, {"k": 2, "v": "y"}]}, {"l": [{"k": 2, "v": "z"}, {"k": 1, "v": "x"}]}
    assert [r[2:] for r in diff([left, {"l": "t"}], [right, {"l": "t"}], unordered=("l",))] == [("value", "y", "z")]


def test_few_name_pairs_are_scored(spark):
    """Names of common parts in one block: under 5 % of the pairs, and every pair of a sample that is similar."""
    r = random.Random(2)
    parts = ["an", "ma", "ri", "jo", "el", "ka", "the", "son", "ber", "li", "to", "wil", "ro", "chris", "ti", "na", "dor", "es", "ham", "ford"]
    names, n = set(), 4000
    while len(names) < n:
        name = "".join(r.choice(parts) for _ in range(r.randint(2, 4)))
        if r.random() < 0.3:
            i = r.randrange(len(name))
            name = name[:i] + r.choice("abcdefghijklmnopqrstuvwxyz") + name[i + 1:]
        names.add(name.upper())
    names = sorted(names)
    frame = spark.createDataFrame([("x", i, n) for i, n in enumerate(names)], "block string, id long, text string")
    found = stage(sm.jaro_candidates(frame, 0.9))
    assert found.count() < 0.05 * n * (n - 1) / 2
    sample = r.sample(range(n), 40)
    near = {(min(i, j), max(i, j)) for i in sample for j in range(n) if i != j and _jaro_winkler(names[min(i, j)], names[max(i, j)]) >= 0.9}
    asked = spark.createDataFrame([(i,) for i in sample], "id long")
    got = found.join(asked.withColumnRenamed("id", "id_a"), "id_a", "left_semi").unionByName(found.join(asked.withColumnRenamed("id", "id_b"), "id_b", "left_semi"))
    assert near and near <= {(p["id_a"], p["id_b"]) for p in got.collect()}


@pytest.mark.parametrize("threshold", [0.7, 0.85, 0.95])
def test_edit_join_by_grams_finds_every_pair(spark, rows, threshold):
    """Short texts sent through the grams: the same pairs as by segments and by brute force."""
    from test_matching import levenshtein, words

    texts = words(120, 13, high=16)
    df = spark.createDataFrame([("x", w) for w in texts], "block string, text string")
    want = sorted((p, q) for i, p in enumerate(texts) for q in texts[i + 1:] if 1 - levenshtein(p, q) / max(len(p), len(q)) >= threshold)
    assert rows(sm.edit_similar(df, threshold, long=0), "a", "b") == want == rows(sm.edit_similar(df, threshold, long=7), "a", "b") and (want or threshold > 0.9)


def test_long_texts_take_time_in_proportion(spark, rows):
    import time

    r = random.Random(6)
    def run(size):
        texts = [" ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(size // 5))[:size] for _ in range(24)]
        near = [t[:size // 2] + "zz" + t[size // 2 + 3:] for t in texts[:10]]
        df = spark.createDataFrame([("x", t) for t in texts + near], "block string, text string")
        began = time.perf_counter()
        found = rows(sm.edit_similar(df, 0.85), "a", "b")
        assert found == sorted(tuple(sorted(p)) for p in zip(texts, near))
        return time.perf_counter() - began

    run(100)
    assert run(1200) < 16 * run(300) + 10


def test_only_rows_that_may_match_move(spark, rows):
    from goldthread.operators import prefilter as pf

    table = spark.range(200_000).select((F.col("id") % 50_000).alias("k"), "id").unionByName(spark.createDataFrame([(None, -1)], "k long, id long"))
    keys = spark.createDataFrame([(k,) for k in range(0, 50_000, 100)] + [(None,), (10**12,)], "k long")
    passed = table.filter(pf.may_be_in(pf.key_bitmap(keys.na.drop(), ["k"]), ["k"])).count()
    assert 2000 <= passed < 0.05 * 200_000
    assert pf.semi_by_keys(table, keys, ["k"]).count() == 2000
    left = pf.without_keys(table, keys, ["k"])
    assert left.count() == 198_001 and left.filter("k % 100 = 0").isEmpty() and left.columns == ["k", "id"]
    assert pf.without_keys(table, keys.filter("false"), ["k"]).count() == 200_001 and pf.semi_by_keys(table, keys.filter("false"), ["k"]).count() == 0


def test_small_groups_have_small_distinct_sketches(spark, rows, monkeypatch):
    """Nulls are left out, an empty text is a value, a group of nulls has none; no group holds all registers of the sketch."""
    small = spark.createDataFrame(
        [(1, v) for v in ("a", "b", "b", "", None)] + [(2, None)] + [(None, "a")], "g int, v string")
    found = small.groupBy("g").agg(sk.approx_distinct("v", 0.01).alias("n"))
    assert rows(found) == sorted([(1, 3), (2, 0), (None, 1)], key=repr)
    many = spark.range(40000).select(sk.approx_distinct(F.col("id") % 20000, 0.01).alias("n")).first()["n"]
    assert abs(many - 20000) <= 3 * 0.01 * 20000
    plans = []

    def watched(df, label="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(skew, "stage", watched)
    queries = entry_points.queries()
    ask = lambda name: rows(queries[name](spark, "/root/testdata/sf0.001"))
    assert ask("wn8_approx_distinct_in_group") == ask("wn7_distinct_in_group")
    assert "hll_sketch_agg" in plans[0] and "approx_count_distinct" not in plans[0]


def test_member_sets_need_no_sort(spark, rows):
    """Equal, larger, smaller and null members; one aggregate per level instead of a sorted full join."""
    table = lambda found: spark.createDataFrame(found, "k int, m int")
    left = table([(1, 1), (1, 1), (1, 2), (2, 1), (3, 1), (3, 2), (4, None), (None, 1), (5, 1)])
    right = table([(1, 2), (1, 1), (2, 1), (2, 2), (3, 1), (4, None), (None, 1), (6, 1)])
    found = er.same_members(left, right, ["k"], ["m"])
    assert rows(found) == sorted([
        (1, True, True, True), (2, False, False, True), (3, False, True, False), (4, False, False, False), (5, False, True, False),
        (None, False, False, False)], key=repr)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
