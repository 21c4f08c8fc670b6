import itertools
import random

import pytest
from pyspark.sql import functions as F

from goldthread.functions import text as tx
from goldthread.functions.similarity import _jaro_winkler
from goldthread.operators import components as cc, keys as ky, rules as ru, similar as sm


def words(n, seed, letters="abcde", low=1, high=9):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(low, high))) for _ in range(n // 3)]
    out = set(base)
    while len(out) < n:  # near copies
        w = list(r.choice(base))
        i = r.randrange(len(w))
        w[i:i + 1] = r.choice([[], [r.choice(letters)], [w[i], r.choice(letters)]])
        if w:
            out.add("".join(w))
    return sorted(out)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold,high", [(0.85, 24), (0.7, 12)])
def test_edit_join_finds_every_pair(spark, rows, threshold, high):
    texts = words(150, 7, high=high)
    df = spark.createDataFrame([("x", w) for w in texts] + [("y", w) for w in texts[:40]], "block string, text string")
    want = sorted((b, p, q) for b, ws in (("x", texts), ("y", texts[:40])) for p, q in itertools.combinations(sorted(ws), 2)
                  if 1 - levenshtein(p, q) / max(len(p), len(q)) >= threshold)
    assert rows(sm.edit_similar(df, threshold), "block", "a", "b") == want and want


@pytest.mark.parametrize("threshold", [0.7, 0.85, 0.92])
def test_jaro_candidates_hold_every_pair(spark, rows, threshold):
    texts = words(90, 11, high=10)
    df = spark.createDataFrame([("x", i, w) for i, w in enumerate(texts)], "block string, id long, text string")
    found = set(rows(sm.jaro_candidates(df, threshold), "id_a", "id_b"))
    need = {(i, j) for (i, p), (j, q) in itertools.combinations(enumerate(texts), 2) if _jaro_winkler(p, q) >= threshold}
    assert need and need <= found and len(found) < len(texts) * (len(texts) - 1) // 2


def test_too_low_a_threshold_is_refused(spark):
    df = spark.createDataFrame([("x", 1, "abc")], "block string, id long, text string")
    with pytest.raises(ValueError):
        sm.jaro_candidates(df, 0.5)


def test_known_jaro_winkler_values():
    assert round(_jaro_winkler("martha", "marhta"), 4) == 0.9611
    assert round(_jaro_winkler("dixon", "dicksonx"), 4) == 0.8133
    assert _jaro_winkler("", "a") == _jaro_winkler(None, "a") == 0.0


def people(spark, data):
    return spark.createDataFrame(data, "id long, market string, fn string, ln string, phone string")


PHONE = {"match_type": "MT1", "match_category": "name_key", "comparison_mode": "EXACT", "secondary_key": "phone", "threshold": 0.85,
         "requires_review": False, "priority": 2, "weight_component_a": 25, "weight_component_b": 25, "weight_contact": 50, "enabled": True}


def links(df, batch=None, **change):
    built = ru.rules_from_config([PHONE | change], market="market", first="fn", last="ln")
    return ru.match_links(df, built, batch=batch)


def test_star_links_give_the_components_of_all_pairs(spark):
    r = random.Random(3)
    data = [(i, r.choice("MN"), r.choice("ab"), r.choice("ab"), r.choice(["1", "2", None])) for i in range(60)]
    found = {x["node"]: x["root"] for x in cc.connected_components(ru.auto_edges(links(people(spark, data)))).collect()}
    groups = {}
    for i, m, f, l, p in data:
        if p:
            groups.setdefault((m, p, tuple(sorted((f, l)))), []).append(i)
    want = {i: min(g) for g in groups.values() if len(g) > 1 for i in g}
    assert found == want


def test_blank_names_on_a_shared_phone_do_not_match(spark):
    raw = people(spark, [(1, "M", " ", "--", "555"), (2, "M", "", None, "555")])
    keyed = raw.withColumns({"fn": tx.alnum_key(F.col("fn")), "ln": tx.alnum_key(F.col("ln"))})
    assert links(keyed).count() == 0


def test_swapped_names_match_and_a_disabled_rule_does_not(spark, rows):
    df = people(spark, [(1, "M", "A", "B", "5"), (2, "M", "B", "A", "5"), (3, "N", "A", "B", "5")])
    assert rows(links(df), "id", "anchor") == [(1, 1), (2, 1)]
    assert ru.rules_from_config([PHONE | {"enabled": False}]) == []


def test_review_links_make_no_edges(spark):
    df = people(spark, [(1, "M", "A", "B", "5"), (2, "M", "A", "B", "5")])
    found = links(df, requires_review=True)
    assert found.count() == 2 and ru.auto_edges(found).count() == 0


def test_blocks_without_a_batch_record_are_left_out(spark, rows):
    df = people(spark, [(1, "M", "A", "B", "5"), (2, "M", "A", "B", "5"), (3, "M", "A", "B", "6"), (4, "M", "A", "B", "6")])
    df = df.withColumn("fresh", F.col("id") == 4)
    assert rows(links(df, batch="fresh"), "id", "anchor") == [(3, 3), (4, 3)]


def test_fuzzy_names_in_a_hot_block(spark, rows):
    data = [(i, "M", n, "SMITH", "5") for i, n in enumerate(["JONATHAN", "JONATHON", "JONATHAN", "ZOE"])]
    found = links(people(spark, data), comparison_mode="FUZZY", threshold=0.95)
    assert {(a, b) for a, b in rows(found, "id", "anchor") if a != b} == {(0, 1), (1, 0), (2, 0)}


def test_colliding_token_sets_differ_with_the_separator(spark):
    df = spark.createDataFrame([("b", "ca"), ("ab", "c")], "f string, l string")
    none = F.lit(None).cast("string")
    keys = df.select(tx.sorted_name_key([(F.col("f"), F.col("l"), none)])["desc"].alias("d"),
                     tx.sorted_name_key([(F.col("f"), F.col("l"), none)], "")["desc"].alias("joined"))
    assert keys.select("d").distinct().count() == 2 and keys.select("joined").distinct().count() == 1


@pytest.mark.parametrize("first,last,full,want", [
    ("Ann", "Lee", "x", ["ann", "lee"]), (None, None, "Lee  Ann", ["ann", "lee"]), (None, None, "A B C", ["abc"]), ("null", "Lee", None, ["lee"]),
    ("山　田", "太郎", None, sorted(["山田", "太郎"])), (" ", "", "null", None), ("Ann", "ann", None, ["ann"])])
def test_name_tokens(spark, first, last, full, want):
    df = spark.createDataFrame([(first, last, full)], "f string, l string, w string")
    assert df.select(tx.name_tokens(F.col("f"), F.col("l"), F.col("w")).alias("t")).first()["t"] == want


def test_new_keys_are_the_same_after_a_rerun_and_known_keys_win(spark, rows):
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 3)], "node long, root long")
    known = spark.createDataFrame([(2, "K2", 5), (1, "K1", 9)], "node long, key string, at long")
    a = ky.assign_keys(members, known, "key", ["at", "node"], "D")
    out = rows(a, "node", "group_key", "is_new")
    assert [x[1:] for x in out[:2]] == [("K2", False)] * 2 and out[2][2] is True
    assert out == rows(ky.assign_keys(members, known, "key", ["at", "node"], "D"), "node", "group_key", "is_new")


def test_components_joining_two_known_keys_are_flagged(spark, rows):
    df = spark.createDataFrame([(1, "old", "a"), (2, "old", "b"), (3, "x", "b"), (4, None, "c"), (5, None, "d")], "id long, k string, new string")
    assert rows(ky.flag_conflicts(df, "new", {"bad": ["k"]}, ["id"]), "id", "bad") == [(1, True), (2, True), (3, False), (4, False), (5, False)]


def test_memberships_vanish_per_owner_not_per_market(spark, rows):
    now = spark.createDataFrame([(1, "P"), (2, "Q")], "owner long, program string")
    before = spark.createDataFrame([(1, "P"), (1, "Q"), (3, "P"), (4, "P")], "owner long, program string")
    gone = spark.createDataFrame([(4,)], "owner long")
    out = ky.membership_mapping(now, before, gone, ["owner"], ["program"])
    assert rows(out) == [(1, "P", "CREATE"), (1, "Q", "DELETE"), (2, "Q", "CREATE"), (4, "P", "DELETE")]


def test_person_rules_similar_english_names(spark, rows):
    df = spark.createDataFrame(
        [(1, "katherine", "lee"), (2, "katherina", "lee"), (3, "bob", "lee"), (4, "", ""), (5, "", "")], "id long, ef string, el string"
    ).withColumns({"market_code": F.lit("M"), "blocking_class": F.lit("Normal"), "email_key": F.lit("a@b.co"), "name_asc": F.lit(None).cast("string")})
    spec = ru.PersonRules(contacts={"Email": ("email_key",)}, english=("el", "ef"))
    found = ru.match_links(df, spec.build())
    assert rows(found, "id", "anchor", "rule") == [(1, 2, "EnglishName_Email_Match"), (2, 1, "EnglishName_Email_Match")]
