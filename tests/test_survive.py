import random

from pyspark.sql import functions as F

from goldthread.operators import master as ms, survive as sv


def test_best_record_does_not_depend_on_row_order(spark, rows):
    data = [(i % 5, i, random.Random(i).choice([None, 1, 2, 3])) for i in range(60)]
    facets = [sv.Facet("new", ("id", "at"), ("at", "id")), sv.Facet("old", ("id",), ("at", "id"), latest=False)]
    out = []
    for seed in (1, 2):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        out.append(rows(sv.best_record(spark.createDataFrame(shuffled, "k long, id long, at long"), ["k"], facets)))
    assert out[0] == out[1]


def test_priority_takes_the_first_condition_that_any_row_meets(spark, rows):
    df = spark.createDataFrame([("a", 1, True, 5), ("a", 2, False, 9), ("b", 3, False, 7), ("c", 4, False, None)], "k string, id long, good boolean, v long")
    assert rows(sv.priority_max(df, ["k"], [F.col("good"), None], "v", "m")) == [("a", 5), ("b", 7), ("c", None)]


def test_group_is_deleted_only_when_all_rows_are(spark, rows):
    df = spark.createDataFrame([("a", "DELETE"), ("a", "CREATE"), ("b", "DELETE"), ("c", None)], "k string, action string")
    assert rows(df.groupBy("k").agg(sv.group_action(F.col("action")).alias("x"))) == [("a", "CREATE"), ("b", "DELETE"), ("c", "CREATE")]


def test_golden_row_of_a_key_without_live_contributors(spark, rows):
    schema = "k string, id long, dead boolean, ts long, touched long, name string"
    df = spark.createDataFrame(
        [("a", 1, False, 5, 1, "x"), ("a", 2, False, 5, 1, "y"), ("a", 3, True, 9, 9, "z"), ("b", 4, True, 1, 7, "p"), ("b", 5, True, 2, 6, "q"), ("c", 6, False, None, 1, "r")], schema)
    out = sv.golden_rollup(df, ["k"], "dead", "ts", "id", "touched", ["name"])
    assert rows(out) == [("a", 2, "y", 2, False), ("b", 4, "p", 0, True), ("c", 6, "r", 1, False)]


def contact(i, value="v", source="S0", deleted=False, quality="ok", optin=1, flag=1, ts=1, update=1):
    return ("p", "mail", value, source, deleted, quality, optin, flag, ts, update, i, i)


CONTACT = ("person string, type_code string, value string, source_code string, is_deleted boolean, quality string, optin_date long, "
           "optin_flag long, source_timestamp long, update_dt long, record_id long, contact_id long")


def survivor(spark, *data):
    out = sv.contact_survivor(spark.createDataFrame(list(data), CONTACT), ["person"], sv.ContactRules(weak_sources=("W",)))
    return [r["contact_id"] for r in out.collect()]


def test_consent_date_decides_then_time(spark):
    assert survivor(spark, contact(1, optin=5, ts=1), contact(2, "w", optin=3, ts=9)) == [1]
    assert survivor(spark, contact(1, optin=5, ts=1), contact(2, "w", optin=5, ts=9)) == [2]


def test_trusted_sources_come_first(spark):
    assert survivor(spark, contact(1, source="W", optin=9, ts=9), contact(2, "w", optin=1, ts=1)) == [2]


def test_contacts_without_consent_fall_back_to_time(spark):
    assert survivor(spark, contact(1, optin=None, ts=1), contact(2, optin=None, ts=2, quality="bad")) == [1]


def test_mixed_groups(spark, rows):
    df = spark.createDataFrame([("a", 1, "P", "x"), ("a", 2, "Q", "y"), ("b", 3, "P", "z")], "k string, id long, kind string, name string")
    member = F.col("kind") == "P"
    assert rows(sv.blank_when_mixed(df, ["k"], member, ["name"], ["id"]), "id", "name") == [(1, None), (2, "y"), (3, "z")]
    assert rows(sv.drop_when_mixed(df, ["k"], member, F.col("kind") == "Q", ["id"]), "id") == [(2,), (3,)]


def test_unbind_clears_only_older_bindings(spark, rows):
    bound = spark.createDataFrame([(1, "x", 5, "x"), (2, "x", 9, "x"), (3, "y", 1, "y")], "owner long, addr string, ts long, shown string")
    gone = spark.createDataFrame([("x", 6), ("x", 3)], "addr string, ts long")
    after, owners = ms.unbind(bound, gone, ["addr"], "ts", ["shown"], "owner")
    assert rows(after, "owner", "shown") == [(1, None), (2, "x"), (3, "y")] and rows(owners) == [(1,)]


def test_late_parent_update_is_ignored_and_delete_blanks(spark, rows):
    schema = "k long, ts long, action string, name string, id string"
    old = spark.createDataFrame([(1, 5, "CREATE", "a", "i1"), (2, 5, "CREATE", "b", "i2"), (3, 5, "CREATE", "c", "i3")], schema)
    new = spark.createDataFrame([(1, 4, "CHANGE", "A", "x"), (2, 5, "DELETE", "B", "x"), (3, 9, "UNBIND", "C", "x"), (4, 1, "CREATE", "d", "i4")], schema)
    out = ms.upsert_parents(old, new, ["k"], "ts", "action", ["name"], keep=["id"])
    assert rows(out) == [(1, 5, "CREATE", "a", "i1"), (2, 5, "DELETE", None, "i2"), (3, 5, "CREATE", "c", "i3"), (4, 1, "CREATE", "d", "i4")]


def test_parent_that_lost_all_children(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "p long, c string")
    parents = spark.createDataFrame([(1,)], "p long")
    assert rows(ms.replace_children(old, old.limit(0), ["p"], parents)) == [(2, "b")]


def test_children_of_a_deleted_parent_are_blanked_with_its_time(spark, rows):
    schema = "p long, kind string, phone string, ts long, action string, parent_ts long"
    old = spark.createDataFrame([(1, "m", "5", 1, None, None), (2, "m", None, 1, None, None)], schema)
    new = spark.createDataFrame([(1, "m", "5", 2, "DELETE", 9), (2, "m", "", 2, "CHANGE", 9), (3, "m", "7", 2, "CREATE", 9)], schema)
    out = ms.replace_changed_children(old, new, ["p", "kind"], ["phone"], deleted=F.col("action") == "DELETE", blank=["phone"], ts="ts", deleted_at="parent_ts")
    assert rows(out, "p", "phone", "ts") == [(1, "", 9), (2, None, 1), (3, "7", 2)]
