import random

import pytest
from pyspark.sql import functions as F

from goldthread.operators import changes as ch, merge as mg

SCHEMA = "k long, v string, ts long"


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(request, spark):
    """Run a merge once with a source within the broadcast limit and once beyond it."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if request.param == "broadcast" else "-1")
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def tables(spark, seed):
    r = random.Random(seed)
    row = lambda k: (k, r.choice("abc"), r.choice([1, 2, 3, None]))
    t = [row(k) for k in range(0, 40) if r.random() < 0.7]
    s = [row(k) for k in range(20, 60) if r.random() < 0.7]
    return t, s, spark.createDataFrame(t, SCHEMA), spark.createDataFrame(s, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_merge_equals_a_dictionary(spark, rows, join_kind, seed):
    t, s, target, source = tables(spark, seed)
    model = {k: (k, v, ts) for k, v, ts in t}
    for k, v, ts in s:
        old = model.get(k)
        if old is None or old[2] is None or (ts is not None and ts > old[2]):
            model[k] = (k, v, ts)
    assert rows(mg.upsert_newer(target, source, ["k"], "ts")) == sorted(model.values(), key=repr)


def test_delete_when_and_no_insert(spark, rows, join_kind):
    t, s, target, source = tables(spark, 3)
    out = mg.merge(target, source, ["k"], insert=False, delete_when=lambda a, b: b["v"] == "a")
    src = {k: (k, v, ts) for k, v, ts in s}
    want = [src.get(k, (k, v, ts)) for k, v, ts in t if not (k in src and src[k][1] == "a")]
    assert rows(out) == sorted(want, key=repr)


def test_null_keys_match_only_on_request(spark, rows, join_kind):
    target = spark.createDataFrame([(None, "old", 1)], SCHEMA)
    source = spark.createDataFrame([(None, "new", 2)], SCHEMA)
    assert rows(mg.merge(target, source, ["k"], null_safe_keys=True)) == [(None, "new", 2)]
    assert len(rows(mg.merge(target, source, ["k"]))) == 2


def test_two_source_rows_for_one_key_are_refused(spark):
    with pytest.raises(mg.DuplicateKeys):
        mg.check_unique(spark.createDataFrame([(1, "a", 1), (1, "b", 2)], SCHEMA), ["k"])


def test_action_routing(spark, rows, join_kind):
    schema = "k long, name string, ts long, action string"
    target = spark.createDataFrame(
        [(1, "a", 10, "CREATE"), (2, "b", 10, "CREATE"), (3, "c", 10, "CREATE"), (4, "d", None, "CREATE"), (5, "e", 10, "CREATE")], schema
    ).withColumn("is_deleted", F.lit(False))
    source = spark.createDataFrame(
        [(1, "A", 11, "CHANGE"), (2, "B", 10, "CHANGE"), (3, "C", 5, "DELETE"), (4, "D", 1, "CREATE"), (6, "F", 1, "CHANGE"), (7, "G", 1, "DELETE")], schema)
    out = mg.route_actions(target, source, ["k"], "ts", "action", ["name"])
    assert rows(out) == [
        (1, "A", 11, "CHANGE", False),  # newer
        (2, "b", 10, "CREATE", False),  # same time: stale
        (3, None, 10, "DELETE", True),  # deletion at any time
        (4, "D", 1, "CREATE", False),  # target has no time
        (5, "e", 10, "CREATE", False),
        (6, "F", 1, "CHANGE", False),  # unknown key is inserted
    ]


@pytest.mark.parametrize("seed", [4, 5])
def test_diff_applied_to_the_old_snapshot_gives_the_new_one(spark, rows, seed):
    _, _, old, new = tables(spark, seed)
    diff = ch.snapshot_diff(old, new, ["k"])
    assert rows(ch.apply_changes(old, diff, ["k"])) == rows(new)
    assert rows(ch.snapshot_diff(new, new, ["k"])) == []


def test_net_codes(spark, rows):
    pairs = [("I", "I"), ("I", "U"), ("I", "D"), ("U", "I"), ("U", "U"), ("U", "D"), ("D", "I"), ("D", "U"), ("D", "D")]
    data = [(i, c, n) for i, p in enumerate(pairs) for n, c in enumerate(p)]
    out = ch.net_changes(spark.createDataFrame(data, "k long, CDC_CODE string, ts long"), ["k"], "ts")
    assert [c for _, c in rows(out, "k", "CDC_CODE")] == ["I", "I", "U", "U", "D", "U", "U", "D"]


def test_alignment_ignores_case_and_survives_bad_values(spark, rows):
    from pyspark.sql.types import StructType
    df = spark.createDataFrame([("1", "x"), ("bad", "y")], "ID string, extra string")
    out = mg.align_schema(df, StructType().add("id", "integer").add("name", "string"))
    assert rows(out) == [(1, None), (None, None)]


def test_replace_slice_twice_changes_nothing(spark, rows):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", None)], SCHEMA)
    fresh = spark.createDataFrame([(9, "z", 1)], SCHEMA)
    once = mg.replace_slice(t, fresh, F.col("ts") == 1)
    assert rows(once) == rows(mg.replace_slice(once, fresh, F.col("ts") == 1)) == [(2, "b", None), (9, "z", 1)]
