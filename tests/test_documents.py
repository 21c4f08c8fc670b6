import json

from pyspark.sql import functions as F

from goldthread.functions import jsonfn as jf
from goldthread.operators import documents as dc
from goldthread.session import stage


def frame(spark, *bodies):
    return spark.createDataFrame([(i, json.dumps(b) if not isinstance(b, (str, type(None))) else b) for i, b in enumerate(bodies)], "id long, j string")


def test_node_may_be_an_object_an_array_empty_or_missing(spark, rows):
    df = frame(spark, {"n": {"a": 1}}, {"n": [{"a": 1}, {"a": 2}]}, {"n": []}, {}, None, {"n": ""})
    got = jf.explode_list(df, jf.node(F.col("j"), "n"), "struct<a:int>", ["id"])
    assert rows(got.select("id", "item.a")) == [(0, 1), (1, 1), (1, 2)]
    kept = jf.explode_list(df, jf.node(F.col("j"), "n"), "struct<a:int>", ["id"], keep_empty=True)
    assert kept.select("id").distinct().count() == 6


def test_schema_is_inferred_from_all_rows(spark):
    df = frame(spark, {"a": 1}, {"b": {"c": ["x"]}}, "not json")
    parsed = df.select(F.from_json("j", jf.infer_schema(df, "j")).alias("d")).select("d.a", "d.b.c").collect()
    assert parsed[0]["a"] == 1 and parsed[1]["c"] == ["x"]


def diff(spark, rows, left, right, **rules):
    out = dc.document_diff(frame(spark, left), frame(spark, right), ["id"], "j", dc.CompareRules(**rules))
    return [r[1:] for r in rows(out)]


def test_values_types_and_missing_paths(spark, rows):
    assert diff(spark, rows, {"a": 1, "b": {"c": "x"}, "d": 1}, {"a": 2, "b": {"c": "x"}, "e": 1}) == [
        ("a", "value", "1", "2"), ("d", "missing_right", "1", None), ("e", "missing_left", None, "1")]


def test_null_and_empty_text(spark, rows):
    assert diff(spark, rows, {"a": ""}, {"a": None}) == []
    assert diff(spark, rows, {"a": "", "b": 1}, {"a": None, "b": 1}, null_equals_empty=False) != []


def test_ignored_and_trimmed_paths(spark, rows):
    assert diff(spark, rows, {"h": {"t": 1}, "n": " x"}, {"h": {"t": 2}, "n": "x "}, ignore=("h",), trim=("n",)) == []


def test_lists_by_place_by_key_and_by_content(spark, rows):
    a, b = {"l": [{"k": "x", "v": 1}, {"k": "y", "v": 2}]}, {"l": [{"k": "y", "v": 2}, {"k": "x", "v": 3}]}
    assert len(diff(spark, rows, a, b)) == 4
    assert diff(spark, rows, a, b, keyed={"l": "k"}) == [("l[x].v", "value", "1", "3")]
    c = {"l": list(reversed(a["l"]))}
    assert diff(spark, rows, a, c, keyed={"l": "*"}) == []


def test_nested_lists_keep_their_places_apart(spark, rows):
    a = {"l": [{"k": "x", "m": [{"q": "1", "v": 1}, {"q": "2", "v": 2}]}]}
    b = {"l": [{"k": "x", "m": [{"q": "2", "v": 2}, {"q": "1", "v": 9}]}]}
    assert diff(spark, rows, a, b, keyed={"l": "k", "l[].m": "q"}) == [("l[x].m[1].v", "value", "1", "9")]


def test_list_lengths_and_composite_keys(spark, rows):
    assert diff(spark, rows, {"l": [1, 2]}, {"l": [1]}) == [("l", "length", "2", "1"), ("l[1]", "missing_right", "2", None)]
    a = {"l": [{"k": "x", "s": {"q": 1}, "v": 1}, {"k": "x", "s": {"q": 2}, "v": 2}]}
    b = {"l": [{"k": "x", "s": {"q": 2}, "v": 2}, {"k": "x", "s": {"q": 1}, "v": 5}]}
    assert diff(spark, rows, a, b, keyed={"l": ("k", "s.q")}) == [("l[x|1].v", "value", "1", "5")]


def test_special_signs_in_list_keys(spark, rows):
    a, b = {"l": [{"k": "$1\\x", "v": 1}]}, {"l": [{"k": "$1\\x", "v": 2}]}
    assert diff(spark, rows, a, b, keyed={"l": "k"}) == [("l[$1\\x].v", "value", "1", "2")]


def test_element_of_a_repeated_list_is_counted(spark, rows):
    assert diff(spark, rows, {"l": ["x", "x"]}, {"l": ["x"]}, keyed={"l": "*"}) != []


def test_names_like_types_and_odd_names(spark, rows):
    a = {"VOIDED": 1, "VARIANT_ID": "x", "OBJECT": {"VOID": None, "x: VOID": 1}, "a.b": 1, 'd"q': [1], "q`t": True}
    b = {"VOIDED": 2, "VARIANT_ID": "y", "OBJECT": {"VOID": "v", "x: VOID": 2}, "a.b": 2, 'd"q': [2], "q`t": False}
    got = {p: (k, x, y) for p, k, x, y in diff(spark, rows, a, b)}
    assert got == {
        "VOIDED": ("value", "1", "2"), "VARIANT_ID": ("value", "x", "y"), "OBJECT.VOID": ("missing_left", None, "v"), "OBJECT.x: VOID": ("value", "1", "2"),
        "`a.b`": ("value", "1", "2"), 'd"q[0]': ("value", "1", "2"), "`q`t`": ("value", "true", "false")}
    assert diff(spark, rows, a, a) == []


def test_single_elements_are_unwrapped(spark, rows):
    one = lambda a, b: diff(spark, rows, a, b, unwrap_single=True)
    assert one({"it": ["a"]}, {"it": ["a"]}) == [] and one({"it": ["a"]}, {"it": "a"}) == []
    assert one({"it": ["a", "b"]}, {"it": ["a", "c"]}) == [("it[1]", "value", "b", "c")]
    assert one({"it": [{"k": 1}]}, {"it": [{"k": 2}]}) == [("it.k", "value", "1", "2")]
    assert one({"it": "b"}, {"it": ["a"]}) == [("it", "value", "b", "a")]


def test_unordered_lists_without_a_key(spark, rows):
    free = lambda a, b, *p: [r[1:] for r in diff(spark, rows, a, b, unordered=p)]
    assert free({"l": ["a", "b"]}, {"l": ["b", "a"]}, "l") == []
    left = {"l": [{"k": 1, "v": "x", "w": 1}, {"k": 2, "v": "y", "w": 1}]}
    right = {"l": [{"k": 2, "v": "z", "w": 1}, {"k": 1, "v": "x", "w": 1}]}
    assert free(left, right, "l") == [("value", "y", "z")]
    nested = lambda *inner: {"l": [{"id": 1, "m": list(inner)}, {"id": 2, "m": ["q"]}]}
    assert free(nested("a", "b"), nested("b", "a"), "l", "l[].m") == []
    assert free({"l": ["a"]}, {"l": ["a", "c"]}, "l") == [("length", "1", "2"), ("missing_left", None, "c")]


def test_unreadable_documents_are_reported(spark, rows):
    left = spark.createDataFrame([(1, '{"a":1}'), (2, "{broken"), (3, "{broken"), (4, None)], "id long, j string")
    right = spark.createDataFrame([(1, "not json"), (2, '{"a":1}'), (3, "{broken"), (4, None)], "id long, j string")
    got = rows(dc.document_diff(left, right, ["id"], "j"), "id", "path", "kind")
    assert (1, "", "unreadable") in got and (2, "", "unreadable") in got and not [r for r in got if r[0] in (3, 4)]


def test_clean_up(spark):
    df = spark.createDataFrame([('{"a":[],"b":1,"c":null}',), ('{"b":1,"a":[]}',)], "j string")
    got = [r[0] for r in df.select(jf.drop_null_members(jf.drop_empty_lists(F.col("j"), ["a"]), ["c"])).collect()]
    assert got == ['{"b":1}', '{"b":1}']
    assert [r[0] for r in df.select(jf.empty_lists_to_null(F.col("j"))).collect()][1] == '{"b":1,"a":null}'


def test_heads_without_children_keep_null_lists(spark, rows):
    heads = spark.createDataFrame([(1,), (2,)], "id long")
    kids = spark.createDataFrame([(1, "b"), (1, "a")], "id long, c string")
    out = dc.assemble(heads, {"kids": dc.ChildList(kids, {"c": "c"}, ("c",))}, ["id"])
    assert [(r["id"], r["kids"] and [k["c"] for k in r["kids"]]) for r in out.orderBy("id").collect()] == [(1, ["a", "b"]), (2, None)]


def test_unordered_paths_are_cut_once(spark, rows, monkeypatch):
    """The leaves of an unordered list are cut from one match (beside the one that picks them) and written once; a list in a list, a path outside."""
    plans = []

    def watched(df, label="stage"):
        if label in ("lefts", "rights") and "path" not in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(dc, "stage", watched)
    side = lambda *found: spark.createDataFrame(list(found), "k int, body string")
    left = side((1, '{"a":1,"L":[{"n":"x","v":1},{"n":"y","v":1,"M":[1,2]}]}'), (2, '{"L":[{"n":"z"}]}'))
    right = side((1, '{"a":2,"L":[{"n":"y","v":2,"M":[1,2]},{"n":"x","v":1}]}'), (2, '{"L":[{"n":"z"}]}'))
    found = dc.document_diff(left, right, ["k"], "body", dc.CompareRules(unordered=("L",)))
    found = found.withColumn("path", F.regexp_replace("path", "[0-9a-f]{32}", "#"))
    assert rows(found) == [(1, "L[#].v", "value", "1", "2"), (1, "a", "value", "1", "2")]
    cut = [p for p in plans if "regexp_extract" in p]
    made = lambda plan: sum(line.count("regexp_extract(") for line in plan.splitlines() if "Project" in line)
    assert [made(p) for p in cut] == [1, 1] and not [p for p in cut if "RLIKE" in p]
