"""Round 3: leaves of documents whose root is a list, or of any shape, come from rows and not from lambdas over lists."""

import pytest

from goldthread.operators import documents as dc

DOCS = {
    1: '[{"p":"x"},{"q":7}]', 2: "[]", 3: None, 4: "[null]", 5: "[1", 6: '[{"p":"only"}]',
    7: " 7", 8: '\t{"a":{"x.y":[true,null]},"b":{}}', 9: '"t"', 10: "null", 11: '{"a"',
}
LIST = [
    (1, "", "array", "2"), (1, "[0].p", "string", "x"), (1, "[0].q", "null", None), (1, "[1].p", "null", None), (1, "[1].q", "bigint", "7"),
    (2, "", "array", "0"), (3, "", "null", None), (4, "", "array", "1"), (4, "[0]", "null", None), (5, "", "unreadable", "[1"),
    (6, "", "array", "1"), (6, "[0].p", "string", "only"), (6, "[0].q", "null", None),
]
ANY = [
    (1, "", "array", "2"), (1, "[0].p", "string", "x"), (1, "[1].q", "number", "7"), (2, "", "array", "0"), (3, "", "null", None),
    (4, "", "array", "1"), (4, "[0]", "null", None), (5, "", "unreadable", "[1"), (6, "", "array", "1"), (6, "[0].p", "string", "only"),
    (7, "", "number", "7"), (8, "a.`x.y`", "array", "2"), (8, "a.`x.y`[0]", "boolean", "true"), (8, "a.`x.y`[1]", "null", None),
    (8, "b", "object", "{}"), (9, "", "string", "t"), (10, "", "null", None), (11, "", "unreadable", '{"a"'),
]


def _frame(spark, ids):
    return spark.createDataFrame([(i, DOCS[i]) for i in ids], "k long, j string")


@pytest.mark.parametrize("ddl, ids, want", [("ARRAY<STRUCT<p: STRING, q: BIGINT>>", range(1, 7), LIST), ("VARIANT", range(1, 12), ANY)])
def test_leaves_without_lambdas(spark, rows, monkeypatch, ddl, ids, want):
    plans = []
    real = dc.stage
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(dc, "stage", lambda df, label="stage": (plans.append(plan(df)), real(df, label))[1])
    found = dc.document_paths(_frame(spark, ids), ["k"], "j", ddl, dc.CompareRules())
    assert rows(found) == sorted(want, key=repr)
    walked = [p for p in [*plans, plan(found)] if "transform(_d" in p or "transform(variant_get" in p or "transform(try_variant_get" in p or "transform(map_entries" in p]
    assert not walked, walked


def test_scalars_are_not_written(spark, monkeypatch):
    """Of documents of any shape only the levels below objects and arrays are written: scalars are leaves at once."""
    written = []
    real = dc.stage
    monkeypatch.setattr(dc, "stage", lambda df, label="stage": (written.append(label), real(df, label))[1])
    assert dc.document_paths(_frame(spark, (3, 7, 9, 10)), ["k"], "j", "VARIANT", dc.CompareRules()).count() == 4
    assert not written


def test_unwrapped_root_list(spark, rows):
    rules = dc.CompareRules(unwrap_single=True)
    for ddl in ("ARRAY<STRUCT<p: STRING, q: BIGINT>>", "VARIANT"):
        found = dc.document_paths(_frame(spark, (2, 6)), ["k"], "j", ddl, rules)
        assert [r[:2] + r[3:] for r in rows(found) if r[2] != "null"] == [(2, "", "0"), (6, "p", "only")]
