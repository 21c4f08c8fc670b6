"""Round 4: documents that are equal on both sides are told by digests and go no further; only open leaves are aligned."""

from goldthread.operators import documents as dc

LEFT = [
    (1, '{"L":[{"n":"a","v":1},{"n":"b","v":2}],"s":"x"}'),  # another order
    (2, '{"L":[{"n":"a","v":1},{"n":"b","v":2}],"s":"x"}'),  # another value in an element
    (3, '{"L":[{"n":"a","v":1}],"s":"x"}'), (3, '{"L":[],"s":"y"}'),  # a key twice, rows in another order
    (4, '{"L":[{"n":"a","v":1}],"s":"x"}'), (4, '{"L":[{"n":"a","v":1}],"s":"x"}'),  # a key twice, other documents twice
    (5, '{"L":[{"n":"a"},{"n":"a"}]}'),  # an element twice against once
    (6, '{"L":[null,{"n":"a"}]}'), (7, '{"L":[null]}'), (8, "no JSON"), (9, "no JSON"), (10, None), (11, None), (12, '{"s":"x"}'),
    (13, '{"s":"x"} end'), (None, '{"s":"x"}'), (14, '{"L":[{"n":"a","v":0.0}]}'), (15, '{"m":{"K":[1,2]},"s":""}'), (16, '{"s":"left"}'),
]
RIGHT = [
    (1, '{"s":"x","L":[{"n":"b","v":2},{"v":1,"n":"a"}]}'),
    (2, '{"L":[{"n":"b","v":3},{"n":"a","v":1}],"s":"x"}'),
    (3, '{"L":[],"s":"y"}'), (3, '{"L":[{"n":"a","v":1}],"s":"x"}'),
    (4, '{"L":[{"n":"b","v":1}],"s":"x"}'), (4, '{"L":[{"n":"b","v":1}],"s":"x"}'),
    (5, '{"L":[{"n":"a"}]}'),
    (6, '{"L":[{"n":"a"},null]}'), (7, '{"L":[]}'), (8, "no JSON"), (9, "none"), (10, None), (11, '{"s":"x"}'), (12, None),
    (13, '{"s":"x"}'), (None, '{"s":"x"}'), (14, '{"L":[{"n":"a","v":-0.0}]}'), (15, '{"m":{"K":[2,1]},"s":null}'), (17, '{"s":"right"}'),
]


def _diff(spark, left, right, rules, ddl=None):
    left, right = (spark.createDataFrame(rows, "k long, j string") for rows in (left, right))
    return sorted(map(str, dc.document_diff(left, right, ["k"], "j", rules, ddl=ddl).collect()))


def test_equal_documents_go_no_further(spark, monkeypatch):
    """The same differences as without digests, for keys that repeat or are null, broken texts, nulls in lists and signed zeros."""
    read, real, paths = [], dc.without_equal, dc.document_paths
    monkeypatch.setattr(dc, "document_paths", lambda df, *args: (read.append(sorted(r.k or 0 for r in df.collect())), paths(df, *args))[1])
    for rules in (dc.CompareRules(unordered=("L", "m.K")), dc.CompareRules(unordered=("L", "m.K"), null_equals_empty=False, unwrap_single=True)):
        for ddl in ("L array<struct<n:string,v:double>>, m struct<K:array<bigint>>, s string", None):
            monkeypatch.setattr(dc, "without_equal", real)
            got = _diff(spark, LEFT, RIGHT, rules, ddl)
            small = read[-2:]
            monkeypatch.setattr(dc, "without_equal", lambda left, right, *rest: (left, right))
            assert got == _diff(spark, LEFT, RIGHT, rules, ddl)
            assert {2, 4, 5, 7, 9, 11, 12, 0} | ({14} if ddl else set()) <= {*small[0], *small[1]}  # 0: the null key, which matches nothing
            assert not {1, 3, 8, 10} & {*small[0], *small[1]}
    assert any("path='L[" in row for row in got)


def test_only_open_leaves_are_staged(spark, monkeypatch):
    """Of a document with one changed element of a hundred only that element's leaves and what is one-sided are written for the alignment."""
    written, real = {}, dc.stage
    monkeypatch.setattr(dc, "stage", lambda df, label="stage", **kw: (lambda out: (written.setdefault(label, []).append(out.count()), out)[1])(real(df, label, **kw)))
    body = lambda last, turn: '{"L":[' + ",".join(f'{{"n":"n{i}","v":{last if i == 99 else i}}}' for i in (range(100) if turn else reversed(range(100)))) + "]}"
    rules = dc.CompareRules(unordered=("L",))
    rows = dc.document_diff(*(spark.createDataFrame([(k, body(x if k else 0, x)) for k in range(5)], "k long, j string") for x in (0, 1)), ["k"], "j", rules).collect()
    assert sorted((r.k, r.kind, r.left_value, r.right_value) for r in rows) == [(k, "value", "0", "1") for k in range(1, 5)]
    assert written["open"] == [16] and max(written["lefts"] + written["rights"]) <= 8
