"""Round 3: what the forest writes, and the links of lines."""

from goldthread.llm import linking, near_dup


def test_forest_leads_all_depths_at_once(spark, monkeypatch):
    """Steps of the search are as many whatever the depth, and all depths are searched."""
    written = []
    for module in (linking, near_dup):
        real = module.stage
        monkeypatch.setattr(module, "stage", lambda df, label="stage", real=real: (written.append(label), real(df, label))[1])
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:59] + [f"x{k}"]) for k in range(6)] + [" ".join(f"y{k}z{i}" for i in range(40)) for k in range(6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == {i: 0 if i < 6 else i for i in range(12)}
    assert written.count("regions") == 1 and written.count("bucket-values") <= 4


def test_roots_after_more_links(spark):
    roots = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6)], "node long, root long")
    more = spark.createDataFrame([(6, 3), (3, 1), (3, 3)], "a long, b long")
    got = {r.node: r.root for r in linking.joined_roots(roots, more).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 1}
