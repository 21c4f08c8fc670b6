import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from goldthread.operators import components as cc
from goldthread.session import stage


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def solve(spark, edges):
    df = spark.createDataFrame(edges, "src long, dst long")
    return {r["node"]: r["root"] for r in cc.connected_components(df).collect()}


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)).filter(lambda e: e[0] != e[1]), min_size=1, max_size=60))
def test_random_graphs_equal_union_find(spark, edges):
    assert solve(spark, edges) == union_find(edges)


def test_chain_longer_than_any_fixed_number_of_label_rounds(spark):
    ids = list(range(300))
    random.Random(1).shuffle(ids)
    edges = list(zip(ids, ids[1:]))
    assert set(solve(spark, edges).values()) == {0}


@pytest.mark.parametrize("per_task", [10, 10**6])
def test_star_with_a_hub(spark, per_task):
    edges = spark.createDataFrame([(5000, i) for i in range(1000)], "src long, dst long")
    found = {r["node"]: r["root"] for r in cc.connected_components(edges, rows_per_task=per_task).collect()}
    assert len(found) == 1001 and set(found.values()) == {0}


def test_self_loops_and_doubled_edges(spark):
    assert solve(spark, [(1, 1), (2, 3), (3, 2), (3, 3)]) == {2: 2, 3: 2}


def test_singletons_are_kept(spark, rows):
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    nodes = spark.createDataFrame([(1,), (2,), (9,)], "node long")
    assert rows(cc.with_singletons(cc.connected_components(edges), nodes), "node", "root") == [(1, 1), (2, 1), (9, 9)]


def test_no_edges(spark):
    assert solve(spark, []) == {}


def test_round_limit_is_an_error_not_a_silent_stop(spark):
    edges = [(i, i + 1) for i in range(200)]
    with pytest.raises(cc.NotConverged):
        cc.connected_components(spark.createDataFrame(edges, "src long, dst long"), max_rounds=1)


def test_no_node_table_passes_the_driver(spark, rows, monkeypatch):
    """Neither the rounds nor added and removed edges broadcast a table of nodes, however small its files are."""
    plans = []

    def watched(df, label="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(cc, "stage", watched)
    edge = lambda found: spark.createDataFrame(found, "src long, dst long")
    kept, gone = edge([(1, 2), (2, 3), (5, 6), (8, 8)]), edge([(3, 5)])
    roots = cc.connected_components(kept.union(gone))
    roots = watched(cc.remove_edges(roots, kept, gone))
    assert rows(roots, "node", "root") == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)]
    roots = watched(cc.add_edges(roots, edge([(6, 9), (9, 1)])))
    assert rows(roots, "node", "root") == [(1, 1), (2, 1), (3, 1), (5, 1), (6, 1), (9, 1)]
    assert len(plans) > 5 and not [p for p in plans if "BroadcastHashJoin" in p]
