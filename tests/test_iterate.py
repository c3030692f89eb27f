"""Traversals of the registered queries on small chains, to their last level."""

import random
from collections import deque
from types import SimpleNamespace

import pytest

from weftgraph.functions import dicts
from weftgraph.operators import iterate
from weftgraph.plans import queries


def found(spark, monkeypatch, name, **tables):
    monkeypatch.setattr(queries, "projected", lambda spark, sf_dir: SimpleNamespace(spark=spark, **tables))
    return queries.QUERIES[name](spark, "").collect()


def chain(spark, first, steps):
    return spark.createDataFrame([(first + i, first + i + 1) for i in range(steps)], "src long, dst long")


def test_input_is_followed_nine_calls(spark, monkeypatch):
    rows = [(0, 0, dicts.EXTERNAL_INPUTS[0], None)] + [(i, i, "f", i + 1) for i in range(12)]
    got = found(spark, monkeypatch, "entry_reach_full", call=spark.createDataFrame(rows, "id long, method_id long, name string, callee_id long"))
    assert {(r.node, r.depth) for r in got} == {(i, i) for i in range(10)}


def test_every_source_is_followed(spark, monkeypatch):
    call = spark.createDataFrame([(1000, dicts.TAINT_SOURCES["c"][0]), (5, "f"), (2000, dicts.TAINT_SOURCES["c"][-1])], "id long, name string")
    ddg = chain(spark, 1000, 8).unionByName(chain(spark, 5, 3)).unionByName(chain(spark, 2000, 1))
    got = found(spark, monkeypatch, "taint_reach_full", call=call, ddg=ddg)
    assert {r.node for r in got} == {*range(1000, 1009), 2000, 2001}


def test_depths_are_those_of_the_operators(spark, monkeypatch):
    paths = found(spark, monkeypatch, "taint_flow_paths_full", ddg=chain(spark, 85, 8))
    assert [r.length for r in paths] == [2, 3, 4, 5]
    ids = spark.createDataFrame([(i,) for i in range(20)], "id long")
    for name, step in (("call_graph_out_full", 1), ("call_graph_in_full", -1)):
        call = spark.createDataFrame([(i, i + 1) for i in range(20)], "method_id long, callee_id long")
        assert sorted(r.dst for r in found(spark, monkeypatch, name, method=ids, call=call)) == sorted(7 + step * i for i in range(1, 6))
    rows = [(i, 1, i, f"v{i + 1}", f"v{i}") for i in range(1, 12)]
    assignment = spark.createDataFrame(rows, "id long, method_id long, line int, target string, source string")
    control = spark.createDataFrame([(1, "FOR", 0)], "method_id long, type string, line int")
    got = found(spark, monkeypatch, "forward_slice_full", assignment=assignment, control=control)
    assert sorted((r.id, r.depth) for r in got) == [(i, i) for i in range(1, 6)]
    back = [(i, 1, 20 - i, f"v{i}", f"v{i + 1}") for i in range(1, 12)]
    assignment = spark.createDataFrame(back, "id long, method_id long, line int, target string, source string")
    control = spark.createDataFrame([(1, "FOR", 30)], "method_id long, type string, line int")
    got = found(spark, monkeypatch, "backward_slice_full", assignment=assignment, control=control)
    assert sorted((r.id, r.depth) for r in got) == [(i, i) for i in range(1, 6)]


def walked(calls, start, depth, forward, sites, limit):
    """A queue of methods, taken one by one."""
    steps = {}
    for _, caller, callee in sorted(calls):
        if callee is not None:
            steps.setdefault(caller if forward else callee, []).append(callee if forward else caller)
    waiting, visited, out = deque([(start, 0)]), [], []
    while waiting and len(out) < limit:
        at, level = waiting.popleft()
        if at in visited:
            continue
        visited.append(at)
        for other in dict.fromkeys(steps.get(at, [])[:sites]):
            out.append((len(out) + 1, *((at, other) if forward else (other, at)), level + 1, other in visited))
            if other not in visited and level + 1 < depth:
                waiting.append((other, level + 1))
    return out


@pytest.mark.parametrize("limit", [6, 25, 500])
def test_call_graph_in_the_order_of_visits(spark, limit):
    rng = random.Random(limit)
    calls = [(i, rng.randint(0, 14), rng.choice([None, *range(15), 0, 0])) for i in range(60)]
    g = SimpleNamespace(call=spark.createDataFrame(calls, "id long, method_id long, callee_id long"), method=spark.createDataFrame([(i,) for i in range(15)], "id long"))
    for forward, depth in ((True, 4), (False, 2)):
        got = iterate.call_graph_bounded(g, 3, depth, "outgoing" if forward else "incoming", 5, limit).collect()
        assert sorted(map(tuple, got)) == walked(calls, 3, depth, forward, 5, limit)


def test_call_graph_of_odd_arguments(spark):
    g = SimpleNamespace(call=spark.createDataFrame([(1, 2, 2)], "id long, method_id long, callee_id long"), method=spark.createDataFrame([(2,), (4,)], "id long"))
    assert [tuple(r) for r in iterate.call_graph_bounded(g, 2).collect()] == [(1, 2, 2, 1, True)]
    assert iterate.call_graph_bounded(g, 4).count() == iterate.call_graph_bounded(g, 9).count() == 0
    for wrong in ({"depth": 0}, {"depth": 16}, {"direction": "up"}):
        with pytest.raises(ValueError):
            iterate.call_graph_bounded(g, 2, **wrong)


def test_dealt_tables_are_grouped_without_a_shuffle(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 7 AS method_id", "id")
    got = iterate.dealt(df, "method_id", f"file://{tmp_path}")
    inside = got.groupBy("method_id").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect())) and inside.count() == 7
    assert "Exchange" not in inside._jdf.queryExecution().executedPlan().toString()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("weft_")]


def test_tables_out_of_dealt_ones_stay_dealt(spark, tmp_path):
    one = iterate.dealt(spark.range(100).selectExpr("id % 7 AS method_id", "id"), "method_id", f"file://{tmp_path}")
    both = one.unionByName(one.selectExpr("method_id", "id + 1000 AS id"))
    got = iterate.dealt(both, "method_id", f"file://{tmp_path}", inside=True)
    inside = got.groupBy("method_id").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, both.collect())) and sorted(map(tuple, inside.collect())) == [(i, 30 if i < 2 else 28) for i in range(7)]
    assert "Exchange" not in inside._jdf.queryExecution().executedPlan().toString()
