"""What crosses methods: slices, flows, defects and confidence, on small hand-made graphs."""

import random

import pytest

from weftgraph import project
from weftgraph.functions import dicts
from weftgraph.graph import Graph
from weftgraph.operators import browse, detectors, iterate, trees
from weftgraph.plans import queries
from weftgraph.schema import TABLES


def graph(spark, **tables):
    return Graph.of(spark, {name: spark.createDataFrame(rows, TABLES[name]) for name, rows in tables.items()})


def method(i, name, line=1):
    return (i, name, name, "", "a.c", line, line + 50, False, "void")


def call(i, m, name, line, callee=None, dispatch="STATIC_DISPATCH"):
    return (i, m, name, name + "()", "a.c", line, dispatch, callee)


def arg(call_id, m, place, code, line, kind="IDENTIFIER"):
    return (call_id, m, place, kind, code, line, None)


def program(spark):
    """outer(1) fills box.width, hands it to inner(2) as w; inner makes size of w and gives it to virtual deep(3) as n."""
    return graph(
        spark,
        method=[method(1, "outer", 1), method(2, "inner", 101), method(3, "deep", 201)],
        parameter=[(21, 2, "w", "int", 1), (31, 3, "n", "int", 1)],
        call=[call(11, 1, "inner", 9, 2), call(12, 2, "deep", 109, None, "DYNAMIC_DISPATCH")],
        argument=[arg(11, 1, 1, "box.width", 9, "CALL"), arg(12, 2, 1, "size", 109)],
        assignment=[(51, 1, 5, "box.width", "given"), (52, 2, 105, "size", "w * 4"), (53, 3, 205, "room", "n + 1"), (54, 1, 12, "box.width", "late")],
    )


def test_backward_goes_on_to_callers(spark):
    seeds = spark.createDataFrame([(3, "room", 210)], "method_id long, var string, line int")
    got = {(r.id, r.var, r.depth) for r in iterate.slice_between(program(spark), seeds, 6).collect()}
    assert got == {(53, "room", 1), (12, "n", 2), (52, "size", 3), (11, "w", 4), (51, "width", 5), (51, "box", 5)}
    assert {r.id for r in iterate.slice_between(program(spark), seeds, 2).collect()} == {53, 12}


def test_backward_goes_on_through_compound_assignments(spark):
    plus = (61, 1, "<operator>.assignmentPlus", "n += p->k * n", "a.c", 7, "STATIC_DISPATCH", None)
    shift = (62, 1, "<operator>.assignmentShiftLeft", "k <<= seed", "a.c", 4, "STATIC_DISPATCH", None)
    late = (63, 1, "<operator>.assignmentPlus", "n += late", "a.c", 20, "STATIC_DISPATCH", None)
    plain = (64, 1, "<operator>.assignment", "n = other", "a.c", 6, "STATIC_DISPATCH", None)
    sides = [(61, "n", "p->k * n"), (62, "k", "seed"), (63, "n", "late"), (64, "n", "other")]
    argument = [arg(c, 1, i, code, 0) for c, *codes in sides for i, code in enumerate(codes, 1)]
    g = graph(spark, method=[method(1, "f")], call=[plus, shift, late, plain], argument=argument, assignment=[(71, 1, 2, "seed", "first"), (72, 1, 5, "n", "0")])
    seeds = spark.createDataFrame([(1, "n", 9)], "method_id long, var string, line int")
    got = {(r.id, r.kind, r.var, r.depth) for r in iterate.slice_between(g, seeds).collect()}
    assert got == {(61, "compound", "n", 1), (72, "assignment", "n", 1), (62, "compound", "k", 2), (71, "assignment", "seed", 3)}
    assert not {(r.id, r.kind) for r in iterate.slice_between(g, seeds, forward=True).collect()} & {(61, "compound"), (62, "compound"), (63, "compound")}


def test_forward_goes_on_to_methods_called(spark):
    seeds = spark.createDataFrame([(1, "given", 1)], "method_id long, var string, line int")
    got = {(r.id, r.kind, r.depth) for r in iterate.slice_between(program(spark), seeds, 6, forward=True).collect()}
    assert got == {(51, "assignment", 1), (11, "argument", 2), (52, "assignment", 3), (12, "argument", 4), (53, "assignment", 5)}


def test_flows_end_at_the_first_sink(spark):
    g = graph(spark, ddg=[(1, 2), (2, 3), (3, 4), (1, 5), (5, 4), (2, 1), (4, 6), (7, 8)])
    nodes = lambda *ids: spark.createDataFrame([(i,) for i in ids], "node long")
    found = lambda **more: {r.path for r in iterate.flows_between(g, nodes(1, 7), nodes(4, 6), **more).collect()}
    assert found() == {"1>2>3>4", "1>5>4"}
    assert found(depth=2) == {"1>5>4"}
    assert found(sanitizers=nodes(5, 1, 4)) == {"1>2>3>4"}
    assert found(sanitizers=nodes(2, 5)) == set()
    assert iterate.flows_between(g, nodes(7), nodes(4)).count() == 0


def test_address_taken(spark):
    g = graph(spark, method=[method(1, "main"), method(2, "on_close"), method(3, "used")], call=[call(9, 1, "used", 3, 3), call(10, 1, "set_hook", 4)], argument=[arg(10, 1, 1, "&on_close", 4), arg(10, 1, 2, "used", 4)])
    assert [(r.name, r.site) for r in iterate.address_taken(g).collect()] == [("on_close", 10)]


def two(spark, inner, checks=(), outer=()):
    """A pointer p of method 1 goes at line 20 to parameter q of method 2, which has one call with an argument at line 105."""
    return graph(
        spark,
        method=[method(1, "outer"), method(2, "inner", 101)],
        parameter=[(21, 2, "q", "char*", 1)],
        call=[call(1, 1, outer[0] if outer else "free", 10), call(2, 1, "inner", 20, 2), call(3, 2, inner, 105)],
        argument=[arg(1, 1, 1, "p", 10), arg(2, 1, 1, "p", 20), arg(3, 2, 1, "q", 105)],
        assignment=[(1, 1, 10, "p", outer[1])] if outer else [],
        control=[(70 + i, m, "IF", c, line, line) for i, (m, c, line) in enumerate(checks)],
    )


def test_freed_and_handed_on(spark):
    hits = lambda g: [(r.site, r.callee_id, r.use_line) for r in detectors.use_after_free_between(g).collect()]
    assert hits(two(spark, "puts")) == [(1, 2, 105)]
    assert hits(two(spark, "free")) == []


def test_unchecked_and_handed_on(spark):
    made = ("malloc", "malloc(8)")
    hits = lambda *checks: detectors.null_deref_between(two(spark, "puts", checks, made)).count()
    assert hits() == 1 and hits((2, "other == NULL", 102)) == 1 and hits((1, "p", 8)) == 1
    assert hits((1, "ready && p != ((void *)0)", 15)) == 0 and hits((2, "!q || stop", 103)) == 0 and hits((2, "(0 == q)", 103)) == 0


def test_product_handed_on(spark):
    def g(*checks):
        return graph(
            spark,
            method=[method(1, "outer"), method(2, "inner", 101)],
            parameter=[(21, 2, "n", "int", 1)],
            call=[call(2, 1, "inner", 20, 2), call(3, 2, "malloc", 105)],
            argument=[arg(2, 1, 1, "total", 20), arg(3, 2, 1, "n", 105)],
            assignment=[(1, 1, 5, "total", "7"), (2, 1, 9, "total", "rows * cols")],
            control=[(70, 1, "IF", c, 12, 13) for c in checks],
        )

    assert [(r.id, r.arithmetic, r.allocation) for r in detectors.integer_overflow_between(g()).collect()] == [(2, "rows * cols", 3)]
    assert detectors.integer_overflow_between(g("rows > SIZE_MAX / cols")).count() == 0


def test_product_handed_on_by_its_own_argument(spark):
    """A static and two dynamic calls meet the allocation, each once, a call of the method by itself does not; the product counts at the parameter's place alone."""
    dynamic = "DYNAMIC_DISPATCH"
    g = graph(
        spark,
        method=[method(1, "outer"), method(2, "inner", 101), method(3, "idle", 201)],
        parameter=[(21, 2, "n", "int", 1), (22, 2, "m", "int", 2), (31, 3, "k", "int", 1)],
        call=[call(11, 1, "inner", 20, 2), call(12, 1, "inner", 30, 2, dynamic), call(13, 1, "inner", 40, None, dynamic), call(14, 2, "inner", 104, 2), call(15, 1, "idle", 45, 3), call(16, 2, "malloc", 105)],
        argument=[arg(c, m, 1, "a * b", line, "CALL") for c, m, line in ((11, 1, 20), (12, 1, 30), (14, 2, 104), (15, 1, 45))]
        + [arg(12, 1, 2, "c * d", 30, "CALL"), arg(13, 1, 1, "e", 40), arg(13, 1, 2, "f", 40), arg(16, 2, 1, "n", 105)],
        assignment=[(51, 1, 35, "f", "g * h"), (52, 1, 36, "e", "i << 2"), (53, 1, 50, "e", "late * late")],
    )
    assert sorted((r.id, r.arithmetic, r.callee_id) for r in detectors.integer_overflow_between(g).collect()) == [(11, "a * b", 2), (12, "a * b", 2), (13, "i << 2", 2)]


@pytest.mark.parametrize("of", ["argument", "assignment"])
def test_trees_of_some_expressions_are_those_of_all(spark, of):
    """Trees made of what some roots come out of are the rows of ``ast`` with these roots."""
    g = project.projected(spark, "/root/testdata/sf0.001")
    place = "root_ord = 0" if of == "assignment" else "root_ord > 0"
    roots = g.ast.where(f"{place} AND (root_id + root_ord) % 7 = 3").select("method_id", "root_id", "root_ord").distinct()
    got, want = g.expressions(of, roots), g.ast.join(roots, ["method_id", "root_id", "root_ord"], "left_semi").select(g.ast.columns)
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert 0 < want.count() < g.ast.count() / 3


def test_given_graphs_parse_only_expressions_asked_for(spark):
    g = graph(spark, argument=[arg(1, 9, 1, "a * b", 3, "CALL"), arg(1, 9, 2, "c", 3), arg(2, 9, 1, "d", 4)], assignment=[(1, 9, 5, "x", "e + 1"), (2, 9, 6, "y", "f")])
    roots = lambda *rows: spark.createDataFrame(rows, "method_id long, root_id long, root_ord int")
    assert sorted(r.code for r in g.expressions("argument", roots((9, 1, 1), (9, 1, 1), (8, 2, 1))).collect()) == ["a", "a * b", "b"]
    assert sorted(r.code for r in g.expressions("assignment", roots((9, 1, 0))).collect()) == ["1", "e", "e + 1"]
    assert "ast" not in g._got


@pytest.mark.parametrize("name", ["int_overflow_interproc", "int_overflow_tree"])
def test_overflows_make_no_trees_but_those_they_need(spark, monkeypatch, name):
    """Neither all arguments nor all trees are stored: only those of allocations, of arguments that reach one, and of what was last assigned."""
    stored, deal = [], iterate.dealt
    monkeypatch.setattr(trees, "by_root", lambda g: pytest.fail("all trees are stored"))
    for module in (project, detectors):
        monkeypatch.setattr(module, "dealt", lambda df, *a, **k: stored.append(deal(df, *a, **k)) or stored[-1])
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    g = project.projected(spark, "/root/testdata/sf0.001")
    assert not any("decl_id" in df.columns for df in stored)
    made = [df for df in stored if "post" in df.columns]
    assert len(made) == 2 and sum(df.count() for df in made) < g.ast.count() / 5


def test_alias_made_after_the_free(spark):
    g = graph(spark, call=[call(1, 1, "free", 10), call(2, 1, "puts", 30)], argument=[arg(1, 1, 1, "p", 10), arg(2, 1, 1, "q", 30)], assignment=[(1, 1, 20, "q", "p")])
    assert [(r.via, r.line, r.first_use) for r in detectors.use_after_free(g).collect()] == [("post-free-alias", 20, 30)]
    g = graph(spark, call=[call(1, 1, "free", 10), call(2, 1, "puts", 30)], argument=[arg(1, 1, 1, "p", 10), arg(2, 1, 1, "q", 30)], assignment=[(1, 1, 20, "q", "p"), (2, 1, 15, "p", "NULL")])
    assert detectors.use_after_free(g).count() == 0


def test_confidence_by_entry(spark):
    g = graph(spark, call=[call(1, 1, dicts.EXTERNAL_INPUTS[0], 2), call(2, 1, "inner", 3, 2)])
    findings = spark.createDataFrame([(5, 7), (6, 2), (4, 9)], "id long, method_id long")
    got = detectors.worst_first(iterate.with_entry(g, findings, dicts.EXTERNAL_INPUTS), ["id"]).orderBy("issue").collect()
    assert [(r.id, r.confidence, r.hops) for r in got] == [(6, "HIGH", 1), (4, "MEDIUM", None), (5, "MEDIUM", None)]


def test_first_flows_are_the_first_of_all(spark):
    """Also where most beginnings meet a node twice, and ids differ in their number of digits."""
    import random

    rng = random.Random(5)
    for _ in range(3):
        ids = rng.sample([1, 2, 3, 12, 13, 100, 101, 23, 31, 7, 70, 700], 10)
        edges = sorted({(a, b) for a, b in ((rng.choice(ids), rng.choice(ids)) for _ in range(26)) if a != b})
        g = Graph.of(spark, {"ddg": spark.createDataFrame(edges, "src long, dst long")})
        nodes = lambda x: spark.createDataFrame([(i,) for i in x], "node long")
        sources, sinks, clean = nodes(ids[:3]), nodes(ids[3:5]), nodes(ids[5:6])
        every = sorted(iterate.flows_between(g, sources, sinks, 6, sanitizers=clean).collect(), key=lambda r: (r.length, r.path))
        for limit in (1, 4, 9):
            assert iterate.flows_between(g, sources, sinks, 6, limit, clean).collect() == every[:limit]


def test_first_flows_of_a_wide_graph_build_few(spark, monkeypatch):
    """Ten layers of twenty nodes, each to all of the next: 20^9 paths, of which the first are found without the rest."""
    edges = [(100 * k + i, 100 * k + 100 + j) for k in range(9) for i in range(20) for j in range(20)]
    g = Graph.of(spark, {"ddg": spark.createDataFrame(edges, "src long, dst long")})
    ends = lambda k: spark.createDataFrame([(100 * k + i,) for i in range(20)], "node long")
    got = iterate.flows_between(g, ends(0), ends(9), 9, 5).collect()
    assert [r.path for r in got] == ["0>" + ">".join(str(100 * k) for k in range(1, 9)) + f">{x}" for x in (900, 901, 902, 903, 904)]


def test_anchors_meet_one_node_of_each_line(spark):
    calls = [call(100 + i, 1, "<operator>.addition" if i < 5 else "f", 10 + i % 2) for i in range(20)]
    g = graph(spark, method=[method(1, "m"), method(2, "n")], call=[*calls, call(7, 2, "f", 30)], assignment=[(50, 1, 10, "x", "y"), (51, 1, 16, "x", "z")], control=[(60, 1, "IF", "x", 16, 18), (61, 2, "IF", "x", 30, 31)])
    got = browse.anchors(g, spark.createDataFrame([("a.c", 10), ("a.c", 13), ("a.c", 33), ("a.c", 40), ("b.c", 10)], "file string, line int"))
    assert {(r.line, r.delta, r.node, r.method_id) for r in got.collect()} == {(10, 0, 106, 1), (13, -2, 105, 1), (33, -3, 7, 2)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, line in enumerate(plan.splitlines()) if "Join" in line)
    assert "Aggregate [m_file" in "".join(plan.splitlines()[join:])  # under the join of places with nodes


def walked(steps, seeds, depth, forward):
    """All (method, variable, line) one by one, with the round of each way."""
    seen, front, hits = set(seeds), set(seeds), {}
    for level in range(1, depth + 1):
        met = [s for s in steps for m, v, line in front if (s.method_id, s.var) == (m, v) and (s.bound > line if forward else s.bound < line)]
        for s in met:
            hits.setdefault((s.id, s.kind, s.method_id, s.var, s["at"]), level)
        front = {(s.next_method, s.next_var, s.next_line) for s in met if s.next_var is not None} - seen
        seen |= front
    return {(*k, d) for k, d in hits.items()}


@pytest.mark.parametrize("forward", [False, True])
def test_slices_are_those_of_all_lines_but_only_the_furthest_travels(spark, monkeypatch, forward):
    rng = random.Random(9)
    v = lambda: rng.choice("abcd")
    calls = [call(100 + i, rng.randint(1, 4), "f", rng.randint(1, 30), rng.randint(1, 4)) for i in range(14)]
    g = graph(
        spark,
        method=[method(i, f"m{i}", rng.randint(1, 5)) for i in range(1, 5)],
        parameter=[(10 * i + j, i, "ab"[j - 1], "int", j) for i in range(1, 5) for j in (1, 2)],
        call=calls,
        argument=[arg(c[0], c[1], j, f"{v()} + {v()}", c[5]) for c in calls for j in (1, 2)],
        assignment=[(1000 + i, rng.randint(1, 4), rng.randint(1, 30), v(), f"{v()} * {v()}") for i in range(40)],
    )
    seeds = [(m, "a", line) for m in (1, 2) for line in range(5, 25, 3)]
    stored, deal = [], iterate.dealt
    monkeypatch.setattr(iterate, "dealt", lambda df, *a: stored.append(deal(df, *a)) or stored[-1])
    for depth in (1, 3, 5):
        stored.clear()
        got = iterate.slice_between(g, spark.createDataFrame(seeds, "method_id long, var string, line int"), depth, forward)
        assert {tuple(r) for r in got.collect()} == walked(iterate.slice_steps(g, forward).collect(), seeds, depth, forward)
        assert 2 <= len(stored) <= depth + 1 and all(t.count() == t.select("method_id", "var").distinct().count() for t in stored[1:])
    assert iterate.slice_between(g, spark.createDataFrame([], "method_id long, var string, line int"), 5, forward).count() == 0


def test_uses_inside_are_exempt_where_their_method_is_read(spark):
    g = two(spark, "puts")
    handed = spark.createDataFrame([(1, 1, "p", 10, 20, 2, "q")], "site long, method_id long, ptr string, a int, b int, callee_id long, param string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hit = detectors._used_inside(g, handed, ["free"])
        plan = hit._jdf.queryExecution().executedPlan().toString()
        assert hit.count() == 1 and detectors._used_inside(g, handed, ["puts"]).count() == 0
        assert "hashpartitioning(call_id#" not in plan and "hashpartitioning(callee_id#" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def flows(edges, sources, sinks, clean, depth):
    """All flows, one by one."""
    found, paths = set(), [(n,) for n in sources]
    for _ in range(depth):
        paths = [(*p, b) for p in paths for a, b in edges if a == p[-1] and b not in p and (b in sinks or b not in clean)]
        found |= {p for p in paths if p[-1] in sinks}
        paths = [p for p in paths if p[-1] not in sinks]
    return found


def test_flows_are_those_of_a_walk_and_edges_know_how_far_a_sink_is(spark, monkeypatch):
    """Also from sources that are sinks, through cycles, and where a sink is a sanitizer."""
    rng = random.Random(11)
    nodes = lambda x: spark.createDataFrame([(i,) for i in x], "node long")
    kept, towards = [], iterate._towards
    monkeypatch.setattr(iterate, "_towards", lambda *a: kept.append(towards(*a)) or kept[-1])
    for depth in (1, 4):
        edges = {(rng.randrange(14), rng.randrange(14)) for _ in range(34)}
        sources, sinks, clean = rng.sample(range(16), 4), rng.sample(range(16), 4), rng.sample(range(14), 3)
        sinks[0], clean[0] = sources[0], sinks[1]
        g = Graph.of(spark, {"ddg": spark.createDataFrame(sorted(edges), "src long, dst long")})
        got = iterate.flows_between(g, nodes(sources), nodes(sinks), depth, sanitizers=nodes(clean)).collect()
        want = flows(edges, set(sources), set(sinks), set(clean), depth)
        assert sorted(r.path for r in got) == sorted(">".join(map(str, p)) for p in want) and all((r.source, r.sink, r.length) == (p[0], p[-1], len(p)) for r in got for p in [[int(x) for x in r.path.split(">")]])
        far = {n: 0 for n in sinks}  # by walks over the edges that a path may take
        usable = [(a, b) for a, b in edges if a != b and (b in sinks or b not in clean) and (a not in sinks or a in sources)]
        steps = {}
        for k in range(depth):
            steps |= {e: k for e in usable if e not in steps and (e[1] in sinks if k == 0 else e[1] not in sinks and far.get(e[1], depth) == k)}
            far |= {a: k + 1 for (a, _), s in steps.items() if s == k and far.get(a, depth) > k + 1 or a not in far}
        assert {(r.src, r.dst): r.after for r in kept.pop().collect()} == steps


def test_flows_store_no_calls_but_those_near_data_flow(spark, monkeypatch):
    """Calls come out of the base tables in one pass, narrowed to the ids of data flow before they are joined or grouped; no path is stored."""
    stored, deal = [], iterate.dealt
    monkeypatch.setattr(project, "dealt", lambda df, *a, **k: pytest.fail("placed is stored"))
    monkeypatch.setattr(iterate, "dealt", lambda df, *a: stored.append(df) or deal(df, *a))
    monkeypatch.setattr(iterate, "cut", lambda df: pytest.fail("a round is stored"))
    found = queries.QUERIES["taint_flows_between"](spark, "/root/testdata/sf0.001")
    calls = [df for df in stored if df.columns == ["node", "name"]]
    assert found.count() > 0 and len(calls) == 1 and not any("path" in df.columns for df in stored)
    plan = calls[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    group = next(i for i, line in enumerate(plan) if "Aggregate [l_orderkey" in line)
    assert any("Filter" in line and "l_orderkey" in line and "<=" in line for line in plan[group:])
