"""Syntax trees: shapes, intervals, and what is no expression."""

import pytest

from weftgraph.operators import trees


def shape(code):
    nodes = trees.parse(code)
    names = [n[3].removeprefix("<operator>.") for n in nodes]

    def show(i):
        inner = [show(k) for k, n in enumerate(nodes) if n[0] == i]
        return names[i] + (f"({' '.join(inner)})" if inner else "")

    # intervals: what a node holds are its descendants, and children come in order
    for i, n in enumerate(nodes):
        held = {k for k in range(len(nodes)) if any(k == x for x in ancestors(nodes, k, i))}
        assert held == set(range(i, n[5] + 1))
        mine = [m for m in nodes if m[0] == i]
        assert [m[1] for m in mine] == list(range(1, len(mine) + 1))
    return show(0)


def ancestors(nodes, k, stop):
    at = k
    while at >= 0:
        if at == stop:
            yield k
        at = nodes[at][0]


@pytest.mark.parametrize(
    ("code", "want"),
    [
        ("n*16", "multiplication(n 16)"),
        ("a + b * c - d", "subtraction(addition(a multiplication(b c)) d)"),
        ("(a + b) * c", "multiplication(addition(a b) c)"),
        ("sizeof(int) * n", "multiplication(sizeOf n)"),
        ("sizeof *p * n", "multiplication(sizeOf n)"),
        ("n << 4 | 1", "or(shiftLeft(n 4) 1)"),
        ("(size_t)n * m", "multiplication(cast(n) m)"),
        ("(char *)f(x, y[2])", "cast(f(x indirectIndexAccess(y 2)))"),
        ("p->a.b", "fieldAccess(indirectFieldAccess(p a) b)"),
        ("*p++ + -q", "addition(indirection(postIncrement(p)) minus(q))"),
        ("a ? b : c ? d : e", "conditional(a b conditional(c d e))"),
        ("a = b = c", "assignment(a assignment(b c))"),
        ("x && !y || z == 0", "logicalOr(logicalAnd(x logicalNot(y)) equals(z 0))"),
        ("(*handlers[i])(a, b)", "pointerCall(indirection(indirectIndexAccess(handlers i)) a b)"),
        ('f("a, b(", \',\')', 'f("a, b(" \',\')'),
    ],
)
def test_shapes(code, want):
    assert shape(code) == want


def test_no_expressions():
    assert trees.parse(None) is None
    for code in ("", "a b", "(a", "f(a", "+", "a[1", "@", "(" * 5000 + "a" + ")" * 5000):
        assert [n[2:4] for n in trees.parse(code)] == [("UNKNOWN", "")], code


def test_trees_are_dealt_by_root_once(spark):
    from weftgraph.graph import Graph
    from weftgraph.operators import trees

    argument = spark.createDataFrame([(1, 1, 1, "CALL", "a + b * 2", 3, None), (2, 1, 1, "IDENTIFIER", "a", 4, None)], "call_id long, method_id long, arg_index int, kind string, code string, line int, decl_id long")
    g = Graph.of(spark, {"argument": argument})
    assert trees.by_root(g) is trees.by_root(g)
    assert {(r.root_id, r.nodes, r.names) for r in trees.descendants(g).collect()} == {(1, 5, "a,b"), (2, 1, "a")}
    assert [(r.pre, r.children) for r in trees.children(g).orderBy("pre").collect()] == [(0, 2), (2, 2)]
