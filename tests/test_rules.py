"""Checks of patterns and addresses, name resolution, compile databases, empty graphs."""

import pytest
from pyspark.sql import functions as F

from weftgraph.functions import dicts
from weftgraph.functions import predicates as P
from weftgraph.graph import Graph
from weftgraph.operators import browse
from weftgraph.schema import TABLES
from weftgraph.sources import files


def test_patterns_that_may_not_end(spark):
    assert P.checked("mem.*|str(cpy|cat)") == "mem.*|str(cpy|cat)"
    for bad in ("(x+)+y", "(one|two)*", "a" * 513):
        with pytest.raises(ValueError):
            browse.list_methods(Graph.of(spark, {}), name=bad)


def test_names_of_a_language():
    table = {"c": ["gets"], "python": ["os.system(", "subprocess.run", "system"]}
    assert dicts.names_for("Python", table) == ["system", "run"]
    assert dicts.names_for("cobol", table) == ["gets"]
    assert dicts.names_for("c", table, {"c": ["a.b.read"]}) == ["read"]
    assert dicts.names_for("c", table, {"c": ["read"]}, ["mine"]) == ["mine"]


def test_every_language_has_its_names():
    assert len(dicts.TAINT_SOURCES) == len(dicts.TAINT_SINKS) == 13 and dicts.TAINT_SOURCES.keys() == dicts.TAINT_SINKS.keys() > dicts.SANITIZERS.keys()
    assert dicts.names_for("Go", dicts.TAINT_SOURCES)[:2] == ["Args", "Getenv"] and "FormValue" in dicts.names_for("go", dicts.TAINT_SOURCES)
    assert "getenv" in dicts.names_for("java", dicts.TAINT_SOURCES) and "$_GET" in dicts.names_for("php", dicts.TAINT_SOURCES)
    assert dicts.names_for("csharp", dicts.TAINT_SINKS) == ["Start", "ExecuteReader", "ExecuteNonQuery", "Write", "WriteAllText", "WriteLine"]
    assert dicts.names_for("jimple", dicts.SANITIZERS) == dicts.SANITIZERS["c"]


def test_paths_left_out(spark):
    cases = {"src/main.c": True, "tests/a.c": False, "src/test_a.c": False, "latest/a.c": True, ".git/config": False, "a/.hidden/x.c": False, "index.js": True, "vendor/x.c": False}
    cases |= {"my_vendor/x.c": True, "doc/a.c": False, "docs.c": True, "a/notes.md": False, "a.mdx": True, "Makefile.inc": False, "tool/x.c": False, "tool.c": True, "a/b.c~": False, "": True}
    got = spark.createDataFrame([(p,) for p in cases], "path string").select("path", (~P.excluded(F.col("path"), dicts.EXCLUDED_PATHS)).alias("kept")).collect()
    assert {r.path: r.kept for r in got} == cases


def test_languages_of_texts(spark):
    cases = {"def f(self):\n  pass\nimport os": "python", "fn main() {\n let mut x = 1;\n}": "rust", "\u00e9end \u00e9nil": None, "end\nnil": "ruby", "": None, None: None, "if x:\u2028y": None}
    got = spark.createDataFrame([(p,) for p in cases], "text string").select("text", P.best_language(P.language_scores(F.col("text"), dicts.LANGUAGE_SIGNALS)).alias("language")).collect()
    assert {r.text: r.language for r in got} == cases


def test_repository_addresses(spark):
    cases = {
        "https://github.com/o/r.git": "https://github.com/o/r",
        "https://www.gitlab.com/group/sub/r/": "https://www.gitlab.com/group/sub/r",
        "https://dev.azure.com/org/p/_git/r?x=1#y": "https://dev.azure.com/org/p/_git/r",
        "https://github.com/o": None,
        "https://github.com//o//": None,
        "http://github.com/o/r": None,
        "https://github.com@evil.org/o/r": None,
        "https://github.com:8443/o/r": None,
        "https://github.com/o/r x": None,
        "https://github.com/o/r ": None,
        "https://github.com/o/r\n": None,
        "HTTPS://github.com/o/r": None,
        "": None,
    }
    df = spark.createDataFrame([(u,) for u in cases] + [(None,)], "url string")
    got = {r.url: r.to for r in df.select("url", P.repository_url(F.col("url")).alias("to")).collect()}
    assert got == cases | {None: None}


@pytest.mark.parametrize(
    ("tree", "found"),
    [
        ([("sub/compile_commands.json", 90), ("build/compile_commands.json", 5), ("compile_commands.json", 5)], "compile_commands.json"),
        ([("a/b/compile_commands.json", 90), ("a/compile_commands.json", 90), ("node_modules/compile_commands.json", 900)], "a/compile_commands.json"),
        ([("a/b/c/d/compile_commands.json", 1), ("a/other.json", 7)], None),
        ([("a/compile_commands.json", 3), ("b/compile_commands.json", 4)], "b/compile_commands.json"),
    ],
)
def test_compile_database(spark, tree, found):
    assert [r.path for r in files.compile_database(spark.createDataFrame(tree, "path string, size long")).collect()] == ([found] if found else [])


def test_rebased(spark):
    df = spark.createDataFrame([(p,) for p in ("/home/x/src/a.c", "/home/x", "/home/xy/a.c", "src/a.c", None)], "p string")
    assert [r[0] for r in df.select(files.rebased(F.col("p"), "/home/x/", "/work")).collect()] == ["/work/src/a.c", "/work", "/home/xy/a.c", "src/a.c", None]


def test_empty_graph(spark):
    row = (1, "f", "f", "", "a.c", 1, 2, True, "int")
    with pytest.raises(ValueError):
        Graph.of(spark, {"method": spark.createDataFrame([row], TABLES["method"])}).checked()
    own = Graph.of(spark, {"method": spark.createDataFrame([row[:7] + (False, "int")], TABLES["method"])})
    assert own.checked() is own


def test_forward_flow_follows_addresses_and_copies(spark):
    make = lambda name, rows: spark.createDataFrame(rows, TABLES[name])
    g = Graph.of(
        spark,
        {
            "assignment": make("assignment", [(1, 1, 3, "p", "&v"), (2, 1, 5, "w", "v + 1"), (3, 1, 2, "early", "v")]),
            "call": make("call", [(7, 1, "puts", "puts(w)", "a.c", 6, "", None), (8, 1, "fill", "fill(p)", "a.c", 4, "", None), (9, 1, "puts", "puts(w)", "a.c", 4, "", None)]),
            "argument": make("argument", [(7, 1, 1, "IDENTIFIER", "w", 6, None), (8, 1, 1, "IDENTIFIER", "p", 4, None), (9, 1, 1, "IDENTIFIER", "w", 4, None)]),
        },
    )
    seeds = spark.createDataFrame([(1, "v", 3)], "method_id long, var string, line int")
    got = {(r.var, r.line, r.kind) for r in browse.variable_flow_forward(g, seeds).collect()}
    assert got == {("v", 3, "propagation"), ("v", 5, "propagation"), ("p", 4, "usage"), ("w", 6, "usage")}
