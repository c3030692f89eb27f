"""Registered queries over the projected graph, each with an independent SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dicts
from ..functions import predicates as P
from ..graph import Graph
from ..operators import browse, catalog, dataflow, detectors, iterate, order, sql, trees
from ..project import oracle, projected

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(twin: str | None) -> Callable:
    """Register f(graph) with its SQL over graph tables in braces."""

    def register(f: Callable[[Graph], DataFrame]) -> Callable[[Graph], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(projected(spark, sf_dir))
        if twin:
            ORACLE_SQL[f.__name__] = oracle(twin)
        return f

    return register


def quoted(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


# --- browsing


@query("""
    SELECT m.id, name, full_name, file, m.line, m.line_end, count(c.id) + 1 AS complexity, m.line_end - m.line + 1 AS number_of_lines
    FROM {method} m LEFT JOIN {control} c ON c.method_id = m.id WHERE NOT is_external GROUP BY m.id, name, full_name, file, m.line, m.line_end""")
def list_methods(g):
    return browse.list_methods(g, limit=None)


@query("""
    SELECT m.id, m.name, full_name, file, m.line, m.line_end, (SELECT count(*) FROM {control} c WHERE c.method_id = m.id) + 1 AS complexity, m.line_end - m.line + 1 AS number_of_lines
    FROM (SELECT * FROM {method} WHERE NOT is_external AND regexp_full_match(name, 'fn_.*7') AND id IN (SELECT method_id FROM {call} WHERE name IN ('free', 'cfree')) ORDER BY id LIMIT 100) m""")
def list_methods_filtered(g):
    return browse.list_methods(g, name="fn_.*7", callee="free|cfree", limit=100)


@query("SELECT DISTINCT m.name AS caller, c.name AS callee, c.code, c.file, c.line FROM {call} c JOIN {method} m ON c.method_id = m.id WHERE regexp_full_match(c.name, 'mem.*|str.*')")
def list_calls(g):
    return browse.list_calls(g, callee="mem.*|str.*", limit=None)


@query("SELECT m.id, m.name, coalesce(string_agg(type_full_name || ' ' || p.name, ', ' ORDER BY ord), '') AS parameters FROM {method} m LEFT JOIN {parameter} p ON p.method_id = m.id GROUP BY m.id, m.name")
def list_parameters(g):
    return browse.list_parameters(g)


@query("SELECT id, code, type_full_name, file, line FROM {literal} WHERE regexp_full_match(code, '\"s[0-9]+\"') ORDER BY id LIMIT 50")
def find_literals(g):
    return browse.find_literals(g, '"s[0-9]+"', r"char\*")


@query("""
    WITH t AS (SELECT * FROM {type_decl} WHERE regexp_full_match(name, 'T_.*1.*') AND id IN (SELECT type_id FROM {member}) ORDER BY id LIMIT 10),
    r AS (SELECT m.*, row_number() OVER (PARTITION BY type_id ORDER BY ord, name, type_full_name) AS r FROM {member} m)
    SELECT t.id, t.name, full_name, file, line, string_agg(r.type_full_name || ' ' || r.name, '; ' ORDER BY r.r) AS members FROM t JOIN r ON r.type_id = t.id AND r.r <= 20 GROUP BY t.id, t.name, full_name, file, line""")
def type_definition(g):
    return browse.type_definition(g, "T_.*1.*")


@query("""
    SELECT (SELECT count(DISTINCT file) FROM {method}) AS files, (SELECT count(*) FROM {method}) AS methods, (SELECT count(*) FROM {method} WHERE NOT is_external) AS user_methods,
      (SELECT count(*) FROM {call}) AS calls, (SELECT count(*) FROM {literal}) AS literals""")
def codebase_summary(g):
    return browse.codebase_summary(g)


_SITES = "SELECT c.id, c.name, c.code, c.file, c.line, m.full_name AS method FROM {{call}} c JOIN {{method}} m ON c.method_id = m.id WHERE c.name IN ({})"


@query(_SITES.format(quoted(dicts.TAINT_SOURCES["c"])))
def taint_sources(g):
    return browse.call_sites(g, dicts.TAINT_SOURCES["c"], limit=None)


@query(_SITES.format(quoted(dicts.TAINT_SINKS["c"])) + " AND regexp_matches(c.file, '(^|/)f1')")
def taint_sinks(g):
    return browse.call_sites(g, dicts.TAINT_SINKS["c"], file="f1", limit=None)


@query(f"SELECT id, name, code, file, line FROM {{call}} WHERE name IN ({quoted(dicts.COMMAND_SINKS['c'])}) AND id IN (SELECT call_id FROM {{argument}} WHERE arg_index = 1 AND kind <> 'LITERAL')")
def cmd_injection(g):
    return browse.command_sinks(g, dicts.COMMAND_SINKS["c"], limit=None)


@query("""
    SELECT file, line, method_id, name FROM (
      SELECT p.file, p.line, m.id AS method_id, m.name, row_number() OVER (PARTITION BY p.file, p.line ORDER BY m.line DESC, m.id) AS r
      FROM (SELECT DISTINCT file, line FROM {call}) p JOIN {method} m ON p.file = m.file AND p.line BETWEEN m.line AND m.line_end) x WHERE r = 1""")
def enclosing_method(g):
    return browse.enclosing_method(g, g.call.select("file", "line").distinct())


@query("SELECT id, name FROM {method} WHERE is_external AND id NOT IN (SELECT method_id FROM {call})")
def gated_bodies(g):
    return browse.gated_bodies(g)


@query("""
    WITH own AS (SELECT * FROM {cfg} WHERE method_id = 7), n AS (SELECT n FROM (SELECT src AS n FROM own UNION SELECT dst FROM own) ORDER BY n LIMIT 100)
    SELECT src, dst, label FROM own WHERE src IN (SELECT n FROM n) AND dst IN (SELECT n FROM n)""")
def cfg_subgraph(g):
    return browse.cfg_subgraph(g, 7)


@query("SELECT callee_id, count(*) AS sites, count(DISTINCT method_id) AS callers FROM {call} WHERE callee_id IS NOT NULL GROUP BY callee_id")
def callers(g):
    return browse.callers_of(g)


@query("""
    WITH d AS (SELECT DISTINCT m.name AS caller, c.name AS callee, c.code, c.file, c.line FROM {call} c JOIN {method} m ON c.method_id = m.id WHERE regexp_full_match(c.name, 'mem.*|str.*')),
    r AS (SELECT *, CAST(row_number() OVER (ORDER BY caller, callee, code, file, line) AS INT) AS place, (SELECT count(*) FROM d) AS n FROM d)
    SELECT caller, callee, code, file, line, place, least(n, 300) AS total, n > 300 AS truncated, CAST(ceil(least(n, 300) / 40.0) AS BIGINT) AS pages FROM r WHERE place BETWEEN 81 AND 120 AND place <= 300""")
def list_calls_page(g):
    return browse.page(browse.list_calls(g, callee="mem.*|str.*", limit=None), ["caller", "callee", "code", "file", "line"], number=3, size=40, limit=300)


@query("""
    WITH p AS (SELECT DISTINCT file, line + 1 AS line FROM {literal}), f AS (SELECT id AS method_id, file FROM {method}),
    n AS (SELECT method_id, line AS at, id AS node, CASE WHEN starts_with(name, '<operator>') THEN 3 ELSE 0 END AS rank, code FROM {call}
      UNION ALL SELECT method_id, line, id, 1, target || ' = ' || source FROM {assignment} UNION ALL SELECT method_id, line, id, 2, condition FROM {control}),
    h AS (SELECT p.file, p.line, n.at - p.line AS delta, node, code, n.method_id, row_number() OVER (PARTITION BY p.file, p.line ORDER BY abs(n.at - p.line), n.at, rank, node, code, n.method_id) AS r
      FROM p JOIN f ON p.file = f.file JOIN n ON n.method_id = f.method_id AND n.at BETWEEN p.line - 3 AND p.line + 3)
    SELECT file, line, delta, node, code, method_id FROM h WHERE r = 1""")
def anchor_search(g):
    return browse.anchors(g, g.literal.select("file", (F.col("line") + 1).alias("line")))


@query("SELECT DISTINCT name FROM {method} WHERE contains(name, 'n_1') AND NOT EXISTS (SELECT 1 FROM {method} WHERE name = 'n_1') ORDER BY name LIMIT 10")
def name_suggestions(g):
    return browse.name_suggestions(g, "n_1")


@query("SELECT '{\"id\":' || id || ',\"name\":\"' || name || '\"}' AS json FROM [method]".replace("{", "{{").replace("}", "}}").replace("[", "{").replace("]", "}"))
def methods_json(g):
    return browse.as_json(g.method.select("id", "name"))


# --- graph iteration

_EDGES = "e AS (SELECT DISTINCT method_id AS src, callee_id AS dst FROM {call} WHERE callee_id IS NOT NULL)"
_LEVELS = """WITH RECURSIVE {e}, w AS (
      SELECT DISTINCT {start} AS node, 0 AS depth {frm}
      UNION SELECT e.dst, w.depth + 1 FROM w JOIN e ON w.node = e.src WHERE w.depth < {depth}),
    seen AS (SELECT node, min(depth) AS depth FROM w GROUP BY node)"""


def _levels(start: str, frm: str, depth: int, edges: str = _EDGES) -> str:
    return _LEVELS.format(e=edges, start=start, frm=frm, depth=depth)


_OUT = "e AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM (SELECT DISTINCT method_id AS src, callee_id AS dst FROM {call} WHERE callee_id IS NOT NULL)) WHERE r <= 50)"
_IN = "e AS (SELECT src, dst FROM (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) AS r FROM (SELECT DISTINCT callee_id AS src, method_id AS dst FROM {call} WHERE callee_id IS NOT NULL)) WHERE r <= 50)"
_GRAPH = " SELECT e.src, e.dst, a.depth + 1 AS depth, b.depth <= a.depth AS is_cycle FROM e JOIN seen a ON e.src = a.node AND a.depth < {d} JOIN seen b ON e.dst = b.node"


@query(_levels("id", "FROM {method} WHERE id = 7", 3, _OUT) + _GRAPH.format(d=3))
def call_graph_out(g):
    return iterate.call_graph(g, 7, 3)


@query(_levels("id", "FROM {method} WHERE id = 7", 2, _IN) + _GRAPH.format(d=2))
def call_graph_in(g):
    return iterate.call_graph(g, 7, 2, "incoming")


@query(_levels("method_id", f"FROM {{call}} WHERE name IN ({quoted(dicts.EXTERNAL_INPUTS)})", 4) + " SELECT node, depth FROM seen")
def entry_reach(g):
    return iterate.entry_reach(g, dicts.EXTERNAL_INPUTS, 4)


@query(_levels("id", "FROM {method} WHERE id = 7", 5) + " SELECT coalesce(min(depth), -1) AS hops FROM seen WHERE node = 100")
def call_path_exists(g):
    return iterate.call_path_exists(g, 7, 100)


@query(_levels("src", "FROM {ddg} WHERE src NOT IN (SELECT dst FROM {ddg})", 6, "e AS (SELECT src, dst FROM {ddg})") + " SELECT node, depth FROM seen")
def taint_reach(g):
    first = g.ddg.select(F.col("src").alias("node")).join(g.ddg.select(F.col("dst").alias("node")), "node", "left_anti")
    return iterate.reach(g.ddg, first, 6)


_PATHS = """WITH RECURSIVE w AS (
      SELECT CAST(85 AS BIGINT) AS node, [CAST(85 AS BIGINT)] AS path
      UNION ALL SELECT d.dst, list_append(w.path, d.dst) FROM w JOIN {{ddg}} d ON w.node = d.src WHERE len(w.path) <= 3 AND NOT list_contains(w.path, d.dst){avoid})
    SELECT node, CAST(len(path) AS INT) AS length, array_to_string(path, '>') AS path FROM w WHERE len(path) > 1 ORDER BY length, path LIMIT 20"""


@query(_PATHS.format(avoid=""))
def taint_flow_paths(g):
    return iterate.flow_paths(g, 85, 3)


@query(_PATHS.format(avoid=" AND d.dst % 5 <> 0"))
def taint_flows_sanitized(g):
    return iterate.flow_paths(g, 85, 3, avoid=g.ddg.where("dst % 5 = 0").select(F.col("dst").alias("node")))


_SLICE = """WITH RECURSIVE a AS (SELECT DISTINCT id, method_id, line AS at, target, source, u AS used FROM (SELECT *, unnest(regexp_extract_all(source, '\\b(v[0-9]+|[A-Za-z_]\\w*)\\b', 1)) AS u FROM {{assignment}})),
    w AS (SELECT DISTINCT method_id, 'v1' AS var, line, 0 AS depth, CAST(NULL AS BIGINT) AS id FROM {{control}} WHERE type = 'FOR'
      UNION SELECT w.method_id, a.{next}, a.at, w.depth + 1, a.id FROM w JOIN a ON a.method_id = w.method_id AND a.{on} = w.var AND a.at {cmp} w.line WHERE w.depth < 3)
    SELECT s.id, s.method_id, s.line, s.target, s.source, min(w.depth) AS depth FROM w JOIN {{assignment}} s ON s.id = w.id GROUP BY s.id, s.method_id, s.line, s.target, s.source"""


def _seeds(g: Graph) -> DataFrame:
    return g.control.where("type = 'FOR'").select("method_id", F.lit("v1").alias("var"), "line").distinct()


@query(_SLICE.format(next="used", on="target", cmp="<"))
def backward_slice(g):
    return iterate.slice_variable(g, _seeds(g), 3)


@query(_SLICE.format(next="target", on="used", cmp=">"))
def forward_slice(g):
    return iterate.slice_variable(g, _seeds(g), 3, forward=True)


# The same operators over the whole job: every source, and the depths of the reference.


@query(_levels("id", "FROM {method} WHERE id = 7", 5, _OUT) + _GRAPH.format(d=5))
def call_graph_out_full(g):
    return iterate.call_graph(g, 7)


@query(_levels("id", "FROM {method} WHERE id = 7", 5, _IN) + _GRAPH.format(d=5))
def call_graph_in_full(g):
    return iterate.call_graph(g, 7, direction="incoming")


def _visited(near: str, far: str, depth: int, sites: int = 50, limit: int = 500) -> str:
    """A breadth-first visit, one level of it after another."""
    out = [
        f"s AS (SELECT {near} AS near, {far} AS far, row_number() OVER (PARTITION BY {near} ORDER BY id) AS r FROM {{call}} WHERE callee_id IS NOT NULL)",
        f"n AS (SELECT near, far, min(r) AS r FROM s WHERE r <= {sites} GROUP BY near, far)",
        "f0 AS (SELECT id AS node, 1 AS visit FROM {method} WHERE id = 7)",
        "seen0 AS (SELECT * FROM f0)",
        "e0 AS (SELECT 0 AS visit, 0 AS near, 0 AS far, 0 AS place, 0 AS depth WHERE false)",
    ]
    for k in range(1, depth + 1):
        before = f"e{k - 1}"
        out += [
            f"a{k} AS (SELECT visit, near, far, row_number() OVER (ORDER BY visit, r) + (SELECT count(*) FROM {before}) AS place FROM f{k - 1} JOIN n ON near = node)",
            f"g{k} AS (SELECT visit, near, far, place, {k} AS depth FROM a{k} QUALIFY min(place) OVER (PARTITION BY visit) <= {limit})",
            f"e{k} AS (SELECT * FROM {before} UNION ALL SELECT * FROM g{k})",
            f"f{k} AS (SELECT far AS node, row_number() OVER (ORDER BY min(place)) + (SELECT count(*) FROM seen{k - 1}) AS visit FROM g{k} WHERE far NOT IN (SELECT node FROM seen{k - 1}) GROUP BY far)",
            f"seen{k} AS (SELECT * FROM seen{k - 1} UNION ALL SELECT * FROM f{k})",
        ]
    caller, callee = ("near", "far") if near == "method_id" else ("far", "near")
    return f"WITH {', '.join(out)} SELECT CAST(place AS INT) AS place, {caller} AS caller, {callee} AS callee, e.depth, coalesce(v.visit <= e.visit, false) AS is_cycle FROM e{depth} e LEFT JOIN seen{depth} v ON v.node = far"


@query(_visited("method_id", "callee_id", 5))
def call_graph_bounded(g):
    return iterate.call_graph_bounded(g, 7)


@query(_visited("callee_id", "method_id", 5))
def call_graph_bounded_in(g):
    return iterate.call_graph_bounded(g, 7, direction="incoming")


@query(_levels("method_id", f"FROM {{call}} WHERE name IN ({quoted(dicts.EXTERNAL_INPUTS)})", 9) + " SELECT node, depth FROM seen")
def entry_reach_full(g):
    return iterate.entry_reach(g, dicts.EXTERNAL_INPUTS)


@query(f"""WITH RECURSIVE {_EDGES}, w AS (
      SELECT DISTINCT method_id, 0 AS hops, method_id AS entry FROM {{call}} WHERE name IN ({quoted(dicts.EXTERNAL_INPUTS)})
      UNION SELECT e.dst, w.hops + 1, w.entry FROM w JOIN e ON w.method_id = e.src WHERE w.hops < 9)
    SELECT method_id, hops, entry FROM (SELECT *, row_number() OVER (PARTITION BY method_id ORDER BY hops, entry) AS r FROM w) WHERE r = 1""")
def entry_points(g):
    return iterate.entry_points(g, dicts.EXTERNAL_INPUTS)


@query(_levels("id", "FROM {method} WHERE id = 7", 5, _OUT) + ", k AS (" + _GRAPH.format(d=5) + ") SELECT depth, count(*) AS edges, count(*) FILTER (is_cycle) AS cyclic FROM k GROUP BY depth")
def call_graph_depths(g):
    return iterate.edges_by_depth(iterate.call_graph(g, 7))


@query(f"""WITH RECURSIVE w AS (
      SELECT id AS node FROM {{call}} WHERE name IN ({quoted(dicts.TAINT_SOURCES["c"])})
      UNION SELECT d.dst FROM w JOIN {{ddg}} d ON w.node = d.src)
    SELECT node FROM w""")
def taint_reach_full(g):
    return iterate.taint_reach(g, dicts.TAINT_SOURCES["c"]).select("node")


@query(_PATHS.replace("<= 3", "<= 4").format(avoid=""))
def taint_flow_paths_full(g):
    return iterate.flow_paths(g, 85)


@query(_PATHS.replace("<= 3", "<= 4").format(avoid=" AND d.dst % 5 <> 0"))
def taint_flows_sanitized_full(g):
    return iterate.flow_paths(g, 85, avoid=g.ddg.where("dst % 5 = 0").select(F.col("dst").alias("node")))


_FULL_SLICE = _SLICE.replace("w.depth < 3", "w.depth < 5")


@query(_FULL_SLICE.format(next="used", on="target", cmp="<"))
def backward_slice_full(g):
    return iterate.slice_variable(g, _seeds(g))


@query(_FULL_SLICE.format(next="target", on="used", cmp=">"))
def forward_slice_full(g):
    return iterate.slice_variable(g, _seeds(g), forward=True)


_NAMES_IN = "regexp_extract_all({}, '\\b([A-Za-z_]\\w*)\\b', 1)"
_CALLEES = """cs AS (SELECT id AS call_id, method_id, line, callee_id FROM {call} WHERE callee_id IS NOT NULL
      UNION SELECT c.id, c.method_id, c.line, m.id FROM {call} c JOIN {method} m ON m.name = c.name WHERE c.dispatch_type = 'DYNAMIC_DISPATCH'),
    ps AS (SELECT DISTINCT cs.*, a.code, a.kind, p.name AS param FROM cs JOIN {argument} a ON a.call_id = cs.call_id JOIN {parameter} p ON p.method_id = cs.callee_id AND p.ord = a.arg_index)"""
_BETWEEN = """WITH RECURSIVE {callees}, s AS ({steps}),
    w AS (SELECT DISTINCT method_id, 'v1' AS var, line, 0 AS depth, CAST(NULL AS BIGINT) AS id, '' AS kind, CAST(NULL AS BIGINT) AS in_method, '' AS of_var, CAST(0 AS INT) AS at FROM {{control}} WHERE type = 'FOR'
      UNION SELECT s.next_method, s.next_var, s.next_line, w.depth + 1, s.id, s.kind, s.method_id, s.var, s.at FROM w JOIN s ON s.method_id = w.method_id AND s.var = w.var AND s.bound {cmp} w.line WHERE w.depth < 5)
    SELECT id, kind, in_method AS method_id, of_var AS var, w.at AS line, min(depth) AS depth FROM w WHERE id IS NOT NULL GROUP BY id, kind, in_method, of_var, w.at"""
_BACK_STEPS = f"""SELECT DISTINCT x.method_id, x.var, x.line AS bound, x.id, 'assignment' AS kind, x.line AS at, x.method_id AS next_method, n.name AS next_var, x.line AS next_line
      FROM (SELECT *, unnest(list_distinct([target, regexp_extract(target, '^(\\w+)(\\[|->|\\.)', 1), regexp_extract(target, '(->|\\.)(\\w+)$', 2)])) AS var FROM {{assignment}} WHERE line > 0) x
      LEFT JOIN (SELECT id, unnest({_NAMES_IN.format("source")}) AS name FROM {{assignment}}) n ON n.id = x.id AND n.name <> x.var WHERE regexp_full_match(x.var, '\\w+')
      UNION SELECT callee_id, param, -1, call_id, 'argument', line, method_id, unnest({_NAMES_IN.format("code")}), line FROM ps WHERE kind <> 'LITERAL'"""
_FORWARD_STEPS = f"""SELECT DISTINCT method_id, var, line AS bound, id, 'assignment' AS kind, line AS at, method_id AS next_method, CASE WHEN regexp_extract(target, '^[*&]*(\\w+)', 1) <> var THEN regexp_extract(target, '^[*&]*(\\w+)', 1) END AS next_var, line AS next_line
      FROM (SELECT *, unnest({_NAMES_IN.format("source")}) AS var FROM {{assignment}} WHERE line > 0)
      UNION SELECT a.method_id, a.var, a.line, a.call_id, 'argument', a.line, i.callee_id, i.name, i.line
      FROM (SELECT *, unnest({_NAMES_IN.format("code")}) AS var FROM {{argument}} WHERE kind <> 'LITERAL') a
      LEFT JOIN (SELECT cs.call_id, cs.callee_id, p.ord, p.name, m.line FROM cs JOIN {{parameter}} p ON p.method_id = cs.callee_id JOIN {{method}} m ON m.id = cs.callee_id) i ON i.call_id = a.call_id AND i.ord = a.arg_index"""


def _between(steps: str, cmp: str) -> str:
    return _BETWEEN.replace("{callees}", _CALLEES).replace("{steps}", steps).replace("{cmp}", cmp).replace("{{", "{").replace("}}", "}")


@query(_between(_BACK_STEPS, "<"))
def backward_slice_interproc(g):
    return iterate.slice_between(g, _seeds(g))


_UPDATES = "xs AS (SELECT id, method_id, line, target, source, 'assignment' AS kind FROM {assignment} UNION ALL SELECT c.id, c.method_id, c.line, t.code, s.code, 'compound' FROM {call} c JOIN {argument} t ON t.call_id = c.id AND t.arg_index = 1 JOIN {argument} s ON s.call_id = c.id AND s.arg_index = 2 WHERE c.name = '<operator>.addition')"
_UPDATE_STEPS = _BACK_STEPS.replace("{assignment}", "xs").replace("x.id, 'assignment' AS kind", "x.id, x.kind").replace("(SELECT id, unnest", "(SELECT id, kind, unnest").replace("n.id = x.id", "n.id = x.id AND n.kind = x.kind")


@query(_between(_UPDATE_STEPS, "<").replace("WITH RECURSIVE ", f"WITH RECURSIVE {_UPDATES}, "))
def backward_slice_compound(g):
    """The graph's sums are taken for compound ones."""
    name = F.when(F.col("name") == "<operator>.addition", "<operator>.assignmentPlus").otherwise(F.col("name"))
    updating = Graph(g.spark, lambda table: g.call.withColumn("name", name) if table == "call" else getattr(g, table))
    return iterate.slice_between(updating, _seeds(g))


@query(_between(_FORWARD_STEPS, ">"))
def forward_slice_interproc(g):
    return iterate.slice_between(g, _seeds(g), forward=True)


def _flow_ends(g: Graph) -> list[DataFrame]:
    """Calls of the sources, sinks and sanitizers of C, all out of one pass."""
    kinds = [dicts.TAINT_SOURCES["c"], dicts.TAINT_SINKS["c"], dicts.SANITIZERS["c"]]
    calls = iterate.flow_calls(g, sorted({n for names in kinds for n in names}))
    return [calls.where(P.any_of(F.col("name"), names)).select("node") for names in kinds]


_FLOWS = f"""WITH RECURSIVE sinks AS (SELECT id FROM {{call}} WHERE name IN ({quoted(dicts.TAINT_SINKS["c"])})), clean AS (SELECT id FROM {{call}} WHERE name IN ({quoted(dicts.SANITIZERS["c"])})),
    e AS (SELECT DISTINCT src, dst, dst IN (SELECT id FROM sinks) AS ends FROM {{ddg}}),
    w AS (SELECT id AS source, id AS node, [id] AS path, false AS ends FROM {{call}} WHERE name IN ({quoted(dicts.TAINT_SOURCES["c"])})
      UNION ALL SELECT w.source, e.dst, list_append(w.path, e.dst), e.ends FROM w JOIN e ON w.node = e.src
        WHERE NOT w.ends AND len(w.path) <= 8 AND NOT list_contains(w.path, e.dst) AND (e.ends OR e.dst NOT IN (SELECT id FROM clean)))
    SELECT source, node AS sink, CAST(len(path) AS INT) AS length, array_to_string(path, '>') AS path FROM w WHERE ends"""


@query(_FLOWS)
def taint_flows_between(g):
    sources, sinks, sanitizers = _flow_ends(g)
    return iterate.flows_between(g, sources, sinks, sanitizers=sanitizers)


@query(_FLOWS + " ORDER BY length, path LIMIT 20")
def taint_flows_first(g):
    sources, sinks, sanitizers = _flow_ends(g)
    return iterate.flows_between(g, sources, sinks, limit=20, sanitizers=sanitizers)


@query("""WITH cs AS (SELECT callee_id FROM {call} WHERE callee_id IS NOT NULL UNION SELECT m.id FROM {call} c JOIN {method} m ON m.name = c.name WHERE c.dispatch_type = 'DYNAMIC_DISPATCH'),
    x AS (SELECT call_id AS site, method_id AS at_method, line, ltrim(code, '&') AS name FROM {argument} WHERE kind <> 'LITERAL' UNION SELECT id, method_id, line, ltrim(source, '&') FROM {assignment})
    SELECT DISTINCT m.id AS method_id, m.name, site, at_method, x.line FROM {method} m JOIN x ON x.name = m.name WHERE NOT m.is_external AND m.id NOT IN (SELECT callee_id FROM cs)""")
def address_taken(g):
    return iterate.address_taken(g, limit=None)


# --- detectors

_CLEAR = """NOT EXISTS (SELECT 1 FROM {{assignment}} z WHERE z.method_id = x.method_id AND z.target = x.ptr AND (z.line > x.a AND z.line < x.b OR x.a = x.b AND z.line = x.a))
  AND NOT EXISTS (SELECT 1 FROM {{apart}} p JOIN {{apart}} q ON p.control_id = q.control_id AND p.branch <> q.branch
    WHERE p.method_id = x.method_id AND x.a BETWEEN p.line AND p.line_end AND x.b BETWEEN q.line AND q.line_end)""".replace("{{", "{").replace("}}", "}")
_RETURN = """ AND NOT EXISTS (SELECT 1 FROM {ret} r WHERE r.method_id = x.method_id AND r.line > x.a AND r.line < x.b
    AND NOT EXISTS (SELECT 1 FROM {control} c WHERE c.method_id = r.method_id AND r.line BETWEEN c.line AND c.line_end))"""
_NO_EXIT = f"""NOT EXISTS (SELECT 1 FROM {{call}} e WHERE e.method_id = x.method_id AND e.name IN ({quoted(dicts.EXITS)}) AND e.line > x.a AND e.line < x.b)
      AND NOT EXISTS (SELECT 1 FROM {{ret}} r WHERE r.method_id = x.method_id AND r.line > x.a AND r.line < x.b AND NOT EXISTS (SELECT 1 FROM {{control}} c WHERE c.method_id = r.method_id AND c.line > x.a AND c.line <= r.line AND c.line_end >= r.line))"""
_APART = _CLEAR[_CLEAR.index("NOT EXISTS (SELECT 1 FROM {apart}") :]
_CLEAR_ONE = _CLEAR[: _CLEAR.index("AND NOT EXISTS (SELECT 1 FROM {apart}")]
_ARG = "SELECT c.id, c.method_id, c.name, c.line, c.file, trim(a.code) AS arg, a.kind, a.decl_id FROM {{call}} c JOIN {{argument}} a ON a.call_id = c.id AND a.arg_index = {i} WHERE c.name IN ({names})"
_FREES = _ARG.format(i=1, names="'free', 'cfree'") + " AND NOT contains(trim(a.code), '(') AND NOT contains(trim(a.code), '[') AND length(trim(a.code)) < 50"
_USE = "(g.code = s.ptr OR starts_with(g.code, s.ptr || '->') OR starts_with(g.code, s.ptr || '[') OR starts_with(g.code, '*' || s.ptr))"


@query(f"""
    WITH f AS ({_FREES}), site AS (SELECT id, method_id, line, arg AS ptr FROM (SELECT *, row_number() OVER (PARTITION BY method_id, arg ORDER BY line, id) AS r FROM f) y WHERE r = 1),
    al AS (SELECT DISTINCT s.id, s.method_id, s.line, z.target AS ptr FROM site s JOIN {{assignment}} z ON z.method_id = s.method_id AND z.line < s.line
      AND (z.source = s.ptr OR z.source = '&' || s.ptr) AND z.target <> s.ptr AND NOT contains(z.target, '(') AND NOT contains(z.target, '[')),
    s AS (SELECT *, 'direct' AS via FROM site UNION ALL SELECT *, 'alias' FROM al),
    late AS (SELECT DISTINCT x.site AS id, x.method_id, x.b AS line, x.target AS ptr FROM (SELECT s.id AS site, s.method_id, s.ptr, s.line AS a, z.line AS b, z.target FROM s JOIN {{assignment}} z ON z.method_id = s.method_id AND z.line > s.line
      AND z.source = s.ptr AND z.target <> s.ptr AND NOT contains(z.target, '(') AND NOT contains(z.target, '[') AND length(z.target) < 50) x WHERE {_CLEAR_ONE}{_RETURN}),
    x AS (SELECT DISTINCT s.id AS site, s.method_id, s.ptr, s.line AS a, g.line AS b, g.call_id, s.via FROM (SELECT * FROM s UNION ALL SELECT *, 'post-free-alias' FROM late) s
        JOIN {{argument}} g ON g.method_id = s.method_id AND (g.line > s.line OR g.line = s.line AND g.call_id > s.id AND s.via <> 'post-free-alias') AND {_USE}
      WHERE g.call_id NOT IN (SELECT id FROM {{call}} WHERE name IN ('free', 'cfree')))
    SELECT site, method_id, ptr, via, a AS line, count(DISTINCT b) AS uses, min(b) AS first_use FROM x WHERE {_CLEAR}{_RETURN} GROUP BY site, method_id, ptr, via, a""")
def use_after_free(g):
    return detectors.use_after_free(g)


@query(f"""
    WITH f AS ({_FREES}), z AS (SELECT method_id, line, source, target FROM {{assignment}} WHERE NOT regexp_matches(source || target, '[(\\[]') AND length(source) < 50 AND length(target) < 50),
    w AS (SELECT method_id, line, source AS ptr, target AS other FROM z UNION ALL SELECT method_id, line, target, source FROM z),
    x AS (SELECT p.id AS site, p.method_id, p.arg AS ptr, 'same-ptr' AS via, p.line AS a, q.line AS b FROM f p JOIN f q ON p.method_id = q.method_id AND p.arg = q.arg AND (q.line > p.line OR q.line = p.line AND q.id > p.id)
      UNION SELECT p.id, p.method_id, p.arg, 'alias', p.line, q.line FROM f p JOIN w ON w.method_id = p.method_id AND w.ptr = p.arg AND w.line < p.line AND w.other <> w.ptr
        JOIN f q ON p.method_id = q.method_id AND w.other = q.arg AND (q.line > p.line OR q.line = p.line AND q.id > p.id))
    SELECT site, method_id, ptr, via, a AS line, min(b) AS second FROM x WHERE {_CLEAR}{_RETURN} GROUP BY site, method_id, ptr, via, a""")
def double_free(g):
    return detectors.double_free(g)


_ALLOC = """SELECT id, method_id, line, name, ptr FROM (SELECT c.id, c.method_id, c.line, c.name, z.target AS ptr, row_number() OVER (PARTITION BY c.id ORDER BY z.id) AS r
      FROM {{call}} c JOIN {{assignment}} z ON z.method_id = c.method_id AND z.line = c.line AND contains(z.source, c.name || '(') WHERE c.name IN ({names})) y
      WHERE r = 1 AND NOT contains(ptr, '(') AND NOT contains(ptr, '[') AND NOT starts_with(ptr, '*') AND NOT starts_with(ptr, '&')"""
_NULLS = r"""SELECT DISTINCT method_id, line, CASE WHEN regexp_full_match(c, '[A-Za-z_]\w*\s*[!=]=\s*(NULL|0)') THEN regexp_extract(c, '^([A-Za-z_]\w*)', 1)
      WHEN regexp_full_match(c, '(NULL|0)\s*[!=]=\s*[A-Za-z_]\w*') THEN regexp_extract(c, '([A-Za-z_]\w*)$', 1)
      WHEN regexp_full_match(c, '!\s*\(?[A-Za-z_]\w*') THEN regexp_extract(c, '([A-Za-z_]\w*)$', 1) WHEN regexp_full_match(c, '[A-Za-z_]\w*') THEN c END AS ptr
      FROM (SELECT method_id, line, trim(unnest(string_split_regex(replace(condition, 'nullptr', 'NULL'), '&&|\|\|'))) AS c FROM {control} WHERE type = 'IF')"""


@query(_NULLS.replace("SELECT DISTINCT", "SELECT * FROM (SELECT DISTINCT") + ") WHERE ptr IS NOT NULL")
def null_checks(g):
    return detectors.null_checks(g)


@query(f"""
    WITH s AS ({_ALLOC.format(names=quoted(dicts.ALLOCATORS))}), n AS ({_NULLS}),
    x AS (SELECT DISTINCT s.id AS site, s.method_id, s.ptr, s.line AS a, g.line AS b FROM s JOIN {{argument}} g ON g.method_id = s.method_id AND g.line > s.line AND {_USE}
      WHERE g.call_id NOT IN (SELECT id FROM {{call}} WHERE name IN ({quoted(dicts.DEREF_EXEMPT)})))
    SELECT site, method_id, ptr, a AS line, count(DISTINCT b) AS uses FROM x WHERE {_CLEAR}
      AND {_NO_EXIT}
      AND NOT EXISTS (SELECT 1 FROM n WHERE n.method_id = x.method_id AND n.ptr = x.ptr AND n.line > x.a AND n.line <= x.b) GROUP BY site, method_id, ptr, a""")
def null_deref_unchecked(g):
    return detectors.null_deref(g)


def _case(table: dict, column: str = "c.name") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + " END"


def _has(code: str, name: str) -> str:
    words = "' ' || trim(regexp_replace({}, '[^A-Za-z0-9_]+', ' ', 'g')) || ' '"
    return f"contains({words.format(code)}, {words.format(name)})"


_LIMITS = "|".join(dicts.OVERFLOW_GUARDS)
_FIXED = "regexp_full_match(trim(code), '-?[0-9]+[UuLl]*|0[xX][0-9a-fA-F]+[UuLl]*|sizeof.*')"

#: The outermost risky arithmetic of each expression (f), and the identifiers in it (w).
_RISKY = f"""k AS (SELECT root_id, root_ord, parent AS pre, count(*) AS n, count(*) FILTER (NOT {_FIXED}) AS open, count(*) FILTER ({_FIXED} AND try_cast(trim(code) AS BIGINT) > 4096) AS large
      FROM {{ast}} WHERE parent >= 0 GROUP BY root_id, root_ord, parent),
    o AS (SELECT root_id, root_ord, pre, post, code, name, CASE WHEN name IN ({quoted(dicts.HIGH_RISK_OPERATORS)}) THEN 'HIGH' ELSE 'MEDIUM' END AS risk FROM {{ast}} JOIN k USING (root_id, root_ord, pre)
      WHERE name IN ({quoted(dicts.HIGH_RISK_OPERATORS)}) AND n >= 2 AND open >= 1 OR name IN ({quoted(dicts.MEDIUM_RISK_OPERATORS)}) AND (open >= 2 OR open = 1 AND large >= 1)),
    f AS (SELECT root_id, root_ord, risk, pre, post, code AS arithmetic, replace(replace(name, '<operator>.', ''), 'shiftLeft', 'left-shift') AS op
      FROM (SELECT *, row_number() OVER (PARTITION BY root_id, root_ord, risk ORDER BY pre) AS r FROM o) WHERE r = 1),
    w AS (SELECT f.root_id, f.root_ord, f.risk, list(DISTINCT t.name) AS names FROM f JOIN {{ast}} t ON t.root_id = f.root_id AND t.root_ord = f.root_ord AND t.pre BETWEEN f.pre AND f.post AND t.kind = 'IDENTIFIER' GROUP BY ALL),
    risky AS (SELECT f.*, coalesce(names, []) AS names FROM f LEFT JOIN w USING (root_id, root_ord, risk))"""
_SIZES = f"z AS (SELECT id, method_id, file, line, {_case(dicts.OVERFLOW_SIZE, 'name')} AS root_ord FROM {{call}} WHERE name IN ({quoted(dicts.OVERFLOW_SIZE)}))"
_UNGUARDED = f"""len(names) = 0 OR NOT EXISTS (SELECT 1 FROM {{control}} c WHERE c.method_id = x.method_id AND c.type = 'IF' AND c.line <= x.line AND (regexp_matches(c.condition, '{_LIMITS}')
        OR contains(c.condition, '__builtin_') AND contains(c.condition, 'overflow') OR contains(c.condition, '/') AND regexp_matches(c.condition, '\\b(' || array_to_string(names, '|') || ')\\b')))"""
_OVERFLOWS = f"""{_RISKY}, {_SIZES},
    v AS (SELECT z.id, z.method_id, z.file, z.line, t.name, min(t.pre) AS place FROM z JOIN {{ast}} t ON t.root_id = z.id AND t.root_ord = z.root_ord WHERE t.kind = 'IDENTIFIER' GROUP BY ALL),
    l AS (SELECT v.*, s.id AS assign_id, row_number() OVER (PARTITION BY v.id, v.name ORDER BY s.line DESC, s.id DESC) AS r FROM v JOIN {{assignment}} s ON s.method_id = v.method_id AND s.target = v.name AND s.line < v.line),
    x AS (SELECT z.id, file, line, method_id, arithmetic, op, risk, names, CASE risk WHEN 'HIGH' THEN 1 ELSE 2 END AS phase, NULL AS size, 0 AS place FROM z JOIN risky ON risky.root_id = z.id AND risky.root_ord = z.root_ord
      UNION ALL SELECT l.id, file, line, method_id, arithmetic, op, risk, names, 3, name, place FROM l JOIN risky ON risky.root_id = l.assign_id AND risky.root_ord = 0 AND risk = 'HIGH' WHERE r = 1),
    found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file, method_id, line ORDER BY id, phase, place) AS nth FROM (SELECT * FROM x WHERE {_UNGUARDED})) WHERE nth = 1)"""


@query(f"""WITH {_OVERFLOWS}
    SELECT id, file, line, method_id, arithmetic, op, risk, CASE phase WHEN 3 THEN 'alloc_indirect_arithmetic' ELSE 'alloc_arithmetic' END AS issue_type, size FROM found""")
def int_overflow_tree(g):
    return detectors.integer_overflow_sizes(g)


@query(f"WITH {_OVERFLOWS} SELECT id, method_id, line, size, arithmetic FROM found WHERE phase = 3")
def int_overflow_indirect(g):
    return detectors.integer_overflow(g)


@query(f"WITH {_OVERFLOWS} SELECT id, method_id, line, arithmetic, op, risk FROM found WHERE phase < 3")
def int_overflow_direct(g):
    return detectors.integer_overflow_direct(g)


@query("""SELECT t.root_id, t.root_ord, t.method_id, count(*) AS nodes, count(*) FILTER (b.kind = 'CALL') AS calls, count(*) FILTER (b.kind = 'IDENTIFIER') AS identifiers, count(*) FILTER (b.kind = 'LITERAL') AS literals,
      coalesce(string_agg(DISTINCT CASE WHEN b.kind = 'IDENTIFIER' THEN b.name END, ',' ORDER BY CASE WHEN b.kind = 'IDENTIFIER' THEN b.name END), '') AS names
    FROM {ast} t JOIN {ast} b ON b.root_id = t.root_id AND b.root_ord = t.root_ord AND b.pre BETWEEN t.pre AND t.post WHERE t.pre = 0 GROUP BY t.root_id, t.root_ord, t.method_id""")
def ast_descendants(g):
    return trees.descendants(g)


@query("""SELECT t.root_id, t.root_ord, t.pre, t.name, CAST(count(*) AS INT) AS children, string_agg(b.code, ' ; ' ORDER BY b.ord) AS operands
    FROM {ast} t JOIN {ast} b ON b.root_id = t.root_id AND b.root_ord = t.root_ord AND b.parent = t.pre GROUP BY t.root_id, t.root_ord, t.pre, t.name""")
def ast_children(g):
    return trees.children(g)


@query(f"""
    SELECT c.id, c.name, c.file, c.line, a.code AS format, CASE WHEN a.kind = 'IDENTIFIER' AND EXISTS (SELECT 1 FROM {{assignment}} s WHERE s.method_id = c.method_id AND s.target = a.code
      AND s.line < c.line AND regexp_matches(s.source, '\\b({"|".join(dicts.FORMAT_TAINT)})\\(')) THEN 'HIGH' ELSE 'MEDIUM' END AS confidence
    FROM {{call}} c JOIN {{argument}} a ON a.call_id = c.id AND a.arg_index = {_case(dicts.FORMAT_ARGUMENT)}
    WHERE a.kind <> 'LITERAL' AND NOT regexp_matches(a.code, '^(u8|[LuU])?"')""")
def format_string(g):
    return detectors.format_string(g)


def _write_sql(table: dict) -> str:
    return f"""SELECT c.id, c.method_id, c.name, c.line AS b, d.code AS dst, s.code AS need FROM {{call}} c
      JOIN {{argument}} d ON d.call_id = c.id AND d.arg_index = {_case({k: v[0] for k, v in table.items()})}
      LEFT JOIN {{argument}} s ON s.call_id = c.id AND s.arg_index = {_case({k: v[1] for k, v in table.items()})}"""


_TARGET = "(w.dst = h.ptr OR starts_with(w.dst, h.ptr || '[') OR starts_with(w.dst, h.ptr || '+') OR starts_with(w.dst, '&' || h.ptr))"
_INT = "try_cast(CASE WHEN regexp_full_match({0}, '[0-9]+[uUlL]*') THEN regexp_replace({0}, '[uUlL]+$', '') END AS BIGINT)"


@query(f"""
    WITH al AS ({_ALLOC.format(names=quoted(dicts.SIZE_ARGUMENT))}), h AS (SELECT al.id AS site, al.method_id, ptr, al.line AS a, g.code AS have FROM al JOIN {{argument}} g ON g.call_id = al.id AND g.arg_index = {_case(dicts.SIZE_ARGUMENT, "al.name")}),
    w AS ({_write_sql(dicts.HEAP_WRITES)}), x AS (SELECT h.*, w.id AS write, w.name, w.b, w.need FROM h JOIN w ON w.method_id = h.method_id AND w.b > h.a AND {_TARGET})
    SELECT site, method_id, ptr, a AS line, count(DISTINCT write) AS writes, CASE WHEN count(*) FILTER (name IN ('strcpy', 'gets', 'sprintf')) > 0 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence FROM x
    WHERE {_CLEAR} AND NOT EXISTS (SELECT 1 FROM {{control}} c WHERE c.method_id = x.method_id AND c.type = 'IF' AND c.line > x.a AND c.line < x.b AND regexp_matches(c.condition, '[<>]') AND {_has("c.condition", "x.need")})
      AND (need IS NULL OR CASE WHEN {_INT.format("have")} IS NOT NULL AND {_INT.format("need")} IS NOT NULL THEN {_INT.format("need")} > {_INT.format("have")} ELSE NOT {_has("have", "need")} END)
    GROUP BY site, method_id, ptr, a""")
def heap_overflow(g):
    return detectors.heap_overflow(g)


@query(f"""
    WITH h AS (SELECT id, method_id, name, name AS ptr, line AS a, CAST(regexp_extract(type_full_name, '\\[([0-9]+)\\]', 1) AS INT) AS have FROM {{local}} WHERE regexp_matches(type_full_name, '\\[[0-9]+\\]')),
    w AS ({_write_sql(dicts.STACK_WRITES)}), x AS (SELECT h.*, w.id AS write, w.name AS f, w.b, trim(w.need) AS need, try_cast(CASE WHEN regexp_full_match(trim(w.need), '-?[0-9]+') THEN trim(w.need) END AS BIGINT) AS number
      FROM h JOIN w ON w.method_id = h.method_id AND {_TARGET})
    SELECT id, method_id, name, have, count(DISTINCT write) AS writes, CASE WHEN count(*) FILTER (f IN ('strcpy', 'gets', 'sprintf', 'vsprintf', 'strcat')) > 0 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence
    FROM x WHERE {_APART} AND (need IS NULL OR number > have OR number IS NULL AND NOT contains(need, 'sizeof') AND NOT regexp_matches(need, '\\b' || have || '\\b')
      AND NOT EXISTS (SELECT 1 FROM {{control}} c WHERE c.method_id = x.method_id AND c.type = 'IF' AND c.line >= x.a AND c.line < x.b AND regexp_matches(c.condition, '[<>]') AND regexp_matches(c.condition, '\\b' || regexp_extract(need, '^\\w+') || '\\b')))
    GROUP BY id, method_id, name, have""")
def stack_overflow(g):
    return detectors.stack_overflow(g)


@query(f"""
    WITH x AS ({_ARG.format(i=1, names=quoted(dicts.PATH_CHECKS))}), y AS ({_ARG.format(i=1, names=quoted(dicts.PATH_USES))})
    SELECT DISTINCT x.method_id, coalesce('#' || x.decl_id, x.arg) AS path, x.name AS "check", x.line AS check_line, y.name AS use, y.line AS use_line
    FROM x JOIN y ON x.method_id = y.method_id AND coalesce('#' || x.decl_id, x.arg) = coalesce('#' || y.decl_id, y.arg) AND x.line < y.line AND x.line > 0""")
def toctou(g):
    return detectors.toctou(g)


@query("""
    WITH i AS (SELECT method_id, name, min(line) AS init FROM (SELECT method_id, target AS name, line FROM {assignment} UNION ALL SELECT method_id, substr(source, 2), line FROM {assignment} WHERE starts_with(source, '&')
      UNION ALL SELECT method_id, substr(code, 2), line FROM {argument} WHERE starts_with(code, '&')) GROUP BY method_id, name)
    SELECT DISTINCT l.id, l.method_id, l.name, a.line FROM {local} l JOIN {argument} a ON a.method_id = l.method_id AND a.code = l.name AND a.kind = 'IDENTIFIER' AND a.line > 0
      LEFT JOIN i ON i.method_id = l.method_id AND i.name = l.name WHERE NOT contains(l.type_full_name, '[') AND (i.init IS NULL OR a.line < i.init)""")
def uninit_read(g):
    return detectors.uninitialized_read(g)


@query(f"""
    WITH x AS ({_ARG.format(i=2, names="'<operator>.indirectIndexAccess'")}), c AS (SELECT d.call_id, k.condition FROM {{cdg}} d JOIN {{control}} k ON k.id = d.control_id WHERE regexp_matches(k.condition, '[<>]|[!=]='))
    SELECT x.id, x.method_id, x.line, x.arg AS "index", count(*) FILTER ({_has("c.condition", "regexp_replace(x.arg, '[^a-zA-Z0-9_].*', '')")}) AS guards,
      count(*) FILTER ({_has("c.condition", "regexp_replace(x.arg, '[^a-zA-Z0-9_].*', '')")}) > 0 AS guarded FROM x LEFT JOIN c ON c.call_id = x.id GROUP BY x.id, x.method_id, x.line, x.arg""")
def bounds_guard(g):
    return detectors.bounds_checks(g)


@query("SELECT DISTINCT method_id, line FROM {ret} r WHERE NOT EXISTS (SELECT 1 FROM {control} c WHERE c.method_id = r.method_id AND r.line BETWEEN c.line AND c.line_end)")
def early_return(g):
    return detectors.plain_returns(g)


_HANDED = f"""h AS (SELECT x.* FROM (SELECT s.site, s.method_id, s.ptr, s.a, ps.line AS b, ps.callee_id, ps.param FROM site s JOIN ps ON ps.method_id = s.method_id AND trim(ps.code) = s.ptr AND ps.kind <> 'LITERAL'
      WHERE ps.line > s.a AND ps.callee_id <> s.method_id) x WHERE {_CLEAR}{_RETURN})"""
_INSIDE = "(g.code = h.param OR starts_with(g.code, h.param || '->') OR starts_with(g.code, h.param || '[') OR starts_with(g.code, '*' || h.param))"


@query(f"""WITH {_CALLEES}, f AS ({_FREES}), site AS (SELECT id AS site, method_id, line AS a, arg AS ptr FROM (SELECT *, row_number() OVER (PARTITION BY method_id, arg ORDER BY line, id) AS r FROM f) y WHERE r = 1), {_HANDED}
    SELECT DISTINCT h.site, h.method_id, h.ptr, h.a AS line, h.callee_id, g.line AS use_line FROM h JOIN {{argument}} g ON g.method_id = h.callee_id AND {_INSIDE} WHERE g.call_id NOT IN (SELECT id FROM {{call}} WHERE name IN ('free', 'cfree'))""")
def use_after_free_interproc(g):
    return detectors.use_after_free_between(g)


@query(f"""WITH {_CALLEES}, al AS ({_ALLOC.format(names=quoted(dicts.ALLOCATORS))}), site AS (SELECT id AS site, method_id, line AS a, ptr FROM al), n AS ({_NULLS}), {_HANDED}
    SELECT DISTINCT h.site, h.method_id, h.ptr, h.a AS line, h.callee_id, g.line AS use_line FROM h JOIN {{argument}} g ON g.method_id = h.callee_id AND {_INSIDE}
    WHERE g.call_id NOT IN (SELECT id FROM {{call}} WHERE name IN ({quoted(dicts.DEREF_EXEMPT)})) AND NOT EXISTS (SELECT 1 FROM n WHERE n.method_id = h.method_id AND n.ptr = h.ptr AND n.line > h.a AND n.line <= h.b)
      AND NOT EXISTS (SELECT 1 FROM n WHERE n.method_id = h.callee_id AND n.ptr = h.param AND n.line <= g.line)""")
def null_deref_interproc(g):
    return detectors.null_deref_between(g)


@query(f"""WITH {_CALLEES}, {_RISKY}, {_SIZES},
    i AS (SELECT DISTINCT cs.call_id AS id, cs.method_id, cs.line, p.ord AS root_ord, cs.callee_id, z.id AS allocation FROM z JOIN {{ast}} t ON t.root_id = z.id AND t.root_ord = z.root_ord AND t.pre = 0 AND t.kind = 'IDENTIFIER'
      JOIN {{parameter}} p ON p.method_id = z.method_id AND p.name = t.name JOIN cs ON cs.callee_id = z.method_id WHERE cs.callee_id <> cs.method_id),
    l AS (SELECT i.*, s.id AS assign_id, row_number() OVER (PARTITION BY i.id, i.root_ord, i.callee_id, i.allocation ORDER BY s.line DESC, s.id DESC) AS r
      FROM i JOIN {{ast}} t ON t.root_id = i.id AND t.root_ord = i.root_ord AND t.pre = 0 AND t.kind = 'IDENTIFIER' JOIN {{assignment}} s ON s.method_id = i.method_id AND s.target = t.name AND s.line < i.line),
    x AS (SELECT i.id, method_id, line, arithmetic, callee_id, allocation, names FROM i JOIN risky ON risky.root_id = i.id AND risky.root_ord = i.root_ord AND risk = 'HIGH'
      UNION ALL SELECT l.id, method_id, line, arithmetic, callee_id, allocation, names FROM l JOIN risky ON risky.root_id = l.assign_id AND risky.root_ord = 0 AND risk = 'HIGH' WHERE r = 1)
    SELECT DISTINCT id, method_id, line, arithmetic, callee_id, allocation FROM x WHERE {_UNGUARDED}""")
def int_overflow_interproc(g):
    return detectors.integer_overflow_between(g)


@query(f"""WITH RECURSIVE {_EDGES}, w AS (
      SELECT DISTINCT method_id, 0 AS hops, method_id AS entry FROM {{call}} WHERE name IN ({quoted(dicts.EXTERNAL_INPUTS)})
      UNION SELECT e.dst, w.hops + 1, w.entry FROM w JOIN e ON w.method_id = e.src WHERE w.hops < 9),
    p AS (SELECT method_id, hops, entry FROM (SELECT *, row_number() OVER (PARTITION BY method_id ORDER BY hops, entry) AS r FROM w) WHERE r = 1),
    k AS (SELECT DISTINCT x.id, x.method_id, x.line FROM {{call}} x WHERE x.name IN ({quoted(dicts.COMMAND_SINKS["c"])}))
    SELECT k.id, k.method_id, k.line, hops, entry, CASE WHEN entry IS NULL THEN 'MEDIUM' ELSE 'HIGH' END AS confidence,
      CAST(row_number() OVER (ORDER BY CASE WHEN entry IS NULL THEN 1 ELSE 0 END, k.line, k.id) AS INT) AS issue FROM k LEFT JOIN p ON p.method_id = k.method_id ORDER BY issue LIMIT 200""")
def findings_with_entry(g):
    sites = g.call.where(P.any_of(F.col("name"), dicts.COMMAND_SINKS["c"])).select("id", "method_id", "line")
    return detectors.worst_first(iterate.with_entry(g, sites, dicts.EXTERNAL_INPUTS), ["line", "id"], limit=200)


@query("SELECT control_id, CAST(row_number() OVER (PARTITION BY control_id ORDER BY line) AS INT) AS branch, method_id, line, line_end FROM {apart} WHERE control_id IN (SELECT id FROM {control} WHERE type = 'SWITCH')")
def switch_segments(g):
    return detectors.switch_segments(g)


@query("""SELECT c.id, c.method_id, c.line, k.id AS control_id, max(l.line) AS label FROM {call} c JOIN {control} k ON k.method_id = c.method_id AND k.type = 'SWITCH' AND c.line BETWEEN k.line AND k.line_end
    JOIN {label} l ON l.control_id = k.id AND l.line <= c.line GROUP BY c.id, c.method_id, c.line, k.id""")
def switch_labels(g):
    return detectors.segment_of(g, g.call.select("id", "method_id", "line"))


# --- numbers, caps, raw SQL


@query("SELECT id, file, line, CAST(row_number() OVER (ORDER BY file, line, id) AS BIGINT) AS issue FROM {call}")
def findings_numbered(g):
    return order.numbered(g.call.select("id", "file", "line"), ["file", "line", "id"])


@query("""WITH r AS (SELECT id, name, code, file, line, row_number() OVER w AS n, sum(strlen(CAST(id AS VARCHAR)) + strlen(name) + strlen(code) + strlen(file) + strlen(CAST(line AS VARCHAR))) OVER (w ROWS UNBOUNDED PRECEDING) AS b
      FROM {call} WINDOW w AS (ORDER BY file, line, id))
    SELECT id, name, code, file, line, (SELECT count(*) FROM {call}) > count(*) OVER () AS truncated FROM r WHERE n <= 3000 AND b <= 100000""")
def findings_capped(g):
    return order.capped(g.call.select("id", "name", "code", "file", "line"), ["file", "line", "id"], 3000, 100_000)


_RAW = "WITH busy AS (SELECT method_id, count(*) AS calls FROM call GROUP BY method_id HAVING count(*) > 3) SELECT m.id, m.name, busy.calls, (SELECT max(line) FROM ret) AS last FROM method m JOIN busy ON m.id = busy.method_id WHERE EXISTS (SELECT 1 FROM local l WHERE l.method_id = m.id) ORDER BY busy.calls DESC, m.id LIMIT 500"


@query(_RAW.replace("FROM call", "FROM {call}").replace("FROM method", "FROM {method}").replace("FROM ret", "FROM {ret}").replace("FROM local", "FROM {local}"))
def raw_sql(g):
    return sql.run_sql(g, _RAW)


# --- data flow over control flow

_DEFINED = r"""n AS (SELECT DISTINCT method_id, node FROM (SELECT method_id, src AS node FROM {cfg} UNION ALL SELECT method_id, dst FROM {cfg})),
    p AS (SELECT n.method_id, c.line, max(n.node) AS node FROM n JOIN {call} c ON c.id = n.node GROUP BY n.method_id, c.line),
    d AS (SELECT p.node, a.target AS var, max(a.id) AS assign_id FROM {assignment} a JOIN p ON p.method_id = a.method_id AND p.line = a.line WHERE regexp_full_match(a.target, '[A-Za-z_]\w*') GROUP BY p.node, a.target),
    e AS (SELECT DISTINCT src, dst FROM {cfg}),
    r AS (SELECT e.dst AS node, d.var, d.assign_id FROM d JOIN e ON e.src = d.node
      UNION SELECT e.dst, r.var, r.assign_id FROM r JOIN e ON e.src = r.node WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.node = r.node AND d.var = r.var))"""


@query("WITH RECURSIVE " + _DEFINED + " SELECT node, var, assign_id FROM r")
def reaching_definitions(g):
    return dataflow.reaching_definitions(g)


@query("WITH RECURSIVE " + _DEFINED + " SELECT DISTINCT a.call_id, r.var, r.assign_id FROM {argument} a JOIN r ON r.node = a.call_id AND r.var = trim(a.code) WHERE a.kind = 'IDENTIFIER'")
def uses_reached(g):
    return dataflow.uses_reached(g)


#: b: a node c from which the ends can be reached without the node n (so n post-dominates no such c); u: nodes that reach an end.
_DECIDED = """e AS (SELECT DISTINCT method_id, src, dst FROM {cfg}), x AS (SELECT method_id, src AS n FROM e UNION SELECT method_id, dst FROM e),
    z AS (SELECT * FROM x WHERE n NOT IN (SELECT src FROM e)),
    b AS (SELECT x.method_id, z.n AS c, x.n FROM z JOIN x ON x.method_id = z.method_id AND x.n <> z.n UNION SELECT b.method_id, e.src, b.n FROM b JOIN e ON e.method_id = b.method_id AND e.dst = b.c AND e.src <> b.n),
    u AS (SELECT n AS c FROM z UNION SELECT e.src FROM u JOIN e ON e.dst = u.c),
    cd AS (SELECT DISTINCT t.method_id, x.n AS node, t.src AS branch FROM e t JOIN x ON x.method_id = t.method_id
      WHERE t.dst IN (SELECT c FROM u) AND x.n IN (SELECT c FROM u) AND NOT EXISTS (SELECT 1 FROM b WHERE b.c = t.dst AND b.n = x.n) AND (t.src = x.n OR EXISTS (SELECT 1 FROM b WHERE b.c = t.src AND b.n = x.n)))"""


@query("WITH RECURSIVE " + _DECIDED + " SELECT method_id, node, branch FROM cd")
def control_dependence(g):
    return dataflow.control_dependence(g)


@query("WITH RECURSIVE " + _DECIDED + """, y AS (SELECT node, branch, 1 AS hops FROM cd UNION SELECT y.node, cd.branch, hops + 1 FROM y JOIN cd ON cd.node = y.branch WHERE hops < 12)
    SELECT node, branch, CAST(min(hops) AS INT) AS hops FROM y GROUP BY node, branch""")
def controlled_by(g):
    return dataflow.controlled_by(g)


@query("""SELECT method_id, seed_line, id, type, condition, line, n > 30 AS more FROM (SELECT s.method_id, s.seed_line, c.id, c.type, c.condition, c.line, row_number() OVER (PARTITION BY s.method_id, s.seed_line ORDER BY c.line, c.id) AS r,
      count(*) OVER (PARTITION BY s.method_id, s.seed_line) AS n FROM (SELECT DISTINCT method_id, line AS seed_line FROM {call} WHERE name = 'system') s JOIN {control} c ON c.method_id = s.method_id AND c.line > 0 AND c.line < s.seed_line) WHERE r <= 30""")
def slice_controls(g):
    return dataflow.slice_controls(g, g.call.where("name = 'system'").select("method_id", "line"))


_SUMMARIES = f"""q AS (SELECT DISTINCT c.method_id, p.name AS param, CASE WHEN c.name IN ('free', 'cfree') AND trim(g.code) = p.name AND g.arg_index = 1 THEN 'frees'
        WHEN trim(g.code) = p.name AND g.arg_index = {_case(dicts.OVERFLOW_SIZE)} THEN 'allocates' WHEN c.name NOT IN ({quoted(dicts.DEREF_EXEMPT)}) AND (c.callee_id IS NULL OR trim(g.code) <> p.name) THEN 'uses' END AS effect
      FROM {{call}} c JOIN {{argument}} g ON g.call_id = c.id JOIN {{parameter}} p ON p.method_id = c.method_id AND {_USE.replace("g.code", "trim(g.code)").replace("s.ptr", "p.name")}),
    h AS (SELECT DISTINCT c.id AS call_id, c.method_id, c.line, trim(g.code) AS ptr, c.callee_id, p.name AS param FROM {{call}} c JOIN {{argument}} g ON g.call_id = c.id AND g.kind = 'IDENTIFIER' JOIN {{parameter}} p ON p.method_id = c.callee_id AND p.ord = g.arg_index),
    t AS (SELECT DISTINCT h.method_id, h.ptr, h.callee_id, h.param FROM h JOIN {{parameter}} p ON p.method_id = h.method_id AND p.name = h.ptr),
    s0 AS (SELECT method_id, param, effect, 0 AS hops FROM q WHERE effect IS NOT NULL UNION SELECT t.method_id, t.ptr, s0.effect, s0.hops + 1 FROM s0 JOIN t ON t.callee_id = s0.method_id AND t.param = s0.param WHERE hops < 20),
    sm AS (SELECT method_id, param, effect, CAST(min(hops) AS INT) AS hops FROM s0 GROUP BY method_id, param, effect)"""


@query(f"WITH RECURSIVE {_SUMMARIES} SELECT * FROM sm")
def method_summaries(g):
    return dataflow.summaries(g)


_MET = f"""fr AS (SELECT id AS site, method_id, arg AS ptr, line, 0 AS hops FROM ({_FREES}) f UNION ALL SELECT call_id, h.method_id, ptr, line, min(hops) + 1 FROM h JOIN sm ON sm.method_id = h.callee_id AND sm.param = h.param AND effect = 'frees' GROUP BY call_id, h.method_id, ptr, line),
    us AS (SELECT call_id, h.method_id, ptr, line, min(hops) + 1 AS hops FROM h JOIN sm ON sm.method_id = h.callee_id AND sm.param = h.param AND effect = 'uses' GROUP BY call_id, h.method_id, ptr, line)"""


@query(f"""WITH RECURSIVE {_SUMMARIES}, {_MET},
    x AS (SELECT fr.method_id, fr.ptr, fr.line AS a, us.line AS b, fr.hops AS free_hops, us.hops AS use_hops FROM fr JOIN us ON us.method_id = fr.method_id AND us.ptr = fr.ptr AND us.line > fr.line
      UNION SELECT s.method_id, s.ptr, s.line, g.line, s.hops, 0 FROM fr s JOIN {{argument}} g ON g.method_id = s.method_id AND g.line > s.line AND {_USE}
        WHERE s.hops > 0 AND g.call_id NOT IN (SELECT id FROM {{call}} WHERE name IN ('free', 'cfree') OR callee_id IS NOT NULL))
    SELECT method_id, ptr, a AS line, b AS use_line, CAST(min(free_hops) AS INT) AS free_hops, CAST(min(use_hops) AS INT) AS use_hops FROM x WHERE {_CLEAR}{_RETURN} GROUP BY method_id, ptr, a, b""")
def use_after_free_deep(g):
    return detectors.use_after_free_deep(g)


@query(f"""WITH RECURSIVE {_SUMMARIES}, {_MET},
    x AS (SELECT p.method_id, p.ptr, p.line AS a, q.line AS b, p.hops + q.hops AS hops FROM fr p JOIN fr q ON p.method_id = q.method_id AND p.ptr = q.ptr AND q.line > p.line WHERE p.hops + q.hops > 0)
    SELECT method_id, ptr, a AS line, b AS second, CAST(min(hops) AS INT) AS hops FROM x WHERE {_CLEAR}{_RETURN} GROUP BY method_id, ptr, a, b""")
def double_free_deep(g):
    return detectors.double_free_deep(g)


@query(f"""WITH RECURSIVE {_SUMMARIES}, {_MET}, al AS ({_ALLOC.format(names=quoted(dicts.ALLOCATORS))}), n AS ({_NULLS}),
    x AS (SELECT al.method_id, al.ptr, al.line AS a, us.line AS b, us.hops FROM al JOIN us ON us.method_id = al.method_id AND us.ptr = al.ptr AND us.line > al.line)
    SELECT method_id, ptr, a AS line, b AS use_line, CAST(min(hops) AS INT) AS hops FROM x WHERE {_CLEAR} AND {_NO_EXIT}
      AND NOT EXISTS (SELECT 1 FROM n WHERE n.method_id = x.method_id AND n.ptr = x.ptr AND n.line > x.a AND n.line <= x.b) GROUP BY method_id, ptr, a, b""")
def null_deref_deep(g):
    return detectors.null_deref_deep(g)


# --- scalar functions


@query("""
    SELECT call_id, arg_index, regexp_replace(code, '[^a-zA-Z0-9_].*', '') AS variable, coalesce(try_cast(CASE WHEN regexp_full_match(code, '[0-9]+') THEN code END AS BIGINT), -1) AS number,
      regexp_full_match(code, '[0-9]+') AS is_constant, coalesce(try_cast(CASE WHEN regexp_full_match(code, '[0-9]+') THEN code END AS BIGINT) <= 100, false) AS is_small,
      CASE WHEN length(code) > 3 THEN left(code, 3) || '…(+' || (length(code) - 3) || ' chars)' ELSE code END AS clipped FROM {argument}""")
def expression_facts(g):
    c = F.col("code")
    return g.argument.select("call_id", "arg_index", P.extract_variable(c).alias("variable"), F.coalesce(P.parse_int_literal(c), F.lit(-1)).alias("number"), P.constant(c).alias("is_constant"), P.small_constant(c, 100).alias("is_small"), P.clip(c, 3).alias("clipped"))


@query("""
    SELECT id, file = 'src/r1/f2.c' OR ends_with(file, '/r1/f2.c') AS exact, regexp_matches(file, '(^|/)f1') AS prefix, regexp_full_match(name, 'fn_1.*|fn_2') AS named,
      left(sha256(file || chr(0) || name), 16) AS short_id, CASE WHEN line <= 100 THEN 'S' WHEN line <= 400 THEN 'M' WHEN line <= 1200 THEN 'L' ELSE 'XL' END AS tier FROM {method}""")
def path_facts(g):
    f = F.col("file")
    return g.method.select("id", P.file_is(f, "r1/f2.c").alias("exact"), P.file_starts(f, "f1").alias("prefix"), P.full_match(F.col("name"), "fn_1.*|fn_2").alias("named"), P.short_id(f, F.col("name")).alias("short_id"), P.size_tier(F.col("line") / 100).alias("tier"))


@query("SELECT page_id, left(regexp_replace(url, '(/[^\\s''\"]+/)([^\\s''\"/]+)', '<path>/\\2', 'g'), 600) AS redacted FROM {pages}")
def redact_paths(g):
    return g._load("pages").select("page_id", P.redact_paths(F.col("url")).alias("redacted"))


_HOSTED = """SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN replace(replace(url, 'http://', 'https://github.com/'), '?', '.git?') WHEN 2 THEN 'https://gitlab.com//' || substr(url, 9) || '/'
    WHEN 3 THEN 'https://dev.azure.com/one' ELSE 'https://www.github.com/a b/' || substr(url, 9) END AS url FROM {pages}"""


@query(rf"""WITH u AS ({_HOSTED}), p AS (SELECT page_id, url, regexp_extract(url, '^(https://(www\.github\.com|github\.com|www\.gitlab\.com|gitlab\.com|dev\.azure\.com))/', 1) AS base,
      trim(regexp_replace(regexp_replace(url, '[?#].*', ''), '^https://[^/]*', ''), '/') AS path FROM u)
    SELECT page_id, CASE WHEN base <> '' AND len(string_split_regex(path, '/+')) >= 2 AND NOT contains(url, ' ') THEN base || '/' || regexp_replace(path, '\.git$', '') END AS repository FROM p""")
def repository_urls(g):
    return _relation(g, _HOSTED).select("page_id", P.repository_url(F.col("url")).alias("repository"))


@query("SELECT id, name, code, dispatch_type, file, line FROM {call} WHERE regexp_full_match(name, 'mem.*') ORDER BY id LIMIT 50")
def macro_calls(g):
    return browse.macro_calls(g, "mem.*")


_MENTION = "({0} = 'v1' OR starts_with({0}, 'v1.') OR starts_with({0}, 'v1[') OR starts_with({0}, 'v1->') OR starts_with({0}, '*v1') OR starts_with({0}, '&v1'))"


@query(f"""
    SELECT DISTINCT line, kind, code FROM (
      SELECT line, 'declaration' AS kind, type_full_name || ' ' || name AS code FROM {{local}} WHERE method_id = 7 AND name = 'v1'
      UNION ALL SELECT m.line, 'parameter', p.type_full_name || ' ' || p.name FROM {{parameter}} p JOIN {{method}} m ON p.method_id = m.id WHERE m.id = 7 AND p.name = 'v1'
      UNION ALL SELECT line, 'assignment', target || ' = ' || source FROM {{assignment}} WHERE method_id = 7 AND {_MENTION.format("target")}
      UNION ALL SELECT a.line, 'use_in_call', c.code FROM {{argument}} a JOIN {{call}} c ON a.call_id = c.id WHERE a.method_id = 7 AND {_MENTION.format("a.code")})
    WHERE line <= 310 ORDER BY line, kind, code LIMIT 50""")
def variable_flow(g):
    return browse.variable_flow(g, 7, "v1", 310)


_MENTIONED = "({0} = f.var OR starts_with({0}, f.var || '.') OR starts_with({0}, f.var || '[') OR starts_with({0}, f.var || '->') OR starts_with({0}, '*' || f.var) OR starts_with({0}, '&' || f.var))"


@query(f"""
    WITH RECURSIVE a AS (SELECT DISTINCT method_id, line, target, source, unnest({_NAMES_IN.format("source")}) AS var FROM {{assignment}}),
    s AS (SELECT DISTINCT method_id, 'v1' AS var, line FROM {{control}} WHERE type = 'FOR'),
    w AS (SELECT method_id, var, line, 0 AS depth FROM s UNION SELECT s.method_id, a.target, s.line, 0 FROM s JOIN a ON a.method_id = s.method_id AND a.var = s.var AND contains(a.source, '&' || s.var)
      UNION SELECT w.method_id, a.target, a.line, w.depth + 1 FROM w JOIN a ON a.method_id = w.method_id AND a.var = w.var AND a.line >= w.line AND a.target <> w.var WHERE w.depth < 4),
    f AS (SELECT DISTINCT method_id, var, line FROM w)
    SELECT DISTINCT f.method_id, f.var, a.line, 'propagation' AS kind, a.target || ' = ' || a.source AS code FROM f JOIN a ON a.method_id = f.method_id AND a.var = f.var AND a.line >= f.line
    UNION SELECT f.method_id, f.var, c.line, 'usage', c.code FROM f JOIN {{call}} c ON c.method_id = f.method_id AND c.line >= f.line AND NOT starts_with(c.name, '<operator>') JOIN {{argument}} g ON g.call_id = c.id AND {_MENTIONED.format("g.code")}""")
def variable_flow_forward(g):
    return browse.variable_flow_forward(g, _seeds(g))


@query("""
    SELECT "use", name, line, assigned, source FROM (SELECT a.call_id * 4 + a.arg_index AS "use", a.code AS name, a.line, s.line AS assigned, s.source,
      row_number() OVER (PARTITION BY a.call_id, a.arg_index ORDER BY s.line DESC, s.id DESC) AS r
      FROM {argument} a JOIN {assignment} s ON a.method_id = s.method_id AND s.target = a.code AND s.line < a.line WHERE a.kind = 'IDENTIFIER') WHERE r = 1""")
def latest_assignment(g):
    uses = g.argument.where("kind = 'IDENTIFIER'").select((F.col("call_id") * 4 + F.col("arg_index")).alias("use"), "method_id", F.col("code").alias("name"), "line")
    return detectors.latest_assignment(g, uses)


@query(f"""
    WITH f AS ({_ARG.format(i=1, names="'free', 'cfree'")})
    SELECT DISTINCT f.id AS site, f.method_id, f.arg AS ptr, f.line, a.line AS second, c.callee_id FROM f JOIN {{argument}} a ON a.method_id = f.method_id AND a.code = f.arg AND a.line > f.line
      JOIN {{call}} c ON c.id = a.call_id AND c.callee_id IS NOT NULL JOIN {{parameter}} p ON p.method_id = c.callee_id AND p.ord = a.arg_index
      WHERE f.kind = 'IDENTIFIER' AND EXISTS (SELECT 1 FROM f h WHERE h.method_id = c.callee_id AND h.arg = p.name)""")
def double_free_interproc(g):
    return detectors.double_free_between(g)


@query(f"""
    WITH x AS ({_ARG.format(i=2, names="'<operator>.indirectIndexAccess'")}) SELECT id, method_id, line, arg AS "index" FROM x WHERE kind = 'IDENTIFIER'
      AND NOT EXISTS (SELECT 1 FROM {{control}} c WHERE c.method_id = x.method_id AND c.line <= x.line AND regexp_matches(c.condition, '[<>]') AND contains(' ' || c.condition || ' ', ' ' || x.arg || ' '))""")
def int_overflow_index(g):
    return detectors.index_arithmetic(g)


@query(r"""
    SELECT doc_id, CASE WHEN i >= 1 THEN 1 ELSE 0 END + CASE WHEN p THEN 1 ELSE 0 END AS python_score, NOT regexp_full_match(source, 'src[0-4]|src1.*') AS in_scope
    FROM (SELECT doc_id, source, CASE WHEN regexp_matches(text, '\bimport\s+\w+') THEN 1 ELSE 0 END AS i, regexp_matches(text, '\bself\b') AS p FROM {documents})""")
def language_scores(g):
    d = g._load("documents")
    score = P.language_scores(F.col("text"), {"python": dicts.LANGUAGE_SIGNALS["python"][1:3]})
    return d.select("doc_id", score["python"].alias("python_score"), (~P.excluded(F.col("source"), ["src[0-4]", "src1.*"])).alias("in_scope"))


def _found(pattern: str) -> str:
    return "regexp_matches(x, '(?m)" + pattern.replace("'", "''").replace("{", "{{").replace("}", "}}") + "')"


_SCORES = ", ".join(" + ".join(f"CASE WHEN {_found(p)} THEN {w} ELSE 0 END" for p, w in signals) + f" AS {language}" for language, signals in dicts.LANGUAGE_SIGNALS.items())


# letters beyond ASCII become a digit, which patterns of words take alike
@query(rf"""
    WITH t AS (SELECT doc_id, regexp_replace(text, '[^\x00-\x7F\PL]|[^\x00-\x7F\PN]', '0', 'g') AS x FROM {{documents}}),
    s AS (SELECT doc_id, {_SCORES} FROM t),
    r AS (SELECT doc_id, [{", ".join(dicts.LANGUAGE_SIGNALS)}] AS scores FROM s), o AS (SELECT *, list_reverse_sort(scores) AS best FROM r)
    SELECT doc_id, CASE WHEN best[1] >= 2 AND best[1] >= 2 * greatest(best[2], 1) THEN [{quoted(dicts.LANGUAGE_SIGNALS)}][list_position(scores, best[1])] END AS language FROM o""")
def snippet_languages(g):
    return g._load("documents").select("doc_id", P.best_language(P.language_scores(F.col("text"), dicts.LANGUAGE_SIGNALS)).alias("language"))


#: Folders that the paths of pages are placed below, by turns.
_FOLDERS = ["", "src/", "src/docs/", "latest/", "tests/", "lib/vendor/", ".cache/", "my_vendor/"]


@query(rf"""
    SELECT page_id, path, NOT regexp_full_match(path, '{"|".join(f"(?:{p})" for p in dicts.EXCLUDED_PATHS)}') AS in_scope
    FROM (SELECT page_id, [{quoted(_FOLDERS)}][page_id % {len(_FOLDERS)} + 1] || regexp_extract(url, '^\w+://[^/]*/([^?#]*)', 1) AS path FROM {{pages}})""")
def pages_in_scope(g):
    folder = F.element_at(F.array(*map(F.lit, _FOLDERS)), (F.col("page_id") % len(_FOLDERS) + 1).cast("int"))
    path = F.concat(folder, F.regexp_extract("url", r"^\w+://[^/]*/([^?#]*)", 1))
    return g._load("pages").select("page_id", path.alias("path")).withColumn("in_scope", ~P.excluded(F.col("path"), dicts.EXCLUDED_PATHS))


def _by_language(names: dict[str, list[str]]) -> str:
    rows = ", ".join(f"('{language}', '{name}')" for language, patterns in names.items() for name in dict.fromkeys(p.rstrip("(").split(".")[-1] for p in patterns))
    return f"SELECT l.language, c.id, c.name, c.file, c.line FROM {{call}} c JOIN (VALUES {rows}) l(language, name) ON c.name = l.name"


@query(_by_language(dicts.TAINT_SOURCES))
def taint_sources_by_language(g):
    return browse.sites_by_language(g, dicts.TAINT_SOURCES)


@query(_by_language(dicts.TAINT_SINKS))
def taint_sinks_by_language(g):
    return browse.sites_by_language(g, dicts.TAINT_SINKS)


# --- catalog

_JOBS = """SELECT o_orderkey AS id, o_custkey % 100 AS codebase, o_orderpriority AS job_type, o_orderdate AS created_at, CAST(o_orderkey % 5 AS INT) AS attempts,
    CASE o_orderstatus WHEN 'O' THEN 'queued' WHEN 'F' THEN 'done' ELSE 'running' END AS status FROM {orders}"""
_FINDINGS = """SELECT event_id AS id, user_id % 20 AS codebase, CASE user_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END AS severity,
    event_type AS type, CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS confidence FROM {events}"""
_BASES = """SELECT c_custkey AS codebase, CASE c_custkey % 3 WHEN 0 THEN 'generating' WHEN 1 THEN 'running' ELSE 'ready' END AS status, CAST(c_custkey % 50 AS INT) AS deadline, CAST(c_custkey % 90 AS INT) AS last_accessed,
    c_nationkey AS host, CAST(c_custkey % 7 + 1 AS INT) AS size FROM {customer}"""


def _relation(g: Graph, sql: str) -> DataFrame:
    import re

    return g.spark.sql(sql, **{n: g._load(n) for n in re.findall(r"\{(\w+)\}", sql)})


@query(f"WITH f AS ({_FINDINGS}) SELECT * FROM f WHERE severity IN ('high', 'critical') AND type = 'error'")
def findings_filter(g):
    return catalog.findings_filter(_relation(g, _FINDINGS), "high", "error")


@query(f"""WITH f AS ({_FINDINGS}) SELECT 'severity' AS "by", severity AS value, count(*) AS n FROM f GROUP BY severity UNION ALL SELECT 'type', type, count(*) FROM f GROUP BY type
    UNION ALL SELECT 'confidence', confidence, count(*) FROM f GROUP BY confidence UNION ALL SELECT 'total', 'all', count(*) FROM f""")
def findings_stats(g):
    return catalog.findings_stats(_relation(g, _FINDINGS))


@query(f"WITH f AS ({_FINDINGS}) SELECT confidence, count(*) AS n FROM f GROUP BY confidence")
def confidence_histogram(g):
    return catalog.confidence_histogram(_relation(g, _FINDINGS))


@query(f"WITH j AS ({_JOBS}) SELECT id, job_type, CAST(rank() OVER (PARTITION BY job_type ORDER BY created_at) AS INT) AS position FROM j WHERE status = 'queued'")
def queue_position(g):
    return catalog.queue_position(_relation(g, _JOBS))


@query(f"WITH j AS ({_JOBS}) SELECT job_type, status, count(*) AS n FROM j GROUP BY job_type, status")
def job_counts(g):
    return catalog.job_counts(_relation(g, _JOBS))


@query(f"""WITH j AS ({_JOBS}) SELECT id, CASE WHEN status = 'running' AND attempts >= 3 THEN 'failed' WHEN status = 'running' THEN 'queued' ELSE status END AS status,
    CASE WHEN status = 'running' AND attempts < 3 THEN attempts + 1 ELSE attempts END AS attempts FROM j""")
def requeue_jobs(g):
    return catalog.requeue(_relation(g, _JOBS))


@query(f"WITH j AS ({_JOBS}) SELECT id, job_type FROM (SELECT *, row_number() OVER (PARTITION BY job_type ORDER BY created_at, id) AS r FROM j WHERE status = 'queued') WHERE r <= 5")
def claim_jobs(g):
    return catalog.claim(_relation(g, _JOBS), 5)


@query(f"WITH j AS ({_JOBS}), b AS ({_BASES}) SELECT codebase FROM b WHERE status = 'generating' AND deadline < 25 AND codebase NOT IN (SELECT codebase FROM j WHERE status IN ('queued', 'running'))")
def stranded_builds(g):
    return catalog.stranded(_relation(g, _BASES), _relation(g, _JOBS), F.lit(25))


@query(f"""WITH b AS ({_BASES}) SELECT host, id, size FROM (SELECT host, codebase AS id, size, coalesce(sum(size) OVER (PARTITION BY host ORDER BY last_accessed, codebase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b) WHERE before < 40""")
def lru_eviction_prefix(g):
    return catalog.evict(_relation(g, _BASES).select("host", F.col("codebase").alias("id"), "size", F.col("last_accessed").alias("last_touch")), 40)


@query(f"WITH b AS ({_BASES}) SELECT codebase FROM b WHERE status = 'running' AND last_accessed < 30")
def cold_gc(g):
    return catalog.cold(_relation(g, _BASES), F.lit(30))


@query(f"""WITH b AS ({_BASES}), o AS (SELECT codebase, status, last_accessed FROM b WHERE codebase % 2 = 0), n AS (SELECT codebase, 'ready' AS status, CAST(99 AS INT) AS last_accessed FROM b WHERE codebase % 3 = 0)
    SELECT n.codebase, n.status, coalesce(o.last_accessed, n.last_accessed) AS last_accessed FROM n LEFT JOIN o ON n.codebase = o.codebase UNION ALL SELECT * FROM o WHERE codebase NOT IN (SELECT codebase FROM n)""")
def codebase_upsert(g):
    b = _relation(g, _BASES).select("codebase", "status", "last_accessed")
    new = b.where("codebase % 3 = 0").select("codebase", F.lit("ready").alias("status"), F.lit(99).alias("last_accessed"))
    return catalog.upsert(b.where("codebase % 2 = 0"), new, "codebase", ["last_accessed"])


@query(f"WITH b AS ({_BASES}) SELECT codebase, host, CASE WHEN codebase % 2 = 0 THEN 'unchanged' ELSE 'created' END AS outcome FROM b")
def create_or_get_version(g):
    b = _relation(g, _BASES)
    return catalog.create_or_get(b.where("codebase % 2 = 0"), b, ["codebase", "host"])


@query(f"WITH f AS ({_FINDINGS}) SELECT * FROM f ORDER BY CASE severity WHEN 'critical' THEN 4 WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END DESC, id LIMIT 40")
def findings_top(g):
    return catalog.findings_top(_relation(g, _FINDINGS), 40)


@query("""SELECT o_custkey AS project, o_orderkey AS version, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS INT) AS place
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""")
def versions_by_owner(g):
    versions = g._load("orders").select(F.col("o_custkey").alias("project"), F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("created_at"))
    return catalog.versions_by_owner(versions, g._load("customer").select(F.col("c_custkey").alias("project"), F.col("c_mktsegment").alias("owner")), "BUILDING")


@query("""SELECT event_id AS codebase, CASE WHEN event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-02 00:00:00' - INTERVAL 60 SECOND THEN 1 ELSE 0 END AS written FROM {events}""")
def codebase_touch(g):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    rows = g._load("events").select(F.col("event_id").alias("codebase"), F.col("ts").alias("last_accessed"))
    new = catalog.touched(rows.withColumn("before", F.col("last_accessed")), rows.where("codebase % 2 = 0"), now)
    return new.select("codebase", F.when(F.col("before") != F.col("last_accessed"), 1).otherwise(0).alias("written"))


@query("SELECT event_id FROM {events} WHERE ts > TIMESTAMP '2024-01-02 00:00:00' - INTERVAL 300 SECOND AND length(props) <= 8")
def cache_live(g):
    cache = g._load("events").select("event_id", F.col("ts").alias("created_at"), F.col("props").alias("output"))
    return catalog.cache_live(cache, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"), most=8).select("event_id")


@query("SELECT event_id FROM {events} WHERE ts < TIMESTAMP '2024-01-02 00:00:00' - INTERVAL 300 SECOND")
def cache_expired(g):
    cache = g._load("events").select("event_id", F.col("ts").alias("created_at"))
    return catalog.cache_expired(cache, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")).select("event_id")


@query(f"WITH b AS ({_BASES}), f AS ({_FINDINGS}) SELECT f.* FROM f WHERE codebase NOT IN (SELECT codebase FROM b WHERE status = 'ready')")
def delete_cascade(g):
    return catalog.delete_cascade(_relation(g, _FINDINGS), _relation(g, _BASES).where("status = 'ready'")).select("id", "codebase", "severity", "type", "confidence")
