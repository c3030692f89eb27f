"""Code browsing: filters, joins and first-n lists over the node tables.

Where a list is cut, rows come in a total order (the node's id unless said).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import predicates as P
from ..functions.dicts import short_names
from ..graph import Graph
from .iterate import cut, identifiers


def list_methods(g: Graph, name: str | None = None, file: str | None = None, callee: str | None = None, external: bool = False, limit: int | None = 1000) -> DataFrame:
    """Methods with length and cyclomatic complexity; filters are full-match patterns."""
    m = g.method
    if not external:
        m = m.where(~F.col("is_external"))
    if name:
        m = m.where(P.full_match(F.col("name"), P.checked(name)))
    if file:
        m = m.where(P.full_match(F.col("file"), P.checked(file)))
    if callee:
        m = m.join(g.call.where(P.full_match(F.col("name"), P.checked(callee))).select(F.col("method_id").alias("id")), "id", "left_semi")
    if limit:
        m = m.orderBy("id").limit(min(limit, 10_000))
    controls = g.control.groupBy(F.col("method_id").alias("id")).agg(F.count("*").alias("n"))
    return m.join(controls, "id", "left").select(
        "id", "name", "full_name", "file", "line", "line_end", (F.coalesce("n", F.lit(0)) + 1).alias("complexity"),
        F.when(F.col("line").isNull() | F.col("line_end").isNull(), 0).otherwise(F.col("line_end") - F.col("line") + 1).alias("number_of_lines"),
    )


def list_calls(g: Graph, caller: str | None = None, callee: str | None = None, limit: int | None = 1000) -> DataFrame:
    c = g.call.where(P.full_match(F.col("name"), P.checked(callee))) if callee else g.call
    m = g.method.select(F.col("id").alias("method_id"), F.col("name").alias("caller"))
    out = c.join(m.where(P.full_match(F.col("caller"), P.checked(caller))) if caller else m, "method_id").select("caller", F.col("name").alias("callee"), "code", "file", "line").distinct()
    return out.orderBy("caller", "callee", "code", "file", "line").limit(min(limit, 10_000)) if limit else out


def list_parameters(g: Graph, name: str | None = None) -> DataFrame:
    """One row per method; parameters as "type name, ..." in order, empty where there are none."""
    own = g.parameter.groupBy("method_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", F.concat_ws(" ", "type_full_name", "name").alias("p")))), lambda x: x.p), ", ").alias("parameters"))
    m = g.method.where(P.full_match(F.col("name"), P.checked(name))) if name else g.method
    return m.join(own, m.id == own.method_id, "left").select("id", "name", F.coalesce("parameters", F.lit("")).alias("parameters"))


def find_literals(g: Graph, pattern: str | None = None, literal_type: str | None = None, limit: int | None = 50) -> DataFrame:
    out = g.literal
    if pattern:
        out = out.where(P.full_match(F.col("code"), P.checked(pattern)))
    if literal_type:
        out = out.where(P.full_match(F.col("type_full_name"), P.checked(literal_type)))
    out = out.select("id", "code", "type_full_name", "file", "line")
    return out.orderBy("id").limit(limit) if limit else out


def type_definition(g: Graph, name: str, limit: int = 10) -> DataFrame:
    """Types with members; at most 20 members each."""
    types = g.type_decl.where(P.full_match(F.col("name"), P.checked(name))).join(g.member.select(F.col("type_id").alias("id")), "id", "left_semi").orderBy("id").limit(limit)
    members = g.member.join(types.select(F.col("id").alias("type_id")), "type_id", "left_semi")
    listed = members.groupBy("type_id").agg(F.array_join(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("ord", "name", "type_full_name"))), lambda x: F.concat_ws(" ", x.type_full_name, x["name"])), 1, 20), "; ").alias("members"))
    return types.join(listed, types.id == listed.type_id).select("id", "name", "full_name", "file", "line", "members")


def codebase_summary(g: Graph) -> DataFrame:
    m = g.method.agg(F.countDistinct("file").alias("files"), F.count("*").alias("methods"), F.count_if(~F.col("is_external")).alias("user_methods"))
    return m.join(g.call.agg(F.count("*").alias("calls"))).join(g.literal.agg(F.count("*").alias("literals")))


def call_sites(g: Graph, names: list[str], file: str | None = None, limit: int | None = 200) -> DataFrame:
    """Calls of named functions with their method: taint sources, sinks."""
    c = g.call.where(P.any_of(F.col("name"), names))
    if file:
        c = c.where(P.file_starts(F.col("file"), file))
    if limit:
        c = c.orderBy("id").limit(limit)
    return c.join(g.method.select(F.col("id").alias("method_id"), F.col("full_name").alias("method")), "method_id").select("id", "name", "code", "file", "line", "method")


def sites_by_language(g: Graph, names: dict[str, list[str]]) -> DataFrame:
    """language, id, name, file, line of the calls of each language's names (of some hundred at most, so they are broadcast)."""
    wanted = [(language, name) for language, patterns in names.items() for name in short_names(patterns)]
    return g.call.join(F.broadcast(g.spark.createDataFrame(wanted, "language string, name string")), "name").select("language", "id", "name", "file", "line")


def command_sinks(g: Graph, names: list[str], file: str | None = None, limit: int | None = 50) -> DataFrame:
    """Calls of command functions whose first argument exists and is no literal."""
    c = g.call.where(P.any_of(F.col("name"), names))
    if file:
        c = c.where(P.file_is(F.col("file"), file))
    open_ = g.argument.where((F.col("arg_index") == 1) & (F.col("kind") != "LITERAL")).select(F.col("call_id").alias("id"))
    out = c.join(open_, "id", "left_semi").select("id", "name", "code", "file", "line")
    return out.orderBy("id").limit(limit) if limit else out


def enclosing_method(g: Graph, places: DataFrame) -> DataFrame:
    """Methods around (file, line); the innermost first one by start, then id."""
    m = g.method.select(F.col("id").alias("method_id"), "name", F.col("file").alias("m_file"), F.col("line").alias("begin"), "line_end")
    hit = places.join(m, (places.file == m.m_file) & F.col("line").between(F.col("begin"), F.col("line_end")) & (m.name != "<global>"))
    rank = F.row_number().over(W.partitionBy("file", "line").orderBy(F.desc("begin"), "method_id"))
    return hit.withColumn("r", rank).where("r = 1").select("file", "line", "method_id", "name")


def gated_bodies(g: Graph) -> DataFrame:
    """Methods without calls on at most two lines: bodies that were likely compiled away."""
    busy = g.call.select(F.col("method_id").alias("id"))
    return g.method.where((F.col("line_end") - F.col("line") <= 1) | F.col("is_external")).join(busy, "id", "left_anti").select("id", "name")


def cfg_subgraph(g: Graph, method_id: int, max_nodes: int = 100) -> DataFrame:
    """Edges between the first nodes of a method's control flow."""
    own = g.cfg.where(F.col("method_id") == method_id)
    nodes = own.select(F.col("src").alias("n")).union(own.select("dst")).distinct().orderBy("n").limit(max_nodes)
    return own.join(nodes.withColumnRenamed("n", "src"), "src", "left_semi").join(nodes.withColumnRenamed("n", "dst"), "dst", "left_semi").select("src", "dst", "label")


def callers_of(g: Graph) -> DataFrame:
    """For each called user method: number of call sites and of distinct callers."""
    return g.call.where(F.col("callee_id").isNotNull()).groupBy("callee_id").agg(F.count("*").alias("sites"), F.countDistinct("method_id").alias("callers"))


def macro_calls(g: Graph, name: str, limit: int | None = 50) -> DataFrame:
    """Calls of a name with code and dispatch, as after macro expansion."""
    out = g.call.where(P.full_match(F.col("name"), P.checked(name))).select("id", "name", "code", "dispatch_type", "file", F.coalesce("line", F.lit(-1)).alias("line"))
    return out.orderBy("id").limit(limit) if limit else out


def variable_flow(g: Graph, method_id: int, variable: str, line: int, limit: int = 50) -> DataFrame:
    """What happens to a variable up to a line: declaration, parameter, assignment, use_in_call; sorted by line and kind."""
    v = F.lit(variable)
    parts = [
        g.local.where((F.col("method_id") == method_id) & (F.col("name") == v)).select("line", F.lit("declaration").alias("kind"), F.concat_ws(" ", "type_full_name", "name").alias("code")),
        g.parameter.where((F.col("method_id") == method_id) & (F.col("name") == v)).join(g.method.select(F.col("id").alias("method_id"), "line"), "method_id").select("line", F.lit("parameter").alias("kind"), F.concat_ws(" ", "type_full_name", "name").alias("code")),
        g.assignment.where((F.col("method_id") == method_id) & P.mentions(F.col("target"), v)).select("line", F.lit("assignment").alias("kind"), F.concat_ws(" = ", "target", "source").alias("code")),
        g.argument.where((F.col("method_id") == method_id) & P.mentions(F.col("code"), v)).join(g.call.select(F.col("id").alias("call_id"), F.col("code").alias("whole")), "call_id").select("line", F.lit("use_in_call").alias("kind"), F.col("whole").alias("code")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where(F.col("line") <= line).distinct().orderBy("line", "kind", "code").limit(limit)


def variable_flow_forward(g: Graph, seeds: DataFrame, depth: int = 4) -> DataFrame:
    """Where a variable goes from a line on: usage in a call, propagation to another variable, whose way is then followed: method_id, var, line, kind, code.

    ``seeds``: method_id, var, line.  Names that hold the variable's address are followed with it.
    """
    sets = cut(g.assignment.select("method_id", F.col("line").alias("at"), F.col("target").alias("other"), "source", F.explode(identifiers(F.col("source"))).alias("var")).distinct())
    seeds = seeds.select("method_id", "var", "line").distinct()
    address = seeds.join(sets, ["method_id", "var"]).where(F.col("source").contains(F.concat(F.lit("&"), "var"))).select("method_id", F.col("other").alias("var"), "line")
    front = seen = cut(seeds.unionByName(address).distinct())
    for _ in range(depth):
        step = front.join(sets, ["method_id", "var"]).where("at >= line AND other <> var").select("method_id", F.col("other").alias("var"), F.col("at").alias("line")).distinct()
        front = cut(step.join(seen, ["method_id", "var", "line"], "left_anti"))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    # the earliest line of a variable has all that later ones have
    first = seen.groupBy("method_id", "var").agg(F.min("line").alias("line"))
    moved = first.join(sets, ["method_id", "var"]).where("at >= line").select("method_id", "var", F.col("at").alias("line"), F.lit("propagation").alias("kind"), F.concat_ws(" = ", "other", "source").alias("code"))
    c = g.call.where(~F.col("name").startswith("<operator>")).select(F.col("id").alias("call_id"), "method_id", F.col("line").alias("at"), F.col("code").alias("whole"))
    used = first.join(c.join(g.argument.select("call_id", F.col("code").alias("arg")), "call_id"), "method_id").where((F.col("at") >= F.col("line")) & P.mentions(F.col("arg"), F.col("var")))
    return moved.unionByName(used.select("method_id", "var", F.col("at").alias("line"), F.lit("usage").alias("kind"), F.col("whole").alias("code"))).distinct()


def page(rows: DataFrame, order: list[str], number: int = 1, size: int = 100, limit: int = 1000) -> DataFrame:
    """One page of the first ``limit`` rows in a total order, with total (after the limit), pages and whether more rows were cut off.

    Only the first ``limit`` rows are numbered, at most 10,000.
    """
    limit = min(limit, 10_000)
    first = rows.orderBy(*order).limit(limit + 1)
    place = W.orderBy(*order)
    every = W.partitionBy(F.lit(0))
    first = first.withColumn("place", F.row_number().over(place)).withColumn("total", F.least(F.count("*").over(every), F.lit(limit))).withColumn("truncated", F.count("*").over(every) > limit)
    out = first.where((F.col("place") > (number - 1) * size) & (F.col("place") <= F.least(F.lit(number * size), F.col("total"))))
    return out.withColumn("pages", F.ceil(F.col("total") / size).cast("long"))


def anchors(g: Graph, places: DataFrame) -> DataFrame:
    """The node meant by each (file, line): on the line or up to three lines off, before rather than after.

    Within a line: a call, an assignment, a condition, an operator's call; then the smallest id.
    """
    m = g.method.select(F.col("id").alias("method_id"), F.col("file").alias("m_file"))
    operator = F.col("name").startswith("<operator>")
    calls = g.call.select("method_id", F.col("line").alias("at"), F.col("id").alias("node"), F.when(operator, 3).otherwise(0).alias("rank"), "code")
    sets = g.assignment.select("method_id", F.col("line").alias("at"), F.col("id").alias("node"), F.lit(1).alias("rank"), F.concat_ws(" = ", "target", "source").alias("code"))
    tests = g.control.select("method_id", F.col("line").alias("at"), F.col("id").alias("node"), F.lit(2).alias("rank"), F.col("condition").alias("code"))
    # the first node of each line and kind is found before rows travel: a line has many nodes, and one is wanted
    first = lambda nodes: nodes.join(m, "method_id").groupBy("m_file", "at").agg(F.min(F.struct("rank", "node", "code", "method_id")).alias("n"))
    nodes = first(calls).unionByName(first(sets)).unionByName(first(tests)).groupBy("m_file", "at").agg(F.min("n").alias("n"))
    # one row for each line that counts, so that the join is on equal values
    near = places.distinct().withColumn("delta", F.explode(F.sequence(F.lit(-3), F.lit(3)))).withColumn("at", F.col("line") + F.col("delta"))
    hit = near.join(nodes, (F.col("file") == F.col("m_file")) & (near["at"] == nodes["at"])).drop(nodes["at"])
    best = F.min(F.struct(F.abs("delta").alias("far"), "delta", F.col("n.rank").alias("rank"), F.col("n.node").alias("node"), F.col("n.code").alias("code"), F.col("n.method_id").alias("method_id")))
    return hit.groupBy("file", "line").agg(best.alias("x")).select("file", "line", "x.delta", "x.node", "x.code", "x.method_id")


def name_suggestions(g: Graph, name: str, limit: int = 10) -> DataFrame:
    """Method names that contain a name, where none is equal to it."""
    exact = g.method.where(F.col("name") == name).select(F.lit(True).alias("there")).limit(1)
    like = g.method.where(F.col("name").contains(name)).select("name").distinct()
    return like.join(exact, F.col("there"), "left_anti").orderBy("name").limit(limit)


def as_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text."""
    return rows.select(F.to_json(F.struct("*")).alias("json"))
