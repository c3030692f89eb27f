"""Bounded graph iteration: frontiers as DataFrames, one round of joins per level.

Rounds are cut by ``checkpoint`` where the session has a checkpoint folder, so plans
stay small and lost executors do not replay all levels.
"""

from __future__ import annotations

import uuid
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import predicates as P
from ..graph import Graph


def cut(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint() if spark.sparkContext.getCheckpointDir() else df.persist()


def dealt(df: DataFrame, key: str, folder: str | None = None, inside: bool = False) -> DataFrame:
    """Stored once in buckets by ``key``, so that joins, groups and windows by it read it without a shuffle.

    Without a checkpoint folder, where all executors could read it, the table is persisted as it is.
    ``inside``: the rows come straight out of a table dealt by the same key, so each task has those of few buckets and writes them as they are.
    """
    spark = df.sparkSession
    folder = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist()
    name, buckets = f"weft_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df if inside else df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder.rstrip('/')}/{name}").format("parquet").saveAsTable(name)
    out = spark.table(name)
    out.schema  # resolved, with its buckets: only the files are needed from here on
    spark.sql(f"DROP TABLE {name}")
    return out


def call_edges(g: Graph) -> DataFrame:
    """Distinct caller -> callee between user methods, by id."""
    return g.call.where(F.col("callee_id").isNotNull()).select(F.col("method_id").alias("src"), F.col("callee_id").alias("dst")).distinct()


def reach(edges: DataFrame, start: DataFrame, depth: int | None) -> DataFrame:
    """(node, depth): the least number of steps, at most ``depth`` (None: as many as it takes), from any start node (column node)."""
    edges = cut(edges.select("src", "dst"))
    seen = cut(start.select("node").distinct().withColumn("depth", F.lit(0)))
    front = seen
    for level in range(1, depth + 1) if depth is not None else count(1):
        step = front.join(edges, front.node == edges.src).select(F.col("dst").alias("node")).distinct()
        front = cut(step.join(seen, "node", "left_anti").withColumn("depth", F.lit(level)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def call_graph(g: Graph, method_id: int, depth: int = 5, direction: str = "outgoing", neighbours: int = 50) -> DataFrame:
    """Edges (src, dst, depth, is_cycle) met walking from a method, at most ``neighbours`` a node.

    An edge is cyclic if its far end was met on its own level or before.
    """
    edges = call_edges(g) if direction == "outgoing" else call_edges(g).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    edges = edges.withColumn("r", F.row_number().over(W.partitionBy("src").orderBy("dst"))).where(F.col("r") <= neighbours).drop("r")
    level = reach(edges, g.method.where(F.col("id") == method_id).select(F.col("id").alias("node")), depth)
    out = edges.join(level.where(F.col("depth") < depth).withColumnRenamed("node", "src"), "src")
    far = level.select(F.col("node").alias("dst"), F.col("depth").alias("far"))
    return out.join(far, "dst").select("src", "dst", (F.col("depth") + 1).alias("depth"), (F.col("far") <= F.col("depth")).alias("is_cycle"))


def call_graph_bounded(g: Graph, method_id: int, depth: int = 5, direction: str = "outgoing", sites: int = 50, limit: int = 500) -> DataFrame:
    """Edges (place, caller, callee, depth, is_cycle) in the order of a breadth-first visit that stops at ``limit`` edges.

    A method's neighbours are those of its first ``sites`` calls by id, each once.  Methods are visited in
    the order in which they were met; an edge is cyclic if its far end was visited by then.  The method
    whose edges reach the limit is the last one, and keeps all of its edges.  ``depth``: 1 to 15.

    A level has less than ``limit + sites`` methods, so it may be broadcast, and ``sites`` edges of each, so one
    task may number them.
    """
    if not 1 <= depth <= 15:
        raise ValueError("depth must be from 1 to 15")
    if direction not in ("outgoing", "incoming"):
        raise ValueError("direction must be outgoing or incoming")
    near, far = ("method_id", "callee_id") if direction == "outgoing" else ("callee_id", "method_id")
    call = g.call.where("callee_id IS NOT NULL").select(F.col(near).alias("near"), F.col(far).alias("far"), "id")
    front = g.method.where(F.col("id") == method_id).select(F.col("id").alias("node"), F.lit(1).alias("visit"))
    seen, found, met, edges = front, None, 1, 0
    for level in range(1, depth + 1):
        first = call.join(F.broadcast(front), F.col("near") == F.col("node")).withColumn("r", F.row_number().over(W.partitionBy("near").orderBy("id"))).where(F.col("r") <= sites)
        step = first.groupBy("visit", "near", "far").agg(F.min("r").alias("r")).withColumn("place", F.row_number().over(W.orderBy("visit", "r")) + edges)
        step = step.withColumn("begins", F.min("place").over(W.partitionBy("visit"))).where(F.col("begins") <= limit)
        step = cut(step.select("place", "near", "far", "visit", F.lit(level).alias("depth")))
        found = step if found is None else found.unionByName(step)
        edges += step.count()
        if level == depth or edges >= limit:
            break
        new = step.join(F.broadcast(seen), F.col("far") == F.col("node"), "left_anti").groupBy(F.col("far").alias("node")).agg(F.min("place").alias("place"))
        front = cut(new.select("node", (F.row_number().over(W.orderBy("place")) + met).alias("visit")))
        new_methods = front.count()
        if not new_methods:
            break
        met += new_methods
        seen = seen.unionByName(front)
    ends = seen.select(F.col("node").alias("far"), F.col("visit").alias("far_visit"))
    caller, callee = ("near", "far") if direction == "outgoing" else ("far", "near")
    cyclic = F.coalesce(F.col("far_visit") <= F.col("visit"), F.lit(False))
    return found.join(F.broadcast(ends), "far", "left").select("place", F.col(caller).alias("caller"), F.col(callee).alias("callee"), "depth", cyclic.alias("is_cycle"))


def entry_reach(g: Graph, inputs: list[str], depth: int = 9) -> DataFrame:
    """Methods reachable from one that reads external input, and in how many calls."""
    start = g.call.where(P.any_of(F.col("name"), inputs)).select(F.col("method_id").alias("node"))
    return reach(call_edges(g), start, depth)


def entry_points(g: Graph, inputs: list[str], depth: int = 9) -> DataFrame:
    """(method_id, hops, entry): the nearest method that reads external input and reaches the method by calls; of several the smallest.

    One walk from all readers at once: the smallest entry travels with the frontier, so no
    search is made for a single method.
    """
    edges = cut(call_edges(g))
    front = g.call.where(P.any_of(F.col("name"), inputs)).select("method_id", F.lit(0).alias("hops"), F.col("method_id").alias("entry")).distinct()
    seen = front = cut(front)
    for level in range(1, depth + 1):
        step = front.join(edges, front.method_id == edges.src).groupBy(F.col("dst").alias("method_id")).agg(F.min("entry").alias("entry"))
        front = cut(step.join(seen.select("method_id"), "method_id", "left_anti").select("method_id", F.lit(level).alias("hops"), "entry"))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def edges_by_depth(edges: DataFrame) -> DataFrame:
    """Edges and cyclic edges of a call graph for each depth."""
    return edges.groupBy("depth").agg(F.count("*").alias("edges"), F.count_if("is_cycle").alias("cyclic"))


def taint_reach(g: Graph, sources: list[str], depth: int | None = None) -> DataFrame:
    """Nodes that data of any call of a source reaches, and in how many steps."""
    return reach(g.ddg, g.call.where(P.any_of(F.col("name"), sources)).select(F.col("id").alias("node")), depth)


def call_path_exists(g: Graph, source: int, sink: int, depth: int = 5) -> DataFrame:
    hit = reach(call_edges(g), g.method.where(F.col("id") == source).select(F.col("id").alias("node")), depth).where(F.col("node") == sink)
    return hit.agg(F.coalesce(F.min("depth"), F.lit(-1)).alias("hops"))


def flow_paths(g: Graph, source: int, depth: int = 4, limit: int | None = 20, avoid: DataFrame | None = None) -> DataFrame:
    """Simple data-flow paths from a node, as arrays; paths through ``avoid`` (column node) are dropped before the limit."""
    edges = g.ddg if avoid is None else g.ddg.join(avoid.select(F.col("node").alias("dst")), "dst", "left_anti").select("src", "dst")
    edges = cut(edges)
    path = g.spark.createDataFrame([(source, [source])], "node long, path array<long>")
    found = None
    for _ in range(depth):
        path = path.join(edges, path.node == edges.src).where(~F.array_contains("path", F.col("dst"))).select(F.col("dst").alias("node"), F.concat("path", F.array("dst")).alias("path"))
        path = cut(path)
        found = path if found is None else found.unionByName(path)
    out = found.select("node", F.size("path").alias("length"), F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))
    return out.orderBy("length", "path").limit(limit) if limit else out


def slice_variable(g: Graph, seeds: DataFrame, depth: int = 5, forward: bool = False) -> DataFrame:
    """Assignments that a variable depends on (or that depend on it) within its method.

    ``seeds``: method_id, var, line.  Backward, an assignment to the variable before the
    line adds the variables in its source; forward, one after the line that mentions it adds its target.
    """
    a = cut(g.assignment.select("id", "method_id", F.col("line").alias("at"), "target", "source", F.explode(F.expr(r"regexp_extract_all(source, '\\b(v[0-9]+|[A-Za-z_]\\w*)\\b', 1)")).alias("used")).distinct())
    front = seeds.select("method_id", "var", "line")
    seen = front
    hits = None
    for level in range(1, depth + 1):
        if forward:
            step = front.join(a, "method_id").where((F.col("used") == F.col("var")) & (F.col("at") > F.col("line")))
            following = step.select("method_id", F.col("target").alias("var"), F.col("at").alias("line"))
        else:
            step = front.join(a, "method_id").where((F.col("target") == F.col("var")) & (F.col("at") < F.col("line")))
            following = step.select("method_id", F.col("used").alias("var"), F.col("at").alias("line"))
        step = cut(step.select("id", "method_id", "at", "target", "source").distinct().withColumn("depth", F.lit(level)))
        hits = step if hits is None else hits.unionByName(step)
        front = cut(following.distinct().join(seen, ["method_id", "var", "line"], "left_anti"))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return hits.groupBy("id", "method_id", F.col("at").alias("line"), "target", "source").agg(F.min("depth").alias("depth"))


def identifiers(code: Column) -> Column:
    """The distinct names in a code text."""
    return F.array_distinct(F.regexp_extract_all(code, F.lit(r"\b([A-Za-z_]\w*)\b"), 1))


def callees(g: Graph, among: DataFrame | None = None) -> DataFrame:
    """(call_id, method_id, line, callee_id): the method called, and for dynamic dispatch every method of the call's name.

    ``among`` (callee_id, and others): only calls of these methods, with the other columns; they are met before rows are made distinct.
    """
    c = g.call.select(F.col("id").alias("call_id"), "method_id", "line", "name", "dispatch_type", "callee_id")
    static = c.where("callee_id IS NOT NULL").select("call_id", "method_id", "line", "callee_id")
    named = g.method.select(F.col("id").alias("callee_id"), "name")
    if among is not None:
        static, named = static.join(among, "callee_id"), named.join(among, "callee_id")
    dynamic = c.where("dispatch_type = 'DYNAMIC_DISPATCH'").drop("callee_id").join(named, "name").drop("name", "dispatch_type")
    out = static.unionByName(dynamic)
    return (out if among is None else out.repartition("method_id")).distinct()


def passed(g: Graph) -> DataFrame:
    """Arguments with the parameter they are bound to: call_id, method_id, line, code, kind, callee_id, param."""
    a = g.argument.select("call_id", "method_id", "arg_index", "code", "kind")
    p = g.parameter.select(F.col("method_id").alias("callee_id"), F.col("ord").alias("arg_index"), F.col("name").alias("param"))
    return callees(g).join(a, ["method_id", "call_id"]).join(p, ["callee_id", "arg_index"]).drop("arg_index").distinct()


def _written(target: Column) -> Column:
    """The names an assignment to ``target`` counts for: itself, the base of an access, the field at its end."""
    name = F.when(P.full_match(target, r"\w+"), target)
    base = F.regexp_extract(target, r"\A(\w+)(?:\[|->|\.)", 1)
    field = F.regexp_extract(target, r"(?:->|\.)(\w+)\z", 1)
    return F.array_distinct(F.filter(F.array(name, base, field), lambda x: x.isNotNull() & (x != "")))


def compound_assignments(g: Graph) -> DataFrame:
    """id, method_id, line, target, source of calls that update their first argument by their second (``x += y``)."""
    c = g.call.where(F.col("name").startswith("<operator>.assignment") & (F.col("name") != "<operator>.assignment")).select("id", "method_id", "line")
    sides = g.argument.where("arg_index IN (1, 2)").select(F.col("call_id").alias("id"), "method_id", "arg_index", "code")
    side = [F.max(F.when(F.col("arg_index") == i, F.col("code"))).alias(n) for i, n in ((1, "target"), (2, "source"))]
    return c.join(sides, ["method_id", "id"]).groupBy("id", "method_id", "line").agg(*side).where("target IS NOT NULL AND source IS NOT NULL")


def slice_steps(g: Graph, forward: bool = False) -> DataFrame:
    """One row for each way a slice goes on from (method_id, var): what is met there (id, kind, at) and next_method, next_var, next_line.

    A way may come more than once.  It is open to a line after (forward: before) ``bound``.  Compound assignments count backward; forward they are calls like others.
    """
    others = F.explode_outer(F.filter("names", lambda x: x != F.col("var")))
    columns = ["id", "method_id", F.col("line").alias("at"), "target", "source"]
    a = g.assignment.where("line > 0").select(*columns, F.lit("assignment").alias("kind"))
    if not forward:
        a = a.unionByName(compound_assignments(g).where("line > 0").select(*columns, F.lit("compound").alias("kind")))
    if forward:
        own = a.select("*", F.explode(identifiers(F.col("source"))).alias("var"), F.array(F.regexp_extract("target", r"\A[*&]*(\w+)", 1)).alias("names"))
    else:
        own = a.select("*", F.explode(_written(F.col("target"))).alias("var"), identifiers(F.col("source")).alias("names"))
    own = own.select("method_id", "var", F.col("at").alias("bound"), "id", "kind", "at", F.col("method_id").alias("next_method"), others.alias("next_var"), F.col("at").alias("next_line"))
    if forward:
        used = g.argument.where("kind <> 'LITERAL'").select("call_id", "arg_index", "method_id", F.col("line").alias("at"), F.explode(identifiers(F.col("code"))).alias("var"))
        p = g.parameter.select(F.col("method_id").alias("callee_id"), F.col("ord").alias("arg_index"), F.col("name").alias("next_var"))
        into = callees(g).select("method_id", "call_id", "callee_id").join(p, "callee_id").join(g.method.select(F.col("id").alias("callee_id"), F.col("line").alias("next_line")), "callee_id")
        step = used.join(into, ["method_id", "call_id", "arg_index"], "left").select("method_id", "var", F.col("at").alias("bound"), F.col("call_id").alias("id"), F.lit("argument").alias("kind"), "at", F.col("callee_id").alias("next_method"), "next_var", "next_line")
    else:
        step = passed(g).where("kind <> 'LITERAL'").select(
            F.col("callee_id").alias("method_id"), F.col("param").alias("var"), F.lit(-1).alias("bound"), F.col("call_id").alias("id"), F.lit("argument").alias("kind"),
            F.col("line").alias("at"), F.col("method_id").alias("next_method"), F.explode(identifiers(F.col("code"))).alias("next_var"), F.col("line").alias("next_line"),
        )
    return own.unionByName(step)


def slice_between(g: Graph, seeds: DataFrame, depth: int = 5, forward: bool = False) -> DataFrame:
    """Assignments and calls that a variable depends on (or that depend on it), across methods: id, kind, method_id, var, line, depth.

    ``seeds``: method_id, var, line.  Backward, a parameter goes on to the arguments of all calls
    of its method; forward, an argument goes on to the parameter of the method called.

    Ways are stored once, dealt by method.  A way is open to all lines beyond its bound, so of a variable only the furthest
    line met (backward the last, forward the first) has to be known: it goes on where that line moves, over the ways between its old
    and new place, and each way is taken once.  What travels in a round is one row for each method and variable.
    """
    furthest, beyond = (F.min, "line < before") if forward else (F.max, "line > before")
    open_ = "bound > line AND (before IS NULL OR bound <= before)" if forward else "bound < line AND (before IS NULL OR bound >= before)"
    steps = dealt(slice_steps(g, forward), "method_id")
    place = ["method_id", "var"]
    # known: the furthest line of a variable, the one before it, and the round that moved it
    known = seeds.groupBy(*place).agg(furthest("line").alias("line")).select(*place, "line", F.lit(None).cast("int").alias("before"), F.lit(0).alias("depth"))
    known = dealt(known, "method_id")
    fronts = None
    for level in range(1, depth + 1):
        front = known.where(F.col("depth") == level - 1).select(*place, "line", "before", F.lit(level).alias("depth"))
        if front.isEmpty():
            break
        fronts = front if fronts is None else fronts.unionByName(front)
        if level == depth:
            break
        met = front.join(steps, place).where(open_).where("next_var IS NOT NULL")
        new = met.groupBy(F.col("next_method").alias("method_id"), F.col("next_var").alias("var")).agg(furthest("next_line").alias("line"))
        both = known.withColumnRenamed("before", "was").withColumnRenamed("line", "before").join(new, place, "full")
        moved = F.expr(f"line IS NOT NULL AND (before IS NULL OR {beyond})")
        known = dealt(
            both.select(
                *place, F.when(moved, F.col("line")).otherwise(F.col("before")).alias("line"),
                F.when(moved, F.col("before")).otherwise(F.col("was")).alias("before"), F.when(moved, F.lit(level)).otherwise(F.col("depth")).alias("depth"),
            ),
            "method_id",
        )
    if fronts is None:
        fronts = known.where("false")
    hits = fronts.join(steps, place).where(open_)
    return hits.groupBy("id", "kind", "method_id", "var", F.col("at").alias("line")).agg(F.min("depth").alias("depth"))


def flow_edges(g: Graph) -> DataFrame:
    """The distinct edges of data flow, stored once, dealt by their beginning."""
    return g.once("flow_edges", lambda: dealt(g.ddg.select("src", "dst").where("src <> dst").distinct(), "src"))


def flow_calls(g: Graph, names: list[str]) -> DataFrame:
    """(node, name): the calls of ``names`` between the least and the largest node of data flow, as others are on no path; read in one pass and stored."""
    least, most = flow_edges(g).agg(F.min(F.least("src", "dst")), F.max(F.greatest("src", "dst"))).first()
    calls = g.passing("call").where(F.col("id").between(F.lit(least), F.lit(most)) & P.any_of(F.col("name"), names))
    return dealt(calls.select(F.col("id").alias("node"), "name"), "node")


def flows_between(g: Graph, sources: DataFrame, sinks: DataFrame, depth: int = 8, limit: int | None = None, sanitizers: DataFrame | None = None) -> DataFrame:
    """Simple data-flow paths from sources to the first sink on them: source, sink, length (nodes), path.

    ``sources``, ``sinks``, ``sanitizers``: column node.  A path with a sanitizer inside (not at
    its ends) is none.  An edge knows the least number of steps from its far end to a sink, and a path takes
    only those edges from which it still gets there within ``depth`` steps, so few paths are built that lead nowhere.
    What travels in a round is the unfinished paths; the edges are stored, dealt by their beginning.
    """
    kinds = {"starts": sources, "ends": sinks} | ({"clean": sanitizers} if sanitizers is not None else {})
    marks = None
    for kind, nodes in kinds.items():
        one = nodes.select("node", *[F.lit(k == kind).alias(k) for k in ("starts", "ends", "clean")])
        marks = one if marks is None else marks.unionByName(one)
    marks = marks.groupBy("node").agg(*[F.max(k).alias(k) for k in ("starts", "ends", "clean")])
    near, far = marks.select(F.col("node").alias("src"), "starts", F.col("ends").alias("over")), marks.select(F.col("node").alias("dst"), "ends", "clean")
    edges = flow_edges(g).join(near, "src", "left").where("starts OR over IS NULL OR NOT over").join(far, "dst", "left").where("ends OR clean IS NULL OR NOT clean")
    edges = dealt(edges.select("src", "dst", *[F.coalesce(k, F.lit(False)).alias(k) for k in ("starts", "ends")]), "dst")
    useful = dealt(_towards(edges, depth), "src")
    if limit:
        return _first_paths(useful.where("starts").select(F.col("src").alias("node")).distinct(), useful.select("src", "dst", "ends"), depth, limit)
    path = useful.where("starts").select(F.col("dst").alias("node"), F.array("src", "dst").alias("path"), "ends")
    found = path.where("ends")
    for step in range(2, depth + 1):
        on = useful.where(F.col("after") <= depth - step).select("src", "dst", F.col("ends").alias("last"))
        path = path.where("NOT ends").join(on, F.col("node") == F.col("src")).where(~F.array_contains("path", F.col("dst")))
        path = path.select(F.col("dst").alias("node"), F.concat("path", F.array("dst")).alias("path"), F.col("last").alias("ends"))
        found = found.unionByName(path.where("ends"))
    return found.select(F.col("path")[0].alias("source"), F.col("node").alias("sink"), F.size("path").alias("length"), F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


def _towards(edges: DataFrame, depth: int) -> DataFrame:
    """Edges with ``after``: the least number of steps from their far end to an end, where that is less than ``depth``."""
    inner = edges.where("NOT ends").select("src", "dst")
    front, levels = edges.where("ends"), []
    after = edges.sparkSession.createDataFrame([], "dst long, after int")
    for level in range(1, depth):
        front = front.select(F.col("src").alias("dst")).distinct()
        for one in levels:
            front = front.join(one, "dst", "left_anti")
        front = dealt(front, "dst")
        if front.isEmpty():
            break
        levels.append(front)
        after = after.unionByName(front.withColumn("after", F.lit(level)))
        front = inner.join(front, "dst", "left_semi")
    return edges.join(after, "dst", "left").withColumn("after", F.when(F.col("ends"), 0).otherwise(F.col("after"))).where("after IS NOT NULL")


def _first_paths(start: DataFrame, useful: DataFrame, depth: int, limit: int) -> DataFrame:
    """The first ``limit`` paths by length, then by text, without building the others.

    Length by length: only nodes that can reach an end in just the steps left are gone to, and of the beginnings the first
    ``2 * limit`` by text are kept, as those of a length order like their paths.  If too few of
    them end without meeting a node twice, the length is done again with four times as many.
    """
    text = lambda x: F.array_join(F.transform(x, lambda n: n.cast("string")), ">")
    spark = start.sparkSession
    none = spark.createDataFrame([], "source long, sink long, length int, path string")
    steps: list[DataFrame] = []  # [k]: edges after which k more lead to an end
    out, have = none, 0
    for length in range(1, depth + 1):
        if steps:
            ahead = steps[-1].select(F.col("src").alias("dst")).distinct()
            steps.append(cut(useful.where("NOT ends").join(ahead, "dst", "left_semi").select("src", "dst")))
        else:
            steps.append(cut(useful.where("ends").select("src", "dst")))
        if steps[-1].isEmpty():
            break
        most = 2 * (limit - have)
        while True:
            path, whole = start.select("node", F.array("node").alias("path")), True
            for k in reversed(range(length)):
                path = path.join(steps[k], F.col("node") == F.col("src")).where(~F.array_contains("path", F.col("dst"))).select(F.col("dst").alias("node"), F.concat("path", F.array("dst")).alias("path"))
                # behind a node stands what goes on, but for the last one
                path = cut(path.orderBy(F.concat(text(F.col("path")), F.lit(">" if k else ""))).limit(most + 1))
                if path.count() > most:
                    path, whole = path.orderBy(F.concat(text(F.col("path")), F.lit(">" if k else ""))).limit(most), False
            found = path.count()
            if whole or found >= limit - have:
                break
            most *= 4
        done = path.select(F.col("path")[0].alias("source"), F.col("node").alias("sink"), F.size("path").alias("length"), text(F.col("path")).alias("path"))
        out, have = out.unionByName(done), have + found
        if have >= limit:
            break
    return out.orderBy("length", "path").limit(limit)


def with_entry(g: Graph, findings: DataFrame, inputs: list[str], depth: int = 9) -> DataFrame:
    """Findings (column method_id) with the entry that reaches their method, and HIGH confidence if there is one, else MEDIUM."""
    found = findings.join(cut(entry_points(g, inputs, depth)), "method_id", "left")
    return found.withColumn("confidence", F.when(F.col("entry").isNotNull(), "HIGH").otherwise("MEDIUM"))


def address_taken(g: Graph, limit: int | None = 50) -> DataFrame:
    """Methods that nothing calls, with places that mention their address: method_id, name, site, at_method, line.

    Likely callers by pointer: an argument or assigned value that is the name, or its address.
    """
    called = callees(g).select(F.col("callee_id").alias("method_id")).distinct()
    idle = g.method.where(~F.col("is_external")).select(F.col("id").alias("method_id"), "name").join(called, "method_id", "left_anti")
    bare = F.regexp_replace(F.trim("code"), r"\A&", "")
    sites = g.argument.where("kind <> 'LITERAL'").select(F.col("call_id").alias("site"), F.col("method_id").alias("at_method"), "line", bare.alias("name"))
    sites = sites.unionByName(g.assignment.select(F.col("id").alias("site"), F.col("method_id").alias("at_method"), "line", F.regexp_replace(F.trim("source"), r"\A&", "").alias("name")))
    hit = idle.join(sites, "name").select("method_id", "name", "site", "at_method", "line").distinct()
    if limit:
        hit = hit.withColumn("r", F.row_number().over(W.partitionBy("method_id").orderBy("site"))).where(F.col("r") <= limit).drop("r")
    return hit
