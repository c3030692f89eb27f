"""Defect detectors: each is one plan of joins inside a method, giving a row per finding.

Events are ordered by line; a use counts only after its cause and only if nothing
between clears it (reassignment, a return that always ends the method, another
branch of the same condition, a null check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import dicts
from ..functions import predicates as P
from ..graph import Graph
from . import dataflow, trees
from .iterate import callees, cut, dealt, passed
from .order import numbered

DETECTORS: dict[str, tuple[str, Callable[..., DataFrame]]] = {}


def detector(name: str, cwe: str) -> Callable:
    """Register a detector: a function (graph, **parameters) -> DataFrame."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        DETECTORS[name] = (cwe, f)
        return f

    return register


def first_arguments(g: Graph, names: list[str], index: int = 1) -> DataFrame:
    """Calls of named functions with the code of one argument: id, method_id, name, line, arg."""
    c = g.call.where(P.any_of(F.col("name"), names)).select("id", "method_id", "name", "line", "file")
    a = g.argument.where(F.col("arg_index") == index).select(F.col("call_id").alias("id"), "method_id", F.trim("code").alias("arg"), "kind", "decl_id")
    return c.join(a, ["method_id", "id"]).select("id", "method_id", "name", "line", "file", "arg", "kind", "decl_id")


def without_reassignment(g: Graph, pairs: DataFrame, name: str = "ptr") -> DataFrame:
    """Drop (method_id, a <= b) pairs with an assignment to ``name`` strictly between the lines, or on the line if that is one."""
    a = g.assignment.select(F.col("method_id").alias("m"), F.col("line").alias("at"), "target")
    return pairs.join(a, (F.col("method_id") == F.col("m")) & (F.col("target") == F.col(name)) & (F.col("at").between(F.col("a") + 1, F.col("b") - 1) | (F.col("a") == F.col("b")) & (F.col("at") == F.col("a"))), "left_anti")


def switch_segments(g: Graph) -> DataFrame:
    """Lines from each label of a switch to the one before the next label: control_id, method_id, branch (from 1), line, line_end.

    A line is in the segment of the last label up to it; switches with one label have none.
    """
    own = g.control.where("type = 'SWITCH'").select(F.col("id").alias("control_id"), F.col("line").alias("begins"), F.col("line_end").alias("ends"))
    labels = g.label.select("control_id", "method_id", "line").distinct().join(own, "control_id").where("line BETWEEN begins AND ends")
    order = W.partitionBy("control_id").orderBy("line")
    last = F.coalesce(F.lead("line").over(order) - 1, F.col("ends")).alias("line_end")
    return labels.select("control_id", "method_id", F.row_number().over(order).alias("branch"), "line", last, F.count("*").over(W.partitionBy("control_id")).alias("n")).where("n >= 2").drop("n")


def segment_of(g: Graph, events: DataFrame) -> DataFrame:
    """Events (method_id, line, and others) in a switch, with the last label up to their line: control_id, label.

    As of the line: labels and events stand in one order, and an event takes the last label before it.
    """
    own = g.control.where("type = 'SWITCH'").select(F.col("id").alias("control_id"), F.col("method_id").alias("m"), F.col("line").alias("begins"), F.col("line_end").alias("ends"))
    inside = events.join(own, (F.col("method_id") == F.col("m")) & F.col("line").between(F.col("begins"), F.col("ends"))).drop("m", "begins", "ends")
    marks = g.label.select("control_id", "line", F.col("line").alias("label")).distinct()
    both = inside.withColumn("label", F.lit(None).cast("int")).unionByName(marks, allowMissingColumns=True)
    latest = F.last("label", ignorenulls=True).over(W.partitionBy("control_id").orderBy("line", F.col("method_id").isNotNull()).rowsBetween(W.unboundedPreceding, 0))
    return both.withColumn("label", latest).where("method_id IS NOT NULL AND label IS NOT NULL")


def without_exclusive(g: Graph, pairs: DataFrame) -> DataFrame:
    """Drop pairs whose lines a and b are in different branches of one condition, or segments of one switch."""
    apart = g.branch.unionByName(switch_segments(g))
    x = apart.select("control_id", F.col("method_id").alias("m"), F.col("branch").alias("xb"), F.col("line").alias("x0"), F.col("line_end").alias("x1"))
    y = apart.select("control_id", F.col("method_id").alias("m"), F.col("branch").alias("yb"), F.col("line").alias("y0"), F.col("line_end").alias("y1"))
    both = x.repartition("m").join(y.repartition("m"), ["m", "control_id"]).where("xb <> yb")
    inside = (F.col("method_id") == F.col("m")) & F.col("a").between(F.col("x0"), F.col("x1")) & F.col("b").between(F.col("y0"), F.col("y1"))
    return pairs.join(both, inside, "left_anti")


def plain_returns(g: Graph) -> DataFrame:
    """Returns outside all control structures: method_id, line."""
    c = g.control.select(F.col("method_id").alias("m"), F.col("line").alias("c0"), F.col("line_end").alias("c1"))
    r = g.ret.select("method_id", "line")
    return r.join(c, (F.col("method_id") == F.col("m")) & F.col("line").between(F.col("c0"), F.col("c1")), "left_anti").distinct()


def without_return(g: Graph, pairs: DataFrame) -> DataFrame:
    r = plain_returns(g).select(F.col("method_id").alias("m"), F.col("line").alias("at"))
    return pairs.join(r, (F.col("method_id") == F.col("m")) & (F.col("at") > F.col("a")) & (F.col("at") < F.col("b")), "left_anti")


def without_exit(g: Graph, pairs: DataFrame) -> DataFrame:
    """Drop pairs with an end between: a call that ends the program, or a return in no control structure that begins after a."""
    c = g.control.select(F.col("method_id").alias("m"), F.col("line").alias("c0"), F.col("line_end").alias("c1"))
    r = g.ret.select("method_id", F.col("line").alias("at")).distinct()
    r = r.join(c, (F.col("method_id") == F.col("m")) & F.col("at").between(F.col("c0"), F.col("c1")), "left")
    r = r.groupBy(F.col("method_id").alias("m"), "at").agg(F.coalesce(F.max("c0"), F.lit(-1)).alias("inside"))
    ends = g.call.where(P.any_of(F.col("name"), dicts.EXITS)).select(F.col("method_id").alias("m"), F.col("line").alias("at"), F.lit(-1).alias("inside")).distinct()
    between = (F.col("method_id") == F.col("m")) & (F.col("at") > F.col("a")) & (F.col("at") < F.col("b")) & (F.col("inside") <= F.col("a"))
    return pairs.join(r.unionByName(ends), between, "left_anti")


def null_checks(g: Graph) -> DataFrame:
    """(method_id, ptr, line) of IF conditions that compare a name with null or test it alone or negated, also inside and / or."""
    c = F.regexp_replace("condition", _NULL, "NULL")
    parts = g.control.where("type = 'IF'").select("method_id", "line", F.explode(F.split(c, r"&&|\|\|")).alias("c"))
    parts = parts.withColumn("c", F.regexp_replace("c", r"\A[(\s]+|[)\s]+\z", ""))
    name = r"([A-Za-z_]\w*)"
    shapes = (rf"{name}\s*[!=]=\s*(?:NULL|0)", rf"(?:NULL|0)\s*[!=]=\s*{name}", rf"!\s*\(?{name}", name)
    ptr = F.coalesce(*(F.when(P.full_match(F.col("c"), p), F.regexp_extract("c", rf"\A{p}\z", 1)) for p in shapes))
    return parts.select("method_id", ptr.alias("ptr"), "line").where("ptr IS NOT NULL").distinct()


def allocations(g: Graph, names: list[str]) -> DataFrame:
    """Allocator calls with the name assigned on their line: id, method_id, line, ptr; the first assignment by id."""
    c = g.call.where(P.any_of(F.col("name"), names)).select("id", "method_id", "line", "name")
    a = g.assignment.select("method_id", "line", F.col("id").alias("assign_id"), F.col("target").alias("ptr"), "source")
    hit = c.join(a, ["method_id", "line"]).where(F.col("source").contains(F.concat("name", F.lit("("))))
    hit = hit.withColumn("r", F.row_number().over(W.partitionBy("id").orderBy("assign_id"))).where("r = 1")
    return hit.where(P.trackable(F.col("ptr")) & ~F.col("ptr").rlike(r"\A[*&]")).select("id", "method_id", "line", "name", "ptr")


def free_sites(g: Graph) -> DataFrame:
    """The first free of each pointer in a method: id, method_id, line, ptr."""
    f = first_arguments(g, ["free", "cfree"]).where(P.trackable(F.col("arg"))).withColumnRenamed("arg", "ptr")
    return f.withColumn("r", F.row_number().over(W.partitionBy("method_id", "ptr").orderBy("line", "id"))).where("r = 1").select("id", "method_id", "line", "ptr")


def later_uses(g: Graph, sites: DataFrame, same_line: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Calls after a site (by line, where ``same_line`` holds within a line by id) with an argument that uses its pointer: site, method_id, ptr, a, b, call_id."""
    a = g.argument.select(F.col("method_id").alias("m"), "call_id", "code", F.col("line").alias("b"))
    s = sites.select(F.col("id").alias("site"), "method_id", "ptr", F.col("line").alias("a"), *keep)
    later = F.col("b") > F.col("a")
    if same_line is not None:
        later = later | (F.col("b") == F.col("a")) & (F.col("call_id") > F.col("site")) & same_line
    return s.join(a, (F.col("method_id") == F.col("m")) & later & P.pointer_use(F.col("code"), F.col("ptr"))).select("site", "method_id", "ptr", "a", "b", "call_id", *keep).distinct()


@detector("use_after_free", "CWE-416")
def use_after_free(g: Graph) -> DataFrame:
    """Uses of a freed pointer, or of an alias taken before the free or after it: (site, method_id, line, ptr, via, uses).

    An alias taken after the free counts from its own line on; ``line`` is then that line.
    """
    frees = g.call.where(P.any_of(F.col("name"), ["free", "cfree"])).select(F.col("id").alias("call_id"))
    sites = cut(free_sites(g))
    copies = g.assignment.where(P.trackable(F.col("target"))).select("method_id", F.col("line").alias("at"), F.col("target").alias("other"), "source")
    met = sites.join(copies, "method_id").where("other <> ptr AND (source = ptr OR source = concat('&', ptr) AND at < line)")
    aliases = met.where("at < line").select("id", "method_id", "line", F.col("other").alias("ptr")).distinct()
    after = aliases.join(copies, "method_id").where("other <> ptr AND source = ptr AND at > line").select("id", "method_id", F.col("line").alias("a"), "ptr", F.col("at").alias("b"), "other")
    after = after.unionByName(met.where("at > line").select("id", "method_id", F.col("line").alias("a"), "ptr", F.col("at").alias("b"), "other"))
    taken = without_return(g, without_reassignment(g, after)).select("id", "method_id", F.col("b").alias("line"), F.col("other").alias("ptr")).distinct()
    names = sites.withColumn("via", F.lit("direct")).unionByName(aliases.withColumn("via", F.lit("alias"))).unionByName(taken.withColumn("via", F.lit("post-free-alias")))
    uses = later_uses(g, names, F.col("via") != "post-free-alias", ("via",))
    uses = uses.join(frees, "call_id", "left_anti")
    uses = without_exclusive(g, without_return(g, without_reassignment(g, uses)))
    return uses.groupBy("site", "method_id", "ptr", "via", F.col("a").alias("line")).agg(F.countDistinct("b").alias("uses"), F.min("b").alias("first_use"))


@detector("double_free", "CWE-415")
def double_free(g: Graph) -> DataFrame:
    """First later free of the same pointer, or of an alias from before: (site, method_id, ptr, via, line, second)."""
    f = first_arguments(g, ["free", "cfree"]).where(P.trackable(F.col("arg")))
    x = f.select(F.col("id").alias("site"), "method_id", F.col("arg").alias("ptr"), F.col("line").alias("a"))
    y = f.select("method_id", F.col("arg").alias("other"), F.col("line").alias("b"), F.col("id").alias("again"))
    later = "(b > a OR b = a AND again > site)"
    same = x.join(y, "method_id").where(later + " AND other = ptr").withColumn("via", F.lit("same-ptr"))
    z = g.assignment.where(P.trackable(F.col("target")) & P.trackable(F.col("source")))
    ways = z.select("method_id", F.col("line").alias("at"), F.col("source").alias("ptr"), F.col("target").alias("other")).unionByName(z.select("method_id", F.col("line").alias("at"), F.col("target").alias("ptr"), F.col("source").alias("other")))
    alias = x.join(ways, ["method_id", "ptr"]).where("at < a AND other <> ptr").join(y, ["method_id", "other"]).where(later).withColumn("via", F.lit("alias"))
    columns = ["site", "method_id", "ptr", "via", "a", "b"]
    pairs = same.select(columns).unionByName(alias.select(columns)).distinct()
    pairs = without_exclusive(g, without_return(g, without_reassignment(g, pairs)))
    return pairs.groupBy("site", "method_id", "ptr", "via", F.col("a").alias("line")).agg(F.min("b").alias("second"))


@detector("null_deref", "CWE-476")
def null_deref(g: Graph) -> DataFrame:
    """Unchecked uses of an allocator's result: (site, method_id, ptr, line, uses)."""
    uses = later_uses(g, allocations(g, dicts.ALLOCATORS))
    exempt = g.call.where(P.any_of(F.col("name"), dicts.DEREF_EXEMPT)).select(F.col("id").alias("call_id"))
    uses = without_exclusive(g, without_exit(g, without_reassignment(g, uses.join(exempt, "call_id", "left_anti"))))
    n = null_checks(g).select(F.col("method_id").alias("m"), F.col("ptr").alias("p"), F.col("line").alias("at"))
    uses = uses.join(n, (F.col("method_id") == F.col("m")) & (F.col("ptr") == F.col("p")) & (F.col("at") > F.col("a")) & (F.col("at") <= F.col("b")), "left_anti")
    return uses.groupBy("site", "method_id", "ptr", F.col("a").alias("line")).agg(F.countDistinct("b").alias("uses"))


def _sizes(g: Graph) -> DataFrame:
    """Allocations with the expression of their size: id, method_id, file, line, root_ord."""
    return g.call.where(P.any_of(F.col("name"), list(dicts.OVERFLOW_SIZE))).select("id", "method_id", "file", "line", _number(dicts.OVERFLOW_SIZE)[F.col("name")].alias("root_ord"))


#: Tells expressions apart inside methods.
_ROOT = ["method_id", *trees.ROOT]


def _trees(g: Graph, of: str, roots: DataFrame) -> DataFrame:
    """The syntax trees of some expressions alone (method_id, root_id, root_ord), stored once, dealt by method."""
    return dealt(g.expressions(of, roots), "method_id")


def _last_products(g: Graph, last: DataFrame) -> DataFrame:
    """Uses (method_id, assign_id, and others) with the HIGH arithmetic in what they were last assigned."""
    sources = last.select("method_id", F.col("assign_id").alias("root_id"), F.lit(0).alias("root_ord"))
    high = trees.risky_arithmetic(_trees(g, "assignment", sources), _ROOT).where("risk = 'HIGH'").drop("root_ord")
    return last.join(high.withColumnRenamed("root_id", "assign_id"), ["method_id", "assign_id"])


def last_before(g: Graph, uses: DataFrame, keys: list[str]) -> DataFrame:
    """Uses (column method_id, name, line) with the id of the last assignment to the name on a line before (assign_id)."""
    a = g.assignment.select("method_id", F.col("target").alias("name"), F.col("line").alias("at"), F.col("id").alias("assign_id"))
    hit = uses.join(a, ["method_id", "name"]).where("at > 0 AND at < line")
    return hit.groupBy(*keys).agg(F.max(F.struct("at", "assign_id")).alias("x")).select(*keys, F.col("x.assign_id"))


def unguarded(g: Graph, sites: DataFrame) -> DataFrame:
    """Sites (method_id, line, names) that no condition of their method up to the line clears.

    It clears if it names a limit or a checked operation, or divides and has one of the names.
    """
    c = g.control.where("type = 'IF'").select(F.col("method_id").alias("m"), F.col("line").alias("g0"), "condition")
    condition = F.col("condition")
    clear = condition.contains("__builtin_") & condition.contains("overflow")
    for word in dicts.OVERFLOW_GUARDS:
        clear = clear | condition.contains(word)
    # those that can clear are few: found by one pattern, before rows meet
    c = c.where(condition.rlike("|".join(["/", "overflow", *dicts.OVERFLOW_GUARDS])))
    clear = clear | condition.contains("/") & F.exists("names", lambda n: P.has_words(condition, n))
    return sites.join(c, (F.col("method_id") == F.col("m")) & (F.col("g0") > 0) & (F.col("g0") <= F.col("line")) & (F.size("names") > 0) & clear, "left_anti")


@detector("integer_overflow_sizes", "CWE-190")
def integer_overflow_sizes(g: Graph) -> DataFrame:
    """Allocation sizes by arithmetic that may overflow, one finding for a line of a method: id, file, line, method_id, arithmetic, op, risk, issue_type, size.

    The arithmetic is in the size itself (``alloc_arithmetic``), or a product or shift in what a
    name in the size was last assigned before (``alloc_indirect_arithmetic``, ``size``: that name).
    The first kind found counts: direct HIGH, direct MEDIUM, indirect.
    """
    sizes = dealt(_sizes(g).withColumn("root_id", F.col("id")), "method_id")
    ast = _trees(g, "argument", sizes.select(_ROOT))
    columns = ["id", "file", "line", "method_id", "arithmetic", "op", "risk", "names", "phase", "size", "place"]
    direct = sizes.join(trees.risky_arithmetic(ast, _ROOT), _ROOT).withColumns(
        {"phase": F.when(F.col("risk") == "HIGH", 1).otherwise(2), "size": F.lit(None).cast("string"), "place": F.lit(0)}
    )
    names = ast.where("kind = 'IDENTIFIER'").groupBy(*_ROOT, "name").agg(F.min("pre").alias("place"))
    keys = ["id", "method_id", "file", "line", "name", "place"]
    last = dealt(last_before(g, sizes.join(names, _ROOT).select(keys), keys), "method_id")
    indirect = _last_products(g, last).withColumn("phase", F.lit(3)).withColumnRenamed("name", "size")
    found = unguarded(g, direct.select(columns).unionByName(indirect.select(columns)))
    first = found.groupBy("file", "method_id", "line").agg(F.min(F.struct("id", "phase", "place", "arithmetic", "op", "risk", "size")).alias("x"))
    kind = F.when(F.col("x.phase") == 3, "alloc_indirect_arithmetic").otherwise("alloc_arithmetic")
    return first.select("x.id", "file", "line", "method_id", "x.arithmetic", "x.op", "x.risk", kind.alias("issue_type"), "x.size")


@detector("integer_overflow", "CWE-190")
def integer_overflow(g: Graph) -> DataFrame:
    """The findings by what a name of the size was assigned: (id, method_id, line, size, arithmetic)."""
    return integer_overflow_sizes(g).where("issue_type = 'alloc_indirect_arithmetic'").select("id", "method_id", "line", "size", "arithmetic")


@detector("integer_overflow_direct", "CWE-190")
def integer_overflow_direct(g: Graph) -> DataFrame:
    """The findings in the size itself: (id, method_id, line, arithmetic, op, risk)."""
    return integer_overflow_sizes(g).where("issue_type = 'alloc_arithmetic'").select("id", "method_id", "line", "arithmetic", "op", "risk")


@detector("format_string", "CWE-134")
def format_string(g: Graph) -> DataFrame:
    """Format arguments that are no literal; HIGH if assigned before from external input."""
    order = F.create_map(*(F.lit(x) for kv in dicts.FORMAT_ARGUMENT.items() for x in kv))
    c = g.call.where(P.any_of(F.col("name"), list(dicts.FORMAT_ARGUMENT))).select("id", "method_id", "name", "line", "file", order[F.col("name")].alias("arg_index"))
    a = g.argument.select(F.col("call_id").alias("id"), "arg_index", "kind", F.col("code").alias("format"))
    open_ = c.join(a, ["id", "arg_index"]).where((F.col("kind") != "LITERAL") & ~F.col("format").rlike(r'\A(u8|[LuU])?"'))
    tainted = g.assignment.where(F.col("source").rlike(rf"\b({'|'.join(dicts.FORMAT_TAINT)})\(")).groupBy(F.col("method_id").alias("m"), F.col("target")).agg(F.min("line").alias("from"))
    hit = open_.join(tainted, (F.col("method_id") == F.col("m")) & (F.col("format") == F.col("target")) & (F.col("kind") == "IDENTIFIER") & (F.col("from") < F.col("line")), "left")
    return hit.select("id", "name", "file", "line", "format", F.when(F.col("from").isNotNull(), "HIGH").otherwise("MEDIUM").alias("confidence"))


# Spellings of the null constant.
_NULL = r"(?:<unknown>\s*)?(?:\(?\(void ?\*\)0\)?|\bnullptr\b|\bNULL\b)"


def _number(table: dict[str, int]) -> Column:
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))


def _writes(g: Graph, table: dict[str, tuple[int, int]]) -> DataFrame:
    """Buffer writes: id, method_id, name, b (line), dst, size (null if unbounded)."""
    place = {i: F.create_map(*(F.lit(x) for k, v in table.items() for x in (k, v[i]))) for i in (0, 1)}
    c = g.call.where(P.any_of(F.col("name"), list(table))).select("id", "method_id", "name", F.col("line").alias("b"), place[0][F.col("name")].alias("di"), place[1][F.col("name")].alias("si"))
    d = g.argument.select(F.col("call_id").alias("id"), "method_id", F.col("arg_index").alias("di"), F.col("code").alias("dst"))
    s = g.argument.select(F.col("call_id").alias("id"), "method_id", F.col("arg_index").alias("si"), F.col("code").alias("size"))
    return c.join(d, ["method_id", "id", "di"]).join(s, ["method_id", "id", "si"], "left").select("id", "method_id", "name", "b", "dst", "size")


@detector("heap_overflow", "CWE-122")
def heap_overflow(g: Graph) -> DataFrame:
    """Writes into an allocation that are unbounded or larger than it: (site, method_id, ptr, line, writes, confidence)."""
    alloc = allocations(g, list(dicts.SIZE_ARGUMENT)).withColumn("arg_index", _number(dicts.SIZE_ARGUMENT)[F.col("name")])
    size = g.argument.select(F.col("call_id").alias("id"), "method_id", "arg_index", F.col("code").alias("have"))
    alloc = alloc.join(size, ["method_id", "id", "arg_index"]).select(F.col("id").alias("site"), F.col("method_id"), "ptr", F.col("line").alias("a"), "have")
    w = _writes(g, dicts.HEAP_WRITES).withColumnRenamed("method_id", "wm").withColumnRenamed("size", "need").withColumnRenamed("id", "write")
    hit = alloc.join(w, (F.col("method_id") == F.col("wm")) & (F.col("b") > F.col("a")) & P.buffer_target(F.col("dst"), F.col("ptr")))
    hit = without_exclusive(g, without_reassignment(g, hit))
    have, need = P.parse_int_literal(F.col("have")), P.parse_int_literal(F.col("need"))
    c = g.control.where("type = 'IF' AND condition RLIKE '[<>]'").select(F.col("method_id").alias("m"), F.col("line").alias("at"), "condition")
    bound = (F.col("method_id") == F.col("m")) & (F.col("at") > F.col("a")) & (F.col("at") < F.col("b")) & P.has_words(F.col("condition"), F.col("need"))
    hit = hit.join(c, bound, "left_anti")
    bad = F.col("need").isNull() | F.when(have.isNotNull() & need.isNotNull(), need > have).otherwise(~P.has_words(F.col("have"), F.col("need")))
    return hit.where(bad).groupBy("site", "method_id", "ptr", F.col("a").alias("line")).agg(
        F.countDistinct("write").alias("writes"), F.when(F.count_if(F.col("name").isin("strcpy", "gets", "sprintf")) > 0, "HIGH").otherwise("MEDIUM").alias("confidence")
    )


@detector("stack_overflow", "CWE-121")
def stack_overflow(g: Graph) -> DataFrame:
    """Writes into a fixed-size local that are unbounded or larger than it: (id, method_id, name, have, writes, confidence).

    A size that is no number is fine if it names the array's own size or sizeof, or if a
    comparison between declaration and write has its first name; so is a write in another branch than the declaration's.
    """
    buf = g.local.withColumn("have", P.array_size(F.col("type_full_name"))).where("have IS NOT NULL").select("id", "method_id", "name", "have", F.col("line").alias("a"))
    w = _writes(g, dicts.STACK_WRITES).select(F.col("method_id").alias("wm"), F.col("name").alias("function"), F.col("id").alias("write"), "b", "dst", F.trim("size").alias("need"))
    hit = without_exclusive(g, buf.join(w, (F.col("method_id") == F.col("wm")) & P.buffer_target(F.col("dst"), F.col("name"))))
    number = F.when(P.full_match(F.col("need"), "-?[0-9]{1,18}"), F.col("need").try_cast("long"))
    own = F.col("need").contains("sizeof") | P.has_words(F.col("need"), F.col("have").cast("string"))
    c = g.control.where("type = 'IF' AND condition RLIKE '[<>]'").select(F.col("method_id").alias("m"), F.col("line").alias("at"), "condition")
    first = P.extract_variable(F.col("need"))
    bound = (F.col("method_id") == F.col("m")) & F.col("at").between(F.col("a"), F.col("b") - 1) & number.isNull() & (first != "") & P.has_words(F.col("condition"), first)
    hit = hit.join(c, bound, "left_anti")
    bad = F.col("need").isNull() | F.when(number.isNotNull(), number > F.col("have")).otherwise(~own)
    return hit.where(bad).groupBy("id", "method_id", "name", "have").agg(
        F.countDistinct("write").alias("writes"), F.when(F.count_if(F.col("function").isin("strcpy", "gets", "sprintf", "vsprintf", "strcat")) > 0, "HIGH").otherwise("MEDIUM").alias("confidence")
    )


@detector("toctou", "CWE-367")
def toctou(g: Graph) -> DataFrame:
    """A path checked and used later in the same method: the same declaration, or the same text."""
    key = F.when(F.col("decl_id").isNotNull(), F.concat(F.lit("#"), F.col("decl_id").cast("string"))).otherwise(F.col("arg"))
    x = first_arguments(g, dicts.PATH_CHECKS).select("method_id", key.alias("path"), F.col("name").alias("check"), F.col("line").alias("check_line"))
    y = first_arguments(g, dicts.PATH_USES).select("method_id", key.alias("path"), F.col("name").alias("use"), F.col("line").alias("use_line"))
    return x.join(y, ["method_id", "path"]).where("check_line > 0 AND check_line < use_line").distinct()


@detector("uninitialized_read", "CWE-457")
def uninitialized_read(g: Graph) -> DataFrame:
    """Reads of a scalar local before its first assignment or address-of."""
    own = g.local.where(~F.col("type_full_name").contains("[")).select("id", "method_id", "name")
    a = g.assignment
    init = a.select("method_id", F.col("target").alias("name"), "line").unionByName(a.where(F.col("source").startswith("&")).select("method_id", F.expr("substring(source, 2)").alias("name"), "line"))
    init = init.unionByName(g.argument.where(F.col("code").startswith("&")).select("method_id", F.expr("substring(code, 2)").alias("name"), "line"))
    init = init.groupBy("method_id", "name").agg(F.min("line").alias("init"))
    reads = g.argument.where("kind = 'IDENTIFIER' AND line > 0").select("method_id", F.col("code").alias("name"), "line")
    out = own.join(init, ["method_id", "name"], "left").join(reads, ["method_id", "name"]).where("init IS NULL OR line < init")
    return out.select("id", "method_id", "name", "line").distinct()


@detector("bounds_check", "CWE-119")
def bounds_checks(g: Graph) -> DataFrame:
    """Index operations and the comparisons that control them: (id, index, guards, guarded)."""
    index = first_arguments(g, ["<operator>.indirectIndexAccess"], 2).select("id", "method_id", "line", F.col("arg").alias("index")).withColumn("var", P.extract_variable(F.col("index")))
    guard = g.cdg.join(g.control.select(F.col("id").alias("control_id"), "condition"), "control_id").where(F.col("condition").rlike("[<>]|[!=]=")).select(F.col("call_id").alias("id"), "condition")
    hit = index.join(guard, "id", "left").groupBy("id", "method_id", "line", "index").agg(F.count_if(P.has_words(F.col("condition"), F.col("var"))).alias("guards"))
    return hit.withColumn("guarded", F.col("guards") > 0)


def latest_assignment(g: Graph, uses: DataFrame) -> DataFrame:
    """The last assignment before each use (columns use, method_id, name, line), as of its line."""
    a = g.assignment.select("method_id", F.col("target").alias("name"), F.col("line").alias("at"), F.col("id").alias("assign_id"), "source")
    hit = uses.join(a, ["method_id", "name"]).where("at < line")
    last = hit.groupBy("use", "name", "line").agg(F.max(F.struct("at", "assign_id", "source")).alias("x"))
    return last.select("use", "name", "line", F.col("x.at").alias("assigned"), F.col("x.source").alias("source"))


@detector("double_free_between_functions", "CWE-415")
def double_free_between(g: Graph) -> DataFrame:
    """A pointer freed, then passed to a function that frees the parameter at that place."""
    freed = first_arguments(g, ["free", "cfree"]).where("kind = 'IDENTIFIER'").select(F.col("id").alias("site"), "method_id", F.col("arg").alias("ptr"), F.col("line").alias("a"))
    inside = first_arguments(g, ["free", "cfree"]).select(F.col("method_id").alias("callee_id"), F.col("arg").alias("param")).distinct()
    frees = g.parameter.select(F.col("method_id").alias("callee_id"), F.col("name").alias("param"), F.col("ord").alias("arg_index")).join(inside, ["callee_id", "param"])
    passed = g.call.where("callee_id IS NOT NULL").select(F.col("id").alias("call_id"), "callee_id").join(g.argument.select("call_id", "method_id", "arg_index", F.col("code").alias("ptr"), F.col("line").alias("b")), "call_id")
    hit = freed.join(passed.join(frees, ["callee_id", "arg_index"]), ["method_id", "ptr"]).where("b > a")
    return hit.select("site", "method_id", "ptr", F.col("a").alias("line"), F.col("b").alias("second"), "callee_id").distinct()


@detector("index_arithmetic", "CWE-190")
def index_arithmetic(g: Graph) -> DataFrame:
    """Indices by a name without a condition before that bounds it in the method."""
    index = first_arguments(g, ["<operator>.indirectIndexAccess"], 2).where("kind = 'IDENTIFIER'").select("id", "method_id", "line", F.col("arg").alias("index"))
    c = g.control.where(F.col("condition").rlike("[<>]")).select(F.col("method_id").alias("m"), F.col("line").alias("at"), "condition")
    bound = (F.col("method_id") == F.col("m")) & (F.col("at") <= F.col("line")) & F.concat(F.lit(" "), "condition", F.lit(" ")).contains(F.concat(F.lit(" "), "index", F.lit(" ")))
    return index.join(c, bound, "left_anti")


def _handed_on(g: Graph, sites: DataFrame) -> DataFrame:
    """Sites (site, method_id, ptr, a) whose pointer is later passed to a method: with b, callee_id, param.

    The three filters inside the caller hold here, too.
    """
    p = passed(g).where("kind <> 'LITERAL'").select("method_id", F.trim("code").alias("ptr"), F.col("line").alias("b"), "callee_id", "param")
    hit = sites.join(p, ["method_id", "ptr"]).where("b > a AND callee_id <> method_id")
    return without_exclusive(g, without_return(g, without_reassignment(g, hit)))


def _used_inside(g: Graph, handed: DataFrame, exempt: list[str]) -> DataFrame:
    """Handed-on pointers with each use of the parameter in the method called: use_line, call_id."""
    a = g.argument.select(F.col("method_id").alias("callee_id"), "call_id", "code", F.col("line").alias("use_line"))
    hit = handed.join(a, "callee_id").where(P.pointer_use(F.col("code"), F.col("param")))
    return hit.join(g.call.where(P.any_of(F.col("name"), exempt)).select(F.col("method_id").alias("callee_id"), F.col("id").alias("call_id")), ["callee_id", "call_id"], "left_anti")


@detector("use_after_free_between_functions", "CWE-416")
def use_after_free_between(g: Graph) -> DataFrame:
    """A freed pointer passed to a method that uses the parameter at that place: (site, method_id, ptr, line, callee_id, use_line)."""
    sites = free_sites(g).select(F.col("id").alias("site"), "method_id", "ptr", F.col("line").alias("a"))
    hit = _used_inside(g, _handed_on(g, sites), ["free", "cfree"])
    return hit.select("site", "method_id", "ptr", F.col("a").alias("line"), "callee_id", "use_line").distinct()


@detector("null_deref_between_functions", "CWE-476")
def null_deref_between(g: Graph) -> DataFrame:
    """An allocator's result passed on unchecked to a method that uses the parameter without a check before."""
    sites = allocations(g, dicts.ALLOCATORS).select(F.col("id").alias("site"), "method_id", "ptr", F.col("line").alias("a"))
    checks = null_checks(g)
    here = checks.select("method_id", "ptr", F.col("line").alias("at"))
    there = checks.select(F.col("method_id").alias("callee_id"), F.col("ptr").alias("param"), F.col("line").alias("at"))
    handed = _handed_on(g, sites).alias("h")
    handed = handed.join(here.alias("n"), F.expr("h.method_id = n.method_id AND h.ptr = n.ptr AND n.at > h.a AND n.at <= h.b"), "left_anti")
    hit = _used_inside(g, handed, dicts.DEREF_EXEMPT).alias("h")
    hit = hit.join(there.alias("n"), F.expr("h.callee_id = n.callee_id AND h.param = n.param AND n.at <= h.use_line"), "left_anti")
    return hit.select("site", "method_id", "ptr", F.col("a").alias("line"), "callee_id", "use_line").distinct()


@detector("integer_overflow_between_functions", "CWE-190")
def integer_overflow_between(g: Graph) -> DataFrame:
    """A product or shift, or a name last assigned one, passed to a method that allocates by the parameter: (id, method_id, line, arithmetic, callee_id, allocation)."""
    sizes = _sizes(g).select("method_id", F.col("id").alias("root_id"), "root_ord")
    plain = g.expressions("argument", sizes).where("kind = 'IDENTIFIER' AND pre = 0").select(F.col("method_id").alias("callee_id"), F.col("name").alias("param"), F.col("root_id").alias("allocation"))
    p = g.parameter.select(F.col("method_id").alias("callee_id"), F.col("ord").alias("root_ord"), F.col("name").alias("param"))
    by = dealt(plain.join(p, ["callee_id", "param"]).select("callee_id", "root_ord", "allocation"), "callee_id")
    # only calls that reach an allocation: of these alone are trees made, of the argument it takes
    into = dealt(callees(g, by).where("callee_id <> method_id").withColumnRenamed("call_id", "root_id"), "method_id")
    ast = _trees(g, "argument", into.select(_ROOT))
    direct = into.join(trees.risky_arithmetic(ast, _ROOT).where("risk = 'HIGH'"), _ROOT)
    used = into.select(*_ROOT, "line").distinct().join(ast.where("kind = 'IDENTIFIER' AND pre = 0").select(*_ROOT, "name"), _ROOT)
    last = dealt(last_before(g, used, [*_ROOT, "line", "name"]), "method_id")
    indirect = _last_products(g, last).join(into, [*_ROOT, "line"])
    columns = [F.col("root_id").alias("id"), "method_id", "line", "arithmetic", "callee_id", "allocation", "names"]
    return unguarded(g, direct.select(columns).unionByName(indirect.select(columns))).drop("names").distinct()


def _effects(g: Graph, known: DataFrame, effect: str) -> DataFrame:
    """Places where a name's object meets an effect: call_id, method_id, line, ptr, hops (calls to where it happens; 0 is here)."""
    handed = dataflow.handed(g)
    inner = known.where(F.col("effect") == effect).select(F.col("method_id").alias("callee_id"), "param", (F.col("hops") + 1).alias("hops"))
    far = handed.join(inner, ["callee_id", "param"]).groupBy("call_id", "method_id", "line", "ptr").agg(F.min("hops").alias("hops"))
    if effect == "frees":
        here = first_arguments(g, ["free", "cfree"]).where(P.trackable(F.col("arg"))).select(F.col("id").alias("call_id"), "method_id", "line", F.col("arg").alias("ptr"), F.lit(0).alias("hops"))
        return here.unionByName(far)
    return far


@detector("use_after_free_deep", "CWE-416")
def use_after_free_deep(g: Graph) -> DataFrame:
    """Frees and later uses of a name of which one at least is in a method called, at any depth: (method_id, ptr, line, use_line, free_hops, use_hops).

    Methods are known by their summaries, so calls of any depth and recursion need no walk here;
    the three filters inside the caller hold.
    """
    known = dataflow.summaries(g)
    freed = _effects(g, known, "frees").select(F.col("call_id").alias("site"), "method_id", "ptr", F.col("line").alias("a"), F.col("hops").alias("free_hops"))
    far = _effects(g, known, "uses").select("call_id", "method_id", "ptr", F.col("line").alias("b"), F.col("hops").alias("use_hops"))
    hit = freed.join(far, ["method_id", "ptr"]).where("b > a")
    # uses here count where the free is in a method called
    a = g.argument.select(F.col("method_id").alias("m"), "call_id", "code", F.col("line").alias("b"))
    quiet = g.call.where(P.any_of(F.col("name"), ["free", "cfree"]) | F.col("callee_id").isNotNull()).select(F.col("id").alias("call_id"))
    here = freed.where("free_hops > 0").join(a, (F.col("method_id") == F.col("m")) & (F.col("b") > F.col("a")) & P.pointer_use(F.col("code"), F.col("ptr"))).join(quiet, "call_id", "left_anti")
    columns = ["method_id", "ptr", "a", "b", "free_hops", "use_hops"]
    both = cut(hit.select(columns).unionByName(here.withColumn("use_hops", F.lit(0)).select(columns)).distinct())
    both = without_exclusive(g, without_return(g, without_reassignment(g, both)))
    return both.groupBy("method_id", "ptr", F.col("a").alias("line"), F.col("b").alias("use_line")).agg(F.min("free_hops").alias("free_hops"), F.min("use_hops").alias("use_hops"))


@detector("double_free_deep", "CWE-415")
def double_free_deep(g: Graph) -> DataFrame:
    """Two frees of a name of which one at least is in a method called, at any depth: (method_id, ptr, line, second, hops)."""
    freed = cut(_effects(g, dataflow.summaries(g), "frees"))
    x = freed.select("method_id", "ptr", F.col("line").alias("a"), F.col("hops").alias("first_hops"))
    y = freed.select("method_id", "ptr", F.col("line").alias("b"), F.col("hops").alias("second_hops"))
    hit = x.join(y, ["method_id", "ptr"]).where("b > a AND first_hops + second_hops > 0").withColumn("hops", F.col("first_hops") + F.col("second_hops"))
    hit = without_exclusive(g, without_return(g, without_reassignment(g, hit)))
    return hit.groupBy("method_id", "ptr", F.col("a").alias("line"), F.col("b").alias("second")).agg(F.min("hops").alias("hops"))


@detector("null_deref_deep", "CWE-476")
def null_deref_deep(g: Graph) -> DataFrame:
    """An allocator's result passed on unchecked to a method that uses it, itself or by methods it calls: (method_id, ptr, line, use_line, hops).

    A method that checks the parameter anywhere before is not looked into: ``null_deref_between_functions`` has that order for one call.
    """
    far = _effects(g, dataflow.summaries(g), "uses").select("method_id", "ptr", F.col("line").alias("b"), "hops")
    sites = allocations(g, dicts.ALLOCATORS).select("method_id", "ptr", F.col("line").alias("a"))
    hit = without_exclusive(g, without_exit(g, without_reassignment(g, sites.join(far, ["method_id", "ptr"]).where("b > a"))))
    n = null_checks(g).select(F.col("method_id").alias("m"), F.col("ptr").alias("p"), F.col("line").alias("at"))
    hit = hit.join(n, (F.col("method_id") == F.col("m")) & (F.col("ptr") == F.col("p")) & (F.col("at") > F.col("a")) & (F.col("at") <= F.col("b")), "left_anti")
    return hit.groupBy("method_id", "ptr", F.col("a").alias("line"), F.col("b").alias("use_line")).agg(F.min("hops").alias("hops"))


def worst_first(findings: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Findings numbered HIGH first, then by ``order`` (which ends in a unique column): column issue."""
    rank = F.when(F.col("confidence") == "HIGH", 0).otherwise(1)
    place = [rank, *map(F.col, order)]
    if not limit:
        return numbered(findings, place)
    return findings.orderBy(*place).limit(limit).withColumn("issue", F.row_number().over(W.orderBy(*place)))
