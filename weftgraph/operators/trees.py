"""Syntax trees of expressions, as rows with nested intervals.

An expression is an argument (root_id: its call, root_ord: its place) or the source of an
assignment (root_id: the assignment, root_ord 0).  Its nodes are numbered in pre-order from 0;
``post`` is the last number below a node, so "below" is a range of numbers within the
expression, "child" an equal ``parent``, and "outermost" the least number.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dicts
from ..functions import predicates as P
from ..graph import Graph
from .iterate import dealt

# Names of operators, by how closely they bind.
_LEVELS = (
    {"=": "assignment", "+=": "assignmentPlus", "-=": "assignmentMinus", "*=": "assignmentMultiplication"},
    {"?": "conditional"},
    {"||": "logicalOr"},
    {"&&": "logicalAnd"},
    {"|": "or"},
    {"^": "xor"},
    {"&": "and"},
    {"==": "equals", "!=": "notEquals"},
    {"<": "lessThan", ">": "greaterThan", "<=": "lessEqualsThan", ">=": "greaterEqualsThan"},
    {"<<": "shiftLeft", ">>": "arithmeticShiftRight"},
    {"+": "addition", "-": "subtraction"},
    {"*": "multiplication", "/": "division", "%": "modulo"},
)
_PREFIX = {"-": "minus", "+": "plus", "!": "logicalNot", "~": "not", "*": "indirection", "&": "addressOf", "++": "preIncrement", "--": "preDecrement"}
_BIND = {op: (level, f"<operator>.{name}") for level, names in enumerate(_LEVELS) for op, name in names.items()}

_TOKEN = re.compile(r"""\s+|(?:u8|[LuU])?"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'|[A-Za-z_]\w*|\d[\w.]*|->|\+\+|--|<<|>>|[-+*/%&|^=!<>]=|&&|\|\||.""", re.S)
_WORD = re.compile(r"[A-Za-z_]\w*\Z")
_TYPE = re.compile(r"(?:(?:const|struct|unsigned|signed|int|char|long|short|float|double|void|bool|size_t|ssize_t|u?int\d+_t)\b\s*|\w+\s*(?=\*))+\**\s*\Z")

NODES = "array<struct<parent:int,ord:int,kind:string,name:string,code:string,post:int>>"


class _Expression:
    """Reads one expression; ``nodes`` are [parent, ord, kind, name, code, post] in pre-order."""

    def __init__(self, code: str):
        self.code, self.at = code, 0
        self.tokens = [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(code) if not m[0].isspace()]

    def peek(self, k: int = 0) -> str:
        return self.tokens[self.at + k][0] if self.at + k < len(self.tokens) else ""

    def node(self, first: int, kind: str, name: str, children: tuple = ()) -> tuple:
        return kind, name, self.code[self.tokens[first][1] : self.tokens[self.at - 1][2]], children

    def binary(self, least: int = 0) -> tuple:
        first, left = self.at, self.unary()
        while self.peek() in _BIND and _BIND[self.peek()][0] >= least:
            level, name = _BIND[self.peek()]
            self.at += 1
            if level == 1:
                yes = self.binary(0)
                self.at += self.peek() == ":"
                left = self.node(first, "CALL", name, (left, yes, self.binary(1)))
            else:
                left = self.node(first, "CALL", name, (left, self.binary(level + (level > 0))))
        return left

    def unary(self) -> tuple:
        first, token = self.at, self.peek()
        if token in _PREFIX:
            self.at += 1
            return self.node(first, "CALL", f"<operator>.{_PREFIX[token]}", (self.unary(),))
        if token == "sizeof":
            self.at += 1
            if self.peek() == "(":
                self.at = self.close() + 1
            else:
                self.unary()
            return self.node(first, "CALL", "<operator>.sizeOf")
        if token == "(" and self.cast():
            self.at = self.close() + 1
            return self.node(first, "CALL", "<operator>.cast", (self.unary(),))
        return self.postfix()

    def close(self) -> int:
        """The token that closes the next open bracket."""
        k = next(i for i in range(self.at, len(self.tokens)) if self.tokens[i][0] == "(")
        depth = 0
        for i in range(k, len(self.tokens)):
            depth += (self.tokens[i][0] == "(") - (self.tokens[i][0] == ")")
            if not depth:
                return i
        raise ValueError("open bracket")

    def cast(self) -> bool:
        end = self.close()
        after = self.tokens[end + 1][0] if end + 1 < len(self.tokens) else ""
        return bool(after == "(" or after[:1].isalnum() or after[:1] in "_\"'") and bool(_TYPE.match(self.code[self.tokens[self.at][2] : self.tokens[end][1]]))

    def arguments(self, end: str) -> tuple:
        out = []
        while self.peek() and self.peek() != end:
            out.append(self.binary())
            self.at += self.peek() == ","
        if self.peek() != end:
            raise ValueError("open bracket")
        self.at += 1
        return tuple(out)

    def postfix(self) -> tuple:
        first, token = self.at, self.peek()
        self.at += 1
        if token == "(":
            left = self.binary()
            if self.peek() != ")":
                raise ValueError("open bracket")
            self.at += 1
        elif _WORD.match(token):
            if self.peek() == "(":
                self.at += 1
                left = self.node(first, "CALL", token, self.arguments(")"))
            else:
                left = self.node(first, "IDENTIFIER", token)
        elif token[:1].isdigit() or token[-1:] in ("'", '"'):
            left = self.node(first, "LITERAL", token)
        else:
            raise ValueError(token)
        while self.peek() in ("[", "->", ".", "(", "++", "--"):
            op = self.peek()
            self.at += 1
            if op == "[":
                left = self.node(first, "CALL", "<operator>.indirectIndexAccess", (left, *self.arguments("]")))
            elif op == "(":
                left = self.node(first, "CALL", "<operator>.pointerCall", (left, *self.arguments(")")))
            elif op in ("++", "--"):
                left = self.node(first, "CALL", "<operator>.postIncrement" if op == "++" else "<operator>.postDecrement", (left,))
            else:
                field = self.at
                self.at += 1
                left = self.node(first, "CALL", "<operator>.indirectFieldAccess" if op == "->" else "<operator>.fieldAccess", (left, self.node(field, "FIELD", self.tokens[field][0])))
        return left


def parse(code: str | None) -> list[tuple] | None:
    """(parent, ord, kind, name, code, post) of the nodes in pre-order; one UNKNOWN node for what is no expression."""
    if code is None:
        return None
    reader = _Expression(code)
    try:
        root = reader.binary()
        if reader.at < len(reader.tokens):
            raise ValueError("more than one expression")
    except (ValueError, IndexError, StopIteration, RecursionError):
        root = ("UNKNOWN", "", code.strip(), ())
    out: list[list] = []

    def put(node: tuple, parent: int, ord_: int) -> None:
        here = len(out)
        out.append([parent, ord_, *node[:3], here])
        for i, child in enumerate(node[3], 1):
            put(child, here, i)
        out[here][5] = len(out) - 1

    put(root, -1, 1)
    return [tuple(x) for x in out]


def syntax(g: Graph) -> DataFrame:
    """The table ``ast`` out of the codes of arguments and of sources of assignments."""
    roots = g.argument.select("method_id", F.col("call_id").alias("root_id"), F.col("arg_index").alias("root_ord"), "line", "code")
    roots = roots.unionByName(g.assignment.select("method_id", F.col("id").alias("root_id"), F.lit(0).alias("root_ord"), "line", F.col("source").alias("code")))
    nodes = roots.select("method_id", "root_id", "root_ord", "line", F.posexplode(F.udf(parse, NODES, useArrow=True)("code")).alias("pre", "n"))
    return nodes.select("method_id", "root_id", "root_ord", "pre", "n.post", "n.parent", "n.ord", "n.kind", "n.name", "n.code", "line")


ROOT = ["root_id", "root_ord"]


def by_root(g: Graph) -> DataFrame:
    """The table ``ast`` dealt by root_id, made once for a graph: joins and groups by expression need no shuffle."""
    return g.once("ast by root", lambda: dealt(g.ast, "root_id"))


def below(nodes: DataFrame, ast: DataFrame, itself: bool = True, root: list[str] = ROOT) -> DataFrame:
    """Each node (root_id, root_ord, pre, post) with the nodes below it, as columns b_pre, b_parent, b_kind, b_name, b_code."""
    b = ast.select(*root, *(F.col(c).alias(f"b_{c}") for c in ("pre", "parent", "kind", "name", "code")))
    least = F.col("pre") if itself else F.col("pre") + 1
    return nodes.join(b, root).where(F.col("b_pre").between(least, F.col("post")))


def descendants(g: Graph) -> DataFrame:
    """What is below each expression: nodes, calls, identifiers, literals, depth-independent counts by kind, the distinct names."""
    ast = by_root(g)
    top = ast.where("pre = 0").select(*ROOT, "method_id", "pre", "post")
    kind = lambda k: F.count_if(F.col("b_kind") == k)
    return below(top, ast).groupBy(*ROOT, "method_id").agg(
        F.count("*").alias("nodes"), kind("CALL").alias("calls"), kind("IDENTIFIER").alias("identifiers"), kind("LITERAL").alias("literals"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("b_kind") == "IDENTIFIER", F.col("b_name")))), ",").alias("names"),
    )


def children(g: Graph) -> DataFrame:
    """Every inner node with its children in order: root_id, root_ord, pre, name, children, operands."""
    ast = by_root(g)
    c = ast.where("parent >= 0").groupBy(*ROOT, F.col("parent").alias("pre")).agg(F.sort_array(F.collect_list(F.struct("ord", "code"))).alias("x"))
    out = ast.select(*ROOT, "pre", "name").join(c, [*ROOT, "pre"])
    return out.select(*ROOT, "pre", "name", F.size("x").alias("children"), F.array_join(F.col("x.code"), " ; ").alias("operands"))


# Constants of sizes, and those too small to matter in a sum.
_CONSTANT = r"\A(-?\d+[UuLl]*|0[xX][0-9a-fA-F]+[UuLl]*|sizeof.*|'.')\z"


def _small(code: Column) -> Column:
    bare = F.regexp_replace(code, "[UuLl]+$", "")
    hexadecimal = F.when(bare.rlike(r"\A0[xX][0-9a-fA-F]{1,15}\z"), F.conv(F.substring(bare, 3, 20), 16, 10).cast("long"))
    octal = F.when(bare.rlike(r"\A0[0-7]{1,15}\z"), F.conv(bare, 8, 10).cast("long"))
    number = F.when(bare.rlike(r"\A-?\d{1,18}\z"), bare.try_cast("long"))
    return bare.startswith("sizeof") | bare.rlike(r"\A'.'\z") | F.coalesce(F.coalesce(hexadecimal, octal, number) <= 4096, F.lit(False))


def risky_arithmetic(ast: DataFrame, root: list[str] = ROOT) -> DataFrame:
    """The outermost arithmetic of each expression and risk that may overflow: root_id, root_ord, risk, arithmetic, op, names.

    HIGH: a product or left shift with an operand that is no constant.  MEDIUM: a sum or
    difference of two such operands, or of one and a constant over 4096.  ``names``: the identifiers in it.
    ``root``: the columns that tell expressions apart; with method_id among them, trees dealt by method need no shuffle.
    """
    code = F.trim("b_code")
    fixed = F.coalesce(code.rlike(_CONSTANT), F.lit(False))
    ops = ast.where(P.any_of(F.col("name"), [*dicts.HIGH_RISK_OPERATORS, *dicts.MEDIUM_RISK_OPERATORS])).select(*root, "pre", "post", "name", F.col("code").alias("arithmetic"))
    seen = below(ops, ast, itself=False, root=root).groupBy(*root, "pre", "name", "arithmetic").agg(
        F.count_if(F.col("b_parent") == F.col("pre")).alias("n"),
        F.count_if((F.col("b_parent") == F.col("pre")) & ~fixed).alias("open"),
        F.count_if((F.col("b_parent") == F.col("pre")) & fixed & ~_small(code)).alias("large"),
        F.collect_set(F.when(F.col("b_kind") == "IDENTIFIER", F.col("b_name"))).alias("names"),
    )
    high = P.any_of(F.col("name"), list(dicts.HIGH_RISK_OPERATORS))
    seen = seen.withColumn("risk", F.when(high, "HIGH").otherwise("MEDIUM")).where("n >= 2 AND (risk = 'HIGH' AND open >= 1 OR risk = 'MEDIUM' AND (open >= 2 OR open = 1 AND large >= 1))")
    first = seen.groupBy(*root, "risk").agg(F.min(F.struct("pre", "arithmetic", "name", "names")).alias("x"))
    words = F.create_map(*(F.lit(x) for kv in (dicts.HIGH_RISK_OPERATORS | dicts.MEDIUM_RISK_OPERATORS).items() for x in kv))
    return first.select(*root, "risk", "x.arithmetic", words[F.col("x.name")].alias("op"), "x.names")
