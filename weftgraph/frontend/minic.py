"""A graph from C sources: a small statement parser that runs per file on the executors.

It reads functions, declarations, assignments, if/else, for, while, do, switch,
return and expression statements; preprocessor lines are skipped and unknown top-level text
is passed over.  The ``line`` of its rows is the statement's order in its method (so
several statements on one source line stay apart); ``place`` maps it to the source line.
Bodies of loops are laid out twice, so what one round does to the next is seen in order.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph import Graph
from ..schema import TABLES

_TOKEN = re.compile(r"""\s+|//[^\n]*|/\*.*?\*/|^[ \t]*\#[^\n]*|(?P<t>[A-Za-z_]\w*|\d[\w.]*|"(?:\\.|[^"\\])*"|'(?:\\.|[^'\\])*'|->|\+\+|--|<<=?|>>=?|[-+*/%&|^=!<>]=|&&|\|\||.)""", re.S | re.M)
_NAME = re.compile(r"[A-Za-z_]\w*\Z")
_KEYWORDS = {"if", "else", "for", "while", "do", "switch", "case", "default", "return", "break", "continue", "goto", "sizeof"}
_TYPES = {"int", "char", "long", "short", "unsigned", "signed", "float", "double", "void", "struct", "const", "static", "size_t", "ssize_t", "FILE", "uint8_t", "uint32_t", "uint64_t", "bool", "enum", "union"}


class File:
    """Parses one source text to rows of the graph tables."""

    def __init__(self, path: str, text: str):
        self.path, self.rows, self.n = path, [], 0
        self.base = zlib.crc32(path.encode()) << 24
        self.tokens, self.lines = [], []
        line = 1
        for m in _TOKEN.finditer(text):
            if m["t"]:
                self.tokens.append(m["t"])
                self.lines.append(line)
            line += m[0].count("\n")
        self.functions()

    def new_id(self) -> int:
        self.n += 1
        return self.base + self.n

    def emit(self, table: str, **row) -> None:
        self.rows.append((table, row))

    def close(self, i: int) -> int:
        """Index of the bracket that closes the one at i (or the last token)."""
        depth = 0
        for k in range(i, len(self.tokens)):
            if self.tokens[k] in "([{" and len(self.tokens[k]) == 1:
                depth += 1
            elif self.tokens[k] in ")]}" and len(self.tokens[k]) == 1:
                depth -= 1
                if not depth:
                    return k
        return len(self.tokens) - 1

    def functions(self) -> None:
        i = 0
        while i < len(self.tokens) - 1:
            if _NAME.match(self.tokens[i]) and self.tokens[i] not in _KEYWORDS and self.tokens[i + 1] == "(":
                end = self.close(i + 1)
                if end + 1 < len(self.tokens) and self.tokens[end + 1] == "{":
                    i = self.function(i, end)
                    continue
            i += 1

    def function(self, i: int, end: int) -> int:
        t = self.tokens
        self.method, self.order, self.depth_locals = self.new_id(), 1, {}
        begin = i
        while begin and t[begin - 1] not in (";", "}") and len(t[begin - 1]) >= 1:
            begin -= 1
        returns = self.code(begin, i)
        params = [p for p in self.split(i + 2, end) if p[0] < p[1]]
        for k, (a, b) in enumerate(params):
            names = [x for x in t[a:b] if _NAME.match(x)]
            if names and names != ["void"]:
                self.emit("parameter", id=self.new_id(), method_id=self.method, name=names[-1], type_full_name=self.code(a, b).rsplit(names[-1], 1)[0].strip(), ord=k + 1)
        stop = self.close(end + 1)
        self.mark(i)
        self.block(end + 2, stop)
        self.emit("method", id=self.method, name=t[i], full_name=t[i], signature=self.code(i + 1, end + 1), file=self.path, line=1, line_end=self.order, is_external=False, return_type=returns)
        return stop + 1

    def code(self, a: int, b: int) -> str:
        out = ""
        for x in self.tokens[a:b]:
            out += (" " if out and (out[-1].isalnum() or out[-1] == "_") and (x[0].isalnum() or x[0] == "_") else "") + x
        return out

    def spaced(self, a: int, b: int) -> str:
        """As ``code``, with blanks around comparisons."""
        return " ".join(re.sub(r"(==|!=|<=|>=|(?<!-)>(?!>)|(?<!<)<(?!<))", r" \1 ", self.code(a, b)).split())

    def split(self, a: int, b: int, by: str = ",") -> list[tuple[int, int]]:
        out, depth, start = [], 0, a
        for k in range(a, b):
            x = self.tokens[k]
            depth += x in ("(", "[", "{")
            depth -= x in (")", "]", "}")
            if x == by and not depth:
                out.append((start, k))
                start = k + 1
        return [*out, (start, b)]

    def mark(self, i: int) -> None:
        self.emit("place", method_id=self.method, place=self.order, line=self.lines[min(i, len(self.lines) - 1)])

    def step(self, i: int) -> int:
        self.order += 1
        self.mark(i)
        return self.order

    def block(self, i: int, stop: int) -> None:
        while i < stop:
            i = self.statement(i, stop)

    def statement(self, i: int, stop: int) -> int:
        t = self.tokens
        if t[i] == "{":
            end = self.close(i)
            self.block(i + 1, end)
            return end + 1
        if t[i] in (";", "}", "break", "continue"):
            return i + 1
        if t[i] == "if":
            end = self.close(i + 1)
            control = self.condition(i, i + 2, end)
            first = self.order + 1
            i = self.statement(end + 1, stop)
            self.emit("branch", control_id=control, method_id=self.method, branch=1, line=first, line_end=self.order)
            if i < stop and t[i] == "else":
                first = self.order + 1
                i = self.statement(i + 1, stop)
                self.emit("branch", control_id=control, method_id=self.method, branch=2, line=first, line_end=self.order)
            self.finish(control)
            return i
        if t[i] in ("for", "while", "switch"):
            end = self.close(i + 1)
            kind = t[i]
            parts = self.split(i + 2, end, ";") if kind == "for" else [(i + 2, end)]
            if kind == "for":
                self.simple(*parts[0])
                parts = parts[1:]
            control = self.condition(i, *parts[0]) if parts else self.condition(i, end, end)
            if kind == "switch":
                nxt = self.cases(control, end + 1, stop)
            else:
                for _ in range(2):
                    nxt = self.statement(end + 1, stop)
                    if len(parts) > 1:
                        self.simple(*parts[1])
            self.finish(control)
            return nxt
        if t[i] == "do":
            control = self.condition(i, i, i)
            for _ in range(2):
                nxt = self.statement(i + 1, stop)
            self.finish(control)
            return self.close(nxt + 1) + 2
        end = next((e for s, e in self.split(i, stop, ";")), stop)
        if t[i] == "return":
            at = self.step(i)
            self.emit("ret", id=self.new_id(), method_id=self.method, line=at)
            self.expression(i + 1, end, "<operator>.return")
        elif t[i] not in ("case", "default", "goto"):
            self.simple(i, end)
        return end + 1

    def condition(self, i: int, a: int, b: int) -> int:
        at = self.step(i)
        control = self.new_id()
        self.open_controls = {**getattr(self, "open_controls", {}), control: (self.tokens[i].upper(), self.spaced(a, b), at)}
        self.expression(a, b, "<operator>.condition")
        return control

    def finish(self, control: int) -> None:
        kind, condition, at = self.open_controls.pop(control)
        self.emit("control", id=control, method_id=self.method, type=kind, condition=condition, line=at, line_end=self.order)

    def cases(self, control: int, i: int, stop: int) -> int:
        end, k = self.close(i), i + 1
        while k < end:
            if self.tokens[k] in ("case", "default"):
                self.emit("label", control_id=control, method_id=self.method, line=self.order + 1)
                k = next((e for s, e in self.split(k, end, ":")), end) + 1
            else:
                k = self.statement(k, end)
        return end + 1

    def simple(self, a: int, b: int) -> None:
        """A declaration, an assignment or an expression."""
        t = self.tokens
        if a >= b:
            return
        at = self.step(a)
        is_type = t[a] in _TYPES or (_NAME.match(t[a]) and a + 1 < b and (_NAME.match(t[a + 1]) or (t[a + 1] == "*" and a + 2 < b and _NAME.match(t[a + 2]) and (a + 3 >= b or t[a + 3] in "=,["))))
        if is_type and t[a] not in _KEYWORDS:
            head = a
            while head < b and (t[head] in _TYPES or (head > a and t[head - 1] == "struct")):
                head += 1
            head = max(head, a + 1)
            for s, e in self.split(head, b):
                names = [k for k in range(s, e) if _NAME.match(t[k])]
                if not names:
                    continue
                k = names[0]
                equals = next((x for x in range(s, e) if t[x] == "="), e)
                stars = "*" * sum(x == "*" for x in t[s:k])
                local = self.new_id()
                self.depth_locals[t[k]] = local
                self.emit("local", id=local, method_id=self.method, name=t[k], type_full_name=self.code(a, head) + stars + self.code(k + 1, equals), line=at)
                if equals < e:
                    self.assign(t[k], equals + 1, e, at)
            return
        for x in range(a, b):
            depth = sum(y in ("(", "[") for y in t[a:x]) - sum(y in (")", "]") for y in t[a:x])
            if not depth and re.fullmatch(r"[-+*/%&|^]?=|<<=|>>=", t[x]):
                target = self.code(a, x)
                if t[x] != "=":
                    self.expression(a, x, "<operator>.assignment")
                self.targets(a, x, at)
                self.assign(target, x + 1, b, at)
                return
        self.expression(a, b, "<operator>.expression")

    def assign(self, target: str, a: int, b: int, at: int) -> None:
        self.emit("assignment", id=self.new_id(), method_id=self.method, line=at, target=target, source=self.code(a, b))
        self.expression(a, b, "<operator>.assignment")

    def targets(self, a: int, b: int, at: int) -> None:
        """Accesses on the left side: a plain name is only written, anything else reads its base."""
        if b - a > 1:
            self.expression(a, b, "<operator>.target")

    def call(self, name: str, a: int, b: int) -> int:
        own = self.new_id()
        self.emit("call", id=own, method_id=self.method, name=name, code=self.code(a, b), file=self.path, line=self.order, dispatch_type="STATIC_DISPATCH", callee_id=None)
        return own

    def argument(self, call: int, index: int, a: int, b: int) -> None:
        text = self.code(a, b)
        kind = "IDENTIFIER" if b - a == 1 and _NAME.match(text) else "LITERAL" if b - a == 1 and (text[0].isdigit() or text[0] in "\"'") else "CALL"
        self.emit("argument", call_id=call, method_id=self.method, arg_index=index, kind=kind, code=text, line=self.order, decl_id=self.depth_locals.get(text))

    def expression(self, a: int, b: int, owner: str) -> None:
        """Calls, accesses and names read in an expression."""
        t, own, k = self.tokens, None, a
        while k < b:
            x = t[k]
            if x == "sizeof":
                k = self.close(k + 1) + 1 if k + 1 < b and t[k + 1] == "(" else k + 2
                continue
            if _NAME.match(x) and k + 1 < b and t[k + 1] == "(" and x not in _KEYWORDS:
                end = self.close(k + 1)
                call = self.call(x, k, end + 1)
                for index, (s, e) in enumerate(self.split(k + 2, end), 1):
                    if s < e:
                        self.argument(call, index, s, e)
                        if e - s > 1:
                            self.expression(s, e, "<operator>.argument")
                k = end + 1
                continue
            if _NAME.match(x) and x not in _TYPES and x not in _KEYWORDS and x != "NULL":
                e = k + 1
                while e < b and (t[e] in ("->", ".") or t[e] == "["):
                    close = self.close(e) + 1 if t[e] == "[" else e + 2
                    kind = "<operator>.indirectIndexAccess" if t[e] == "[" else "<operator>.indirectMemberAccess" if t[e] == "->" else None
                    if kind:
                        call = self.call(kind, k, close)
                        self.argument(call, 1, k, e)
                        if t[e] == "[":
                            self.argument(call, 2, e + 1, close - 1)
                            self.expression(e + 1, close - 1, "<operator>.argument")
                    e = close
                if k > a and t[k - 1] == "&" and (k - 1 == a or not (_NAME.match(t[k - 2]) or t[k - 2] in (")", "]"))):
                    pass  # its address is taken
                elif k > a and t[k - 1] == "*" and (k - 1 == a or not (_NAME.match(t[k - 2]) or t[k - 2] in (")", "]") or t[k - 2][0].isdigit())):
                    self.argument(self.call("<operator>.indirection", k - 1, e), 1, k, e)
                elif b - a > 1 or owner != "<operator>.argument":
                    own = own or self.call(owner, a, b)
                    self.argument(own, 9, k, e)
                k = e
                continue
            k += 1


def parse(path: str, text: str) -> list[tuple[str, dict]]:
    return File(path, text).rows


def graph_of(sources: DataFrame) -> tuple[Graph, DataFrame]:
    """(graph, places) of sources (columns path, text): each file is parsed on its own; calls meet methods by name."""

    def work(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(name, json.dumps(row)) for path, text in zip(pdf["path"], pdf["text"], strict=True) for name, row in parse(path, text or "")]
            yield pd.DataFrame(rows, columns=["name", "row"])

    rows = sources.select("path", "text").mapInPandas(work, "name string, row string").persist()

    def table(name: str, schema: str) -> DataFrame:
        return rows.where(F.col("name") == name).select(F.from_json("row", schema).alias("r")).select("r.*")

    tables = {name: table(name, schema) for name, schema in TABLES.items() if name != "ast"}
    owner = tables["method"].groupBy("name").agg(F.min("id").alias("callee"))
    tables["call"] = tables["call"].join(owner, "name", "left").select(*(F.col("callee").alias(c) if c == "callee_id" else F.col(c) for c in tables["call"].columns))
    inside = tables["control"].select(F.col("id").alias("control_id"), F.col("method_id").alias("m"), F.col("line").alias("c0"), "line_end")
    k = tables["call"].select(F.col("id").alias("call_id"), "method_id", "line")
    tables["cdg"] = k.join(inside, (F.col("method_id") == F.col("m")) & (F.col("line") > F.col("c0")) & (F.col("line") <= F.col("line_end"))).select("control_id", "call_id")
    return Graph.of(sources.sparkSession, tables), table("place", "method_id long, place int, line int")
