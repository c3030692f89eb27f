"""Raw SQL over a graph's tables: reads only, of these tables only.

The session's own parser reads the text; its logical plan is walked, with common table
expressions and subqueries, and refused unless it is made of reading operators over the graph's views.
"""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame

from ..graph import Graph
from ..schema import TABLES
from .order import MOST_ROWS

#: Operators of plans that only read.
READING = (
    "Project Filter Aggregate Sort GlobalLimit LocalLimit Offset Tail Join Union Intersect Except Distinct Deduplicate SubqueryAlias UnresolvedWith UnresolvedRelation UnresolvedHaving "
    "UnresolvedInlineTable UnresolvedSubqueryColumnAliases OneRowRelation WithWindowDefinition Window LateralJoin Generate Pivot Unpivot Sample UnresolvedHint"
).split()
#: Functions that call other code.
REFUSED = {"reflect", "java_method", "try_reflect"}


def _each(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _walk(gateway, plan) -> Iterator[tuple[str, object]]:
    """(kind, node) of all operators and functions, also in subqueries."""
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName().removesuffix("$")
        yield name, node
        todo += [*_each(node.children()), *_each(node.innerChildren())]
        if name == "UnresolvedWith":
            todo += [x._2() for x in _each(node.cteRelations())]
        expressions = list(_each(node.expressions()))
        while expressions:
            e = expressions.pop()
            kind = e.getClass().getSimpleName()
            if kind == "UnresolvedFunction":
                yield kind, e
            if is_instance_of(gateway, e, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
                todo.append(e.plan())
            expressions += _each(e.children())


def checked_sql(g: Graph, text: str) -> None:
    """An error that says why, if the text is no read of the graph's tables alone."""
    plan = g.spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    nodes = list(_walk(g.spark.sparkContext._gateway, plan))
    own = {x._1() for name, n in nodes if name == "UnresolvedWith" for x in _each(n.cteRelations())}
    for name, node in nodes:
        if name == "UnresolvedFunction":
            parts = [str(x) for x in _each(node.nameParts())]
            if len(parts) > 1 or parts[0].lower() in REFUSED:
                raise ValueError(f"function {'.'.join(parts)} is not allowed")
        elif name not in READING:
            raise ValueError(f"{name} is not allowed: only reads are")
        elif name == "UnresolvedRelation":
            parts = [str(x) for x in _each(node.multipartIdentifier())]
            if len(parts) > 1 or parts[0].lower() not in TABLES and parts[0] not in own:
                raise ValueError(f"unknown table {'.'.join(parts)}")


def run_sql(g: Graph, text: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """The first rows of a read over the graph's tables (``TABLES``)."""
    checked_sql(g, text)
    g.views()
    return g.spark.sql(text).limit(min(most_rows, MOST_ROWS))
