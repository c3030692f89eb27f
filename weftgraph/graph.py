"""A program graph: lazy DataFrames of node and edge tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import TABLES


def rooted(table: DataFrame, of: str, roots: DataFrame) -> DataFrame:
    """The rows of ``argument`` or ``assignment`` whose expressions have these roots (method_id, root_id, root_ord)."""
    key = ["method_id", "call_id", "arg_index"] if of == "argument" else ["method_id", "id"]
    return table.join(roots.select(*(F.col(c).alias(k) for c, k in zip(("method_id", "root_id", "root_ord"), key))), key, "left_semi")


class Graph:
    """Tables by name (``graph.call``, ``graph.method``, ...), loaded when first used."""

    def __init__(
        self, spark: SparkSession, load: Callable[[str], DataFrame], passing: Callable[[str], DataFrame] | None = None, expressions: Callable[[str, DataFrame], DataFrame] | None = None
    ):
        self.spark, self._load, self._got, self._passing, self._expressions = spark, load, {}, passing, expressions

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> Graph:
        """A stored graph: one Parquet folder per table, read with its declared schema."""
        return cls(spark, lambda name: spark.read.schema(TABLES[name]).parquet(f"{path}/{name}"))

    @classmethod
    def of(cls, spark: SparkSession, tables: dict[str, DataFrame]) -> Graph:
        """From given tables; a missing one is empty, but syntax trees come out of the codes of expressions."""

        def load(name: str) -> DataFrame:
            if name == "ast" and name not in tables:
                from .operators.trees import syntax

                return syntax(g)
            return tables[name] if name in tables else spark.createDataFrame([], TABLES[name])

        def parsed(of: str, roots: DataFrame) -> DataFrame:
            from .operators.trees import syntax

            return syntax(cls.of(spark, {of: rooted(getattr(g, of), of, roots)}))

        g = cls(spark, load, expressions=None if "ast" in tables else parsed)
        return g

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._got:
            self._got[name] = self._load(name)
        return self._got[name]

    def passing(self, name: str) -> DataFrame:
        """A table for a step that reads few of its rows or columns, once: not made of stored tables, so filters reach what it comes out of."""
        return self._passing(name) if self._passing else getattr(self, name)

    def expressions(self, of: str, roots: DataFrame) -> DataFrame:
        """The rows of ``ast`` of some expressions (method_id, root_id, root_ord), all of the table ``of``: argument, or assignment (root_ord 0)."""
        if self._expressions:
            return self._expressions(of, roots)
        return self.ast.join(roots, ["method_id", "root_id", "root_ord"], "left_semi")

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table out of the graph's that several steps use, made by the first of them."""
        if name not in self._got:
            self._got[name] = make()
        return self._got[name]

    def save(self, path: str) -> None:
        for name in TABLES:
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    def checked(self) -> Graph:
        """The graph itself; an error if it holds no method of the user's."""
        if self.method.where("NOT is_external").limit(1).isEmpty():
            raise ValueError("the graph is empty: it has no method but external ones")
        return self

    def views(self, prefix: str = "") -> None:
        """Register all tables as temporary views for SQL."""
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
