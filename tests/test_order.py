"""Numbers and caps in a total order, and raw SQL that only reads."""

import random

import pytest
from pyspark.errors import ParseException

from weftgraph.graph import Graph
from weftgraph.operators import order, sql


def test_numbers_are_those_of_the_whole_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), i) for i in range(5000)]
    frame = spark.createDataFrame(rows, "k string, id long").repartition(7)
    got = {r.id: r.issue for r in order.numbered(frame, ["k", "id"]).collect()}
    assert got == {i: n for n, (_, i) in enumerate(sorted(rows), 1)}
    assert order.numbered(frame.limit(0), ["k", "id"]).count() == 0


def test_caps(spark):
    frame = spark.createDataFrame([(i, "x" * 10) for i in range(100)] + [(100, None)], "id long, text string")
    read = lambda *caps: order.capped(frame, ["id"], *caps).collect()
    assert [r.id for r in read(5, 10_000)] == list(range(5)) and all(r.truncated for r in read(5, 10_000))
    assert [r.id for r in read(50, 34)] == [0, 1, 2] and len(read(101, 10_000)) == 101 and not any(r.truncated for r in read(101, 10_000))


@pytest.fixture(scope="module")
def graph(spark):
    return Graph.of(spark, {"call": spark.createDataFrame([(1, 9, "free"), (2, 9, "puts")], "id long, method_id long, name string")})


def test_reads(graph):
    assert [r.n for r in sql.run_sql(graph, "SELECT count(*) AS n FROM call").collect()] == [2]
    assert sql.run_sql(graph, "WITH x AS (SELECT * FROM call) SELECT name FROM x WHERE id IN (SELECT id FROM call) ORDER BY name", 1).collect()[0].name == "free"
    assert sql.run_sql(graph, "SELECT name, row_number() OVER (ORDER BY id) AS r FROM CALL UNION ALL SELECT name, 0 FROM method").count() == 2


@pytest.mark.parametrize(
    "text",
    [
        "DROP TABLE call",
        "INSERT INTO call VALUES (1)",
        "CREATE TABLE x AS SELECT 1",
        "SET spark.sql.shuffle.partitions = 1",
        "ADD JAR 'x.jar'",
        "SHOW TABLES",
        "SELECT * FROM parquet.`/etc/passwd`",
        "SELECT * FROM other",
        "SELECT * FROM db.call",
        "SELECT * FROM call WHERE id IN (SELECT id FROM secrets)",
        "SELECT (SELECT max(x) FROM csv.`/tmp/a`) FROM call",
        "WITH x AS (SELECT * FROM secrets) SELECT * FROM x",
        "SELECT reflect('java.lang.System', 'exit', 1)",
        "SELECT java_method('java.util.UUID', 'randomUUID') FROM call",
        "SELECT * FROM range(10)",
        "SELECT EXISTS (SELECT 1 FROM secrets WHERE secrets.id = call.id) FROM call",
    ],
)
def test_refused(graph, text):
    with pytest.raises(ValueError):
        sql.run_sql(graph, text)


def test_two_statements_are_no_statement(graph):
    with pytest.raises(ParseException):
        sql.run_sql(graph, "SELECT 1; DROP TABLE call")
