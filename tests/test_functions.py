import re

from pyspark.sql import functions as F

from weftgraph.functions import predicates as P


def rows(spark, values, *columns):
    return [tuple(r) for r in spark.createDataFrame([(v,) for v in values], "x string").select(*columns).collect()]


def test_full_match_is_not_a_search(spark):
    got = rows(spark, ["free", "xfreex", "free\n"], P.full_match(F.col("x"), "free|cfree"))
    assert [g[0] for g in got] == [True, False, False]


def test_paths(spark):
    got = rows(spark, ["a/shell.c", "shell.c", "a/xshell.c"], P.file_is(F.col("x"), "shell.c"), P.file_starts(F.col("x"), "shell"), P.same_path(F.col("x"), F.lit("b\\a/shell.c")))
    assert got == [(True, True, True), (True, True, True), (False, False, False)]


def test_numbers(spark):
    got = rows(spark, ["12", "0x1F", "12UL", "n", "(n+1)", "010"], P.parse_int_literal(F.col("x")), P.extract_variable(F.col("x")), P.constant(F.col("x")), P.small_constant(F.col("x"), 8))
    assert [g[0] for g in got] == [12, 31, 12, None, None, 10]
    assert [g[1] for g in got] == ["12", "0x1F", "12UL", "n", "", "010"]
    assert [g[2] for g in got] == [True, True, True, False, False, True]
    assert [g[3] for g in got] == [False, False, False, False, False, True]


def test_pointer_predicates(spark):
    got = rows(spark, ["p", "p->f", "p[1]", "*p", "&p", "px", "p.f", "p+1"], P.pointer_use(F.col("x"), F.lit("p")), P.buffer_target(F.col("x"), F.lit("p")), P.mentions(F.col("x"), F.lit("p")))
    assert [g[0] for g in got] == [True, True, True, True, False, False, False, False]
    assert [g[1] for g in got] == [True, False, True, False, True, False, False, True]
    assert [g[2] for g in got] == [True, True, True, True, True, False, True, False]


def test_clip_and_redact(spark):
    assert rows(spark, ["x" * 205], P.clip(F.col("x")))[0][0] == "x" * 200 + "…(+5 chars)"
    assert rows(spark, ["at /home/me/a.c here"], P.redact_paths(F.col("x")))[0][0] == "at <path>/a.c here"


def test_globs():
    assert re.fullmatch(P.glob_regex("src/**/*.c"), "src/a/b/x.c") and re.fullmatch(P.glob_regex("src/**/*.c"), "src/x.c")
    assert not re.fullmatch(P.glob_regex("src/*.c"), "src/a/x.c")
