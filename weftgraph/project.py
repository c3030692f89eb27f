"""A deterministic program graph out of star-schema tables, as SQL that two engines run.

It exercises the operators on tables of any size; it says nothing about programs.
``PROJECTION[name]`` may use the tables in braces and earlier projections.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import Graph, rooted
from .operators.iterate import dealt

_NAMES = (
    "free cfree malloc calloc realloc strdup memcpy memset strcpy strncpy snprintf sprintf printf fprintf system popen "
    "read recv fgets getenv access stat open fopen sanitize <operator>.addition <operator>.multiplication "
    "<operator>.indirectIndexAccess <operator>.indirection <operator>.lessThan"
).split()
_NAME = "CASE k " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES)) + " ELSE 'fn_' || CAST(callee_id AS VARCHAR(20)) END"


def _text(x: str) -> str:
    return f"CAST({x} AS VARCHAR(20))"


#: Arithmetic in an argument, by its left and right operand.
_LEFT = f"CASE p % 5 WHEN 1 THEN 'v' || {_text('s % 6')} WHEN 4 THEN 'v' || {_text('s % 6')} ELSE 'n' || {_text('p % 4')} END"
_RIGHT = f"CASE p % 5 WHEN 0 THEN 'v' || {_text('s % 6')} WHEN 1 THEN '3' WHEN 2 THEN 'v' || {_text('s % 6')} WHEN 3 THEN '16' ELSE CASE WHEN p % 2 = 0 THEN '8' ELSE '65536' END END"
_SIGN = "CASE p % 5 WHEN 1 THEN ' << ' WHEN 2 THEN ' + ' WHEN 4 THEN ' - ' ELSE ' * ' END"
_SIGN_NAME = "'<operator>.' || CASE p % 5 WHEN 1 THEN 'shiftLeft' WHEN 2 THEN 'addition' WHEN 4 THEN 'subtraction' ELSE 'multiplication' END"
_ARITHMETIC = f"{_LEFT} || {_SIGN} || {_RIGHT}"


def _kind(code: str) -> str:
    return f"CASE WHEN substr({code}, 1, 1) IN ('0', '1', '2', '3', '4', '5', '6', '7', '8', '9', '\"') THEN 'LITERAL' ELSE 'IDENTIFIER' END"


PROJECTION: dict[str, str] = {
    "method": f"""
        SELECT c_custkey AS id, 'fn_' || {_text("c_custkey")} AS name, 'src/fn_' || {_text("c_custkey")} AS full_name,
          'int(int,char*)' AS signature, 'src/r' || {_text("n_regionkey")} || '/f' || {_text("n_nationkey")} || '.c' AS file,
          CAST(1 + (c_custkey % 50) * 40 AS INT) AS line, CAST(40 + (c_custkey % 50) * 40 AS INT) AS line_end,
          c_mktsegment = 'MACHINERY' AS is_external, CASE c_custkey % 3 WHEN 0 THEN 'int' WHEN 1 THEN 'char*' ELSE 'void' END AS return_type
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "raw": """
        SELECT l_orderkey * 8 + l_linenumber AS id, min(o_custkey) AS method_id, min(l_partkey) AS p, min(l_suppkey) AS s,
          CAST(min(l_quantity) AS INT) AS q, min(l_returnflag) AS flag, CAST((l_orderkey + l_linenumber * 3) % 38 + 1 AS INT) AS at
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY l_orderkey, l_linenumber""",
    "placed": """
        SELECT r.id, r.method_id, p, s, q, flag, CAST(m.line + r.at AS INT) AS line, m.file, (p * 7 + s) % 48 AS k,
          CASE WHEN (p * 7 + s) % n % 10 = 0 THEN (p * 7 + s) % n + 1 ELSE (p * 7 + s) % n END AS callee_id
        FROM {raw} r JOIN {method} m ON r.method_id = m.id CROSS JOIN (SELECT count(*) AS n FROM {customer}) customers""",
    "parameter": f"""
        SELECT c_custkey * 2 + i AS id, c_custkey AS method_id, 'v' || {_text("(c_custkey + i) % 6")} AS name,
          CASE i WHEN 0 THEN 'int' ELSE 'char*' END AS type_full_name, CAST(i + 1 AS INT) AS ord
        FROM {{customer}} CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 AS i) two""",
    "local": f"""
        SELECT o_custkey * 8 + o_orderkey % 6 AS id, o_custkey AS method_id, 'v' || {_text("o_orderkey % 6")} AS name,
          min(CASE o_orderkey % 3 WHEN 0 THEN 'char[' || {_text("16 + o_orderkey % 32")} || ']' WHEN 1 THEN 'int' ELSE 'char*' END) AS type_full_name,
          CAST(min(m.line) AS INT) AS line
        FROM {{orders}} JOIN {{method}} m ON o_custkey = m.id GROUP BY o_custkey, o_orderkey % 6""",
    "argument": f"""
        SELECT id AS call_id, method_id, CAST(1 AS INT) AS arg_index, CASE WHEN q % 7 = 0 THEN 'LITERAL' WHEN q % 7 <= 2 THEN 'CALL' ELSE 'IDENTIFIER' END AS kind,
          CASE WHEN q % 7 = 0 THEN '"s' || {_text("q")} || '"' WHEN q % 7 = 1 THEN 'v' || {_text("s % 6")} || '->f'
            WHEN q % 7 = 2 THEN {_ARITHMETIC} WHEN q % 7 = 3 AND p % 40 = 0 THEN 'fn_' || {_text("s * 10")} ELSE 'v' || {_text("s % 6")} END AS code,
          line, CASE WHEN q % 7 > 2 THEN method_id * 8 + s % 6 END AS decl_id FROM {{placed}}
        UNION ALL
        SELECT id, method_id, CAST(2 AS INT), CASE WHEN p % 3 = 0 THEN 'LITERAL' ELSE 'IDENTIFIER' END,
          CASE WHEN p % 3 = 0 THEN {_text("q * 3")} ELSE 'v' || {_text("p % 6")} END, line, CASE WHEN p % 3 <> 0 THEN method_id * 8 + p % 6 END FROM {{placed}}
        UNION ALL
        SELECT id, method_id, CAST(3 AS INT), CASE WHEN s % 2 = 0 THEN 'LITERAL' ELSE 'IDENTIFIER' END,
          CASE WHEN s % 2 = 0 THEN {_text("q + 10")} ELSE 'n' || {_text("p % 4")} END, line, CAST(NULL AS BIGINT) FROM {{placed}}""",
    "call": f"""
        SELECT id, method_id, {_NAME} AS name, {_NAME} || '(v' || {_text("s % 6")} || ', ' || {_text("q")} || ')' AS code, file, line,
          CASE WHEN s % 5 = 0 THEN 'DYNAMIC_DISPATCH' ELSE 'STATIC_DISPATCH' END AS dispatch_type,
          CASE WHEN k >= {len(_NAMES)} THEN callee_id END AS callee_id FROM {{placed}}""",
    "assignment": f"""
        SELECT id * 4 + 1 AS id, method_id, line, 'v' || {_text("(s + p) % 6")} AS target,
          CASE p % 5 WHEN 0 THEN 'v' || {_text("p % 6")} WHEN 1 THEN '&v' || {_text("s % 6")} WHEN 2 THEN {_NAME} || '(n' || {_text("p % 4")} || ' * v1)'
            WHEN 3 THEN 'NULL' ELSE 'v' || {_text("s % 6")} || ' + 1' END AS source
        FROM {{placed}} WHERE flag = 'R'
        UNION ALL
        SELECT id * 4 + 2, method_id, line, 'v' || {_text("p % 6")}, {_NAME} || '(' || {_text("q")} || ')' FROM {{placed}} WHERE k IN (2, 3, 4, 5, 15, 17, 19, 23)""",
    "control": f"""
        SELECT o_orderkey AS id, o_custkey AS method_id, CASE o_orderkey % 5 WHEN 0 THEN 'FOR' WHEN 1 THEN 'WHILE' ELSE CASE WHEN o_orderkey % 9 = 2 THEN 'SWITCH' ELSE 'IF' END END AS type,
          CASE o_orderkey % 4 WHEN 0 THEN CASE WHEN o_orderkey % 40 = 8 THEN 'n1 > SIZE_MAX / v2' WHEN o_orderkey % 40 = 16 THEN 'n2 > 9000 / v' || {_text("o_orderkey % 5")} ELSE 'v' || {_text("o_orderkey % 6")} || ' < n' || {_text("o_orderkey % 3")} END WHEN 1 THEN '!v' || {_text("o_orderkey % 6")}
            WHEN 2 THEN 'v' || {_text("o_orderkey % 6")} || ' == NULL' ELSE 'v' || {_text("o_orderkey % 6")} END AS condition,
          CAST(m.line + 1 + o_orderkey % 30 AS INT) AS line, CAST(m.line + 1 + o_orderkey % 30 + o_orderkey % 9 AS INT) AS line_end
        FROM {{orders}} JOIN {{method}} m ON o_custkey = m.id""",
    "branch": """
        SELECT id AS control_id, method_id, CAST(1 AS INT) AS branch, line, CAST(floor((line + line_end) / 2) AS INT) AS line_end FROM {control} WHERE type = 'IF'
        UNION ALL
        SELECT id, method_id, CAST(2 AS INT), CAST(floor((line + line_end) / 2) + 1 AS INT), line_end FROM {control} WHERE type = 'IF' AND line_end > line""",
    "label": """
        SELECT id AS control_id, method_id, CAST(line + i * 2 AS INT) AS line FROM {control} CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 AS i UNION ALL SELECT 2 AS i) three
        WHERE type = 'SWITCH' AND line + i * 2 <= line_end""",
    "apart": """
        SELECT control_id, branch, method_id, line, line_end FROM {branch}
        UNION ALL SELECT l.control_id, l.line, l.method_id, l.line, coalesce((SELECT min(n.line) - 1 FROM {label} n WHERE n.control_id = l.control_id AND n.line > l.line), c.line_end)
        FROM {label} l JOIN {control} c ON c.id = l.control_id WHERE (SELECT count(DISTINCT n.line) FROM {label} n WHERE n.control_id = l.control_id) >= 2""",
    "ret": """
        SELECT o_orderkey AS id, o_custkey AS method_id, CAST(m.line + 2 + o_orderkey % 36 AS INT) AS line
        FROM {orders} JOIN {method} m ON o_custkey = m.id WHERE o_orderpriority = '1-URGENT'""",
    "literal": """
        SELECT a.call_id * 4 + a.arg_index AS id, a.method_id, a.code, CASE WHEN a.arg_index = 1 THEN 'char*' ELSE 'int' END AS type_full_name, m.file, a.line
        FROM {argument} a JOIN {method} m ON a.method_id = m.id WHERE a.kind = 'LITERAL'""",
    "type_decl": f"""
        SELECT p_partkey AS id, 'T_' || p_brand || '_' || {_text("p_size")} AS name, 'struct T_' || p_brand || '_' || {_text("p_size")} AS full_name,
          'include/t' || {_text("p_partkey % 20")} || '.h' AS file, CAST(1 + p_partkey % 400 AS INT) AS line FROM {{part}}""",
    "member": f"""
        SELECT l_partkey AS type_id, 'm' || {_text("l_suppkey % 30")} AS name, CASE l_suppkey % 2 WHEN 0 THEN 'int' ELSE 'char*' END AS type_full_name,
          CAST(l_suppkey % 30 AS INT) AS ord FROM {{lineitem}} WHERE l_partkey % 3 <> 0 GROUP BY l_partkey, l_suppkey % 30, l_suppkey % 2""",
    "cfg": """
        SELECT src, dst, method_id, label FROM (
          SELECT id AS src, lead(id) OVER (PARTITION BY method_id ORDER BY line, id) AS dst, method_id,
            CASE WHEN flag = 'A' THEN 'TRUE' ELSE '' END AS label FROM {placed}) x WHERE dst IS NOT NULL
        UNION ALL SELECT src, dst, method_id, 'FALSE' FROM (
          SELECT id AS src, lead(id, 4) OVER (PARTITION BY method_id ORDER BY line, id) AS dst, method_id, q FROM {placed}) x WHERE dst IS NOT NULL AND q % 7 = 3
        UNION ALL SELECT src, dst, method_id, 'TRUE' FROM (
          SELECT id AS src, lag(id, 3) OVER (PARTITION BY method_id ORDER BY line, id) AS dst, method_id, q FROM {placed}) x WHERE dst IS NOT NULL AND q % 11 = 5""",
    "ddg": """
        SELECT src, dst FROM (
          SELECT user_id * 40 + event_id % 40 AS src, lead(user_id * 40 + event_id % 40) OVER (PARTITION BY user_id ORDER BY event_id) AS dst FROM {events}) x
        WHERE dst IS NOT NULL AND src <> dst GROUP BY src, dst""",
    "ast": f"""
        WITH x AS (
          SELECT a.method_id, call_id AS root_id, arg_index AS root_ord, kind, code, a.line, p, s, q, '' AS name, 0 AS form FROM {{argument}} a JOIN {{placed}} r ON r.id = a.call_id AND arg_index <> 1
          UNION ALL SELECT a.method_id, call_id, arg_index, a.kind, a.code, a.line, p, s, q, '', CASE q % 7 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END FROM {{argument}} a JOIN {{placed}} r ON r.id = a.call_id AND arg_index = 1
          UNION ALL SELECT a.method_id, a.id, 0, CASE WHEN p % 5 IN (1, 2, 4) THEN 'CALL' ELSE 'IDENTIFIER' END, source, a.line, p, s, q, {_NAME}, CASE p % 5 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 4 THEN 5 ELSE 0 END
            FROM {{assignment}} a JOIN {{placed}} r ON a.id = r.id * 4 + 1
          UNION ALL SELECT a.method_id, a.id, 0, 'CALL', source, a.line, p, s, q, {_NAME}, 6 FROM {{assignment}} a JOIN {{placed}} r ON a.id = r.id * 4 + 2),
        y AS (
          SELECT x.*, 0 AS pre, CASE form WHEN 0 THEN 0 WHEN 3 THEN 1 WHEN 6 THEN 1 WHEN 4 THEN 3 ELSE 2 END AS post, -1 AS parent, 1 AS ord, kind AS node,
            CASE form WHEN 0 THEN code WHEN 1 THEN '<operator>.indirectFieldAccess' WHEN 2 THEN {_SIGN_NAME} WHEN 3 THEN '<operator>.addressOf' WHEN 5 THEN '<operator>.addition' ELSE name END AS node_name, code AS node_code FROM x
          UNION ALL SELECT x.*, 1, CASE form WHEN 4 THEN 3 ELSE 1 END, 0, 1, CASE form WHEN 4 THEN 'CALL' WHEN 6 THEN 'LITERAL' ELSE 'IDENTIFIER' END,
            CASE form WHEN 1 THEN 'v' || {_text("s % 6")} WHEN 2 THEN {_LEFT} WHEN 3 THEN 'v' || {_text("s % 6")} WHEN 4 THEN '<operator>.multiplication' WHEN 5 THEN 'v' || {_text("s % 6")} ELSE {_text("q")} END,
            CASE form WHEN 1 THEN 'v' || {_text("s % 6")} WHEN 2 THEN {_LEFT} WHEN 3 THEN 'v' || {_text("s % 6")} WHEN 4 THEN 'n' || {_text("p % 4")} || ' * v1' WHEN 5 THEN 'v' || {_text("s % 6")} ELSE {_text("q")} END FROM x WHERE form > 0
          UNION ALL SELECT x.*, 2, 2, CASE form WHEN 4 THEN 1 ELSE 0 END, CASE form WHEN 4 THEN 1 ELSE 2 END, CASE form WHEN 1 THEN 'FIELD' WHEN 2 THEN {_kind(_RIGHT)} WHEN 4 THEN 'IDENTIFIER' ELSE 'LITERAL' END,
            CASE form WHEN 1 THEN 'f' WHEN 2 THEN {_RIGHT} WHEN 4 THEN 'n' || {_text("p % 4")} ELSE '1' END, CASE form WHEN 1 THEN 'f' WHEN 2 THEN {_RIGHT} WHEN 4 THEN 'n' || {_text("p % 4")} ELSE '1' END FROM x WHERE form IN (1, 2, 4, 5)
          UNION ALL SELECT x.*, 3, 3, 1, 2, 'IDENTIFIER', 'v1', 'v1' FROM x WHERE form = 4)
        SELECT method_id, root_id, CAST(root_ord AS INT) AS root_ord, CAST(pre AS INT) AS pre, CAST(post AS INT) AS post, CAST(parent AS INT) AS parent, CAST(ord AS INT) AS ord,
          node AS kind, node_name AS name, node_code AS code, line FROM y""",
    "cdg": """
        SELECT c.id AS control_id, k.id AS call_id FROM {control} c JOIN {call} k
          ON c.method_id = k.method_id AND k.line > c.line AND k.line <= c.line_end""",
}
BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def needed(names: list[str]) -> list[str]:
    """The projections that ``names`` need, in an order in which each finds what it uses."""
    out: list[str] = []

    def add(name: str) -> None:
        for other in re.findall(r"\{(\w+)\}", PROJECTION[name]):
            if other in PROJECTION and other not in out:
                add(other)
        if name not in out:
            out.append(name)

    for name in names:
        add(name)
    return out


def oracle(sql: str) -> str:
    """SQL over graph tables (in braces) as one statement over the base tables."""
    used = [n for n in re.findall(r"\{(\w+)\}", sql) if n in PROJECTION]
    names = {n: n for n in BASE} | {n: f"g_{n}" for n in PROJECTION}
    parts = [f"g_{n} AS ({PROJECTION[n].format(**names)})" for n in needed(list(dict.fromkeys(used)))]
    body = sql.format(**names)
    if not parts:
        return body
    if body.lstrip().upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + body.lstrip()[len("WITH RECURSIVE") :]
    if body.lstrip().upper().startswith("WITH"):
        return "WITH " + ",\n".join(parts) + ",\n" + body.lstrip()[len("WITH") :]
    return "WITH " + ",\n".join(parts) + "\n" + body


def projected(spark: SparkSession, sf_dir: str) -> Graph:
    """The projected graph, made when used.

    Nearly all tables come out of ``placed``, several times each: it is stored once, dealt by method, as are
    the arguments, so that windows, groups and joins inside methods need no shuffle of them. A passing table is made without them.
    """
    # also if a join has more keys than the method
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    made: dict[tuple[str, bool], DataFrame] = {}

    def table(name: str, stored: bool = True) -> DataFrame:
        if (name, stored) not in made:
            if name in PROJECTION:
                inputs = {n: table(n, stored) for n in dict.fromkeys(re.findall(r"\{(\w+)\}", PROJECTION[name]))}
                out = spark.sql(PROJECTION[name], **inputs)
                if stored and name in ("placed", "argument"):
                    out = dealt(out, "method_id", inside=name == "argument")
            else:
                out = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            made[name, stored] = out
        return made[name, stored]

    def expressions(of: str, roots: DataFrame) -> DataFrame:
        """``ast`` by its SQL over what these roots come out of, which is found by method and stored by id, as ``ast`` joins by id."""
        # an assignment's id is four times its call's, and one or two
        home = F.col("root_id") if of == "argument" else F.shiftright("root_id", 2)
        placed = table("placed").drop("file").join(roots.select("method_id", home.alias("id")), ["method_id", "id"], "left_semi")
        placed = dealt(placed, "id")
        inputs = {n: spark.sql(PROJECTION[n], placed=placed) for n in ("argument", "assignment")}
        inputs = {n: rooted(t, of, roots) if n == of else t.where("false") for n, t in inputs.items()}
        return spark.sql(PROJECTION["ast"], placed=placed, **inputs)

    return Graph(spark, table, partial(table, stored=False), expressions)
