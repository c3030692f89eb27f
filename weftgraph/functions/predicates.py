"""Predicates and scalar functions as Column builders; all run inside code generation.

Fixed values, on which results depend: the patterns of constants, array sizes, redacted paths
and memory failures below.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_match(column: Column, pattern: str) -> Column:
    """The whole value matches: ``rlike`` alone is a search, and ``$`` would let a last line end pass."""
    return column.rlike(rf"\A(?:{pattern})\z")


# The longest search pattern taken from a user, and a group with a quantifier or a choice inside that is repeated itself.
LONGEST_PATTERN = 512
_NESTED = r"\([^)]*(?:[+*]|\|)[^)]*\)\s*[+*]"


def checked(pattern: str) -> str:
    """A user's pattern as it is; an error if it is too long or may backtrack without end."""
    if len(pattern) > LONGEST_PATTERN:
        raise ValueError(f"pattern longer than {LONGEST_PATTERN} characters")
    if re.search(_NESTED, pattern):
        raise ValueError("pattern repeats a group that repeats or chooses inside")
    return pattern


def any_of(column: Column, names: list[str]) -> Column:
    return column.isin(*names)


def file_is(column: Column, path: str) -> Column:
    """The path, or its end after a slash."""
    return (column == path) | column.endswith("/" + path)


def file_starts(column: Column, prefix: str) -> Column:
    """A path component starts with ``prefix``."""
    return column.rlike(r"(\A|/)" + re.escape(prefix))


def same_path(a: Column, b: Column) -> Column:
    a, b = F.regexp_replace(a, r"\\", "/"), F.regexp_replace(b, r"\\", "/")
    return (a == b) | a.endswith(F.concat(F.lit("/"), b)) | b.endswith(F.concat(F.lit("/"), a))


def mentions(code: Column, name: Column) -> Column:
    """code is the variable, its address or target, or starts with an access to it."""
    starts = [F.concat(name, F.lit(x)) for x in (".", "[", "->")] + [F.concat(F.lit(x), name) for x in ("*", "&")]
    out = code == name
    for s in starts:
        out = out | code.startswith(s)
    return out


def pointer_use(code: Column, name: Column) -> Column:
    return (code == name) | code.startswith(F.concat(name, F.lit("->"))) | code.startswith(F.concat(name, F.lit("["))) | code.startswith(F.concat(F.lit("*"), name))


def buffer_target(code: Column, name: Column) -> Column:
    return (code == name) | code.startswith(F.concat(name, F.lit("["))) | code.startswith(F.concat(name, F.lit("+"))) | code.startswith(F.concat(F.lit("&"), name))


def trackable(code: Column) -> Column:
    return ~code.contains("(") & ~code.contains("[") & (F.length(code) < 50)


def words(code: Column) -> Column:
    return F.trim(F.regexp_replace(code, "[^A-Za-z0-9_]+", " "))


def has_words(code: Column, name: Column) -> Column:
    """The words of ``name`` stand in the code as whole words, in a row."""
    blank = F.lit(" ")
    return F.concat(blank, words(code), blank).contains(F.concat(blank, words(name), blank))


def extract_variable(code: Column) -> Column:
    return F.regexp_replace(code, r"(?s)[^a-zA-Z0-9_].*", "")


def parse_int_literal(code: Column) -> Column:
    """Decimal or 0x literal without its suffix, else null; octal reads as decimal."""
    bare = F.regexp_replace(F.trim(code), "[uUlL]+$", "")
    return F.when(full_match(bare, "0[xX][0-9a-fA-F]{1,15}"), F.conv(F.substring(bare, 3, 20), 16, 10).cast("long")).when(full_match(bare, "[0-9]{1,18}"), bare.try_cast("long"))


def array_size(type_name: Column) -> Column:
    return F.regexp_extract(type_name, r"\[([0-9]+)\]", 1).try_cast("int")


def constant(code: Column) -> Column:
    return full_match(code, "[0-9]+[uUlL]*|0[xX][0-9a-fA-F]+[uUlL]*|'.*'|sizeof.*")


def small_constant(code: Column, most: int = 4096) -> Column:
    always = full_match(code, "'.*'|sizeof.*")
    bare = F.regexp_replace(code, "[uUlL]+$", "")
    octal = F.when(full_match(bare, "0[0-7]{1,15}"), F.conv(bare, 8, 10).cast("long"))
    return always | F.coalesce(F.coalesce(octal, parse_int_literal(code)) <= most, F.lit(False))


def clip(code: Column, most: int = 200) -> Column:
    return F.when(F.length(code) > most, F.concat(F.substring(code, 1, most), F.lit("…(+"), (F.length(code) - most).cast("string"), F.lit(" chars)"))).otherwise(code)


def redact_paths(text: Column) -> Column:
    return F.substring(F.regexp_replace(text, r"(/[^\s'\"]+/)([^\s'\"/]+)", "<path>/$2"), 1, 600)


def size_tier(gigabytes: Column) -> Column:
    return F.when(gigabytes <= 1, "S").when(gigabytes <= 4, "M").when(gigabytes <= 12, "L").otherwise("XL")


def short_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\u0000", *parts), 256), 1, 16)


def glob_regex(glob: str) -> str:
    """``**/`` any folders, ``*`` within a component, ``?`` one character."""
    out, i = "", 0
    while i < len(glob):
        if glob.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif glob.startswith("**", i):
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + "[^/]", i + 1
        else:
            out, i = out + re.escape(glob[i]), i + 1
    return out


def language_scores(text: Column, signals: dict[str, list[tuple[str, int]]]) -> Column:
    """A map of language to the summed weights of its patterns found in the text; letters of all scripts are letters, lines end at line feeds."""
    pairs = []
    for language, patterns in signals.items():
        total = F.lit(0)
        for pattern, weight in patterns:
            total = total + F.when(text.rlike("(?mdU)" + pattern), weight).otherwise(0)
        pairs += [F.lit(language), total]
    return F.create_map(*pairs)


def best_language(scores: Column) -> Column:
    """The language with the top score if that is 2 or more and at least twice the next one, else null."""
    entries = F.array_sort(F.map_entries(scores), lambda a, b: F.when(a.value != b.value, b.value - a.value).otherwise(F.when(a.key < b.key, -1).otherwise(1)))
    top, second = entries[0], entries[1]
    return F.when((top.value >= 2) & (top.value >= 2 * F.greatest(second.value, F.lit(1))), top.key)


def excluded(path: Column, patterns: list[str]) -> Column:
    """The whole path matches one of the patterns."""
    return full_match(path, "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


# Hosts from which source is taken.
REPOSITORY_HOSTS = ["github.com", "www.github.com", "gitlab.com", "www.gitlab.com", "dev.azure.com"]


def repository_url(url: Column) -> Column:
    """A repository's address as https://host/path without .git; null if it is not of a known host, has blanks or control characters, or lacks owner and name."""
    hosts = "|".join(map(re.escape, REPOSITORY_HOSTS))
    host = F.regexp_extract(url, rf"\Ahttps://({hosts})/", 1)
    path = F.regexp_replace(F.regexp_extract(url, rf"\Ahttps://(?:{hosts})/([^?#]*)", 1), r";[^/]*\z", "")
    path = F.regexp_replace(path, r"\A/+|/+\z", "")
    parts = F.size(F.filter(F.split(path, "/"), lambda x: x != ""))
    clean = F.regexp_replace(path, r"\.git\z", "")
    return F.when((host != "") & (parts >= 2) & ~url.rlike(r"[\x00-\x20\x7F\p{Z}]"), F.concat(F.lit("https://"), host, F.lit("/"), clean))


def out_of_memory(exit_code: Column, log: Column) -> Column:
    return (exit_code == 137) | F.lower(log).rlike("outofmemory|out of memory|java heap space|gc overhead|cannot allocate memory|oom-?kill|killed")
