"""Licence scan: Aho-Corasick over notice phrases and identifier tags, shunting-yard for expressions.

A text becomes its words in lower case, one blank apart, and one automaton finds
every phrase at once.  Texts with an SPDX tag are read again for the expression
behind it; and/or/with are parsed to postfix order and evaluated.

Cases: null or empty text has no words and no labels; unbalanced or broken
expressions give the labels of the identifiers that can be read; texts are
scanned whole, very long ones too; repeated rows are scanned each; a null doc_id stays null; extra
columns are left alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, texts

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "permission is hereby granted free of charge to any person": "mit",
    "licensed under the apache license version 2 0": "apache",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "creative commons": "cc",
    "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
#: Prefixes of SPDX identifiers and their labels.
FAMILIES = {"mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "mpl": "mpl", "epl": "epl", "bsd": "bsd", "isc": "isc", "bsl": "bsl", "cc": "cc"}

_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_EXPRESSION = re.compile(r"SPDX-License-Identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_RANK = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str]:
    """Shunting-yard: identifiers and the operators or < and < with, in postfix order.

    Reading ends at the first word that cannot follow, so prose behind a tag is left out.
    """
    out, stack, operand = [], [], False
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if low in _RANK:
            if not operand:
                break
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = False
        elif token == "(":
            if operand:
                break
            stack.append(token)
        elif token == ")":
            if not operand or "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        else:
            if operand:
                break
            out.append(low)
            operand = True
    if not operand and stack and stack[-1] != "(":
        stack.pop()  # an operator without its right side
    return out + [x for x in reversed(stack) if x != "("]


def evaluate(rpn: list[str], accepted: Callable[[str], bool]) -> bool:
    """Whether the expression can be met with accepted licences; ``a with b`` is judged as ``a``."""
    stack: list[bool] = []
    for token in rpn:
        if token in _RANK:
            if len(stack) < 2:
                return False
            b, a = stack.pop(), stack.pop()
            stack.append(a or b if token == "or" else a and b if token == "and" else a)
        else:
            stack.append(accepted(token))
    return bool(stack) and stack[-1]


def families(rpn: list[str]) -> set[str]:
    """Labels of the licences named; the right side of ``with`` is an exception, not a licence."""
    stack: list[set[str]] = []
    for token in rpn:
        if token in _RANK:
            if len(stack) < 2:
                break
            b, a = stack.pop(), stack.pop()
            stack.append(a if token == "with" else a | b)
        else:
            stack.append({FAMILIES[p]} if (p := token.split("-")[0].rstrip("+")) in FAMILIES else set())
    return set().union(*stack)


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


PERMISSIVE = frozenset({"mit", "apache", "bsd", "isc", "bsl"})


def scan(text: str, found) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, permissive."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORD).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    n_base, first, last, base, labels, tagged, evidence = 0, None, None, set(), set(), False, 0
    at, word = 0, 0
    places = []
    for end, phrase in found.iter(line):
        if phrase == TAG:
            tagged = True
            continue
        evidence += 1
        if phrase in BASE:
            base.add(BASE[phrase])
            places.append(end - len(phrase) - 1)
        else:
            labels.add(NOTICES[phrase])
    for place in sorted(places):
        word += line.count(" ", at, place)
        at = place
        n_base += 1
        first = word if first is None else first
        last = word
    expressions, permissive = [], None
    if tagged:
        for written in _EXPRESSION.findall(text):
            if rpn := postfix(written):
                expressions.append(" ".join(rpn))
                labels |= families(rpn)
                evidence += 2
                ok = evaluate(rpn, lambda x: x.split("-")[0] in PERMISSIVE)
                permissive = ok if permissive is None else permissive and ok
    labels |= base
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - 0.5**evidence, expressions, permissive


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, permissive boolean"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_())]
)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document with its licence evidence; the input is read once, without a shuffle."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton()
        for batch in slices(batches):
            rows = [scan(t, found) for t in batch["text"].to_pylist()]
            values = [batch["doc_id"], *(pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), list(_ARROW)[1:], strict=True))]
            yield pa.RecordBatch.from_arrays(values, schema=_ARROW)

    return texts(docs).mapInArrow(scanned, SCHEMA)
