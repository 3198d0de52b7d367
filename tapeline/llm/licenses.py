"""License scan: Aho-Corasick finds notice phrases and identifier tags; tagged expressions go through a shunting-yard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import text_slices

#: Fixed by the contract of the scan: places of these phrases are counted.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Notices that add a label of their own.
NOTICES = {
    "permission is hereby granted free of charge to any person": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"
TAG_RAW = re.compile(rb"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
#: How sure a kind of evidence makes us that the text carries a licence.
TAG_SCORE, NOTICE_SCORE, BASE_SCORE = 1.0, 0.9, 0.6
BINDING = {"with": 3, "and": 2, "or": 1}

#: Byte to byte: a-z, 0-9 and bytes of non-ASCII characters stay, A-Z are lowered, the rest separates words.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def parse(expression: str) -> list[str] | None:
    """Reverse Polish notation of an and/or/with expression, or None if it is malformed.

    `with` stands between one licence and one exception: neither is an expression of its own.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = True  # is an operand due?
    before = last = ""  # the two tokens read before this one
    for token in re.findall(r"[()]|[^\s()]+", expression.lower()):
        if token == "(":
            if not operand or last == "with":
                return None
            stack.append(token)
        elif token == ")":
            if operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in BINDING:
            if operand or token == "with" and (last == ")" or before == "with"):
                return None
            while stack and stack[-1] != "(" and BINDING[stack[-1]] >= BINDING[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        elif not operand or not re.fullmatch(r"[a-z0-9][a-z0-9.+-]*", token):
            return None
        else:
            out.append(token)
            operand = False
        before, last = last, token
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(rpn: list[str]) -> tuple[list[str], int]:
    """Licences named by the expression, and how many of them must be met together at least.

    `or` offers a choice (the smaller side counts), `and` asks for both sides, `with` ties an
    exception to its licence.
    """
    stack: list[tuple[list[str], int]] = []
    for token in rpn:
        if token not in BINDING:
            stack.append(([token], 1))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "with":
            stack.append(([f"{x} with {y}" for x in left for y in right], a))
        else:
            left += right  # in place: a long chain costs its length
            stack.append((left, min(a, b) if token == "or" else a + b))
    return stack[0]


_automaton = None


def automaton():
    """Aho-Corasick over all phrases, as blank-separated words; built once in a worker."""
    global _automaton
    if _automaton is None:
        import ahocorasick

        _automaton = ahocorasick.Automaton()
        for phrase in {*BASE, *NOTICES, TAG}:
            _automaton.add_word(f" {phrase} ", phrase)
        _automaton.make_automaton()
    return _automaton


def scan_text(text: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, needed of one text."""
    words = words_of(text)
    line = b" " + b" ".join(words) + b" "
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    score, counted, at, tagged = 0.0, 0, 0, False
    for end, phrase in automaton().iter(line.decode("latin-1")):
        counted += line.count(b" ", at, end)  # matches come in the order of their ends
        at = end
        if phrase == TAG:
            tagged = True
        if phrase in BASE:
            starts.append(counted - len(phrase.split()))
            base.add(BASE[phrase])
            score = max(score, BASE_SCORE)
        if phrase in NOTICES:
            labels.add(NOTICES[phrase])
            score = max(score, NOTICE_SCORE)
    expressions, needed = [], 0
    for found in TAG_RAW.findall(text.lower()) if tagged else []:
        expression = found.decode("utf-8", "replace").strip(" \t*/#->")
        rpn = parse(expression)
        if rpn is not None:
            names, least = evaluate(rpn)
            labels.update(names)
            expressions.append(expression)
            needed = max(needed, least)
            score = TAG_SCORE
    first, last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), score, "; ".join(sorted(set(expressions))), needed


SCHEMA = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "expressions": pa.string(),
    "n_needed": pa.int64(),
}


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id with the places, labels and expressions found in its whole text.

    Null texts count as empty (no words, empty labels, score 0). Malformed expressions add no
    label. Ids of any type, repeated or null, pass through; no other column is read. One pass, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            columns = zip(*map(scan_text, texts))
            arrays = [pa.array(list(values), kind) for values, kind in zip(columns, SCHEMA.values())]
            yield pa.RecordBatch.from_arrays([part.column("id"), *arrays], [id_col, *SCHEMA])

    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    schema = ", ".join([f"{id_col} {df.schema[id_col].dataType.simpleString()}", *[f"{name} {kinds[kind]}" for name, kind in SCHEMA.items()]])
    slim = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(run, schema)
