"""Licence scans: Aho-Corasick over identifier tags and notice phrases, and a parser of licence expressions.

One automaton runs over each text's words, so that line breaks and punctuation within a notice do not matter. Where it
meets an identifier tag, the expression that follows is read from the raw text, brought to postfix order by the
shunting-yard algorithm and evaluated.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import raw

#: Base phrases, further notice phrases, and identifiers, each with the label it stands for.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NOTICES = {
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "all rights reserved": "proprietary",
    "released into the public domain": "public-domain",
}
IDENTIFIERS = {"mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "mpl": "mpl", "bsd": "bsd", "isc": "isc", "cc-by": "cc-by", "cc0": "public-domain", "unlicense": "public-domain"}
#: How freely text under a label may be used, from 0 to 1; an exception (`with`) adds to it.
FREEDOM = {"public-domain": 1.0, "mit": 1.0, "bsd": 1.0, "isc": 1.0, "apache": 1.0, "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.5, "gpl": 0.2, "agpl": 0.1, "proprietary": 0.0}
EXCEPTION = 0.2
TAGS = ("spdx license identifier", "license expression")
TAG = re.compile(r"(?:spdx[-\s]license[-\s]identifier|license[-\s]expression)\s*[:=]?\s*([^\n]*)", re.ASCII)
TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*")
BINDS = {"or": 1, "and": 2, "with": 3}

#: A-Z to lower case, and every byte that no word holds to a blank. Bytes from 0x80 on belong to words.
_WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())



def postfix(expression: str) -> list[str]:
    """Shunting-yard: operands and operators in postfix order, up to where the text stops being an expression."""
    out: list[str] = []
    stack: list[str] = []
    operand = False
    for token in TOKEN.findall(expression):
        if token in BINDS:
            if not operand:
                break
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
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
        elif operand:
            break
        else:
            out.append(token)
            operand = True
    if not operand and stack and stack[-1] in BINDS:
        stack.pop()
    return out + [x for x in reversed(stack) if x != "("]


def label_of(identifier: str) -> str | None:
    """The label of an identifier: its longest known beginning, up to a version."""
    parts = identifier.rstrip("+").split("-")
    return next((IDENTIFIERS[x] for n in range(len(parts), 0, -1) if (x := "-".join(parts[:n])) in IDENTIFIERS), None)


def evaluate(expression: str) -> tuple[set[str], float | None]:
    """The labels of an expression and how free it is: `or` leaves the choice, `and` binds to all, `with` relaxes."""
    labels: set[str] = set()
    stack: list[float | None] = []
    for token in postfix(expression.lower()):
        if token not in BINDS:
            label = label_of(token)
            labels |= {label} if label else set()
            stack.append(FREEDOM[label] if label else None)
            continue
        if len(stack) < 2:
            break
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(None if left is None else min(1.0, left + EXCEPTION))
        else:
            known = [x for x in (left, right) if x is not None]
            stack.append((max if token == "or" else min)(known) if known else None)
    return labels, stack[-1] if stack else None


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases = [("base", p, x) for p, x in BASE.items()] + [("notice", p, x) for p, x in NOTICES.items()] + [("tag", p, "") for p in TAGS]
    for kind, phrase, label in phrases:
        found.add_word(f" {phrase} ", (kind, len(phrase), label))
    found.make_automaton()
    return found


def scan_text(text: bytes) -> dict[str, object]:
    words = text.translate(_WORD_BYTES).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts: list[int] = []
    labels: set[str] = set()
    more: set[str] = set()
    tagged = False
    for end, (kind, size, label) in _automaton().iter(line):
        if kind == "base":
            starts.append(end - size)
            labels.add(label)
        elif kind == "notice":
            more.add(label)
        else:
            tagged = True
    freedoms = [FREEDOM[x] for x in labels | more]
    if tagged:
        for m in TAG.finditer(text.decode("utf-8", "replace").lower()):
            names, free = evaluate(m[1])
            more |= names
            freedoms += [] if free is None else [free]
    places = [line.count(" ", 0, s) - 1 for s in (min(starts), max(starts))] if starts else [None, None]
    return {
        "n_words": len(words), "n_base": len(starts), "first_word": places[0], "last_word": places[1],
        "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | more)), "score": min(freedoms, default=0.0),
    }


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for every row of `docs`: words, base phrases and where the first and last start, labels, and a score.

    The score is how freely a text may be used under all that it names, from 0 (not, or nothing named) to 1. A null text
    is empty: no words, no labels, null places. Repeated rows give repeated rows, an empty table gives an empty one,
    further columns are ignored. Texts are scanned one by one, whole, where they lie.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
        for batch in batches:
            found = [scan_text(x) for x in raw(batch.column(1))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0)} | {k: pa.array([x[k] for x in found], t) for k, t in kinds.items()})

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id long, {SCHEMA}")
