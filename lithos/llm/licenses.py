"""License scans: an Aho-Corasick automaton finds notices and tags, a shunting-yard parser reads expressions.

One automaton holds the notice phrases over the text's words and, over the lower-cased text
itself, the tags that introduce a license expression. What follows a tag up to the end of
its line is tokenised into identifiers, ``and``, ``or``, ``with`` and brackets, brought into
postfix order by operator precedence (with, and, or) and evaluated to the license sets that
satisfy it. An expression that does not parse gives the identifiers before its first fault.

Defined results: a null text counts as empty; without a place the positions are null, the
labels empty and the score 0. A phrase counts at every place, overlapping ones too.
Repeated rows are scanned alike. Columns other than id and text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed phrases of the base and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further notices, as words.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license": "apache-2",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "under the bsd license": "bsd",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
#: Fixed identifiers whose label is not the identifier itself in lower case.
SAME = {"apache-2.0": "apache-2", "apache-2.0+": "apache-2"}
RANK = {"with": 3, "and": 2, "or": 1}
TOKEN = re.compile(r"[()]|[a-z0-9.+-]+(?::[a-z0-9.+-]+)?")
GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


@dataclass(frozen=True)
class Params:
    base: dict[str, str] = field(default_factory=lambda: dict(BASE))
    notices: dict[str, str] = field(default_factory=lambda: dict(NOTICES))
    tags: tuple[str, ...] = TAGS


def postfix(tokens: list[str]) -> list[str]:
    """Operands and operators in postfix order; reading stops at the first token that cannot follow."""
    out, held, operand = [], [], False
    for t in tokens:
        if t == "(" and not operand:
            held.append(t)
        elif t == ")" and operand and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        elif t in RANK and operand:
            while held and held[-1] != "(" and RANK[held[-1]] >= RANK[t]:
                out.append(held.pop())
            held.append(t)
            operand = False
        elif t not in RANK and t not in "()" and not operand:
            out.append(t)
            operand = True
        else:
            break
    if not operand and held and held[-1] in RANK:  # an operator without its right side
        held.pop()
    return out + [t for t in reversed(held) if t != "("]


def choices(tokens: list[str]) -> list[frozenset[str]]:
    """All sets of licenses any of which satisfies the expression: their number may grow as the product of its clauses."""
    stack: list[list[frozenset[str]]] = []
    for t in postfix(tokens):
        if t not in RANK:
            stack.append([frozenset([SAME.get(t, t)])])
            continue
        if len(stack) < 2:
            break
        b, a = stack.pop(), stack.pop()
        if t == "or":
            both = a + [x for x in b if x not in a]
        elif t == "and":
            both = [x | y for x in a for y in b]
        else:  # the exception belongs to each license before it
            both = [frozenset(f"{i} with {j}" for i in x for j in y) for x in a for y in b]
        stack.append(sorted(set(both), key=lambda x: (len(x), sorted(x))))
    return stack[0] if stack else []


def read(tokens: list[str]) -> tuple[set[str], str]:
    """(labels, factored form) of an expression, in time linear in its operands: nothing is multiplied out."""
    stack: list[tuple[set[str], str, list[str]]] = []  # labels, operator, operands

    def shown(op: str, parts: list[str], inside: str) -> str:
        text = f" {op} ".join(dict.fromkeys(parts))
        return f"({text})" if op and inside and len(set(parts)) > 1 else text

    for t in postfix(tokens):
        if t not in RANK:
            name = SAME.get(t, t)
            stack.append(({name}, "", [name]))
            continue
        if len(stack) < 2:
            break
        (right, op_b, b), (left, op_a, a) = stack.pop(), stack.pop()
        if t == "with":
            left = {f"{i} with {j}" for i in left for j in right}
            stack.append((left, "", [f"{shown(op_a, a, t)} with {shown(op_b, b, t)}"]))
            continue
        left |= right
        a = a if op_a == t else [shown(op_a, a, t)]
        a += b if op_b == t else [shown(op_b, b, t)]
        stack.append((left, t, a))
    return (stack[0][0], shown(stack[0][1], stack[0][2], "")) if stack else (set(), "")


@lru_cache(maxsize=4)
def _automaton(phrases: tuple[tuple[str, str, bool], ...]):
    a = ahocorasick.Automaton()
    for phrase, label, base in phrases:
        a.add_word(f" {phrase} ", (label, base, len(phrase) + 2))
    a.make_automaton()
    return a


@lru_cache(maxsize=4)
def _tags(tags: tuple[str, ...]):
    a = ahocorasick.Automaton()
    for tag in tags:
        a.add_word(tag, tag)
    a.make_automaton()
    return a


def scan_text(text: str, p: Params) -> tuple:
    """(words, base places as (first word, label), other labels, expressions)."""
    phrases = tuple((k, v, k in p.base) for k, v in {**p.notices, **p.base}.items())
    # Only the Kelvin sign lowers to an ASCII letter of its own; other letters beyond ASCII make no phrase either way.
    low = text.translate(LOW) if "\u212a" in text else text.lower()
    joined = " " + GAP.sub(" ", low).strip(" ") + " "
    n_words = joined.count(" ") - 1 if joined != "  " else 0
    places, others, at, word = [], set(), 0, 0
    if n_words:
        hits = sorted((end - length + 1, label, base) for end, (label, base, length) in _automaton(phrases).iter(joined))
        for start, label, base in hits:
            word += joined.count(" ", at, start)
            at = start
            if base:
                places.append((word, label))
            else:
                others.add(label)
    found = []
    if ":" in low:
        for end, _ in _tags(p.tags).iter(low):
            stop = low.find("\n", end)
            names, form = read(TOKEN.findall(low[end + 1 : stop if stop >= 0 else len(low)]))
            if names:
                found.append((names, form))
    return n_words, places, others, found


def scan(docs: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, places, base_labels, labels, expressions, score)`` for each row of ``docs``.

    ``places`` are (word, label) of the base phrases, ``expressions`` the factored form of
    each tagged expression, such as "(a or b) and c". ``score`` grows with the evidence: a tag
    that parses counts three notices.
    """
    place = T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())])
    strings = T.ArrayType(T.StringType())
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(place))]
        + [T.StructField(c, strings) for c in ("base_labels", "labels")]
        + [T.StructField("expressions", strings), T.StructField("score", T.DoubleType())]
    )
    kinds = [pa.int64(), pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64()]

    def row(text: str) -> tuple:
        n_words, places, others, found = scan_text(text, p)
        base = sorted({label for _, label in places})
        labels = sorted({*base, *others, *(x for names, _ in found for x in names)})
        score = 1 - 0.5 ** (len(places) + len(others) + 3 * len(found))
        spans = [{"word": w, "label": label} for w, label in places]
        return n_words, spans, base, labels, [form for _, form in found], score

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            rows = [row(t.as_py() or "") for t in texts]
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
