"""License scan: notice phrases by Aho-Corasick, tagged licence expressions by a shunting-yard parser.

Each text is lower-cased (A-Z), cut into words and scanned once by one automaton that holds the base
phrases, further notice phrases and the words of the identifier tag. Where the tag occurs, the rest of
its line is parsed as an expression of licence names joined by ``WITH``, ``AND``, ``OR`` (binding in this
order) and parentheses. ``WITH`` takes one licence and one exception. The longest valid beginning counts: comment ends and prose
behind it are left out, but an operator, a parenthesis or a further known licence there makes the expression malformed, and
so does prose behind a name that is no known licence.

Every finding has a value in 0..1 for how freely the text may be used: ``AND`` takes the smaller value,
``OR`` the larger one, an exception after ``WITH`` lifts its licence half way to 1. The score of a
document is the smallest value of its findings, 0 without findings.

Defined results: NULL and empty texts have no words, no labels and NULL positions; a malformed
expression keeps its known licences as labels, adds ``invalid-expression`` and has the value 0;
repeated rows give repeated results; whole texts of any length are scanned; other columns are not read.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

# Phrases of the base scan and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notices that the scan knows.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"

# How freely a text under the licence may be used.
VALUES = {
    "mit": 1.0, "apache-2": 1.0, "apache-2.0": 1.0, "bsd": 1.0, "bsd-2-clause": 1.0, "bsd-3-clause": 1.0, "isc": 1.0,
    "public-domain": 1.0, "cc0-1.0": 1.0, "unlicense": 1.0, "cc-by": 0.9, "cc-by-4.0": 0.9, "cc-by-sa-4.0": 0.7,
    "mpl": 0.7, "mpl-2.0": 0.7, "lgpl": 0.6, "lgpl-2.1": 0.6, "lgpl-3.0": 0.6, "gpl-2": 0.4, "gpl-2.0": 0.4,
    "gpl-3": 0.4, "gpl-3.0": 0.4, "agpl": 0.3, "agpl-3.0": 0.3, "cc-by-nc": 0.2, "cc-by-nc-4.0": 0.2,
    "all-rights-reserved": 0.0,
}
UNKNOWN_VALUE = 0.5

_BINDING = {"or": 1, "and": 2, "with": 3}
_TERMS = re.compile(r"[()]|[a-z0-9][a-z0-9.+:_-]*|\S")
_TAG_LINE = re.compile(rb"spdx-license-identifier[ \t]*:?([^\r\n]*)", re.IGNORECASE)
# A-Z become a-z; bytes that separate words become spaces; bytes from 0x80 on are word bytes.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _plain(name: str) -> str:
    return re.sub(r"(-only|-or-later|\+)$", "", name)


def known(name: str) -> bool:
    return name in VALUES or _plain(name) in VALUES


def licence_value(name: str) -> float:
    return VALUES.get(name, VALUES.get(_plain(name), UNKNOWN_VALUE))


def longest_valid(terms: list[str]) -> int:
    """How many terms make up the longest valid expression at the beginning."""
    depth, operand_next, simple, best = 0, True, False, 0
    for i, term in enumerate(terms):
        if term == "(":
            if not operand_next:
                break
            depth += 1
        elif term == ")":
            if operand_next or not depth:
                break
            depth, simple = depth - 1, False
        elif term in _BINDING:
            if operand_next or term == "with" and not simple:
                break
            operand_next, simple = True, False
            if term == "with" and (i + 1 == len(terms) or terms[i + 1] in _BINDING or not terms[i + 1][0].isalnum()):
                break
            continue
        else:
            if not operand_next or not term[0].isalnum():
                break
            operand_next = False
            simple = i == 0 or terms[i - 1] != "with"
        if not operand_next and not depth:
            best = i + 1
    return best


def postfix(terms: list[str]) -> list[str]:
    """Operands and operators of a valid expression in postfix order (shunting yard)."""
    out: list[str] = []
    waiting: list[str] = []
    for term in terms:
        if term == "(":
            waiting.append(term)
        elif term == ")":
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
        elif term in _BINDING:
            while waiting and waiting[-1] != "(" and _BINDING[waiting[-1]] >= _BINDING[term]:
                out.append(waiting.pop())
            waiting.append(term)
        else:
            out.append(term)
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """Licence names of an expression and its value."""
    terms = [t.rstrip(".-") or t for t in _TERMS.findall(expression.lower())]
    size = longest_valid(terms)
    rest = terms[size:size + 1]
    names = {t for t in terms[:size] if t not in _BINDING and t not in "()"}
    after = bool(rest) and (rest[0] in _BINDING or rest[0] in "()" or known(rest[0]) or rest[0][0].isalnum() and not all(map(known, names)))
    if not size or after:
        return {t for t in terms if known(t)} | {"invalid-expression"}, 0.0
    stack: list[tuple[frozenset[str], float]] = []
    for term in postfix(terms[:size]):
        if term not in _BINDING:
            stack.append((frozenset([term]), licence_value(term)))
            continue
        (right, right_value), (left, left_value) = stack.pop(), stack.pop()
        if term == "with":
            stack.append((frozenset([f"{min(left)}-with-{min(right)}"]), (left_value + 1) / 2))
        else:
            stack.append((left | right, min(left_value, right_value) if term == "and" else max(left_value, right_value)))
    return set(stack[0][0]), stack[0][1]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrases, base in ((BASE_PHRASES, True), (NOTICE_PHRASES, False), ({TAG: None}, False)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (len(phrase) + 2, label, base))
    found.make_automaton()
    return found


def scan_text(raw: bytes, phrases: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    words = raw.translate(_FOLD).split()
    line = f" {b' '.join(words).decode('latin-1')} "
    base, labels, values = [], set(), []
    at = seen = 0
    tagged = False
    for end, (length, label, is_base) in phrases.iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        values.append(licence_value(label))
        if is_base:
            base.append((end - length + 1, label))
    places = []
    for start, _ in sorted(base):
        seen += line.count(" ", at, start)
        at = start
        places.append(seen)
    if tagged:
        for rest in _TAG_LINE.findall(raw):
            names, value = evaluate(rest.decode("utf-8", "replace"))
            labels |= names
            values.append(value)
    return (len(words), len(base), places[0] if places else None, places[-1] if places else None,
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), min(values, default=0.0))


SCHEMA = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double")


def _scanner():
    phrases = automaton()

    def work(texts: list[bytes]) -> list[pa.Array]:
        columns = list(zip(*(scan_text(t, phrases) for t in texts))) or [()] * 7
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        return [pa.array(c, k) for c, k in zip(columns, kinds)]
    return work


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, in one narrow pass."""
    return common.map_bytes(docs, [id_col], text, _scanner, SCHEMA)
