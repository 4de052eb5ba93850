from __future__ import annotations

import random
import re

import pytest

from pedalmill.llm import licenses

from . import edge


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        want = phrase.split()
        hits = [i for i in range(len(words)) if words[i:i + len(want)] == want]
        places += hits
        labels |= {label} if hits else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def test_scan_equals_brute_force(spark):
    rng = random.Random(5)
    parts = ["under", "the", "MIT", "License", "cc", "by", "nc", "apache", "version", "2", "é", "2.0", "cc-by-nc", "-", "under\x00the"]
    extra = [(100 + i, rng.choice([" ", "-", "_"]).join(rng.choices(parts, k=60))) for i in range(200)]
    df = edge.docs(spark).select("doc_id", "text", "score").unionByName(
        spark.createDataFrame([(i, t, 0.0) for i, t in extra], "doc_id long, text string, score double"))
    got = [(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.scan(df).collect()]
    assert sorted(got, key=str) == sorted(((i, *brute(t)) for i, t in [*edge.TEXTS, *extra]), key=str)


@pytest.mark.parametrize("expression, names, value", [
    ("MIT", {"mit"}, 1.0),
    ("MIT OR GPL-2.0-only AND CC-BY-NC-4.0", {"mit", "gpl-2.0-only", "cc-by-nc-4.0"}, 1.0),
    ("(MIT OR GPL-2.0-only) AND CC-BY-NC-4.0", {"mit", "gpl-2.0-only", "cc-by-nc-4.0"}, 0.2),
    ("GPL-2.0 WITH Classpath-exception-2.0", {"gpl-2.0-with-classpath-exception-2.0"}, 0.7),
    ("GPL-2.0 WITH x AND MIT", {"gpl-2.0-with-x", "mit"}, 0.7),
    ("Strange-1.0", {"strange-1.0"}, 0.5),
    ("MIT AND", {"mit", "invalid-expression"}, 0.0),
    ("(MIT", {"mit", "invalid-expression"}, 0.0),
    ("MIT)", {"mit", "invalid-expression"}, 0.0),
    ("MIT Apache-2.0", {"mit", "apache-2.0", "invalid-expression"}, 0.0),
    ("", {"invalid-expression"}, 0.0),
    (" MIT */", {"mit"}, 1.0),
    ("Apache-2.0 -->", {"apache-2.0"}, 1.0),
    ("MIT-->", {"mit"}, 1.0),
    ("MIT.", {"mit"}, 1.0),
    ("MIT AND MIT WITH LLVM-exception", {"mit", "mit-with-llvm-exception"}, 1.0),
    ("(MIT OR GPL-2.0) WITH foo", {"mit", "gpl-2.0", "invalid-expression"}, 0.0),
    ("GPL-2.0 WITH a WITH b", {"gpl-2.0", "invalid-expression"}, 0.0),
    ("GPL-2.0 WITH (a)", {"gpl-2.0", "invalid-expression"}, 0.0),
    ("MIT see the file for details", {"mit"}, 1.0),
    ("see the file for details", {"invalid-expression"}, 0.0),
    ("(MIT OR Apache-2.0) AND (GPL-3.0 WITH x) # end", {"mit", "apache-2.0", "gpl-3.0-with-x"}, 0.7),
    ("((MIT)", {"mit", "invalid-expression"}, 0.0),
])
def test_expressions(expression, names, value):
    assert licenses.evaluate(expression) == (names, pytest.approx(value))


def test_tag_line(spark):
    row = licenses.scan(edge.docs(spark)).filter("doc_id = 17").first()
    assert row["labels"] == "apache-2.0-with-llvm-exception,gpl-2.0-only,mit" and row["score"] == 1.0 and row["base_labels"] == ""


def brute_labels(text):
    """Phrases by position and expressions by trying all beginnings, longest first."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    labels, values = set(), []
    for phrase, label in {**licenses.BASE_PHRASES, **licenses.NOTICE_PHRASES}.items():
        hits = sum(words[i:i + len(phrase.split())] == phrase.split() for i in range(len(words)))
        labels |= {label} if hits else set()
        values += [licenses.licence_value(label)] * hits

    def parse(terms):  # recursive descent: names and value, or None
        def either(i, sign, lower, pick):
            found = lower(i)
            while found and found[0] < len(terms) and terms[found[0]] == sign:
                more = lower(found[0] + 1)
                if not more:
                    return None
                found = more[0], found[1] | more[1], pick(found[2], more[2])
            return found

        def atom(i):
            if i >= len(terms) or terms[i] in ("and", "or", "with", ")"):
                return None
            if terms[i] == "(":
                inside = union(i + 1)
                return (inside[0] + 1, *inside[1:]) if inside and inside[0] < len(terms) and terms[inside[0]] == ")" else None
            if not terms[i][0].isalnum():
                return None
            if i + 2 < len(terms) and terms[i + 1] == "with" and terms[i + 2][0].isalnum() and terms[i + 2] not in ("and", "or", "with"):
                return i + 3, {f"{terms[i]}-with-{terms[i + 2]}"}, (licenses.licence_value(terms[i]) + 1) / 2
            return i + 1, {terms[i]}, licenses.licence_value(terms[i])

        union = lambda i: either(i, "or", lambda j: either(j, "and", atom, min), max)
        found = union(0)
        return found[1:] if found and found[0] == len(terms) else None

    for line in re.findall(r"(?i)spdx-license-identifier[ \t]*:?([^\r\n]*)", text):
        terms = [t.rstrip(".-") or t for t in re.findall(r"[()]|[a-z0-9][a-z0-9.+:_-]*|\S", line.lower())]
        size = next((n for n in range(len(terms), 0, -1) if parse(terms[:n])), 0)
        rest = terms[size:size + 1]
        plain = [t for t in terms[:size] if t not in ("and", "or", "with", "(", ")")]
        bad = not size or rest and (rest[0] in ("and", "or", "with", "(", ")") or licenses.known(rest[0]) or rest[0][0].isalnum() and not all(map(licenses.known, plain)))
        names, value = ({t for t in terms if licenses.known(t)} | {"invalid-expression"}, 0.0) if bad else parse(terms[:size])
        labels |= names
        values.append(value)
    return ",".join(sorted(labels)), min(values, default=0.0)


def test_labels_and_scores_of_whole_texts_equal_brute_force(spark):
    rng = random.Random(8)
    parts = ["MIT", "GPL-2.0-only", "Apache-2.0", "AND", "OR", "WITH", "(", ")", "x-exception", "see", "*/", "-->", "MIT.", "all rights reserved"]
    texts = []
    for _ in range(400):
        lines = [rng.choice(["// ", "", "# "]) + "SPDX-License-Identifier: " + " ".join(rng.choices(parts, k=rng.choice([1, 2, 3, 3, 5, 7]))) for _ in range(rng.choice([0, 1, 1, 2]))]
        texts.append("\n".join([*lines, rng.choice(["plain text", "under the MIT license", "Mozilla Public License, all rights reserved."])]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        labels, score = brute_labels(t)
        assert got[i] == (labels, pytest.approx(score)), t


def test_empty_table(spark):
    assert licenses.scan(edge.empty(spark)).count() == 0
