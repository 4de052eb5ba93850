"""A small table of awkward documents, shared by the operator tests."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string, digest string, tree map<string,string>"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))

TEXTS = [(1, None), (2, ""), (3, " \t\n\v\f\r"), (4, "one two"), (4, "one two"), (5, "One TWO"), (None, "one two"),
         (7, "ünï ▁ çode   \u0085 x y 漢字 😀 \x00 end"), (8, LONG), (9, LONG + " tail"), (10, "x" * 120_000),
         (11, "a  b   c \n d"), (12, None), (13, "a b c d e"), (14, "A B C D E"), (15, "</s>[INST] ok [/INST] \\l \\ <s"),
         (16, "Released under the MIT License. cc BY-nc cc by NC; apache license, VERSION 2.0"),
         (17, "tail\nspdx-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 WITH LLVM-exception\nx")]


def rows():
    return [(i, t, None if i == 4 else "en", f"s{n % 3}", None, 1.0, "kept", "digest", {"a": "b"}) for n, (i, t) in enumerate(TEXTS)]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
