from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pedalmill.llm import mixing

from . import edge


def brute(rows, rounds=mixing.ROUNDS, power=mixing.TEMPERATURE):
    """rows: (id, text, lang, source) -> {(source, lang, topic): chance}."""
    def cell(text, lang, source):
        marks = [(len(re.findall(p, text or "")), -n, name) for n, (name, p) in enumerate(sorted(mixing.TOPICS.items()), 1)]
        return source or "\0", lang or "\0", max([(0, 0, mixing.OTHER_TOPIC), *marks])[2]
    weight = defaultdict(float)
    for _, text, lang, source in rows:
        weight[cell(text, lang, source)] += len(re.findall(mixing.WORD, text or ""))
    goals = []
    for d in range(3):
        sums = defaultdict(float)
        for c, w in weight.items():
            sums[c[d]] += w
        up = {k: s ** power for k, s in sums.items() if s}
        goals.append({k: u / sum(up.values()) * sum(weight.values()) for k, u in up.items()})
    fitted = dict(weight)
    for _ in range(rounds):
        for d in range(3):
            sums = defaultdict(float)
            for c, w in fitted.items():
                sums[c[d]] += w
            fitted = {c: w * goals[d][c[d]] / sums[c[d]] if sums[c[d]] else 0.0 for c, w in fitted.items()}
    ratio = {c: fitted[c] / w if w else 0.0 for c, w in weight.items()}
    return {c: r / max(ratio.values()) for c, r in ratio.items()}, fitted, goals, cell


def drawn(ident, chance):
    digest = hashlib.md5(f"{'null' if ident is None else ident}/mix".encode()).hexdigest()
    return int(digest[:13], 16) / 16 ** 13 < chance


def test_chances_equal_brute_force(spark):
    extra = [(100 + n, "word " * (n % 9) + ["", "12 34", "a@b.c", "License"][n % 4], ["en", "de", None][n % 3], "hot" if n % 3 else f"s{n % 4}") for n in range(400)]
    rows = [(r[0], r[1], r[2], r[3]) for r in edge.rows()] + extra
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, chance double")
    want, _, _, cell = brute(rows)
    got = mixing.chances(df, mixing.fit(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        chance = want[cell(r["text"], r["lang"], r["source"])]
        assert r["__chance"] == pytest.approx(chance, abs=2e-9) and r["__drawn"] == drawn(r["doc_id"], round(chance, 9))


def test_fitted_margins_meet_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cells = mixing.fit(docs).collect()
    _, _, goals, _ = brute([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()])
    for d, name in enumerate(["__source", "__lang", "__topic"]):
        sums = defaultdict(float)
        for c in cells:
            sums[c[name]] += c["fitted"]
        for k, goal in goals[d].items():
            assert sums[k] == pytest.approx(goal, rel=0.01)


def test_given_targets(spark):
    df = spark.createDataFrame([(n, "a b c", ["en", "de"][n % 4 == 0], f"s{n % 2}") for n in range(2000)], "doc_id long, text string, lang string, source string")
    langs = spark.createDataFrame([("en", 0.5), ("de", 0.5)], "lang string, share double")
    kept = mixing.sample(df, mixing.fit(df, {"lang": langs}))
    assert kept.columns == df.columns
    counts = {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()}
    assert abs(counts["en"] - counts["de"]) < 0.2 * counts["de"]


def test_without_words_or_rows(spark):
    blank = edge.docs(spark).filter("text IS NULL OR text = ''")
    assert mixing.sample(blank, mixing.fit(blank)).count() == 0
    assert mixing.sample(edge.empty(spark), mixing.fit(edge.empty(spark))).count() == 0


def test_plan_has_no_python(spark):
    df = edge.docs(spark)
    plan = mixing.chances(df, mixing.fit(df))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def rare_cell(spark):
    """Two sources that differ in language, and one document of a source and language of its own."""
    rows = [(n, "a b c d", ["en", "de"][n % 3 == 0], f"s{n % 2}") for n in range(3000)] + [(9000, "a b", "xx", "rare")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_rare_cell_does_not_throttle_the_others(spark):
    df = rare_cell(spark)
    total = 3000 * 4 + 2
    cells = mixing.common.stored(mixing.fit(df, least=0.6), "cells")
    rows = {(c["__source"], c["__lang"]): c for c in cells.collect()}
    assert sum(c["weight"] * c["chance"] for c in rows.values()) == pytest.approx(0.6 * total, rel=1e-4)
    assert rows["rare", "xx"]["chance"] == 1.0 and all(0 < c["chance"] <= 1 for c in rows.values())
    report = {(r["dimension"], r["value"]): r for r in mixing.report(cells).collect()}
    assert report["source", "rare"]["gap"] > 0.1 and report["source", "s0"]["gap"] < 0.01 and report["lang", "de"]["gap"] < 0.01


def test_budget_beyond_all_tokens(spark):
    assert {c["chance"] for c in mixing.fit(rare_cell(spark), budget=1e9).collect()} == {1.0}
    assert mixing.fit(edge.empty(spark), budget=10).count() == 0


def test_linked_targets_are_raked_until_they_fit_or_the_gap_is_told(spark):
    rows = [(n, "a b c", ["en", "de"][n % 50 == 0], f"s{n % 2 if n % 50 else 0}") for n in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    langs = spark.createDataFrame([("en", 0.98), ("de", 0.02)], "lang string, share double")
    sources = spark.createDataFrame([("s0", 0.1), ("s1", 0.9)], "source string, share double")
    goals = {"lang": langs, "source": sources}
    told = mixing.report(mixing.fit(df, goals, budget=3000.0), goals)
    assert told.filter("dimension != 'topic'").agg(F.max("gap")).first()[0] < 0.001
    apart = {"lang": langs, "source": spark.createDataFrame([("s0", 0.01), ("s1", 0.99)], "source string, share double")}
    told = mixing.report(mixing.fit(df, apart, budget=3000.0), apart)
    assert told.agg(F.max("gap")).first()[0] > 0.1
