from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pedalmill.llm import exact_dedup

from . import edge


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, keep[t or ""], len(groups[t or ""]), i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=str)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.crc32(c.cast("binary")) % 2], ids=["sha", "colliding"])
def test_groups_equal_brute_force(spark, digest):
    many = [(100 + i, f"copy {i % 7}" if i % 3 else "hot") for i in range(3000)]
    df = edge.docs(spark).select("doc_id", "text", "score", "kept").unionByName(
        spark.createDataFrame([(i, t, 0.0, "") for i, t in many], "doc_id long, text string, score double, kept string"))
    got = exact_dedup.duplicate_groups(df, digest=digest)
    assert sorted(map(tuple, got.collect()), key=str) == brute([*edge.TEXTS, *many])


def test_distinct_rows_keep_whole_rows(spark):
    df = edge.docs(spark)
    got = exact_dedup.distinct_rows(df)
    assert got.columns == df.columns
    winners = {}
    for row in df.collect():
        rank = lambda r: (r["doc_id"] or -1, r["lang"] or "", r["source"])
        best = winners.get(row["text"] or "")
        if best is None or rank(row) > rank(best):
            winners[row["text"] or ""] = row
    assert sorted(map(str, got.collect())) == sorted(map(str, winners.values()))


def test_empty_table(spark):
    assert exact_dedup.duplicate_groups(edge.empty(spark)).count() == 0
    assert exact_dedup.distinct_rows(edge.empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = exact_dedup.duplicate_groups(edge.docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
