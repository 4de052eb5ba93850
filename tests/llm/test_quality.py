from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from pedalmill.llm import quality
from pedalmill.llm.common import table

from . import edge

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    ranking = quality.fit(docs, labels)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality.scored(docs, ranking).select("doc_id", quality.held_out(F.col("doc_id")).alias("h"), "__score").collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    test = [(r["__score"], truth[r["doc_id"]]) for r in rows if r["h"] and r["doc_id"] in truth]
    good, bad = [s for s, y in test if y], [s for s, y in test if not y]
    assert len(bad) > 5 and sum(g > b for g in good for b in bad) / len(good) / len(bad) > 0.97
    assert sum((s >= quality.CUT_SCORE) == bool(y) for s, y in test) / len(test) > 0.95


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("quality", (quality.held_out(F.col("doc_id")).cast("int") + labels["quality"]) % 2)
    assert quality.fit(docs, labels) == quality.fit(docs, flipped)


def test_awkward_documents(spark):
    docs = edge.docs(spark)
    labels = spark.createDataFrame([(i, q, 0) for i, q in [(1, 1), (2, 0), (4, 1), (4, 1), (5, 0), (5, 1), (8, 1), (9, None), (13, 0), (None, 1)]], "doc_id long, quality int, text int")
    got = quality.scored(docs, quality.fit(docs, labels)).collect()
    assert len(got) == len(edge.TEXTS) and all(0 <= r["__score"] <= 1 for r in got)
    assert len({r["__score"] for r in got if not r["text"]}) == 1
    assert got[0].asDict().keys() >= {"score", "kept", "digest", "tree"}


def test_without_labels(spark):
    docs, none = edge.docs(spark), spark.createDataFrame([], "doc_id long, quality int")
    assert {round(r["__score"], 9) for r in quality.scored(docs, quality.fit(docs, none)).collect()} == {0.3}
    assert quality.scored(edge.empty(spark), quality.fit(edge.empty(spark), none)).count() == 0
