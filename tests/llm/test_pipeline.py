from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pedalmill.llm import sentence_pieces

from . import edge
from .test_mixing import brute as mixing_chances
from .test_mixing import drawn
from .test_near_dedup import brute as near_groups

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: tuple(r) for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.common.stored(stage(spark, docs, SF), name)
        results.append(sorted(map(tuple, docs.collect())))
    good = {r[0] for r in results[0]}
    assert sum((i in good) == bool(q) for i, q in labels.items()) > 0.95 * len(labels)
    assert results[0] == sorted(r for i, r in rows.items() if i in good)
    last = {}
    for r in results[0]:
        last[r[1]] = max(r, last.get(r[1], r))
    assert results[1] == sorted(last.values())
    kept = {i for i, _, _, k in near_groups([r[:2] for r in results[1]]) if k}
    assert results[2] == [r for r in results[1] if r[0] in kept]
    chances, _, _, cell = mixing_chances([r[:4] for r in results[2]])
    assert results[3] == [r for r in results[2] if drawn(r[0], round(chances[cell(r[1], r[2], r[3])], 9))]
    model = sentence_pieces.model(public_tokenizers.path("piece_bpe_32k.model"))
    assert [(r[0], r[1], r[2]) for r in results[4]] == [(r[0], r[2], r[3]) for r in results[3]]
    for r, source in zip(results[4], results[3]):
        assert r[4] == len(r[3]) and model.decode(r[3]).decode() == source[1]


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_awkward_and_empty_tables(spark, stage):
    docs = edge.docs(spark)
    out = stage[1](spark, docs, SF)
    assert out.columns == docs.columns or stage is corpus_pipeline.STAGES[-1]
    assert out.count() <= len(edge.TEXTS)
    assert stage[1](spark, edge.empty(spark), SF).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_extra_columns_of_any_name_come_back(spark, stage):
    names = ["__text", "__score", "__content", "__digest", "__source", "extra0", "TEXT", "rows", "chosen"]
    base = edge.docs(spark)
    docs = base.select("*", *[F.concat(F.lit(f"{n}="), F.md5(F.coalesce("text", F.lit("null"))), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for n in names])
    out = stage[1](spark, docs, SF)
    assert out.columns == docs.columns
    plain = out.toDF(*base.columns, *[f"x{i}" for i in range(len(names))])
    wrong = plain.filter(" OR ".join(f"x{i} IS NULL OR x{i} != concat('{n}=', md5(coalesce(text, 'null')), coalesce(string(doc_id), '-'))" for i, n in enumerate(names)))
    assert wrong.isEmpty() and plain.count() == stage[1](spark, base, SF).count()


def test_near_copies_leave_one_row_of_each_group(spark):
    words = lambda k: [f"{k}{i}" for i in range(60)]
    near = lambda k, n: " ".join([*words(k)[:-1], f"end{n}"])
    rows = [(1, near("a", 0)), (2, near("a", 1)), (2, "something else entirely"),  # a repeated id with different texts
            (5, near("b", 0)), (5, near("b", 1)), (5, near("b", 2)),  # copies that share the smallest id
            (None, near("c", 0)), (None, near("c", 1)), (None, "no id and alone"),  # no ids
            (7, near("d", 0)), (7, near("d", 0)), (8, near("d", 1))]  # a repeated row
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").repartition(3)
    out = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted((str(i), t.split()[0]) for i, t, _, _ in out) == sorted(
        [("1", "a0"), ("2", "something"), ("5", "b0"), ("None", "c0"), ("None", "no"), ("7", "d0")])
