from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pedalmill.llm import neighbours

SCHEMA = "vec_id long, embedding array<double>, label int, node string, rank int"
QUERY = "vec_id % 50 = 0"


def brute(rows, top=5, every=50):
    ids = sorted({i for i, _ in rows})
    best = {}
    for i, v in rows:
        best[i] = min(best.get(i, v), v)
    x = np.array([best[i] for i in ids])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for n, i in enumerate(ids):
        if i % every == 0:
            score = (x @ x[n]) / norm / norm[n]
            out[i] = sorted(((-round(s, 12), j) for s, j in zip(score, ids) if j != i))[:top]
    return out


def found(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], -round(r["score"], 12), r["vec_id"]))
    return {q: [(s, v) for _, s, v in sorted(rows)] for q, rows in got.items()}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n", 2) for i, v in rows], SCHEMA).repartition(4)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(120)]
    hot = [float(x) for x in rng.normal(size=8)]
    rows += [(200 + i, hot) for i in range(30)]  # equal vectors, a query among them
    rows += [(300 + i, [3 * x for x in hot]) for i in range(3)]  # same direction, other length
    rows += [(400 + i, [hot[0] + 1e-4 * i, *hot[1:]]) for i in range(60)]  # near copies
    rows += [(7, rows[7][1]), (50, [9.0] * 8)]  # a repeated row, and an id with two vectors
    got = found(neighbours.nearest(frame(spark, rows), QUERY))
    assert got == brute(rows)


def test_rows_that_take_no_part(spark):
    good = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (2, [-1.0, 0.0]), (50, [2.0 ** -700] * 2), (3, [2.0 ** 900] * 2)]
    bad = [(4, None), (5, []), (6, [0.0, 0.0]), (8, [1.0, None]), (9, [1.0, float("nan")]), (100, [float("inf"), 1.0]), (None, [1.0, 1.0]), (11, [1.0, 0.0, 0.0])]
    assert found(neighbours.nearest(frame(spark, good + bad), QUERY)) == brute(good)
    assert neighbours.nearest(frame(spark, bad[:3]), QUERY).count() == 0
    assert neighbours.nearest(frame(spark, [(0, [1.0, 2.0])]), QUERY).count() == 0


def test_recall_and_growth_of_the_graph(spark, monkeypatch):
    """With blocks, beams and lists far smaller than the table, the graph still finds nine in ten."""
    for name, value in {"BLOCK": 150, "CHUNK": 24}.items():
        monkeypatch.setattr(neighbours, name, value)
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    df = frame(spark, rows)
    got, want = found(neighbours.nearest(df, QUERY, degree=16, beam=80)), brute(rows)
    assert got.keys() == want.keys()
    recall = np.mean([len({v for _, v in got[q]} & {v for _, v in want[q]}) / 5 for q in want])
    assert recall >= 0.9
    nodes, _ = neighbours.make_nodes(neighbours.usable(df, "vec_id", "embedding"))
    sums = []
    graph = neighbours.start_graph(nodes, 12)
    for _ in range(3):
        sums.append(graph.agg(F.sum("sim")).first()[0])
        graph = neighbours.descend(graph, nodes, 12)
    sums.append(graph.agg(F.sum("sim")).first()[0])
    assert sums == sorted(sums) and sums[-1] > sums[0]
    assert graph.groupBy("u").count().agg(F.max("count")).first()[0] == 12


def test_more_near_copies_than_the_beam_holds(spark, monkeypatch):
    """Vectors closer than half precision, dealt in small blocks and chunks, and many more than a beam."""
    for name, value in {"BLOCK": 60, "CHUNK": 24}.items():
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8)
    rows = [(i, [float(x) for x in hot + 3e-4 * rng.normal(size=8)]) for i in range(700)]
    got, want = found(neighbours.nearest(frame(spark, rows), QUERY, degree=16, beam=60)), brute(rows)
    recall = np.mean([len({v for _, v in got[q]} & {v for _, v in want[q]}) / 5 for q in want])
    assert recall >= 0.95


def test_rounds_go_on_until_few_edges_are_fresh(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.default_rng(4)
    df = frame(spark, [(i, [float(x) for x in rng.normal(size=12)]) for i in range(600)])
    nodes, _ = neighbours.make_nodes(neighbours.usable(df, "vec_id", "embedding"))
    graph = neighbours.build(nodes, rounds=0, degree=8)
    assert graph.agg(F.avg(F.col("fresh").cast("int"))).first()[0] < neighbours.LEAST_FRESH


def test_empty_table(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA), QUERY).count() == 0
