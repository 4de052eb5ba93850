from __future__ import annotations

from fractions import Fraction
from hashlib import sha256
from math import floor

import pytest

from pedalmill.llm import vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, ints string, code string, n long"


def brute(rows, parts=8, entries=16, rounds=6):
    """The contract in plain Python, for kept rows of one length."""
    kept = sorted(((i, [max(min(floor(Fraction(x) * 4096), 2 ** 26), -2 ** 26) for x in v], lab) for i, v, lab in rows),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            near = [nearest(books[p], row[p])[1] for row in cut]
            for e in set(near):
                own = [row[p] for row, k in zip(cut, near) if k == e]
                books[p] = [[sum(c) // len(own) for c in zip(*own)] if k == e else c for k, c in enumerate(books[p])]
    digest = sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [[nearest(books[p], row[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    return [(i, "".join(f"{e:02x}" for _, e in f), err, sum(x for x, r in zip(errors, kept) if r[2] == lab), digest)
            for (i, _, lab), f, err in zip(kept, found, errors)]


def result(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", None, 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(df, **options).collect()), key=str)


def vectors(n, seed=7, dims=16):
    state, out = seed, []
    for i in range(n):
        v = []
        for _ in range(dims):
            state = (state * 6364136223846793005 + 1442695040888963407) % 2 ** 64
            v.append((state >> 40) / 2 ** 23 - 1)
        out.append((i, v, None if i % 5 == 0 else i % 3))
    return out


@pytest.mark.parametrize("n", [1, 9, 16, 60])
def test_equals_brute_force(spark, n):
    rows = vectors(n)
    assert result(spark, rows) == sorted(brute(rows), key=str)


def test_awkward_rows(spark):
    rows = vectors(40)
    rows += [(3, rows[8][1], 1), (3, rows[3][1], rows[3][2]), (None, rows[5][1], None), (50, [1e300] * 16, 1), (51, [-1e-300] * 16, 1), (52, [0.0] * 16, 2)]
    bad = [(60, None, 1), (61, [], 1), (62, [None] + [0.5] * 15, 1), (63, [float("nan")] * 16, None), (64, [float("inf")] * 16, 1), (-9, [1.0] * 8, 1)]
    assert result(spark, rows + bad) == sorted(brute(rows), key=str)


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(i % 2)] * 8, 0) for i in range(40)]
    got = result(spark, rows)
    assert got == sorted(brute(rows), key=str)
    assert {r[1] for r in got} == {"00" * 8, "01" * 8}


def test_blocks_and_odd_length(spark):
    rows = vectors(30, dims=11)
    whole = result(spark, rows)
    assert len(whole) == 30 and all(len(r[1]) == 16 for r in whole)
    assert result(spark, rows, size=4) == whole


def test_empty_table(spark):
    assert result(spark, []) == [] and vector_codes.compress(spark.createDataFrame([], SCHEMA)).columns == [
        "vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert result(spark, [(1, None, 1)]) == []
