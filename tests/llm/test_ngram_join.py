from __future__ import annotations

import random
import re

import numpy as np
import pytest

from pedalmill.llm import ngram_join

from . import edge


def brute(rows):
    """Shingle sets, all pairs, and components by repeated merging."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * min(len(sets[i]), len(sets[j])) >= 4 * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, len(s), least.get(g)) for g, s, (i, _) in zip(group, sets, rows)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(400)
    rows, n = list(edge.TEXTS), 1000
    for _ in range(15):
        base = [word() for _ in range(rng.choice([6, 30, 120, 300]))]
        for _ in range(rng.choice([2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy).upper() if n % 2 else "\n".join(copy)))
            n += 1
    # a passage that many otherwise different texts share, a chain whose ends are not alike, many edited copies of one text
    passage = [f"p{i}" for i in range(60)]
    rows += [(2000 + i, " ".join(passage + [f"q{i}x{j}" for j in range(8 + i % 9)])) for i in range(60)]
    chain = [f"c{i}" for i in range(200)]
    rows += [(3000 + i, " ".join(chain[i * 10:i * 10 + 100])) for i in range(8)]
    base = [f"e{i}" for i in range(150)]
    rows += [(4000 + i, " ".join(w if rng.random() > 0.015 else word() for w in base)) for i in range(60)]
    rng.shuffle(rows)
    return rows


def result(spark, rows):
    df = spark.createDataFrame([(t, i, "x", 1) for i, t in rows], "text string, doc_id long, label string, n int").repartition(6)
    return sorted(map(tuple, ngram_join.join(df).collect()), key=str)


@pytest.mark.parametrize("seed, hubs, spread", [(11, 256, 32 << 20), (5, 7, 700)])
def test_components_equal_brute_force(spark, monkeypatch, seed, hubs, spread):
    monkeypatch.setattr(ngram_join, "HUBS", hubs)
    monkeypatch.setattr(ngram_join, "RANGE_BYTES", spread)  # many token ranges
    rows = corpus(seed)
    assert result(spark, rows) == brute(rows)


def test_exact_threshold_and_null_ids(spark):
    base = [f"t{i}" for i in range(49)]  # 45 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:40])), (3, " ".join(base[:39])), (None, " ".join(base)), (None, "alone here"), (9, None), (9, "a"), (9, "b")]
    assert 36 * 100 >= 80 * 45 > 35 * 100
    got = result(spark, rows)
    assert got == brute(rows) and (2, 36, 1) in got and (3, 35, 1) in got and (None, 45, 1) in got
    assert (3, 35, 3) in result(spark, [rows[0], rows[2]])


def test_prefix_size_leaves_no_link_out():
    for n in range(1, 400):
        for size in range(n * 4 // 5, n * 5 // 4 + 2):
            need = -(-ngram_join.UNION * (n + size) // (ngram_join.INTERSECTION + ngram_join.UNION))
            assert n - ngram_join.prefix_size(n) < need or 4 * max(n, size) > 5 * min(n, size)


def test_prefixes_keep_places():
    tokens, totals = np.arange(10, 30, dtype=np.uint64), np.array([1, 1, 3, 1] * 5)
    found = ngram_join.prefixes(tokens, totals)
    assert found is None  # 15 tokens of a single set fill the prefix of 5
    found = ngram_join.prefixes(tokens, np.array([1, 2] + [5] * 18))
    assert found[0][0] == 11 and found[1] == [19, 18, 17, 16]


def test_empty_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None), (2, " \n"), (2, "")]) == [(1, 0, 1), (2, 0, 2), (2, 0, 2)]
