from __future__ import annotations

import random
import re

import numpy as np
import pytest

from pedalmill.llm import near_dedup
from pedalmill.llm.components import connected_components

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
            if sets[i] and sets[j] and 4 * min(len(sets[i]), len(sets[j])) >= 3 * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
    out = []
    for n, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if group[m] == group[n] and rows[m][0] is not None]
        component = min(ids, default=None)
        out.append((i, len(sets[n]), component, component == i))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    word = lambda: "w%d" % rng.randrange(400)
    rows, n = list(edge.TEXTS), 1000
    for _ in range(15):
        base = [word() for _ in range(rng.choice([8, 30, 120]))]
        for _ in range(rng.choice([2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n, " ".join(copy).upper() if n % 2 else "\n".join(copy)))
            n += 1
    # a passage that many otherwise different texts share, and a chain whose ends are not alike
    passage = [f"p{i}" for i in range(60)]
    rows += [(2000 + i, " ".join(passage + [f"q{i}x{j}" for j in range(12 + i % 5)])) for i in range(90)]
    chain = [f"c{i}" for i in range(200)]
    rows += [(3000 + i, " ".join(chain[i * 12:i * 12 + 100])) for i in range(8)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hubs", [near_dedup.HUBS, 7])
def test_groups_equal_brute_force(spark, monkeypatch, hubs):
    monkeypatch.setattr(near_dedup, "HUBS", hubs)
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, n int, class string").repartition(4)
    got = sorted(map(tuple, near_dedup.near_duplicate_groups(df).collect()), key=str)
    assert got == brute(rows)


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.75, 0.9):
        both, rest = int(2000 * share), 2000 - int(2000 * share)
        pool = rng.integers(0, 2 ** 63, both + rest, dtype=np.uint64)
        a, b = pool[:both + rest // 2], np.concatenate([pool[:both], pool[both + rest // 2:]])
        agree = np.mean(near_dedup.signature(a) == near_dedup.signature(b))
        assert abs(agree - share) < 0.13


def test_empty_table(spark):
    assert near_dedup.near_duplicate_groups(edge.empty(spark)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["class"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: g for v, g in label.items() if any(a != b and v in (a, b) for a, b in edges)}
