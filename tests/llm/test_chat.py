from __future__ import annotations

import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from pedalmill.llm import chat

MESSAGES = "tree long, node long, parent long, role string, text string, score double"
pieces = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]", "\\", "<", "[", "l", "b", " ",
                                   "\n", "é", "/s>", "INST]", "x"]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), pieces), pieces), max_size=6))
def test_round_trip(turns):
    whole, spans = chat.render(turns)
    assert chat.parse(whole) == turns
    assert [chat.unescape(whole[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert not any(c in chat.escape(t) for _, t in turns for c in chat._CONTROLS)


def brute(rows, per_tree):
    trees = defaultdict(dict)
    for tree, node, parent, role, text, score in rows:
        trees[tree][node] = (parent, role or "", text or "", score or 0.0)
    out = []
    for tree, nodes in trees.items():
        inner = {p for n, (p, *_) in nodes.items() if p in nodes and p != n}
        found = []
        for leaf in set(nodes) - inner:
            path, at, seen = [], leaf, set()
            while at in nodes and at not in seen:
                seen.add(at)
                path.append(at)
                at = nodes[at][0] if nodes[at][0] != at else None
            if at in seen:
                continue
            found.append((-sum(nodes[n][3] for n in path) / len(path), -len(path), leaf, path[::-1]))
        for rank, (score, _, _, path) in enumerate(sorted(found)[:per_tree], 1):
            out.append((tree, rank, round(-score, 9), [nodes[n][1:3] for n in path]))
    return sorted(out, key=str)


def test_branches_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(t, n, rng.randrange(n) if n and rng.random() < .95 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", None, "b", ""]),
             rng.choice([None, rng.random()])) for t in [*range(12), None] for n in range(rng.choice([1, 5, 40]))]
    rows += [(50, n, n - 1, "user", str(n), 0.5) for n in range(1, 301)]  # a long thread under an unknown root
    rows += [(51, n, 0 if n else None, "user", "hot", float(n % 5)) for n in range(400)]  # many replies to one message
    rows += [(52, 1, 2, "user", "x", 1.0), (52, 2, 1, "user", "y", 1.0), (52, 3, 3, "user", "z", 1.0)]  # cycles
    got = chat.branches(spark.createDataFrame(rows, MESSAGES).repartition(4), per_tree=3).collect()
    assert sorted(((r["tree"], r["branch"], round(r["path_score"], 9), [(t["role"], t["text"]) for t in r["turns"]]) for r in got), key=str) == brute(rows, 3)


def test_chains_read_back(spark):
    said = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, "assistant", said), (2, 5, None, said), (None, 0, "user", "x"), (3, 1, "user", "same"),
            (3, 1, "user", "same"), (3, None, "assistant", "y" * 50_000), (-1, 0, "user", said), (-1, 1, "assistant", said), (4, 0, "we\nird", "\\l")]
    rows += [(9, n, "assistant" if n % 2 else "user", f"t{n}") for n in range(150)]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "conv_id long, turn long, role string, text string, node int, score int")
    got = chat.read_back(chat.format_branches(chat.branches(chat.as_chain(df)))).collect()
    want = []
    for conv in {r[0] for r in rows}:
        turns = [(r or "", t or "") for _, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))]
        loss = "".join(t for r, t in turns if r == "assistant")
        want.append((conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest()))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_branches(chat.branches(chat.as_chain(df)))).count() == 0
