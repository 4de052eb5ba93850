from __future__ import annotations

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from pedalmill.llm import token_links

from . import edge

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a b", "a \nb", " a", "a ", "\n", "   ", "a\n b", "x  y", "<|endoftext|> x </s> <s> <unk> <0x0A>", "é è 漢字 漢", "a▁b", "tab\t x",
       "\x1c a", "  b", "end  x", "don't 12 34", "Straße naïve  ", "𝒳 𝒴 😀😀", "x" * 3000, "ab" * 500 + " c", "\x00", "a ́b"]


@pytest.fixture(scope="module")
def both():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def _a_bytes(letters):
    shown = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    table, more = {}, 0
    for b in range(256):
        table[chr(b) if b in shown else chr(256 + more)] = b
        more += b not in shown
    return bytes(table[c] for c in letters)


def _ends(sizes):
    return np.cumsum(sizes).tolist()


def brute_groups(text, both):
    """Groups of whole texts, token by token."""
    if not text:
        return []
    a, m = both
    whole = b" " + text.encode()
    enc = a.encode(" " + text, add_special_tokens=False)
    ids, pieces = m.encode(text), [m.id_to_piece(i) for i in m.encode(text)]
    ab = [_a_bytes(t) for t in enc.tokens]
    bb = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids, pieces)]
    if b"".join(ab) != whole or b"".join(bb) != whole:
        return []
    ae, be = _ends(list(map(len, ab))), _ends(list(map(len, bb)))
    groups, i, j = [], 0, 0
    for end in sorted(set(ae) & set(be)):
        i1, j1 = ae.index(end) + 1, be.index(end) + 1
        groups.append((enc.ids[i:i1], ids[j:j1]))
        i, j = i1, j1
    return groups


def brute(rows, both):
    docs = [(i, brute_groups(t, both)) for i, t in rows]
    pairs = [Counter() for _ in docs]
    for k, (_, groups) in enumerate(docs):
        for a, b in groups:
            for (x, n), (y, m) in ((p, q) for p in Counter(a).items() for q in Counter(b).items()):
                pairs[k][x, y] += n * m
    counts = Counter(p for c in pairs for p in c)
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    return [(i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), sum(n for p, n in c.items() if counts[p] == top[p[0]]),
             sum(n * counts[p] for p, n in c.items()),
             sha256(";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g).encode()).hexdigest() if g else "")
            for (i, g), c in zip(docs, pairs)]


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, t, None, 1) for i, t in rows], "doc_id long, text string, block string, a int").repartition(5)
    return sorted(map(tuple, token_links.align(df, A, B, **options).collect()), key=str)


def test_awkward_texts_equal_brute_force(spark, both):
    rows = [(i, t) for i, t in edge.TEXTS if t is None or len(t) < 20_000] + [(100 + i, t) for i, t in enumerate(ODD)]
    assert result(spark, rows) == sorted(brute(rows, both), key=str)


def test_documents_equal_brute_force(spark, both):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t[:20_000]) for i, t in rows]
    want = sorted(brute(rows, both), key=str)
    assert result(spark, rows) == want
    assert result(spark, rows, block_docs=7, block_postings=900) == want


def test_whole_texts_of_any_length(spark, both):
    text = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    (got,) = result(spark, [(1, text)])
    a, m = both
    assert got[1:3] == (len(a.encode(" " + text).ids), len(m.encode(text))) and got[4] == got[6] >= got[5] > 0


def test_large_groups_count_links_by_distinct_ids():
    keys, times = token_links._large(np.array([5, 5, 7]), np.array([1, 2, 1, 1]))
    assert dict(zip(keys.tolist(), times.tolist())) == {(5 << 32) | 1: 6, (5 << 32) | 2: 2, (7 << 32) | 1: 3, (7 << 32) | 2: 1}


def test_postings_keep_documents_and_multiplicities():
    rng = np.random.default_rng(3)
    seen = sorted({(int(d), int(k)) for d, k in zip(rng.integers(0, 90, 3000), rng.zipf(1.3, 3000) % 50)})
    doc, key = np.array(seen).T
    times = rng.integers(1, 40, len(doc))
    keys, counts, planes = token_links.packed_postings(doc, key, times, 90)
    pair, at, weight = token_links.opened_postings(planes, len(keys), 90)
    back = Counter()
    for p, d, w in zip(pair, at, weight):
        back[int(d), int(keys[p])] += int(w)
    assert back == Counter(dict(zip(seen, times.tolist())))
    assert counts.tolist() == [sum(k == x for _, x in seen) for k in keys]


def test_empty_table(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, None), (1, None), (None, "")]) == [(1, 0, 0, 0, 0, 0, 0, "")] * 2 + [(None, 0, 0, 0, 0, 0, 0, "")]
