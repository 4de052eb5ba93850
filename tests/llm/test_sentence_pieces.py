from __future__ import annotations

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from pedalmill.llm import sentence_pieces as sp

from . import edge

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "ab▁é"
vocab = st.dictionaries(st.text(LETTERS, min_size=1, max_size=4), st.floats(-9, -0.5).map(lambda x: round(x, 3)), max_size=14)


def best_score(text, pieces, unknown):
    """Exhaustive dynamic programme over all cuts."""
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = []
        for start in range(end):
            piece = text[start:end]
            if piece in pieces:
                options.append(best[start] + pieces[piece])
            elif end - start == 1:
                options.append(best[start] + unknown)
        best[end] = max(options)
    return best[-1]


@settings(max_examples=400, deadline=None)
@given(vocab, st.text("ab é", min_size=1, max_size=12))
def test_cut_has_the_best_sum(pieces, text):
    items = sorted(pieces.items())
    model = sp.Unigram([(1000 + n, p, s) for n, (p, s) in enumerate(items)], list(range(256)))
    ids = model.encode([text.encode()], {})[0].tolist()
    assert model.decode(ids) == text.encode()
    parts = model.parts.findall(b" " + text.encode())
    assert ids == [i for p in parts for i in model.best_cut(p)]
    shown = "▁" + text.replace(" ", "▁")
    score, pending = 0.0, 0
    for i in ids:
        if i >= 1000:
            score += items[i - 1000][1]
        elif i < 0x80 or i >= 0xC0:  # first byte of an unknown character
            score += model.unknown
    assert abs(score - best_score(shown, pieces, model.unknown)) < 1e-6


@settings(max_examples=200, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5), max_size=40), st.binary(max_size=12))
def test_double_array_finds_all_prefixes(keys, text):
    keys = sorted(keys)
    trie = sp.DoubleArray(keys)
    for start in range(len(text)):
        assert {keys[k]: e for e, k in trie.prefixes(text, start)} == {k: start + len(k) for k in keys if text.startswith(k, start)}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_round_trip(text):
    model = sp.model(PATH)
    assert model.decode(model.encode([text.encode("utf-8", "replace")], {})[0].tolist()) == text.encode("utf-8", "replace")


def test_library_decodes_the_same(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    model = sp.model(PATH)
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert library.decode(model.encode([row["text"].encode()], {})[0].tolist()) == row["text"]


def test_tables(spark):
    docs = edge.docs(spark).select("doc_id", "text", "score")
    rows = sp.encode(docs, PATH, ["doc_id", "text"])
    back = sp.decode(rows, PATH, ["doc_id", "text", "ids"], out="decoded").collect()
    assert len(back) == len(edge.TEXTS)
    assert all(r["decoded"] == (r["text"] or "") and bool(r["ids"]) == bool(r["text"]) for r in back)
    assert sp.encode(edge.empty(spark), PATH, ["doc_id"]).count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["text"] for r in sp.decode(none, PATH, ["doc_id"]).collect()] == ["", ""]
