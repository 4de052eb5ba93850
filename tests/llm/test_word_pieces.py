from __future__ import annotations

import json
import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from pedalmill.llm import word_pieces

from . import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


def greedy(word, initial, continuation):
    if not word:
        return 0, False
    at = n = 0
    while at < len(word):
        known = continuation if at else initial
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 1, True
        at, n = end, n + 1
    return n, False


pieces = st.sets(st.text("abc", min_size=1, max_size=4).map(str.encode), max_size=12)


@settings(max_examples=400, deadline=None)
@given(pieces, pieces, st.text("abcd", max_size=14).map(str.encode))
def test_automaton_equals_greedy(initial, continuation, word):
    assert word_pieces.LengthAutomaton(initial, continuation).count(word) == greedy(word, initial, continuation)


def test_query_vocabulary_equals_greedy(spark):
    alphabet = word_pieces.byte_level_alphabet()
    vocab = [bytes(alphabet[c] for c in p) for p in json.load(open(PATH))["model"]["vocab"] if all(c in alphabet for c in p)]
    initial = {p[1:] for p in vocab if p[:1] == b" " and len(p) > 1 and b" " not in p[1:]}
    continuation = {p for p in vocab if b" " not in p}
    longest = max(map(len, initial | continuation))

    def count(text):
        words = (text or "").encode().split()
        total = unknown = 0
        for w in words:
            at = n = 0
            while at < len(w):
                known = continuation if at else initial
                end = next((e for e in range(min(len(w), at + longest), at, -1) if w[at:e] in known), None)
                if end is None:
                    n, at = 1, len(w)
                    unknown += 1
                else:
                    n, at = n + 1, end
            total += n
        return len(words), total, unknown

    got = sorted(map(tuple, word_pieces.count_tokens(edge.docs(spark), PATH).collect()), key=str)
    assert got == sorted(((i, *count(t)) for i, t in edge.TEXTS), key=str)
    real = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    df = spark.createDataFrame(real, "doc_id long, text string")
    assert sorted(map(tuple, word_pieces.count_tokens(df, PATH).collect())) == sorted((i, *count(t)) for i, t in real)


def test_long_word_is_linear():
    machine = word_pieces.automaton(PATH)
    assert machine.count(b"ab" * 500_000)[0] > 1000


def test_random_words_have_random_lengths():
    rng = random.Random(1)
    machine = word_pieces.automaton(PATH)
    assert all(1 <= machine.count(bytes(rng.choices(range(33, 127), k=k)))[0] <= k for k in range(1, 40))


def test_empty_table(spark):
    assert word_pieces.count_tokens(edge.empty(spark), PATH).count() == 0


@settings(max_examples=400, deadline=None)
@given(pieces, pieces, st.text("abcd", max_size=14).map(str.encode))
def test_lone_space_automaton_equals_greedy(initial, continuation, word):
    got = word_pieces.LengthAutomaton(initial, continuation, lone_space=True).count(word)
    if word and not any(word.startswith(p) for p in initial):
        n, unknown = greedy(word, continuation, continuation)
        assert got == ((1, True) if unknown else (n + 1, False))
    else:
        assert got == greedy(word, initial, continuation)


def test_words_without_an_initial_piece(spark):
    words = ["рука", "тест", "สวัสดีชาวโลก", "中国人民", "\x00x", "hello"]
    df = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in word_pieces.count_tokens(df, PATH, lone_space=True).collect()}
    plain = word_pieces.automaton(PATH)
    rest = word_pieces.LengthAutomaton(continued := [p for p in pieces_of(PATH) if b" " not in p], continued)
    for n, word in enumerate(words):
        tokens, unknown = plain.count(word.encode())
        assert unknown == (word != "hello")
        assert got[n]["n_unknown"] == 0 and got[n]["n_tokens"] == (1 + rest.count(word.encode())[0] if unknown else tokens)


def pieces_of(path):
    alphabet = word_pieces.byte_level_alphabet()
    return [bytes(alphabet[c] for c in p) for p in json.load(open(path))["model"]["vocab"] if all(c in alphabet for c in p)]
