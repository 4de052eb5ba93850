"""Token counts by a linear longest-match automaton.

Greedy word pieces: a word begins with the longest piece of the initial vocabulary and goes on with the
longest piece of the continuation vocabulary; a word that cannot be cut this way is one unknown token. A
trie over both vocabularies gets failure links and, per state, the number of tokens that following the link
pops. Counting then takes one pass over the bytes of a word and builds no piece. With ``lone_space``, as the
query has it, a word that no initial piece fits begins with the piece of a single space, one token, and goes on with
the continuation vocabulary; without it such a word is unknown.

Words are runs without the six ASCII white-space characters; a distinct word is counted once per task.

Defined results: NULL and empty texts have no words and no tokens; repeated rows give repeated results; a
word of any length takes time linear in its length; other columns are not read.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

CACHE_WORDS, CACHE_BYTES = 500_000, 64


class LengthAutomaton:
    """Trie with failure links; states are numbers, 0 starts a word and 1 continues it."""

    def __init__(self, initial: Iterable[bytes], continuation: Iterable[bytes], lone_space: bool = False):
        self.go: list[dict[int, int]] = [{}, {}]
        final = [False, False]
        for root, pieces in ((0, initial), (1, continuation)):
            for piece in pieces:
                state = root
                for byte in piece:
                    nxt = self.go[state].get(byte)
                    if nxt is None:
                        nxt = self.go[state][byte] = len(self.go)
                        self.go.append({})
                        final.append(False)
                    state = nxt
                final[state] = final[state] or bool(piece)
        self.fail: list[int] = [-1] * len(self.go)
        self.popped = [0] * len(self.go)
        if lone_space:  # the space is a token of its own before the continuation
            self.fail[0], self.popped[0] = 1, 1
        todo = deque([1, 0])
        while todo:
            state = todo.popleft()
            for byte, child in self.go[state].items():
                todo.append(child)
                if final[child]:  # the whole way to the child is one token
                    self.fail[child], self.popped[child] = 1, 1
                    continue
                count, back = self.popped[state], self.fail[state]
                while back >= 0 and byte not in self.go[back]:
                    count += self.popped[back]
                    back = self.fail[back]
                if back >= 0:
                    self.fail[child], self.popped[child] = self.go[back][byte], count

    def count(self, word: bytes) -> tuple[int, bool]:
        """Tokens of a word, and whether it is unknown."""
        go, fail, popped = self.go, self.fail, self.popped
        state = tokens = 0
        if not word:
            return 0, False
        for byte in word:
            nxt = go[state].get(byte)
            while nxt is None:
                if fail[state] < 0:
                    return 1, True
                tokens += popped[state]
                state = fail[state]
                nxt = go[state].get(byte)
            state = nxt
        while state != 1:
            if fail[state] < 0:
                return 1, True
            tokens += popped[state]
            state = fail[state]
        return tokens, False


def byte_level_alphabet() -> dict[str, int]:
    """Printable characters that stand for bytes in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def automaton(path: str, lone_space: bool = False) -> LengthAutomaton:
    """From a byte-level vocabulary: pieces that begin with a space start a word, the others continue it.

    ``lone_space`` needs the piece of a single space in the vocabulary.
    """
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    alphabet = byte_level_alphabet()
    pieces = [bytes(alphabet[c] for c in piece) for piece in vocabulary if all(c in alphabet for c in piece)]
    return LengthAutomaton([p[1:] for p in pieces if len(p) > 1 and p[0] == 32 and b" " not in p[1:]],
                           [p for p in pieces if b" " not in p], lone_space and b" " in pieces)


def _counter(path: str, lone_space: bool = False):
    def start():
        machine = automaton(path, lone_space)
        cache: dict[bytes, tuple[int, bool]] = {}

        def work(texts: list[bytes]) -> list[pa.Array]:
            out = []
            for text in texts:
                words = text.split()
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                local = {w: machine.count(w) for w in set(words).difference(cache)}
                cache.update((w, c) for w, c in local.items() if len(w) <= CACHE_BYTES)
                found = [cache[w] if w in cache else local[w] for w in words]
                out.append((len(words), sum(n for n, _ in found), sum(u for _, u in found)))
            columns = list(zip(*out)) or [()] * 3
            return [pa.array(c, pa.int64()) for c in columns]
        return work
    return start


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", lone_space: bool = False) -> DataFrame:
    """``n_words``, ``n_tokens`` and ``n_unknown`` of every document, in one narrow pass."""
    return common.map_bytes(docs, [id_col], text, _counter(vocabulary, lone_space), "n_words long, n_tokens long, n_unknown long")
