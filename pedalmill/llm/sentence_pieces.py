"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces and their scores come from a model file; a text's encoding is the cut with the largest sum of
log scores. Files of merge models hold negative ranks, from which log scores follow by Zipf's law,
``-log(rank + 1)``; scores of unigram models are used as they are. Spaces are the white-space marker, one marker is put before the text, and a
character without a piece of its own costs ``UNKNOWN_COST`` below the smallest score and is written as the
byte pieces of its UTF-8 form. Of cuts with equal sums the one whose last differing piece is longer wins.

No piece has a marker after another character, so a best cut never crosses the place before a run of
markers. The text is cut there, and distinct parts are solved once per worker, many at a time.

Decoding joins the pieces, turns byte pieces back into bytes and markers into spaces and drops the first
marker: every text comes back exactly. A marker character that stands in the text itself is written as
bytes, so it does not turn into a space.

Defined results: NULL and empty texts have no ids and decode to an empty text; repeated rows give repeated
results; the time is linear in the length of a text; other columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

MARKER = "▁"
UNKNOWN_COST = 10.0
CACHE_PARTS, CACHE_BYTES = 150_000, 64
BATCH_PARTS = 10_000
_PARTS = re.compile(rb" *[^ ]+| +")


class DoubleArray:
    """Byte trie in two integer arrays: the child of ``s`` by ``c`` is ``base[s] + c`` if ``check`` of it is ``s``."""

    def __init__(self, keys: list[bytes]):
        children: list[dict[int, int]] = [{}]
        value = [-1]
        for number, key in enumerate(keys):
            node = 0
            for byte in key:
                nxt = children[node].get(byte)
                if nxt is None:
                    nxt = children[node][byte] = len(children)
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = number
        size = 2 * len(children) + 1024
        base, check, values = [0] * size, [-1] * size, [-1] * size
        taken = bytearray(size)
        place = [0] * len(children)
        slots = dense = 257  # slot 0 is the root; bases stay positive
        # Nodes with many children are the hard ones to place; single children fill the holes left.
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            codes = sorted(children[node])
            if not codes:
                break
            if len(codes) > 1:
                start = dense
                while any(taken[start + c - codes[0]] for c in codes):
                    start += 1
                if start > dense + 200:
                    dense = start - 100
            else:
                slots = start = taken.index(0, slots)
            base_of = start - codes[0]
            if start + 1024 > len(taken):
                grow = len(taken)
                base, check, values = base + [0] * grow, check + [-1] * grow, values + [-1] * grow
                taken += bytes(grow)
            for code in codes:
                taken[base_of + code] = 1
                place[children[node][code]] = base_of + code
            children[node][-1] = base_of
        for node, kids in enumerate(children):
            values[place[node]] = value[node]
            base[place[node]] = kids.pop(-1, 0)
            for child in kids.values():
                check[place[child]] = place[node]
        self.base, self.check, self.values = base, check, values
        self.arrays = np.array(base), np.array(check + [-1] * 256), np.array(values + [-1] * 256)

    def prefixes(self, text: bytes, start: int) -> list[tuple[int, int]]:
        """(end, key number) of every key that begins at ``start``."""
        base, check, values = self.base, self.check, self.values
        node, found, limit = 0, [], len(check)
        for at in range(start, len(text)):
            nxt = base[node] + text[at]
            if nxt >= limit or check[nxt] != node:
                break
            node = nxt
            if values[node] >= 0:
                found.append((at + 1, values[node]))
        return found


class Unigram:
    """Encoder and decoder for (piece, score) pairs and the ids of the 256 byte pieces."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int]):
        self.trie = DoubleArray([p.replace(MARKER, " ").encode() for _, p, _ in pieces])
        self.ids = [i for i, _, _ in pieces]
        self.scores = [s for _, _, s in pieces]
        self.id_array, self.score_array = np.array(self.ids, np.int32), np.array(self.scores, float)
        self.unknown = min(self.scores, default=0.0) - UNKNOWN_COST
        self.byte_ids = byte_ids
        self.bytes_of = {i: p.replace(MARKER, " ").encode() for i, p, _ in pieces}
        self.bytes_of |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        crossing = re.compile("[^ ] ")
        self.parts = _PARTS if not any(crossing.search(p.replace(MARKER, " ")) for _, p, _ in pieces) else re.compile(rb"(?s).+")

    def best_cut(self, part: bytes) -> list[int]:
        """Ids of the best cut of ``part``, in which a space is a marker."""
        n = len(part)
        best: list[float | None] = [None] * (n + 1)
        came: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        best[0] = 0.0
        for at in range(n):
            here = best[at]
            if here is None:
                continue
            first = part[at]
            step = at + (1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4)
            single = False
            for end, key in self.trie.prefixes(part, at):
                single = single or end == step
                score = here + self.scores[key]
                if best[end] is None or score > best[end]:
                    best[end], came[end] = score, (at, self.ids[key])
            if not single:
                score = here + self.unknown
                if best[step] is None or score > best[step]:
                    best[step], came[step] = score, (at, -1)
        ids: list[int] = []
        at = n
        while at:
            start, piece = came[at]
            ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(part[start:at])]
            at = start
        return ids[::-1]

    def best_cuts(self, parts: list[bytes]) -> list[bytes]:
        """``best_cut`` of many short parts at once, as int32 bytes: all parts take each step together."""
        base, check, values = self.trie.arrays
        sizes = np.array([len(p) for p in parts])
        width = int(sizes.max())
        text = np.frombuffer(b"".join(p.ljust(width + 1, b"\0") for p in parts), np.uint8).reshape(len(parts), width + 1)
        best = np.full((len(parts), width + 4), -np.inf)
        came = np.zeros((len(parts), width + 4), np.int32)
        piece = np.full((len(parts), width + 4), -1, np.int32)
        best[:, 0] = 0.0

        def offer(rows, end, score, start, ids):
            better = score > best[rows, end]
            rows, end = rows[better], end[better] if np.ndim(end) else end
            best[rows, end], came[rows, end], piece[rows, end] = score[better], start, ids[better] if np.ndim(ids) else ids

        for at in range(width):
            reached = np.flatnonzero((sizes > at) & (best[:, at] > -np.inf))
            first = text[reached, at]
            step = at + 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
            single = np.zeros(len(reached), bool)
            live, node, end = np.arange(len(reached)), np.zeros(len(reached), int), at
            while len(live):
                rows = reached[live]
                child = base[node] + text[rows, end]
                on = (check[child] == node) & (sizes[rows] > end)
                live, node, rows, end = live[on], child[on], rows[on], end + 1
                hit = values[node] >= 0
                keys, rows = values[node[hit]], rows[hit]
                offer(rows, end, best[rows, at] + self.score_array[keys], at, self.id_array[keys])
                single[live[hit]] |= step[live[hit]] == end
            alone = reached[~single]
            offer(alone, step[~single], best[alone, at] + self.unknown, at, -1)
        rows, at, backwards = np.arange(len(parts)), sizes.copy(), []
        while (at > 0).any():
            backwards.append(np.where(at > 0, piece[rows, at], -2))
            at = np.where(at > 0, came[rows, at], 0)
        ordered = np.stack(backwards[::-1], axis=1)
        used = ordered != -2
        data, ends = ordered[used].tobytes(), 4 * np.cumsum(used.sum(axis=1))
        cut = [data[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for n in np.flatnonzero((ordered == -1).any(axis=1)):  # characters without a piece
            cut[n] = np.array(self.best_cut(parts[n]), np.int32).tobytes()
        return cut

    def encode(self, texts: list[bytes], cache: dict[bytes, bytes]) -> list[np.ndarray]:
        """Ids of whole texts; ``cache`` keeps the ids of short parts as int32 bytes."""
        if len(cache) > CACHE_PARTS:
            cache.clear()
        split = [self.parts.findall(b" " + t) if t else [] for t in texts]
        new = set().union(*split).difference(cache)
        long = {p: np.array(self.best_cut(p), np.int32).tobytes() for p in new if len(p) > CACHE_BYTES}
        short = sorted(new.difference(long), key=len)
        for start in range(0, len(short), BATCH_PARTS):
            some = short[start:start + BATCH_PARTS]
            cache.update(zip(some, self.best_cuts(some)))
        get = (lambda p: cache.get(p) or long[p]) if long else cache.__getitem__
        return [np.frombuffer(b"".join(map(get, parts)), np.int32) for parts in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:]


def log_scores(scores: list[float]) -> list[float]:
    """Log scores as they are; whole non-positive numbers are negative ranks."""
    if all(s <= 0 and s == int(s) for s in scores):
        return [-math.log(1 - s) for s in scores]
    return scores


@lru_cache(maxsize=4)
def model(path: str) -> Unigram:
    """Pieces and log scores of a SentencePiece model file with byte fallback."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.get_piece_size()
    used = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    plain = list(zip(used, map(sp.id_to_piece, used), log_scores(list(map(sp.get_score, used)))))
    by_byte = {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(size) if sp.is_byte(i)}
    return Unigram(plain, [by_byte[b] for b in range(256)])


@lru_cache(maxsize=4)
def part_cache(path: str) -> dict[bytes, bytes]:
    """One cache per Python worker, so parts solved by one task serve the next."""
    return {}


def _as_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.array([], np.int32)))


def _encoder(path: str):
    def start():
        unigram, cache = model(path), part_cache(path)

        def work(texts: list[bytes]) -> list[pa.Array]:
            return [_as_lists(unigram.encode(texts, cache))]
        return work
    return start


def encode(docs: DataFrame, model_path: str, keys: list[str], text: str = "text", out: str = "ids") -> DataFrame:
    """``keys`` and the piece ids of each whole text, in one narrow pass."""
    return common.map_bytes(docs, keys, text, _encoder(model_path), f"{out} array<int>")


def decode(rows: DataFrame, model_path: str, keys: list[str], ids: str = "ids", out: str = "text") -> DataFrame:
    """``keys`` and the text that the ids stand for; NULL ids count as none."""
    before = rows.select(*[f"`{k}`" for k in keys], f"`{ids}`")
    schema = type(before.schema)(before.schema.fields[:-1] + rows.sparkSession.createDataFrame([], f"{out} string").schema.fields)

    def run(batches):
        unigram = model(model_path)
        for whole in batches:
            for start in range(0, whole.num_rows, common.SLICE_ROWS):
                batch = whole.slice(start, common.SLICE_ROWS)
                texts = [b"" if x is None else unigram.decode(x.to_numpy(zero_copy_only=False).tolist())
                         for x in (v.values for v in batch.column(batch.num_columns - 1))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
                                                 [f.name for f in schema.fields])

    return before.mapInArrow(run, schema)
