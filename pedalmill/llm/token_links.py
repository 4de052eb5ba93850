"""Alignment of two tokenizers: which of their tokens cover the same bytes, and how often over the corpus.

A text is encoded by a byte-level BPE (A) and by a SentencePiece model (B); both cover the text with a space before
it. Byte offsets at which a token of both ends cut the tokens into groups; every A token of a group is linked
with every B token of it.

Encoding. A text is cut at single spaces between two characters that are no white space: the byte-level
pre-tokenizer always cuts there, and no piece of B holds a space behind other characters (checked; otherwise texts
stay whole). Distinct pieces are encoded once per worker, many in one call, and aligned with array operations.

Index. Documents are dealt to blocks of at most ``BLOCK_DOCS``. A block has, for each id pair, a bitmap of its
documents and planes of the multiplicity less one: bit j of that number is set in plane j for the document.
Bitmaps and planes are compressed by container: a list of 16-bit document places where few bits are set, packed
bits where many are. Bitmaps of slices are OR-merged into those of their block; blocks hold different documents,
so the popcounts of their bitmaps add up to a pair's document count, and popcounts of planes, weighted, to its links.

Counting. Blocks send (pair, popcount); Spark sums them by pair and finds the highest of each A id (at most as
many rows as B has ids). Counts go back to the blocks of each pair, and the postings hand them to the
documents. What is shuffled has one row per block and pair, not one per link or document, so a very common pair costs
one row a block.

Defined results: NULL and empty texts, and texts whose A or B bytes are not the text behind a space (such as those that
hold U+2581), have no tokens: all numbers 0 and the digest column empty; repeated rows and NULL ids each count as a
document of their own; texts of any length are encoded whole; ties for the highest all count as best;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
import uuid
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Documents and postings of a block; places in a block have 16 bits.
BLOCK_DOCS, BLOCK_POSTINGS = 16_384, 2_000_000
#: Pieces and bytes of group texts kept per worker.
CACHE_PIECES, CACHE_BYTES = 300_000, 48 << 20
SLICE_DOCS, SLICE_BYTES = 500, 8 << 20
#: Groups with more links than this are counted by distinct ids.
LARGE_GROUP = 64
_CUT = re.compile(r"(?<=\S) (?=\S)")
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


class Tokenizers:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        plain = {c: bytes([b]) for b, c in _byte_letters().items()}
        self.a_bytes = {i: b"".join(plain.get(c, c.encode()) for c in w) for w, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes = np.zeros(max(self.a_bytes) + 1, np.int64)
        self.a_sizes[list(self.a_bytes)] = [len(x) for x in self.a_bytes.values()]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def pieces(self, text: str) -> list[str]:
        """Parts of a text that can be encoded apart, each behind a space."""
        if not self.cuts:
            return [text]
        parts = text.split(" ")
        return parts if parts == text.split() else _CUT.split(text)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B, none where their bytes are not the text behind a space."""
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text, num_threads=1)
        whole = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


@lru_cache(maxsize=1)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def pair_keys(a, b):
    return (a << 32) | b


class PieceLinks:
    """Aligned pieces: numbers of tokens, groups and links, the text of the groups, and id pairs with multiplicities."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.groups: list[str | None] = []  # None: the bytes differ
        self.held = 0
        self.numbers = np.zeros((1024, len(NUMBERS)), np.int64)
        self.starts = np.zeros(1025, np.int64)
        self.keys, self.times = np.zeros(4096, np.int64), np.zeros(4096, np.int64)

    def learn(self, pieces: list[str]) -> None:
        """Align new pieces: those without white space at an end in one call, others one by one."""
        joined = [p for p in pieces if p and not p[0].isspace() and not p[-1].isspace() and "▁" not in p and self.both.cuts]
        found = self.both.encode(" ".join(joined)) if joined else None
        if found is not None:
            self._add(joined, *found)
        rest = set(pieces).difference(self.places)
        for piece in [p for p in pieces if p in rest]:
            ids = self.both.encode(piece)
            if ids is None:
                self._keep(piece, None, np.zeros(len(NUMBERS), np.int64), np.array([], np.int64), np.array([], np.int64))
            else:
                self._add([piece], *ids)

    def _add(self, pieces: list[str], a: np.ndarray, b: np.ndarray) -> None:
        a_ends, b_ends = np.cumsum(self.both.a_sizes[a]), np.cumsum(self.both.b_sizes[b])
        ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_cut, b_cut = (np.concatenate([[0], np.searchsorted(e, ends, "right")]) for e in (a_ends, b_ends))
        piece_ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        last = np.searchsorted(ends, piece_ends)
        if last[-1] >= len(ends) or (ends[last] != piece_ends).any():
            raise ValueError("a tokenizer does not cut at spaces")
        a_text, b_text = list(map(str, a.tolist())), list(map(str, b.tolist()))
        ac, bc = a_cut.tolist(), b_cut.tolist()
        texts = [f"{a_text[i]}|{b_text[j]}" if i1 - i == 1 == j1 - j else ",".join(a_text[i:i1]) + "|" + ",".join(b_text[j:j1])
                 for i, i1, j, j1 in zip(ac, ac[1:], bc, bc[1:])]
        a_n, b_n = np.diff(a_cut), np.diff(b_cut)
        links = a_n * b_n
        # links of small groups: each A token of a group is repeated for each B token of it
        small = links <= LARGE_GROUP
        sizes = np.where(small, links, 0)
        group = np.repeat(np.arange(len(links)), sizes)
        at = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = pair_keys(a[a_cut[group] + at // b_n[group]], b[b_cut[group] + at % b_n[group]])
        times = np.ones(len(keys), np.int64)
        if not small.all():
            extra = [(g, *_large(a[a_cut[g]:a_cut[g + 1]], b[b_cut[g]:b_cut[g + 1]])) for g in np.flatnonzero(~small)]
            group = np.concatenate([group, *[np.full(len(k), g) for g, k, _ in extra]])
            keys, times = np.concatenate([keys, *[k for _, k, _ in extra]]), np.concatenate([times, *[t for _, _, t in extra]])
            order = np.argsort(group, kind="stable")
            group, keys, times = group[order], keys[order], times[order]
        first = np.concatenate([[0], last[:-1] + 1])
        pair_cut = np.searchsorted(group, np.append(first, len(links)))
        numbers = np.stack([a_cut[last + 1] - a_cut[first], b_cut[last + 1] - b_cut[first], last + 1 - first,
                            np.add.reduceat(links, first)], axis=1)
        fresh = len(self.groups)
        self._room(len(pieces), len(keys))
        base = self.starts[fresh]
        self.numbers[fresh:fresh + len(pieces)] = numbers
        self.starts[fresh + 1:fresh + len(pieces) + 1] = base + pair_cut[1:]
        self.keys[base:base + len(keys)], self.times[base:base + len(keys)] = keys, times
        self.groups.extend(";".join(texts[i:j + 1]) for i, j in zip(first.tolist(), last.tolist()))
        self.held += sum(map(len, self.groups[fresh:]))
        self.places.update(zip(pieces, range(fresh, fresh + len(pieces))))

    def _keep(self, piece: str, groups: str | None, numbers: np.ndarray, keys: np.ndarray, times: np.ndarray) -> None:
        fresh = len(self.groups)
        self._room(1, len(keys))
        self.numbers[fresh] = numbers
        base = self.starts[fresh]
        self.starts[fresh + 1] = base + len(keys)
        self.keys[base:base + len(keys)], self.times[base:base + len(keys)] = keys, times
        self.groups.append(groups)
        self.places[piece] = fresh

    def _room(self, pieces: int, keys: int) -> None:
        while len(self.groups) + pieces > len(self.numbers):
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.starts = np.concatenate([self.starts, np.zeros(len(self.starts), np.int64)])
        while self.starts[len(self.groups)] + keys > len(self.keys):
            self.keys, self.times = np.concatenate([self.keys, np.zeros_like(self.keys)]), np.concatenate([self.times, np.zeros_like(self.times)])

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Numbers and group digests of the texts; and (place of the text, id pair, multiplicity), each pair once a text."""
        if len(self.groups) > CACHE_PIECES or self.held > CACHE_BYTES:
            self.clear()
        cut = [self.both.pieces(t) if t else [] for t in texts]
        new = list(dict.fromkeys(p for parts in cut for p in parts if p not in self.places))
        if new:
            self.learn(new)
        get, groups = self.places.__getitem__, self.groups
        numbers, digests, rows = np.zeros((len(texts), len(NUMBERS)), np.int64), [], []
        for i, parts in enumerate(cut):
            at = list(map(get, parts))
            shown = [groups[p] for p in at]
            if not at or None in shown:
                digests.append("")
                continue
            digests.append(sha256(";".join(shown).encode()).hexdigest())
            places, times = np.unique(np.array(at, np.int64), return_counts=True)
            numbers[i] = times @ self.numbers[places]
            rows.append((np.full(len(places), i), places, times))
        if not rows:
            none = np.array([], np.int64)
            return numbers, digests, none, none, none
        doc, place, n = (np.concatenate(c) for c in zip(*rows))
        sizes = self.starts[place + 1] - self.starts[place]
        at = np.arange(sizes.sum()) + np.repeat(self.starts[place] - np.cumsum(sizes) + sizes, sizes)
        return (numbers, digests, *_summed(np.repeat(doc, sizes), self.keys[at], self.times[at] * np.repeat(n, sizes)))


def _large(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs of a group and how many of its links they are."""
    (a, a_n), (b, b_n) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return pair_keys(np.repeat(a, len(b)), np.tile(b, len(a))), np.repeat(a_n, len(b)) * np.tile(b_n, len(a))


def _summed(doc: np.ndarray, key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((key, doc))
    doc, key, times = doc[order], key[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]))
    return doc[first], key[first], np.add.reduceat(times, first)


def _container(pair: np.ndarray, doc: np.ndarray, pairs: int, docs: int) -> tuple[bytes, np.ndarray]:
    """One plane of all pairs (sorted by pair, then document): popcounts, places where few are set, bits where many are."""
    counts = np.bincount(pair, minlength=pairs)
    many = counts * 16 > docs
    dense = many[pair]
    bits = np.zeros((int(many.sum()), docs), bool)
    bits[(np.cumsum(many) - 1)[pair[dense]], doc[dense]] = True
    return counts.astype("<u2").tobytes() + doc[~dense].astype("<u2").tobytes() + np.packbits(bits, axis=1).tobytes(), counts


def _opened(data: bytes, pairs: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    counts = np.frombuffer(data, "<u2", pairs).astype(np.int64)
    many = counts * 16 > docs
    few = np.where(many, 0, counts)
    listed = np.frombuffer(data, "<u2", int(few.sum()), 2 * pairs).astype(np.int64)
    packed = np.frombuffer(data, np.uint8, offset=2 * (pairs + len(listed))).reshape(int(many.sum()), (docs + 7) // 8)
    row, doc = np.nonzero(np.unpackbits(packed, axis=1, count=docs)) if len(packed) else (np.array([], np.int64),) * 2
    return np.concatenate([np.repeat(np.arange(pairs), few), np.flatnonzero(many)[row]]), np.concatenate([listed, doc])


def packed_postings(doc: np.ndarray, key: np.ndarray, times: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Distinct pairs, the popcounts of their document bitmaps, and bitmap and multiplicity planes of all pairs."""
    keys, pair = np.unique(key, return_inverse=True)
    order = np.lexsort((doc, pair))
    pair, doc, more = pair[order], doc[order], times[order] - 1
    bitmap, counts = _container(pair, doc, len(keys), docs)
    planes = [bitmap]
    while more.any():
        bit = (more & 1).astype(bool)
        planes.append(_container(pair[bit], doc[bit], len(keys), docs)[0])
        pair, doc, more = pair[more > 1], doc[more > 1], more[more > 1] >> 1
    return keys, counts, planes


def opened_postings(planes: list[bytes], pairs: int, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the pair, place of the document, share of the multiplicity) of every set bit."""
    parts = [(*_opened(p, pairs, docs), 1 << max(j - 1, 0)) for j, p in enumerate(planes)]
    return (np.concatenate([p for p, _, _ in parts]), np.concatenate([d for _, d, _ in parts]),
            np.concatenate([np.full(len(p), w, np.int64) for p, _, w in parts]))


@lru_cache(maxsize=1)
def piece_links(a_path: str, b_path: str) -> PieceLinks:
    """One per Python worker, so pieces aligned by one task serve the next."""
    return PieceLinks(tokenizers(a_path, b_path))


def _slices(batches):
    """Ids and texts, some hundred documents or some megabytes at a time."""
    for batch in batches:
        texts, start, held = batch.column(1).to_pylist(), 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if i + 1 - start >= SLICE_DOCS or held >= SLICE_BYTES or i + 1 == len(texts):
                yield batch.column(0).slice(start, i + 1 - start), [t.decode("utf-8", "replace") for t in texts[start:i + 1]]
                start, held = i + 1, 0


def _indexer(a_path: str, b_path: str, block_docs: int, block_postings: int):
    def run(batches):
        links = piece_links(a_path, b_path)
        ids, numbers, digests, postings = [], [], [], []

        def block() -> pa.RecordBatch:
            whole, n = np.concatenate(numbers), len(digests)
            keys, counts, planes = packed_postings(*(np.concatenate(c) for c in zip(*postings)), n)
            one = [pa.array([0, n], pa.int32()), pa.array([0, len(keys)], pa.int32())]
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.ListArray.from_arrays(one[0], pa.concat_arrays(ids))]
                + [pa.ListArray.from_arrays(one[0], pa.array(whole[:, i])) for i in range(len(NUMBERS))]
                + [pa.ListArray.from_arrays(one[0], pa.array(digests, pa.string()))]
                + [pa.ListArray.from_arrays(one[1], pa.array(c, t)) for c, t in ((keys >> 32, pa.int32()), (keys & 0xFFFFFFFF, pa.int32()), (counts, pa.int32()))]
                + [pa.array([planes], pa.list_(pa.binary()))],
                ["block", "doc_id", *NUMBERS, "groups_sha256", "a", "b", "n", "planes"])

        for own, texts in _slices(batches):
            n, d, doc, key, times = links.documents(texts)
            if digests and (len(digests) + len(d) > block_docs or sum(len(p[0]) for p in postings) + len(doc) > block_postings):
                yield block()
                ids, numbers, digests, postings = [], [], [], []
            postings.append((doc + len(digests), key, times))
            ids.append(own)
            numbers.append(n)
            digests.extend(d)
        if digests:
            yield block()
    return run


def index(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text",
          block_docs: int = BLOCK_DOCS, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Blocks of aligned documents with their postings, written to the shared folder."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), common.utf8(text).alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{n} array<long>" for n in NUMBERS)
    return common.stored(plain.mapInArrow(_indexer(a_path, b_path, block_docs, block_postings), f"block string, doc_id array<{kind}>, {lists}, "
                                          "groups_sha256 array<string>, a array<int>, b array<int>, n array<int>, planes array<binary>"), "link-blocks")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """One row per block and id pair: ``block``, ``place`` in it, ``a``, ``b``, and ``n`` documents."""
    return blocks.select("block", F.posexplode(F.arrays_zip("a", "b", "n")).alias("place", "pair")).select("block", "place", "pair.*")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a``, ``b``, ``documents`` that hold them linked, and whether that is the highest of ``a``."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("documents"))
    highest = F.max("documents").over(Window.partitionBy("a"))  # at most one row per id of B
    return counts.withColumn("best", F.col("documents") == highest)


def _scorer(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            ids = row.column("doc_id").flatten()
            found = row.column("found").flatten()
            documents, best = (found.field(c).to_numpy(zero_copy_only=False) for c in ("documents", "best"))
            pair, doc, weight = opened_postings(row.column("planes")[0].as_py(), len(documents), len(ids))
            sums, bests = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            np.add.at(sums, doc, weight * documents[pair])
            np.add.at(bests, doc, weight * best[pair])
            yield pa.RecordBatch.from_arrays(
                [ids, *[row.column(c).flatten() for c in NUMBERS], pa.array(bests), pa.array(sums), row.column("groups_sha256").flatten()],
                ["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256"])


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Every row of ``docs``: id, numbers of tokens, groups and links, ``n_best``, ``count_sum`` and ``groups_sha256``."""
    blocks = index(docs, a_path, b_path, id_col, text, **options)
    pairs = block_pairs(blocks)
    found = pairs.drop("n").join(pair_counts(pairs), ["a", "b"]).groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("place", "documents", "best"))).alias("found"))
    rows = blocks.drop("a", "b", "n").join(found, "block", "left").withColumn(
        "found", F.coalesce("found", F.expr("array()").cast("array<struct<place:int,documents:bigint,best:boolean>>")))
    kind = blocks.schema["doc_id"].dataType.elementType.simpleString()
    return rows.mapInArrow(_scorer, f"doc_id {kind}, " + ", ".join(f"{n} long" for n in [*NUMBERS, "n_best", "count_sum"])
                           + ", groups_sha256 string").withColumnRenamed("doc_id", id_col)
