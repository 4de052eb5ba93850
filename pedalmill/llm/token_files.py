"""Token-id files: Parquet list columns in document order, for selective reads.

A file row holds ``doc_id``, ``n_tokens`` and ``ids array<int>``. Rows are in ascending ``doc_id`` order
across and within files, ids are dictionary-encoded (or delta-encoded), row groups and pages are small and
carry column and offset indexes, so one document's tokens or the metadata alone can be read without the
rest. Documents are ordered by range before encoding; nothing but the texts is shuffled, once. Files are numbered, and
read in the order of their numbers.

Encoding uses the tokenizers library as it is loaded, so strings of its special tokens inside texts get their ids. A text is cut at single
spaces between two non-space characters, where the byte-level pre-tokenizer always cuts; Arrow finds the distinct pieces of a slice of
texts, the library encodes those that are new to the worker in one call, and array operations put the ids of the texts
together. Texts with other white space around a cut, with strings of special tokens, or with pieces beyond
``CACHE_CHARS`` go to the library whole.

Defined results: NULL and empty texts hold just the end id; NULL ids come first; rows with the same id are
ordered by text, and split over files where there are many; an empty table gives files without rows;
other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

END_ID = 2
#: Pieces kept per worker, and the longest text of such a piece.
CACHE_PIECES, CACHE_CHARS = 250_000, 64
#: Texts of a slice: rows and bytes.
SLICE_ROWS, SLICE_BYTES = 2_000, 2 << 20
#: Marks that may follow a word, and two white spaces in a row of which one stands between pieces.
MARKS = ".,;:!?"
_JOINT = re.compile(r" \s|\s ")
#: Characters of a text by which rows of one id are dealt to files.
ORDER_CHARS = 32
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 256 << 10, 2_000


def _gathered(store: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``store`` one after the other."""
    ends = np.cumsum(sizes)
    return store[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class PieceEncoder:
    """Ids of whole texts, from stored ids of their space-separated pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        words = self.tokenizer.get_vocab()
        self.starts = np.zeros(max(words.values()) + 1, bool)  # ids of tokens that begin with a space
        self.starts[[i for w, i in words.items() if w.startswith(space)]] = True
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}  # piece -> its run of ids after a space
        self.run = np.zeros((2, CACHE_PIECES * 2), np.int64)  # start and size of runs
        self.uses = np.zeros(CACHE_PIECES * 2, np.int64)  # slices that held the piece
        self.ids, self.held = np.zeros(1 << 20, np.int32), 0

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    def _put(self, ids: np.ndarray) -> int:
        """Append to the stored ids; where they begin."""
        while self.held + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.held:self.held + len(ids)] = ids
        self.held += len(ids)
        return self.held - len(ids)

    def _name(self, pieces: list[str], starts: np.ndarray, sizes: np.ndarray) -> None:
        fresh = len(self.places)
        while fresh + len(pieces) > self.run.shape[1]:
            self.run = np.concatenate([self.run, np.zeros_like(self.run)], axis=1)
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.places.update(zip(pieces, range(fresh, fresh + len(pieces))))
        self.run[0, fresh:fresh + len(pieces)], self.run[1, fresh:fresh + len(pieces)] = starts, sizes

    def _learn(self, pieces: list[str]) -> None:
        """One library call for all new pieces; only a piece's first token begins with a space.

        A mark after a letter is a token run of its own, so words are learned without the marks behind them.
        """
        cores = [(p, c) for p in pieces if p[-1] in MARKS and (c := p.rstrip(MARKS)) and c[-1].isalpha()]
        marked = {p for p, _ in cores}
        plain = list(dict.fromkeys([p for p in pieces if p not in marked] + [c for _, c in cores if c not in self.places]))
        if plain:
            ids = self._whole(" " + " ".join(plain))
            cuts = np.flatnonzero(self.starts[ids])
            if len(cuts) != len(plain):
                raise ValueError("the pre-tokenizer does not cut at spaces")
            self._name(plain, self._put(ids) + cuts, np.diff(cuts, append=len(ids)))
        if cores:
            marks = list({p[len(c):] for p, c in cores})
            encoded = [self._whole(m) for m in marks]
            at = dict(zip(marks, np.cumsum([0, *map(len, encoded)])[:-1] + self._put(np.concatenate(encoded))))
            size = dict(zip(marks, map(len, encoded)))
            core = self.run[:, [self.places[c] for _, c in cores]]
            tails = [p[len(c):] for p, c in cores]
            starts = np.stack([core[0], [at[m] for m in tails]], axis=1)
            sizes = np.stack([core[1], [size[m] for m in tails]], axis=1)
            whole = sizes.sum(axis=1)
            base = self._put(_gathered(self.ids, starts.ravel(), sizes.ravel()))
            self._name([p for p, _ in cores], base + np.cumsum(whole) - whole, whole)

    def _forget(self) -> None:
        """Keep pieces that several slices held, if they leave room."""
        kept = [(p, i) for p, i in self.places.items() if self.uses[i] > 1]
        if len(kept) > CACHE_PIECES // 2:
            kept = []
        starts, sizes = self.run[:, [i for _, i in kept]]
        ids, uses = _gathered(self.ids, starts, sizes), self.uses[[i for _, i in kept]]
        self._clear()
        if kept:
            self._name([p for p, _ in kept], self._put(ids) + np.cumsum(sizes) - sizes, sizes)
            self.uses[:len(kept)] = np.minimum(uses, 1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number for each text."""
        if len(self.places) > CACHE_PIECES:
            self._forget()
        split = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.cumsum(counts) - counts
        coded = split.flatten().dictionary_encode()
        word, names = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        doc = np.repeat(np.arange(len(counts)), counts)
        inner = np.ones(len(word), bool)
        inner[first] = False
        heads = [names[i] for i in word[first]]
        # A cut is safe between two non-space characters; stored pieces have been found safe before.
        whole = np.array([n > 1 and (not h or h[-1].isspace()) for h, n in zip(heads, counts)], bool)
        for mark in self.special:
            whole |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        met = np.zeros(len(names), bool)
        met[word[inner & ~whole[doc]]] = True
        place = np.fromiter(map(self.places.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(met & (place < 0)).tolist()
        if not _safe([names[i] for i in new]):
            unsafe = np.zeros(len(names), bool)
            unsafe[[i for i in new if not _safe([names[i]])]] = True
            whole[doc[inner & unsafe[word]]] = True
            met[:] = False
            met[word[inner & ~whole[doc]]] = True
            new = [i for i in new if met[i]]
        if new:
            fresh = [names[i] for i in new]
            self._learn(fresh)
            place[new] = np.fromiter(map(self.places.__getitem__, fresh), np.int64, len(fresh))
        self.uses[place[met]] += 1
        starts, sizes = (run[place[word]] for run in self.run)
        sizes[~inner | whole[doc]] = 0
        # first pieces and whole texts stand behind the stored ids, for this slice only
        held = self.held
        begun = self.tokenizer.encode_batch_fast([h for h, w in zip(heads, whole) if not w], add_special_tokens=False)
        own = [np.array(h.ids, np.int32) for h in begun]
        at = first[~whole]
        for k in np.flatnonzero(whole).tolist():
            own.append(self._whole(texts[k].as_py()))
        at = np.concatenate([at, first[whole]])
        own_sizes = np.array([len(x) for x in own], np.int64)
        starts[at], sizes[at] = self._put(np.concatenate([np.array([], np.int32), *own])) + np.cumsum(own_sizes) - own_sizes, own_sizes
        ids = _gathered(self.ids, starts, sizes)
        self.held = held
        return ids, np.add.reduceat(sizes, first) if len(first) else sizes


def _safe(pieces: list[str]) -> bool:
    return not pieces or not _JOINT.search(f" {' '.join(pieces)} ") and max(map(len, pieces)) <= CACHE_CHARS


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, so pieces learned by one task serve the next."""
    return PieceEncoder(path)


def _strings(column: pa.Array) -> pa.Array:
    """UTF-8 bytes as text; bytes that are no UTF-8 are replaced."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in column.to_pylist()], pa.string())


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    held = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        least = held[start - 1] if start else 0
        end = max(start + 1, min(int(np.searchsorted(held, least + SLICE_BYTES)), start + SLICE_ROWS))
        yield batch.slice(start, end - start)
        start = end


def _encoder(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in batches:
            for rows in _slices(batch):
                ids, sizes = encoder.encode(_strings(rows.column("text")))
                ends = np.cumsum(sizes)
                values = np.insert(ids, ends, np.int32(end_id))
                offsets = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sizes + 1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))],
                                                 ["doc_id", "n_tokens", "ids"])
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, encoding: str = "dictionary",
                 id_col: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` and write the files to ``path``; ``encoding`` is ``dictionary`` or ``delta``."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    ordered = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
               .repartitionByRange("doc_id", F.substring("text", 1, ORDER_CHARS)).sortWithinPartitions("doc_id", "text"))
    kind = ordered.schema["doc_id"].dataType.simpleString()
    rows = ordered.select("doc_id", common.utf8("text").alias("text")).mapInArrow(
        _encoder(tokenizer, end_id), f"doc_id {kind}, n_tokens long, ids array<int>")
    options = {"compression": "snappy", "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES,
               "parquet.page.row.count.limit": PAGE_ROWS, "parquet.writer.version": "PARQUET_2_0",
               "parquet.enable.dictionary": str(encoding == "dictionary").lower(), "parquet.dictionary.page.size": 1 << 20}
    rows.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; ``ids`` reads only the pages of these documents, column choice only those columns."""
    rows = spark.read.schema("doc_id long, n_tokens long, ids array<int>").parquet(path)
    return rows if ids is None else rows.filter(F.col("doc_id").isin(ids))


def _digests(batches):
    for batch in batches:
        ids = batch.column("ids")
        values, offsets = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("file"), batch.column("row"), pa.array(np.diff(offsets).astype(np.int64)),
             pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])], pa.int64())],
            ["doc_id", "file", "row", "n_tokens", "ids_crc32"])


def file_number(name: str = "file"):
    """Number of a file in the order in which the files were written."""
    return F.regexp_extract(name, r"part-(\d+)", 1).cast("long")


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document: how many ids the files hold before it, its number of ids and their checksum.

    Running totals are per file (a file holds a bounded part of the rows); one row per file gives the
    totals before each file.
    """
    rows = read_tokens(spark, path).select("doc_id", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"), "ids")
    rows = rows.mapInArrow(_digests, "doc_id long, file string, row long, n_tokens long, ids_crc32 long")
    rows = common.stored(rows, "token-index")
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy(file_number(), "file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(files, "file")
            .select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"))
