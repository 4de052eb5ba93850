from __future__ import annotations

import struct
import zlib

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from pedalmill.llm import token_files
from pedalmill.llm.common import scratch_path

from . import edge

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def brute(rows, tokenizer):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_files_equal_library(spark, tokenizer, encoding):
    real = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    odd = ["a b", "a \nb", " a", "a ", "a\n b", "it's 5 o'clock", "x  y", "<|endoftext|> x", "a <|endoftext|> b", "a<|endoftext|>", "word, word. word! word?! word.x word", "é è ê", "1 2 3", "a b c", "tab\t x", "\x1c a"]
    rows = edge.TEXTS + [(1000 + i, t) for i, t in real] + [(5000 + i, t) for i, t in enumerate(odd)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int").repartition(5)
    path = scratch_path(spark, "t")
    token_files.write_tokens(df, path, PATH, encoding=encoding)
    got = sorted(map(tuple, token_files.document_index(spark, path).collect()), key=lambda r: r[1])
    assert got == brute(rows, tokenizer)
    assert [r["ids"] for r in token_files.read_tokens(spark, path, [5000]).collect()] == [tokenizer.encode("a b").ids + [2]]
    from pathlib import Path
    files = sorted(Path(path.removeprefix("file:")).glob("part-*"))
    column = next(m for m in (pq.ParquetFile(f).metadata for f in files) if m.num_row_groups).row_group(0)
    ids = column.column(column.num_columns - 1)
    assert ids.has_offset_index and ids.has_column_index
    assert any(("DICT" in e) == (encoding == "dictionary") and ("DICT" in e or "DELTA" in e) for e in ids.encodings)


def test_worker_cache_forgets(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_PIECES", 40)
    encoder = token_files.PieceEncoder(PATH)
    for k in range(12):
        texts = [" ".join(f"w{i % 7}, v{i * k}. again u{k}x{i}!" for i in range(9)), "", "a", " lead", "x y"]
        ids, sizes = encoder.encode(pa.array(texts, pa.string()))
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]
        assert len(encoder.places) < 150


def test_files_are_read_by_number(spark):
    rows = spark.createDataFrame([("part-100000-a.parquet",), ("part-99999-a.parquet",), ("part-00010-a.parquet",)], "file string")
    assert [r["file"][5:11] for r in rows.orderBy(token_files.file_number(), "file").collect()] == ["00010-", "99999-", "100000"]


def test_many_rows_of_one_id(spark, tokenizer):
    rows = [(None if i % 3 else 5, f"text {i % 50} of many " + "x " * (i % 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = scratch_path(spark, "t")
    token_files.write_tokens(df, path, PATH)
    got = sorted(map(tuple, token_files.document_index(spark, path).collect()), key=lambda r: r[1])
    assert got == brute(rows, tokenizer)


def test_empty_table(spark):
    path = scratch_path(spark, "t")
    token_files.write_tokens(edge.empty(spark), path, PATH)
    assert token_files.document_index(spark, path).count() == 0
    with pytest.raises(ValueError):
        token_files.write_tokens(edge.empty(spark), path, PATH, encoding="plain")
