"""Vector code compression by parts, with distances from per-dimension value dictionaries.

Each component x becomes the integer floor(4096 x). Vectors are cut into ``PARTS`` consecutive parts, each part
position has a codebook of ``ENTRIES`` entries, and a vector's code names the nearest entry of every part.

Storage. Vectors are packed into blocks of at most ``BLOCK`` vectors. A block holds, per dimension, the sorted
dictionary of its distinct integers and every vector's 16-bit place in it. Dictionaries belong to a block, so
their size is bounded by it and nothing about values is collected or broadcast.

Distances. For a codebook, the squared differences of every distinct integer of a dimension to that dimension's
entries are tabulated once per block; the distances of all parts to all entries are then gathers by dictionary
place and adds over the dimensions of the part.

Training. The first entries are the parts of the vectors with the ``ENTRIES`` smallest ids. A round assigns all
parts and replaces entries by the componentwise floor of the mean; tasks send sums per entry and component, so
the driver holds ``PARTS * ENTRIES`` entries and nothing else. Blocks are written to the shared folder; a lost
executor costs a rerun of its tasks.

Defined results: vectors that are NULL, empty, or hold a NULL or non-finite component, and vectors of another
length than most (of equally many, the longer) take no part; NULL ids come last and rows with equal ids are
ordered by their integers when first entries are chosen; every row of repeated ids gets its code; integers beyond +-``LIMIT`` count as
that bound, so that sums of squares stay exact; ties go to the lower entry; fewer vectors than entries give smaller
codebooks; a length that is no multiple of the parts gives parts whose sizes differ by one; an empty table
gives no rows. Other columns are not read, labels of any type are compared as text.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
BLOCK = 16_384
LIMIT = 2 ** 26

#: One codebook per part: entries by row, components of the part by column.
Codebooks = list[np.ndarray]


def usable(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id``, ``label`` (text) and ``ints`` of the rows that take part."""
    plain = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"),
                        F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    plain = plain.filter("size(vector) > 0").filter(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))
    lengths = plain.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).select("length")
    kept = plain.join(F.broadcast(usual), F.size("vector") == F.col("length"), "left_semi")
    whole = F.transform("vector", lambda x: F.floor(F.greatest(F.least(x * F.lit(float(SCALE)), F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return kept.select("vec_id", "label", whole.alias("ints"))


def _bounds(length: int, parts: int) -> list[int]:
    return [i * length // parts for i in range(parts + 1)]


def _packer(size: int):
    """Blocks of a task's vectors: ids, labels, dictionaries and 16-bit places."""
    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        n = rows.num_rows
        ints = rows.column("ints").chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        values, sizes, places = [], [], np.empty((ints.shape[1], n), np.uint16)
        for d in range(ints.shape[1]):
            distinct, places[d] = np.unique(ints[:, d], return_inverse=True)
            values.append(distinct.astype("<i4"))
            sizes.append(len(distinct))
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows.column(c).chunk(0)) for c in ("vec_id", "label")]
            + [pa.array([sizes], pa.list_(pa.int32())), pa.array([np.concatenate(values).tobytes()], pa.binary()),
               pa.array([places.astype("<u2").tobytes()], pa.binary())],
            ["vec_id", "label", "sizes", "dictionaries", "places"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for whole in batches:
            for start in range(0, whole.num_rows, size):
                piece = whole.slice(start, size)
                if held and sum(b.num_rows for b in held) + piece.num_rows > size:
                    yield block(held)
                    held.clear()
                held.append(piece)
        if held:
            yield block(held)
    return run


def packed(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of at most ``size`` (65,536 at most) ``usable`` rows, written to the shared folder."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    return common.stored(rows.mapInArrow(
        _packer(size), f"vec_id array<{kind}>, label array<string>, sizes array<int>, dictionaries binary, places binary"), "vector-blocks")


def _blocks(batches):
    """Each block as its Arrow row, dictionaries per dimension and places (dimension by vector)."""
    for batch in batches:
        for i in range(batch.num_rows):
            sizes = np.array(batch.column("sizes")[i].as_py(), np.int64)
            values = np.frombuffer(batch.column("dictionaries")[i].as_py(), "<i4")
            places = np.frombuffer(batch.column("places")[i].as_py(), "<u2").reshape(len(sizes), -1)
            yield batch.slice(i, 1), np.split(values, np.cumsum(sizes)[:-1]), places


def assign(values: list[np.ndarray], places: np.ndarray, codebooks: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries (part by vector, ties to the lower one) and their squared distances."""
    codes = np.empty((len(codebooks), places.shape[1]), np.int64)
    least = np.empty_like(codes)
    bounds = _bounds(len(values), len(codebooks))
    for part, entries in enumerate(codebooks):
        total = np.zeros((places.shape[1], len(entries)), np.int64)
        for at, d in enumerate(range(bounds[part], bounds[part + 1])):
            table = (values[d].astype(np.int64)[:, None] - entries[None, :, at]) ** 2
            total += table[places[d]]
        codes[part] = total.argmin(axis=1)
        least[part] = total[np.arange(len(total)), codes[part]]
    return codes, least


def _summer(codebooks: Codebooks):
    """Sums and numbers of the parts of every entry, one set of rows per task."""
    def run(batches):
        bounds, sums, counts = None, None, None
        for _, values, places in _blocks(batches):
            if bounds is None:
                bounds = _bounds(len(values), len(codebooks))
                sums = [np.zeros(c.shape, np.int64) for c in codebooks]
                counts = [np.zeros(len(c), np.int64) for c in codebooks]
            codes, _ = assign(values, places, codebooks)
            for part, entries in enumerate(codebooks):
                counts[part] += np.bincount(codes[part], minlength=len(entries))
                for at, d in enumerate(range(bounds[part], bounds[part + 1])):
                    np.add.at(sums[part][:, at], codes[part], values[d][places[d]].astype(np.int64))
        if bounds is None:
            return
        rows = [(p, e, at, int(sums[p][e, at]), int(counts[p][e])) for p, c in enumerate(codebooks)
                for e in range(len(c)) if counts[p][e] for at in range(c.shape[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
                                         ["part", "entry", "place", "total", "n"])
    return run


def first_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors with the smallest ids; none for an empty table."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    if not first:
        return []
    whole = np.array([r["ints"] for r in first], np.int64)
    bounds = _bounds(whole.shape[1], parts)
    return [whole[:, a:b] for a, b in zip(bounds, bounds[1:])]


def train(blocks: DataFrame, codebooks: Codebooks, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` of assigning all parts and moving every used entry to the floor of their mean."""
    for _ in range(rounds):
        sums = blocks.mapInArrow(_summer(codebooks), "part int, entry int, place int, total long, n long")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
                                                          F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
        codebooks = [c.copy() for c in codebooks]
        for r in sums.collect():  # one row per entry and component
            codebooks[r["part"]][r["entry"], r["place"]] = int(r["total"]) // int(r["n"])
    return codebooks


def codebook_digest(codebooks: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and place."""
    return sha256(",".join(str(x) for c in codebooks for e in c for x in e.tolist()).encode()).hexdigest()


def _coder(codebooks: Codebooks):
    hexed = np.array([f"{i:02x}" for i in range(256)], "U2")

    def run(batches):
        for row, values, places in _blocks(batches):
            codes, least = assign(values, places, codebooks)
            n = places.shape[1]
            yield pa.RecordBatch.from_arrays(
                [row.column("vec_id").flatten(), row.column("label").flatten(),
                 pa.array(np.ascontiguousarray(hexed[codes].T).view(f"U{2 * len(codebooks)}").reshape(n).tolist(), pa.string()),
                 pa.array(least.sum(axis=0))], ["vec_id", "label", "code", "error"])
    return run


def encode(blocks: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hex digits a part) and ``error`` of every vector."""
    kind = blocks.schema["vec_id"].dataType.elementType.simpleString()
    return blocks.mapInArrow(_coder(codebooks), f"vec_id {kind}, label string, code string, error long")


def compress(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
             size: int = BLOCK) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` (of equal labels) and ``codebooks_sha256`` of every vector."""
    kept = usable(rows, id_col, vector, label)
    blocks = packed(kept, size)
    codebooks = train(blocks, first) if (first := first_codebooks(kept)) else []
    coded = encode(blocks, codebooks).withColumn("label", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    coded = common.stored(coded, "vector-codes")
    labels = common.stored(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("size")), "vector-labels")
    found = common.join_by_hot_key(coded, labels, "label", "size")
    return found.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(codebooks)).alias("codebooks_sha256"))
