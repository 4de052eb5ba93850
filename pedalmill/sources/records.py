"""CSV records of text files, with line breaks inside quoted cells, read in parallel.

Spark deals a text file to tasks by byte ranges (splits) and hands out its lines. Whether a line begins inside a
quoted cell depends on everything before it, so files with such cells are scanned speculatively:

1. One scan finds the files in which some line ends inside a cell. All others are read as lines.
2. A second scan of these files makes each split a function from the state before it to the state after it (parity, but for
   quotes that do not open or close a cell), by scanning under both assumptions: that the split begins outside, or inside a
   quoted cell. Only lines with a quote are looked at, and one row per split is kept.
3. Composing the functions along a file gives the state at each split: the last constant function before it, then the
   parity of negations since. It also gives the split in which a record that is open at a split's end begins.
4. A third scan, with the state at each split known, writes the records that lie within a split. Of those that cross splits it
   writes one fragment per split; only the fragments are shuffled and joined.

A quote opens a cell only at the cell's beginning and closes it only before a comma or the end of the line; ``""`` stands
for a quote; other quotes are text. A record that is still open at the end of its file has no closing
quote: its lines are records of their own, so a stray quote does not swallow the rest of a file. Line breaks
inside cells are kept as they are; a carriage return at the end of a record is dropped, and blank records
are too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import durable, input_bytes, ship_package

#: A task reads at least so many bytes of lines, whatever the size of splits, unless cores would stay idle.
TASK_BYTES = 64 << 20


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after the line."""
    line = line.rstrip("\r")
    at = 0
    while True:
        if not inside:
            if at >= len(line):
                return False
            if line[at] == '"':
                inside, at = True, at + 1
            else:
                comma = line.find(",", at)
                if comma < 0:
                    return False
                at = comma + 1
                continue
        while inside:
            quote = line.find('"', at)
            if quote < 0:
                return True
            after = line[quote + 1:quote + 2]
            if after == '"':
                at = quote + 2
            elif after in ("", ","):
                inside, at = False, quote + 2
                if not after:
                    return False
            else:
                at = quote + 1


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of the files with their path and split, in the order of the files; a task takes many small splits."""
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    return lines.coalesce(max(3 * spark.sparkContext.defaultParallelism, -(-input_bytes(lines) // TASK_BYTES)))


def _opening(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files with a line that begins outside and ends inside a cell."""
    found = set()
    for batch in batches:
        for path, line in zip(*(batch.column(c).to_pylist() for c in ("path", "line"))):
            if path not in found and ends_inside(line, False):
                found.add(path)
    yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["path"])


def files_of_several_lines(lines: DataFrame) -> set[str]:
    """Paths of the files in which a record may have several lines; the driver lists one path per file."""
    # a line without a quote outside of closed cells ends outside; the others are looked at
    rest = F.regexp_replace("line", r'"(?<=(?:^|,)")[^"]*+"(?=,|\r*\z)', "")
    doubtful = lines.filter(F.col("line").contains('"')).filter(rest.contains('"'))
    found = doubtful.select("path", "line").mapInArrow(_opening, "path string").distinct()
    return {r["path"] for r in found.toLocalIterator()}


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """The splits of a batch of lines in order: (path, start), first line, end."""
    if batch.num_rows:
        paths = batch.column("path").dictionary_encode()
        places, starts = paths.indices.to_numpy(), batch.column("start").to_numpy()
        cuts = np.flatnonzero((np.diff(places) != 0) | (np.diff(starts) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            yield (paths.dictionary[places[lo]].as_py(), int(starts[lo])), lo, hi


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split the states after it under both assumptions, and the number of the line in it at which the record open then begins.

    ``line`` is NULL for lines without a quote.
    """
    done: list[tuple] = []
    split, number, states, opened = None, 0, [False, True], [None, None]

    def finished() -> pa.RecordBatch:
        cols = list(zip(*done)) if done else [()] * 6
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), *[pa.bool_()] * 2, *[pa.int64()] * 2))],
                                          ["path", "start", "out_outside", "out_inside", "opened_outside", "opened_inside"])

    for batch in batches:
        lines = batch.column("line")
        quoted = np.flatnonzero(lines.is_valid().to_numpy(zero_copy_only=False))
        texts = lines.take(pa.array(quoted)).to_pylist()
        for this, lo, hi in _runs(batch):
            if this != split:
                if split is not None:
                    done.append((*split, *states, *opened))
                split, number, states, opened = this, 0, [False, True], [None, None]
            a, b = np.searchsorted(quoted, (lo, hi))
            for at, text in zip(quoted[a:b].tolist(), texts[a:b]):
                ends = {s: ends_inside(text, s) for s in set(states)}
                for k in (0, 1):
                    after = ends[states[k]]
                    opened[k] = (opened[k] if states[k] else number + at - lo) if after else None
                    states[k] = after
            number += hi - lo
        if len(done) > 1000:
            yield finished()
    if split is not None:
        done.append((*split, *states, *opened))
    yield finished()


def split_functions(lines: DataFrame) -> DataFrame:
    """One row per split: its function of the state before it."""
    quoted = lines.withColumn("line", F.when(F.col("line").contains('"'), F.col("line")))
    return durable(quoted.mapInArrow(_functions, "path string, start long, out_outside boolean, out_inside boolean, "
                                                 "opened_outside long, opened_inside long"))


numbered_lines = split_functions  # its former name


def split_states(splits: DataFrame) -> DataFrame:
    """Per split whether a quoted cell is open ``before`` and ``after`` it.

    ``opened``: the line of the split at which the record begins that is open after it, NULL if that is no line of the split.
    ``origin``: the split in which the record begins that is open before.
    """
    along = Window.partitionBy("path").orderBy("start")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    constant = F.col("out_outside") == F.col("out_inside")
    negations = F.sum((F.col("out_outside") & ~F.col("out_inside")).cast("int")).over(earlier)
    counted = splits.withColumn("turns", F.coalesce(negations, F.lit(0)))
    # the state that the last constant function before a split left behind, with the negations counted up to it
    fixed = F.last(F.when(constant, F.struct(F.col("out_outside").alias("state"), "turns")), ignorenulls=True).over(earlier)
    known = counted.withColumn("fixed", fixed)
    odd = (F.col("turns") - F.coalesce(F.col("fixed.turns"), F.lit(0))) % 2 == 1
    states = known.withColumn("before", F.coalesce("fixed.state", F.lit(False)) != odd)
    states = states.select("path", "start", "before", *[F.when(F.col("before"), F.col(f"{c}_inside")).otherwise(F.col(f"{c}_outside")).alias(n)
                                                        for c, n in (("out", "after"), ("opened", "opened"))])
    return states.withColumn("origin", F.last(F.when(F.col("opened").isNotNull(), F.col("start")), ignorenulls=True).over(earlier))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records within splits, and a fragment per split of those that cross splits, with ``origin``.

    Lines of a record that is never closed, those from the line ``unclosed_from`` on, are records of their own.
    """
    split, held, number = None, [], 0
    inside, origin, loose = False, None, None

    def piece(paths, texts, origin=None, start=None) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays([paths if isinstance(paths, pa.Array) else pa.array([paths] * n, pa.string()),
                                           texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()),
                                           pa.array([origin] * n, pa.int64()), pa.array([start] * n, pa.int64())],
                                          ["path", "record", "origin", "start"])

    for batch in batches:
        lines = batch.column("line")
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        texts = lines.take(pa.array(quoted)).to_pylist()
        alone, joined = np.zeros(batch.num_rows, bool), []
        for this, lo, hi in _runs(batch):
            if this != split:
                if held:  # part of the record that was open before the split, or of one that began in it
                    yield piece(split[0], ["\n".join(held)], split[1] if origin is None else origin, split[1])
                split, held, number = this, [], 0
                inside, origin, loose = (batch.column(c)[lo].as_py() for c in ("before", "origin", "unclosed_from"))
                inside, origin = bool(inside), origin if inside else None
            first, turned = inside, np.zeros(hi - lo, np.int64)
            a, b = np.searchsorted(quoted, (lo, hi))
            for at, text in zip(quoted[a:b], texts[a:b]):
                after = ends_inside(text, inside)
                turned[at - lo] = after != inside
                inside = after
            after = (np.cumsum(turned) + first) % 2 == 1
            part = after | ((turned == 1) != after)  # lines that end or begin inside
            if loose is not None:
                part[max(loose - number, 0):] = False
            number += hi - lo
            alone[lo:hi] = ~part
            some = np.flatnonzero(part)
            for text, open_after in zip(lines.take(pa.array(some + lo)).to_pylist(), after[some]):
                held.append(text)
                if not open_after:
                    if origin is None:
                        joined.append((this[0], "\n".join(held)))
                    else:
                        yield piece(this[0], ["\n".join(held)], origin, this[1])
                    held, origin = [], None
        mask = pa.array(alone)
        yield piece(batch.column("path").filter(mask), lines.filter(mask))
        if joined:
            yield piece(*(pa.array(c, pa.string()) for c in zip(*joined)))
    if held:
        yield piece(split[0], ["\n".join(held)], split[1] if origin is None else origin, split[1])


def _joined(lines: DataFrame) -> DataFrame:
    """``path`` and ``record`` of files with records of several lines.

    Pieces are written at once, while files are cut into the same splits as for the states.
    """
    states = durable(split_states(split_functions(lines)))
    begun = F.when(F.col("after"), F.when(F.col("opened").isNotNull(), F.col("start")).otherwise(F.col("origin")))
    unclosed = states.groupBy("path").agg(F.max_by(begun, "start").alias("unclosed"))
    # the lines of a split from which on they belong to a record without an end
    loose = F.when(F.col("before") & (F.col("origin") == F.col("unclosed")), F.lit(0)).when(F.col("start") == F.col("unclosed"), F.col("opened"))
    states = states.join(unclosed, "path").select("path", "start", "before", "origin", loose.cast("long").alias("unclosed_from"))
    # a short row for each split that begins inside or holds such lines; a broadcast leaves the lines in order
    marked = F.broadcast(states.filter("before OR unclosed_from IS NOT NULL"))
    pieces = durable(lines.join(marked, ["path", "start"], "left").mapInArrow(_pieces, "path string, record string, origin long, start long"))
    crossing = pieces.filter("origin IS NOT NULL").groupBy("path", "origin").agg(F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"))
    crossing = crossing.select("path", F.array_join(F.transform("parts", lambda x: x["record"]), "\n").alias("record"))
    return pieces.filter("origin IS NULL").select("path", "record").unionByName(crossing)


def _clean(record: Column) -> Column:
    marked = record.startswith("\ufeff") | record.endswith("\r")
    return F.when(marked, F.regexp_replace(F.regexp_replace(record, "^\ufeff", ""), r"\r\z", "")).otherwise(record)


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path`` and ``record`` of all CSV records of the files, headers among them.

    The driver holds one path per file. Files with records of several lines are written once more, by record.
    """
    ship_package(spark)
    several = files_of_several_lines(_lines(spark, paths))
    plain = [p for p in paths if p not in several]
    records = _lines(spark, plain).select("path", F.col("line").alias("record")) if plain else None
    if several:
        joined = _joined(_lines(spark, sorted(several)))
        records = joined if records is None else records.unionByName(joined)
    return records.withColumn("record", _clean(F.col("record"))).filter(F.trim("record") != "")
