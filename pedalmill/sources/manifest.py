"""Tables of files: family, month, size, hash, what to read and what to skip."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..session import lookup_join

#: A header is at most so long; no more of a file is read to find it.
MAX_HEADER_BYTES = 64 * 1024

FAMILIES = ("modern", "legacy", "legacy_titlecase")


def schema_family(header: Column) -> Column:
    """Schema family of a header line, ``unknown`` for anything else."""
    low = F.lower(header)
    return (F.when(low.contains("ride_id") | low.contains("member_casual"), "modern")
            .when(header.contains("Trip Duration"), "legacy_titlecase")
            .when(low.contains("tripduration"), "legacy").otherwise("unknown"))


def open_stream(uri: str):
    """A file of any file system that the workers reach, as a stream of bytes."""
    from pyarrow import fs

    if uri.startswith("file:/"):
        system, path = fs.LocalFileSystem(), "/" + uri[len("file:/"):].lstrip("/")
    else:
        system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path)


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        heads = []
        for uri in pdf["path"]:
            with open_stream(uri) as stream:
                line, _, _ = stream.read(MAX_HEADER_BYTES).partition(b"\n")
            # A first line beyond the bound is no header, and its file of no known family.
            line = line if len(line) < MAX_HEADER_BYTES else b""
            heads.append(line.decode("utf-8-sig", "replace").rstrip("\r"))
        yield pdf.assign(header=heads)


def list_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """One row per file: path, file_name, length, modified. Contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length",
                    F.col("modificationTime").alias("modified")))


def trip_files(spark: SparkSession, path: str) -> DataFrame:
    """Raw trip files with header, schema family and the month their name promises.

    Headers are read in tasks, a few kilobytes per file.
    """
    return with_headers(list_files(spark, path))


def with_headers(files: DataFrame) -> DataFrame:
    """``files`` (path, file_name, ...) with header, schema family and promised month."""
    spark = files.sparkSession
    heads = files.select("path").repartition(
        max(1, min(256, spark.sparkContext.defaultParallelism))).mapInPandas(
        _first_lines, "path string, header string")
    return (files.join(heads, "path").withColumn("family", schema_family(F.col("header")))
            .withColumn("expected", parse.expected_year_month(F.col("file_name"))))


def of_years(files: DataFrame, years: Sequence[int]) -> DataFrame:
    """Files by parsed year: ``2012`` does not match ``202012``."""
    return files.filter(F.col("expected.year").isin(*years))


def first_files(files: DataFrame, n: int) -> DataFrame:
    return files.orderBy("file_name").limit(n)


def _marked(files: DataFrame) -> DataFrame:
    """``files`` with ``__superseded``: whether a numbered part of a month has an unsplit file beside it."""
    split = F.col("file_name").rlike(r"_\d\.csv$")
    whole = (files.filter(~split & F.col("expected.month").isNotNull())
             .select(F.col("expected.year").alias("__y"), F.col("expected.month").alias("__m"),
                     F.lit(True).alias("__whole")).distinct())
    return (files.join(whole, (F.col("expected.year") == F.col("__y"))
                       & (F.col("expected.month") == F.col("__m")), "left")
            .withColumn("__superseded", split & F.coalesce("__whole", F.lit(False))).drop("__y", "__m", "__whole"))


def with_status(files: DataFrame) -> DataFrame:
    """``files`` with ``status``: ``superseded`` for the numbered parts of a month that also has an unsplit file,
    ``unknown_header`` for files of no known family, else ``processed``."""
    status = F.when(F.col("__superseded"), "superseded").when(F.col("family") == "unknown", "unknown_header").otherwise("processed")
    return _marked(files).withColumn("status", status).drop("__superseded")


def without_superseded(files: DataFrame) -> DataFrame:
    """Drop the numbered parts of a month that also has an unsplit file."""
    return _marked(files).filter("NOT __superseded").drop("__superseded")


def content_hashes(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Files with the MD5 of their bytes, hashed in tasks; contents do not leave the scan.

    A file larger than 2 GB cannot be one binary value; split such files first.
    """
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length",
                    F.md5("content").alias("md5")))


def without_duplicates(hashed: DataFrame) -> DataFrame:
    """One file per content; same name with other content gets its hash in the name.

    The first path keeps the plain name. Both choices are minima, so a name that
    most files share needs no numbering in one task.
    """
    one = hashed.groupBy("md5").agg(F.min(F.struct("path", "file_name")).alias("f")).select("md5", "f.path", "f.file_name")
    first = one.groupBy("file_name").agg(F.min("path").alias("__first"))
    stem = F.regexp_replace("file_name", r"\.csv$", "")
    named = F.when(F.col("path") == F.col("__first"), F.col("file_name")).otherwise(
        F.concat(stem, F.lit("_"), F.col("md5"), F.lit(".csv")))
    return lookup_join(one, first, "file_name", "inner").withColumn("stored_name", named).drop("__first")


def row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per file less the header, for all files in one job."""
    return (spark.read.text(path).groupBy(F.col("_metadata.file_name").alias("file_name"))
            .agg((F.count(F.lit(1)) - 1).alias("approx_rows")))


def pending(files: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Files not processed yet; all of them with ``force``."""
    if force:
        return files
    return files.join(done.select("file_name").distinct(), "file_name", "left_anti")
