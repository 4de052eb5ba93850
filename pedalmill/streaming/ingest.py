"""Process each new raw file once with a file-source stream.

The source checkpoint remembers which files were read. A run takes everything
that is new and stops. A batch that is tried again after a failure replaces its
own output folder, so files are never counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import parse
from ..sources import manifest, trips as trip_source

Transform = Callable[[DataFrame], DataFrame | None]


def raw_stream(spark: SparkSession, folder: str, family: str, columns: list[str] | None = None,
               max_files: int | None = None) -> DataFrame:
    """Stream of projected raw trips of one schema family (one folder per family).

    The files must have the columns in the given order: another order in a header is an
    error. ``ingest_folder`` takes files of any order and family.
    """
    names = columns or list(trip_source.COLUMN_NAMES[family].values())
    schema = ", ".join(f"`{n}` string" for n in [*names, trip_source.CORRUPT])
    reader = (spark.readStream.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", trip_source.CORRUPT).option("columnPruning", False)
              .option("enforceSchema", False))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.csv(folder).withColumn("source_file", F.col("_metadata.file_name"))
    raw = raw.withColumn("expected", parse.expected_year_month(F.col("source_file")))
    return trip_source.project(raw, family)


def ingest_folder(spark: SparkSession, folder: str, transform: Transform, out: str, checkpoint: str,
                  max_files: int | None = None) -> StreamingQuery:
    """Ingest all new files of a folder, of any schema family and column order.

    The stream carries file names; each batch reads its files by their headers.
    """
    reader = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    names = reader.load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))

    def read(batch: DataFrame) -> DataFrame | None:
        files = manifest.with_headers(batch).filter(F.col("family") != "unknown")
        return None if files.isEmpty() else transform(trip_source.read_files(spark, files))

    return ingest_new(names, read, out, checkpoint)


def ingest_new(stream: DataFrame, transform: Transform, out: str, checkpoint: str) -> StreamingQuery:
    """Run ``transform`` on all files not seen before and write each batch once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        if rows is not None:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch={batch_id}")

    return (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
