"""Writers. All can be repeated: a retried task or a second run leaves one copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_trips(trips: DataFrame, root: str, mode: str = "append", force: bool = False) -> None:
    """Trips as ZSTD Parquet by system, (status,) year and month.

    Rows are rebalanced by partition before the write, so each month becomes a
    few large files and a month with most of the rows is split over tasks.
    ``force`` replaces only the partitions present in the input.
    """
    added = {"system": F.lit("nyc"), "year": F.year("started_at"), "month": F.month("started_at")}
    dated = trips.withColumns({c: v for c, v in added.items() if c not in trips.columns})
    keys = [c for c in ("system", "status", "year", "month") if c in dated.columns]
    writer = dated.hint("rebalance", *keys).write.option("compression", "zstd").partitionBy(*keys)
    if force:
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    else:
        writer = writer.mode(mode)
    writer.parquet(root)


def write_parts(trips: DataFrame, root: str) -> None:
    """Trips as ZSTD Parquet by system, year, month and ``part``, added to what is there.

    A part holds one version of one source file, kept and dropped rows together. Rows are in order of status, which
    lets filters on it skip row groups.
    """
    keys = ["system", "year", "month", "part"]
    (trips.hint("rebalance", *keys).sortWithinPartitions(*keys, "status").write
     .option("compression", "zstd").mode("append").partitionBy(*keys).parquet(root))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report tables with a header row; quotes inside cells are doubled, white space is kept."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_log(metrics: DataFrame, path: str, run: str) -> None:
    """Run metrics as JSON lines, one folder per run, so a repeated run replaces its own."""
    (metrics.withColumn("run", F.lit(run)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run").json(path))
