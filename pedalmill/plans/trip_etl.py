"""Raw trip files to canonical trips with full accounting of dropped rows."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse
from ..operators import identity, quality
from ..session import durable, wide_projections
from ..sources import ledger, manifest, sinks, trips as trip_source

CANONICAL = [
    "ride_id", "started_at", "ended_at", "duration_sec",
    "start_station_id", "start_station_name", "start_lat", "start_lon",
    "end_station_id", "end_station_name", "end_lat", "end_lon",
    "start_lat_raw", "start_lon_raw", "end_lat_raw", "end_lon_raw",
    "member_casual", "rideable_type", "bike_id", "birth_year", "gender",
    "birth_year_valid", "gender_valid", "age_at_trip",
    "source_file", "start_match_type", "end_match_type",
]


def reason_names() -> list[str]:
    """Reasons for rows of files, in the order in which the first one is charged."""
    return ["malformed_row", *quality.quality_reasons(month_check=True, names=True)]


@dataclass(frozen=True)
class Result:
    """Judged rows: canonical columns, ``drop_reason`` (NULL for kept rows) and all ``reasons``.

    ``files`` has the ledger's entries where rows were read from files.
    """

    judged: DataFrame
    reason_names: list[str]
    files: DataFrame | None = None

    @property
    def trips(self) -> DataFrame:
        return self.judged.filter(F.col("drop_reason").isNull()).select(*CANONICAL)

    def accounting(self) -> DataFrame:
        """Rows in, rows out and rows per reason of every file; files without rows, such as those of an unknown header,
        stand there with zeros and their ``status``."""
        if self.files is None:
            return accounting(self.judged, self.reason_names)
        counts = accounting(self.judged, self.reason_names, ["source_path"])
        known = self.files.filter("status != 'superseded'").select(F.col("file_name").alias("source_file"), F.col("path").alias("source_path"), "status")
        numbers = [c for c in counts.columns if c != "source_path"]
        return known.join(counts, "source_path", "left").fillna(0, numbers).select("source_file", "source_path", "status", *numbers)

    def matches(self) -> DataFrame:
        return quality.match_counts(self.trips, ["source_file"])


def accounting(judged: DataFrame, reason_names: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows in, rows out and rows per reason for every source file."""
    flags = {n: F.array_contains("reasons", n) for n in reason_names}
    return quality.filter_accounting(judged, flags, by or ["source_file"])


def harmonise(projected: DataFrame, crosswalk: DataFrame, current: DataFrame,
              overrides: DataFrame | None = None) -> Result:
    """Resolve stations and judge every row in the canonical schema.

    Filter and counters work on the same parsed frame, so they cannot disagree.
    """
    if overrides is not None:
        crosswalk = identity.apply_overrides(crosswalk, overrides)
    resolved = identity.resolve_stations(projected, identity.station_map(crosswalk, current))
    conditions = {}
    if trip_source.CORRUPT in resolved.columns:
        conditions["malformed_row"] = F.col(trip_source.CORRUPT).isNotNull()
    dated = "expected" in resolved.columns
    conditions |= quality.quality_reasons(month_check=dated, names=True)
    year, rider, when = F.col("birth_year"), F.col("member_casual"), F.col("started_at")
    found = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions.items()]))
    out = resolved.withColumns({
        "birth_year_valid": parse.birth_year_valid(year, rider, when),
        "gender_valid": parse.gender_valid(F.col("gender")),
        "age_at_trip": parse.age_at_trip(year, rider, when),
        "reasons": found})
    judged = out.select(*CANONICAL, "reasons", F.get("reasons", F.lit(0)).alias("drop_reason"),
                        *[c for c in ("source_path", "expected") if c in out.columns])
    return Result(judged, list(conditions))


def _part(path: str, version: str) -> Column:
    """Folder name of one version of a file."""
    return F.concat(F.substring(F.md5(path), 1, 16), F.lit(version))


def result(spark: SparkSession, out: str, system: str = "nyc", years: list[int] | None = None) -> Result:
    """What ``out`` holds: rows of the current version of every file, and the ledger's entries."""
    files = ledger.Ledger(spark, out).state(system)
    if years is not None:
        files = manifest.of_years(files.withColumn("expected", parse.expected_year_month(F.col("file_name"))), years).drop("expected")
    if files.filter("part IS NOT NULL").isEmpty():
        raise ValueError(f"{out} holds no rows of files")
    rows = ledger.live_rows(spark, out, spark.read.parquet(out)).filter(F.col("system") == system)
    if years is not None:
        rows = rows.filter(F.col("year").isin(*years))
    return Result(rows, reason_names(), files)


def run(spark: SparkSession, raw: str, out: str, crosswalk: DataFrame, current: DataFrame,
        overrides: DataFrame | None = None, years: list[int] | None = None, system: str = "nyc",
        force: bool = False, log: str | None = None, run_id: str = "run") -> Result:
    """Read the new and changed files of a folder and write them once, kept and dropped rows together.

    A ledger below ``out`` says which version of which path was read (see ``ledger``). A file is read again when its
    bytes have changed or ``force`` is given; its new rows replace its earlier ones and no others. Files of the same name
    in different folders are different files. Rows become visible with the ledger's commit: a run that fails, or loses
    against another one (``ledger.CommitConflict``), leaves the table as it was and can be repeated. Numbered parts of a
    month give way to an unsplit file whenever it arrives. Counters come from the written Parquet, of which they read three columns.
    """
    book = ledger.Ledger(spark, out)
    number = book.last() + 1
    files = manifest.with_status(manifest.trip_files(spark, raw))
    if years is not None:
        files = manifest.of_years(files, years)
    planned = durable(ledger.plan(files, book.state(system), force).filter("action != 'unchanged'"))
    fresh = planned.filter("action IN ('new', 'changed')")
    if not planned.isEmpty():
        version = f"-{number}-{uuid.uuid4().hex[:8]}"
        read = fresh.filter("status = 'processed'")
        if not read.isEmpty():
            judged = harmonise(trip_source.read_files(spark, read), crosswalk, current, overrides).judged
            with wide_projections(spark):
                sinks.write_parts(judged.withColumns({
                    "system": F.lit(system), "part": _part("source_path", version),
                    "status": F.when(F.col("drop_reason").isNull(), "kept").otherwise("dropped"),
                    "year": F.coalesce(F.col("expected.year"), F.year("started_at")),
                    "month": F.coalesce(F.col("expected.month"), F.month("started_at"))}).drop("expected"), out)
        part = F.when(F.col("action") == "touched", F.col("old_part")).when(F.col("status") == "processed", _part("path", version))
        book.commit(planned.withColumns({"system": F.lit(system), "run_id": F.lit(run_id), "part": part}), number)
        book.drop_parts(fresh.filter("old_part IS NOT NULL").select(F.col("old_part").alias("part")))
    stored = result(spark, out, system, years)
    if log is not None:
        sinks.write_log(stored.accounting(), log, run_id)
    return stored
