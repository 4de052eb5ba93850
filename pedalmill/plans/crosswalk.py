"""Legacy stations from raw files, matched to current stations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import identity
from ..sources import manifest, sinks, trips as trip_source


def from_files(spark: SparkSession, raw: str, current: DataFrame, system: str = "nyc",
               out: str | None = None) -> DataFrame:
    projected = trip_source.read_files(spark, manifest.trip_files(spark, raw))
    legacy = identity.legacy_stations(trip_source.station_ends(projected), system)
    crosswalk = identity.build_crosswalk(legacy, current)
    if out is not None:
        sinks.write_csv(crosswalk, out)
    return crosswalk
