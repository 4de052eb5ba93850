"""Small side tables: station feed, weather, holidays, ridership batches, schedules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..session import same_rows_union

STATION_FEED_SCHEMA = """data struct<stations: array<struct<station_id: string, short_name: string,
    name: string, lat: double, lon: double, capacity: int, region_id: string>>>"""

HOURLY_MEASURES = ["temperature_2m", "apparent_temperature", "precipitation", "rain", "snowfall",
                   "wind_speed_10m", "relative_humidity_2m"]
HOURLY_SCHEMA = ("hourly struct<time: array<string>, "
                 + ", ".join(f"{m}: array<double>" for m in HOURLY_MEASURES) + ", weather_code: array<int>>")
DAILY_SCHEMA = "daily struct<time: array<string>, sunrise: array<string>, sunset: array<string>>"

# Schedule files: explicit text and number columns, so ids keep leading zeros.
GTFS_SCHEMAS = {
    "stops": "stop_id string, stop_name string, stop_lat double, stop_lon double, location_type string, "
             "parent_station string",
    "routes": "route_id string, route_short_name string, route_long_name string, route_type string, "
              "route_color string, route_text_color string",
    "trips": "trip_id string, route_id string, service_id string",
    "stop_times": "trip_id string, stop_id string, arrival_time string",
    "calendar": "service_id string, monday int, saturday int, sunday int",
}


def explode_stations(feed: DataFrame) -> DataFrame:
    """Nested feed to one row per station, with defaults for missing fields."""
    s = feed.select(F.explode("data.stations").alias("s")).select("s.*")
    return s.select("station_id", F.coalesce("short_name", F.lit("")).alias("short_name"), "name", "lat", "lon",
                    F.coalesce("capacity", F.lit(0)).alias("capacity"),
                    F.coalesce("region_id", F.lit("")).alias("region_id"))


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return explode_stations(spark.read.schema(STATION_FEED_SCHEMA).option("multiLine", True).json(path))


def explode_hourly(raw: DataFrame) -> DataFrame:
    """Parallel arrays to one row per hour."""
    fields = ["time", *HOURLY_MEASURES, "weather_code"]
    zipped = F.arrays_zip(*[F.col(f"hourly.{f}").alias(f) for f in fields])
    rows = raw.select(F.explode(zipped).alias("h")).select("h.*")
    stamp = F.coalesce(F.try_to_timestamp("time", F.lit("yyyy-MM-dd'T'HH:mm")),
                       F.try_to_timestamp("time", F.lit("yyyy-MM-dd HH:mm:ss")))
    return rows.select(stamp.alias("datetime"), *fields[1:])


def explode_daily(raw: DataFrame) -> DataFrame:
    zipped = F.arrays_zip(*[F.col(f"daily.{f}").alias(f) for f in ("time", "sunrise", "sunset")])
    rows = raw.select(F.explode(zipped).alias("d")).select("d.*")

    def stamp(c: str):
        return F.try_to_timestamp(F.col(c), F.lit("yyyy-MM-dd'T'HH:mm"))

    return rows.select(F.to_date("time").alias("date"), stamp("sunrise").alias("sunrise"),
                       stamp("sunset").alias("sunset"),
                       dates.daylight_hours(stamp("sunrise"), stamp("sunset")).alias("daylight_hours"))


def read_hourly_weather(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(HOURLY_SCHEMA).option("multiLine", True).json(path)
    return combine_chunks([explode_hourly(raw)], ["datetime"])


def read_daily_sun(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(DAILY_SCHEMA).option("multiLine", True).json(path)
    return combine_chunks([explode_daily(raw)], ["date"])


def combine_chunks(parts: Sequence[DataFrame], key: Sequence[str], sort: bool = True) -> DataFrame:
    """Chunks to one table with unique keys; among copies the smallest row is kept."""
    rows = same_rows_union(list(parts))
    rest = [c for c in rows.columns if c not in key]
    one = rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__r")).select(*key, "__r.*")
    return one.orderBy(*key) if sort else one


def clean_holidays(raw: DataFrame) -> DataFrame:
    """(date, name) to (date, holiday_name, holiday_type)."""
    name, kind = text.split_observed(F.col("name"))
    return raw.select(F.to_date("date").alias("date"), name.alias("holiday_name"), kind.alias("holiday_type"))


def read_gtfs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The schedule tables as text columns, matched by header name."""
    out = {}
    for table, ddl in GTFS_SCHEMAS.items():
        raw = spark.read.option("header", True).csv(f"{folder}/{table}.txt")
        have = set(raw.columns)
        cols = [p.strip().split(" ") for p in ddl.split(",")]
        out[table] = raw.select(*[
            (F.col(n).try_cast(t) if n in have else F.lit(None).cast(t)).alias(n) for n, t in cols])
    return out


def ridership(df: DataFrame, start: str | None = None, end: str | None = None,
              borough: str | None = None, limit: int | None = None,
              ts: str = "transit_timestamp") -> DataFrame:
    """Stored ridership rows by date range, borough and count; filters reach the scan."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col(ts) < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    if borough is not None:
        df = df.filter(F.col("borough") == borough)
    return df if limit is None else df.orderBy(ts).limit(limit)


def write_batch(rows: DataFrame, folder: str, number: int) -> None:
    """Store one fetched batch; the same batch fetched again replaces itself."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/batch={number}")


def combine_batches(spark: SparkSession, folder: str, out: str, key: Sequence[str] | None = None) -> DataFrame:
    """All stored batches as one ZSTD table below ``out``; with ``key``, rows that overlapping batches share once."""
    rows = spark.read.parquet(folder).drop("batch")
    if key:
        rows = combine_chunks([rows], key, sort=False)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(out)
    return spark.read.schema(rows.schema).parquet(out)


def clean_ferry(raw: DataFrame) -> DataFrame:
    """Hourly ferry rows with typed date, hour (-1 if unknown) and boardings (0 if unknown)."""
    return raw.select(F.to_date("date").alias("date"), "route", "direction", "stop",
                      text.coerce_int(F.col("hour"), -1).alias("hour"),
                      text.coerce_int(F.col("boardings"), 0).alias("boardings"), "typeday")


def normalise_operator(df: DataFrame, mapping: dict[str, str] | None = None,
                       col: str = "operator") -> DataFrame:
    """Reported operator names; unknown names stay as they are (trimmed)."""
    names = text.OPERATOR_NAMES if mapping is None else mapping
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    trimmed = F.trim(F.col(col))
    return df.withColumn(col, F.coalesce(F.try_element_at(known, trimmed), trimmed))
