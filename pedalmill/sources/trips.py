"""Raw trip files of all schema families to one projected schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse, text
from ..session import lookup_join
from . import ledger, records

CORRUPT = "_corrupt"

# Raw column names per family, in the order of the columns below.
MODERN = {
    "ride_id": "ride_id", "rideable_type": "rideable_type", "start": "started_at", "end": "ended_at",
    "start_name": "start_station_name", "start_id": "start_station_id",
    "end_name": "end_station_name", "end_id": "end_station_id",
    "start_lat": "start_lat", "start_lon": "start_lng", "end_lat": "end_lat", "end_lon": "end_lng",
    "rider": "member_casual",
}
LEGACY = {
    "seconds": "tripduration", "start": "starttime", "end": "stoptime",
    "start_id": "start station id", "start_name": "start station name",
    "start_lat": "start station latitude", "start_lon": "start station longitude",
    "end_id": "end station id", "end_name": "end station name",
    "end_lat": "end station latitude", "end_lon": "end station longitude",
    "bike": "bikeid", "rider": "usertype", "birth": "birth year", "gender": "gender",
}
TITLECASE = {
    "seconds": "Trip Duration", "start": "Start Time", "end": "Stop Time",
    "start_id": "Start Station ID", "start_name": "Start Station Name",
    "start_lat": "Start Station Latitude", "start_lon": "Start Station Longitude",
    "end_id": "End Station ID", "end_name": "End Station Name",
    "end_lat": "End Station Latitude", "end_lon": "End Station Longitude",
    "bike": "Bike ID", "rider": "User Type", "birth": "Birth Year", "gender": "Gender",
}
COLUMN_NAMES = {"modern": MODERN, "legacy": LEGACY, "legacy_titlecase": TITLECASE}


def _typed(raw: DataFrame, cols: dict[str, Column], modern: Column) -> DataFrame:
    """Raw text cells by column key to typed common columns; ``modern`` tells the family of a row.

    Every value is text on input, so ids keep their zeros (``5636.10``) and a bad
    cell becomes NULL instead of failing the file.
    """
    def col(key: str) -> Column:
        return cols.get(key, parse.null_of("string"))

    def station_id(key: str) -> Column:
        return F.when(modern, col(key)).otherwise(text.strip_float_suffix(col(key)))

    raw = raw.withColumns({"__start": parse.parse_timestamp(col("start")), "__end": parse.parse_timestamp(col("end"))})
    start, end = F.col("__start"), F.col("__end")
    keep = [c for c in ("source_file", "source_path", "expected", CORRUPT) if c in raw.columns]
    return raw.select(
        F.when(modern, col("ride_id")).otherwise(parse.synthetic_key(col("start"), col("start_id"), col("bike")))
        .alias("ride_id"),
        F.when(modern, col("rideable_type")).alias("rideable_type"),
        start.alias("started_at"), end.alias("ended_at"),
        F.when(modern, parse.duration_seconds(start, end)).otherwise(parse.try_int(col("seconds"))).alias("duration_sec"),
        station_id("start_id").alias("start_station_id_raw"), col("start_name").alias("start_station_name_raw"),
        parse.try_double(col("start_lat")).alias("start_lat_raw"),
        parse.try_double(col("start_lon")).alias("start_lon_raw"),
        station_id("end_id").alias("end_station_id_raw"), col("end_name").alias("end_station_name_raw"),
        parse.try_double(col("end_lat")).alias("end_lat_raw"),
        parse.try_double(col("end_lon")).alias("end_lon_raw"),
        F.when(modern, col("rider")).otherwise(parse.rider_type(col("rider"))).alias("member_casual"),
        F.when(~modern, col("bike")).alias("bike_id"),
        F.when(~modern, parse.try_int(col("birth"))).alias("birth_year"),
        F.when(~modern, parse.try_int(col("gender"))).alias("gender"),
        *keep)


def project(raw: DataFrame, family: str) -> DataFrame:
    """Raw text columns of one family to typed common columns."""
    cols = {key: F.col(f"`{name}`").cast("string") for key, name in COLUMN_NAMES[family].items()}
    return _typed(raw, cols, F.lit(family == "modern"))


def _cells(record: Column, width: int) -> Column:
    """The first ``width`` cells of a CSV record; empty and missing ones are NULL."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv(record, schema, {"mode": "PERMISSIVE", "escape": '"'})
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def _cell_count(record: Column) -> Column:
    """Number of cells of a CSV record, commas between quotes not counting.

    The pattern goes from quote to quote, so neither its time nor its depth depends on how long the cells are.
    """
    quoted = r'"(?<=(?:^|,)")[^"]*+(?:"(?:"|(?!,|\z))[^"]*+)*+"(?=,|\z)'
    bare = F.when(record.contains('"'), F.regexp_replace(record, quoted, "")).otherwise(record)
    return F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


#: Raw cells in the order in which a header's positions are kept.
CELLS = list(dict.fromkeys([*MODERN, *LEGACY]))


def _positions(head: Column, family: Column) -> Column:
    """Place of every raw cell in a header of a family, -1 where it has none."""
    def place(key: str) -> Column:
        name = F.lit(None).cast("string")
        for kind, names in COLUMN_NAMES.items():
            if key in names:
                name = F.when(family == kind, F.lit(names[key])).otherwise(name)
        return F.coalesce(F.array_position(head, name) - 1, F.lit(-1)).cast("int")
    return F.array(*[place(key) for key in CELLS])


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """All files of a manifest (see ``manifest.trip_files``) as one projected frame.

    One reader for all families and headers: each record meets the header of its file, in which cells were looked up once
    per file, so column order never matters and headers may differ from
    file to file. Cells may hold line breaks (see ``records``). The driver handles one path per file, as Spark's own file listing does.
    Unknown families are skipped; rows with too many or too few cells are kept and
    marked in ``_corrupt``, to be counted rather than lost.
    """
    known = files.filter(F.col("family") != "unknown").select("path", "family", "header")
    paths = [row.path for row in known.select("path").toLocalIterator()]
    if not paths:
        raise ValueError("no file with a known header")
    width = known.agg(F.max(F.size(F.split("header", ",")))).first()[0]
    heads = known.select(F.col("path").alias("source_path"), "family", "header", _cell_count(F.col("header")).alias("__width"),
                         _positions(F.transform(_cells(F.col("header"), width), F.trim), F.col("family")).alias("__at"),
                         F.element_at(F.split("path", "/"), -1).alias("source_file"),
                         parse.expected_year_month(F.element_at(F.split("path", "/"), -1)).alias("expected"))
    lines = records.read_records(spark, paths).select(F.col("record").alias("__line"), F.col("path").alias("source_path"))
    rows = lookup_join(lines, heads, "source_path", "inner").filter(F.col("__line") != F.col("header"))
    rows = rows.withColumn("__cells", _cells(F.col("__line"), width))
    rows = rows.withColumn(CORRUPT, F.when(_cell_count(F.col("__line")) != F.col("__width"), F.col("__line")))
    cells = {key: F.get("__cells", F.get("__at", F.lit(i))) for i, key in enumerate(CELLS)}
    return _typed(rows, cells, F.col("family") == "modern")


def read_processed(spark: SparkSession, root: str, system: str | None = None,
                   years: list[int] | None = None) -> DataFrame:
    """Canonical trips; system and years prune partitions, superseded versions of files are left out."""
    df = ledger.live_rows(spark, root, spark.read.parquet(root)).drop("part")
    if "status" in df.columns:
        df = df.filter(F.col("status") == "kept").drop("status", "drop_reason", "reasons", "source_path")
    if system is not None:
        df = df.filter(F.col("system") == system)
    if years is not None:
        df = df.filter(F.col("year").isin(*years))
    return df


def station_ends(projected: DataFrame) -> DataFrame:
    """Start-station observations of projected raw trips, with the file's year."""
    return projected.select(
        F.col("start_station_id_raw").alias("station_id"), F.col("start_station_name_raw").alias("name"),
        F.col("start_lat_raw").alias("lat"), F.col("start_lon_raw").alias("lon"), "source_file",
        F.regexp_extract("source_file", r"(\d{4})", 1).try_cast("int").alias("file_year"))
