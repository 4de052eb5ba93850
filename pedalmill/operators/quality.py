"""Trip quality: reasons, accounting, drift, timelines, anomalies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from ..functions.numeric import count_if

MIN_SECONDS = 90
MAX_SECONDS = 14_400


def _blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def quality_reasons(start_id: str = "start_station_id_raw", end_id: str = "end_station_id_raw",
                    month_check: bool = False, names: bool = False) -> dict[str, Column]:
    """Reason -> condition that drops a trip, in the order reasons are charged.

    ``month_check`` needs ``expected`` (struct year, month); ``names`` needs the
    canonical station names. A trip with an unknown name is charged to
    ``unnamed_station`` rather than lost to NULL logic.
    """
    d = F.col("duration_sec")
    reasons = {
        "invalid_timestamp": F.col("started_at").isNull() | F.col("ended_at").isNull(),
        "missing_station": _blank(F.col(start_id)) | _blank(F.col(end_id)),
        "missing_duration": d.isNull(),
        "negative_duration": d < 0,
        "duration_too_short": d < MIN_SECONDS,
        "duration_too_long": d > MAX_SECONDS,
    }
    if month_check:
        ok = ((F.year("started_at") == F.col("expected.year"))
              & (F.month("started_at") == F.col("expected.month")))
        reasons["wrong_month"] = F.col("expected.year").isNotNull() & ~ok
    if names:
        reasons["unnamed_station"] = F.col("start_station_name").isNull() | F.col("end_station_name").isNull()
        reasons["test_station"] = (text.is_test_station(F.col("start_station_name"))
                                   | text.is_test_station(F.col("end_station_name")))
    return {k: F.coalesce(v, F.lit(False)) for k, v in reasons.items()}


def first_reason(reasons: dict[str, Column]) -> Column:
    """Name of the first reason that applies, NULL for a good row."""
    return F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in reasons.items()])


def with_reason(df: DataFrame, reasons: dict[str, Column], out: str = "drop_reason") -> DataFrame:
    return df.withColumn(out, first_reason(reasons))


def filter_accounting(df: DataFrame, reasons: dict[str, Column], by: Sequence[str]) -> DataFrame:
    """Per group: rows in, rows out, each reason counted on its own, and by first charge.

    ``rows_in = rows_out + sum(first_*)`` holds for every group. One aggregate
    over all files at once; every condition is evaluated once per row.
    """
    flags = df.select(*by, *[cond.alias(name) for name, cond in reasons.items()])
    flags = flags.withColumn("__first", first_reason({name: F.col(name) for name in reasons}))
    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_in"), count_if(F.col("__first").isNull()).alias("rows_out"),
        *[count_if(F.col(name)).alias(name) for name in reasons],
        *[count_if(F.col("__first") == name).alias(f"first_{name}") for name in reasons])


def match_counts(df: DataFrame, by: Sequence[str], col: str = "start_match_type") -> DataFrame:
    """Rows per station match type, one column each."""
    kinds = ["direct", "crosswalk", "ghost", "unmatched"]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("total"),
                               *[count_if(F.col(col) == k).alias(k) for k in kinds])


def reason_audit(df: DataFrame, by: Sequence[str], box: Sequence[float] | str = "nyc",
                 start: tuple[str, str, str] = ("start_station_id", "start_lat", "start_lon"),
                 end: tuple[str, str, str] = ("end_station_id", "end_lat", "end_lon")) -> DataFrame:
    """Ten independent data-quality counters per group."""
    d = F.col("duration_sec")
    (sid, slat, slon), (eid, elat, elon) = start, end

    def outside(lat: str, lon: str) -> Column:
        return ~geo.in_box(F.col(lat), F.col(lon), box)

    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(F.col("started_at").isNull() | F.col("ended_at").isNull()).alias("invalid_timestamp"),
        count_if(_blank(F.col(sid))).alias("missing_start_station"),
        count_if(_blank(F.col(eid))).alias("missing_end_station"),
        count_if(d < 0).alias("negative_duration"),
        count_if((d >= 0) & (d < MIN_SECONDS)).alias("duration_under_90s"),
        count_if(d > MAX_SECONDS).alias("duration_over_4h"),
        count_if(F.col(slat).isNull() | F.col(slon).isNull()).alias("missing_start_coords"),
        count_if(F.col(elat).isNull() | F.col(elon).isNull()).alias("missing_end_coords"),
        count_if(outside(slat, slon)).alias("invalid_start_coords"),
        count_if(outside(elat, elon)).alias("invalid_end_coords"))


def coordinate_spread(df: DataFrame, station: str, lat: str, lon: str, n: int | None = 20,
                      places: int = 4) -> DataFrame:
    """Stations seen at more than one rounded position, widest first.

    Positions are collapsed per (station, rounded lat, rounded lon) before the
    distinct counts, so a busy station shuffles its few positions.
    """
    cells = (df.filter(F.col(station).isNotNull())
             .groupBy(F.col(station).alias("station_id"), F.round(lat, places).alias("__la"),
                      F.round(lon, places).alias("__lo"))
             .agg(F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
                  F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
                  F.count(F.lit(1)).alias("trips")))
    out = (cells.groupBy("station_id")
           .agg(F.countDistinct("__la").alias("unique_lats"), F.countDistinct("__lo").alias("unique_lons"),
                F.min("min_lat").alias("min_lat"), F.max("max_lat").alias("max_lat"),
                F.min("min_lon").alias("min_lon"), F.max("max_lon").alias("max_lon"),
                F.sum("trips").alias("trips"))
           .filter((F.col("unique_lats") > 1) | (F.col("unique_lons") > 1)))
    if n is None:
        return out
    width = (F.col("max_lat") - F.col("min_lat")) + (F.col("max_lon") - F.col("min_lon"))
    # Rounded for the order only: equal widths then fall back to the station id.
    return out.orderBy(F.desc(F.round(width, 9)), "station_id").limit(n)


def station_timeline(ends: DataFrame, station: str = "station_id", ts: str = "started_at",
                     name: str = "name") -> DataFrame:
    """First and last month, months active and trip ends per station.

    ``ends`` holds both ends of each trip. Months are counted once per (station,
    month, name), which also makes the distinct count a plain count.
    """
    months = (ends.filter(F.col(station).isNotNull())
              .groupBy(station, F.date_trunc("month", ts).alias("month"), name)
              .agg(F.count(F.lit(1)).alias("__n")))
    return months.groupBy(station).agg(
        F.min("month").alias("first_seen"), F.max("month").alias("last_seen"),
        F.countDistinct("month").alias("months_active"), F.sum("__n").alias("trip_ends"),
        F.max(name).alias("station_name"))


def _month_bits(df: DataFrame, station: str, ts: str, name: str) -> DataFrame:
    """Per station a bitmap of its months, with the first and last one, rows and the largest name."""
    month = F.year(ts).cast("long") * 12 + F.month(ts)
    return df.filter(F.col(station).isNotNull()).groupBy(F.col(station).alias("station_id")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(month)).alias("months"), F.min(ts).alias("first"), F.max(ts).alias("last"),
        F.count(F.lit(1)).alias("n"), F.max(name).alias("name"))


def trip_timeline(trips: DataFrame, ts: str = "started_at", start: str = "start_station_id", end: str = "end_station_id",
                  start_name: str = "start_station_name", end_name: str = "end_station_name") -> DataFrame:
    """First and last month, months active and trip ends per station seen at either end.

    Each end is counted on its own into bitmaps of months, which are merged by OR; no trip is repeated for its two ends. A bitmap has
    room for the months of 32,768 (the years to 2730).
    """
    both = _month_bits(trips, start, ts, start_name).unionByName(_month_bits(trips, end, ts, end_name))
    return both.groupBy("station_id").agg(
        F.date_trunc("month", F.min("first")).alias("first_seen"), F.date_trunc("month", F.max("last")).alias("last_seen"),
        F.bitmap_count(F.bitmap_or_agg("months")).alias("months_active"), F.sum("n").alias("trip_ends"), F.max("name").alias("station_name"))


def stations_added(timeline: DataFrame) -> DataFrame:
    """Stations by the year they were first seen."""
    return (timeline.groupBy(F.year("first_seen").alias("year"))
            .agg(F.count(F.lit(1)).alias("stations_added")))


def anomalies(df: DataFrame, by: Sequence[str], launch: str, now: Column | None = None) -> DataFrame:
    """Future trips, trips before launch and round trips."""
    now = F.current_timestamp() if now is None else now
    return df.groupBy(*by).agg(
        count_if(F.col("started_at") > now).alias("future_dates"),
        count_if(F.col("started_at") < F.lit(launch).cast("timestamp")).alias("pre_launch_dates"),
        count_if(F.col("start_station_id") == F.col("end_station_id")).alias("round_trips"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows, NULLs."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (wide.unpivot(["__rows"], cols, "column_name", "nulls")
            .select("column_name", F.col("__rows").alias("total_rows"), "nulls"))


def zero_rate(df: DataFrame, value: str, by: Sequence[str], *more: Column) -> DataFrame:
    """Records, zero records and their percent per group, with further aggregates."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_records"), count_if(F.col(value) == 0).alias("zero_records"),
        F.avg(F.when(F.col(value) == 0, 100.0).otherwise(0.0)).alias("zero_pct"), *more)
