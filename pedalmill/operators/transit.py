"""Schedule tables: stations, entrances, lines, service frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse, text

SUBWAY = 1


def stations(stops: DataFrame) -> DataFrame:
    """Station complexes: type 1, or untyped stops without a parent."""
    kind = F.col("location_type").try_cast("int")
    complexes = stops.filter((kind == 1) | (kind.isNull() & F.col("parent_station").isNull()))
    return complexes.select(
        F.col("stop_id").alias("station_id"), F.col("stop_name").alias("station_name"),
        F.col("stop_lat").alias("latitude"), F.col("stop_lon").alias("longitude"),
        text.borough_of(F.col("stop_name")).alias("borough"))


def entrances(stops: DataFrame) -> DataFrame:
    """Entrances with the name of their station (self join on the parent)."""
    parent = stops.select(F.col("stop_id").alias("parent_station"), F.col("stop_name").alias("station_name"))
    return (stops.filter(F.col("location_type").try_cast("int") == 2).join(parent, "parent_station", "left")
            .select(F.col("stop_id").alias("entrance_id"), F.col("stop_name").alias("entrance_name"),
                    F.col("stop_lat").alias("latitude"), F.col("stop_lon").alias("longitude"),
                    F.col("parent_station").alias("station_id"), "station_name"))


def lines(routes: DataFrame) -> DataFrame:
    return routes.filter(F.col("route_type").try_cast("int") == SUBWAY).select(
        "route_id", F.col("route_short_name").alias("line_name"), F.col("route_long_name").alias("route_name"),
        "route_color", "route_text_color", text.line_group(F.col("route_short_name")).alias("line_group"))


def _platforms(stops: DataFrame) -> DataFrame:
    """Stop id -> station id and name of its complex."""
    station = F.coalesce(F.col("parent_station"), F.col("stop_id"))
    names = stops.select(F.col("stop_id").alias("station_id"), F.col("stop_name").alias("station_name"))
    return stops.select("stop_id", station.alias("station_id")).join(names, "station_id", "left")


def _lined_trips(trips: DataFrame, routes: DataFrame) -> DataFrame:
    subway = routes.filter(F.col("route_type").try_cast("int") == SUBWAY).select(
        "route_id", F.col("route_short_name").alias("line_name"), "route_color")
    return trips.join(subway, "route_id").drop("route_id")


def station_lines(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    """Distinct (station, line) pairs.

    Stop times are reduced to distinct (line, stop) before the stop join.
    """
    lined = _lined_trips(trips, routes).select("trip_id", "line_name", "route_color")
    seen = (stop_times.select("trip_id", "stop_id").join(lined, "trip_id")
            .select("line_name", "route_color", "stop_id").distinct())
    return (seen.join(_platforms(stops), "stop_id")
            .select("station_id", "station_name", "line_name", "route_color").distinct())


def service_frequency(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame,
                      calendar: DataFrame | None = None) -> DataFrame:
    """Trips and trains per hour by station, line, period and (with a calendar) day type.

    Stop times are counted per (stop, line, day type, period) as soon as the trip
    is known; the stop names join the counts.
    """
    lined = _lined_trips(trips, routes).select("trip_id", "line_name", "service_id")
    keys = ["line_name"]
    if calendar is not None:
        kind = calendar.select("service_id", parse.day_type(
            F.col("monday"), F.col("saturday"), F.col("sunday")).alias("day_type"))
        lined = lined.join(kind, "service_id")
        keys.append("day_type")
    lined = lined.select("trip_id", *keys)
    hours = stop_times.select("trip_id", "stop_id", parse.clock_hour(F.col("arrival_time")).alias("__h"))
    timed = hours.select("trip_id", "stop_id", parse.service_period(F.col("__h")).alias("time_period"))
    counts = (timed.join(lined, "trip_id")
              .groupBy("stop_id", *keys, "time_period").agg(F.count(F.lit(1)).alias("__n")))
    return (counts.join(_platforms(stops), "stop_id")
            .groupBy("station_id", "station_name", *keys, "time_period")
            .agg(F.sum("__n").alias("trips_in_period"))
            .withColumn("trains_per_hour", F.round(
                F.col("trips_in_period") / parse.service_period_hours(F.col("time_period")), 1)))
