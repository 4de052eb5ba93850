"""Trips with weather, daylight and holidays.

Trips are counted per hour before any join, so the join sees hours and not
trips. Counts stay as weights, which keeps trip-weighted means exact. Distinct
stations cannot be added up over hours and have their own daily aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bins, dates
from ..functions.numeric import count_if, ratio


def hourly_counts(trips: DataFrame, by: Sequence[str | Column] = (), ts: str = "started_at") -> DataFrame:
    """Trips per hour, with rider and bike splits."""
    return trips.groupBy(F.date_trunc("hour", ts).alias("hour_ts"), *by).agg(
        F.count(F.lit(1)).alias("trips"),
        count_if(F.col("member_casual") == "member").alias("member_trips"),
        count_if(F.col("member_casual") == "casual").alias("casual_trips"),
        count_if(F.col("rideable_type") == "electric_bike").alias("ebike_trips"),
        count_if(F.col("rideable_type") == "classic_bike").alias("classic_trips"))


def with_weather(hours: DataFrame, weather: DataFrame | None = None, sun: DataFrame | None = None,
                 holidays: DataFrame | None = None) -> DataFrame:
    """Attach side tables to an hourly aggregate; hours without weather stay."""
    out = hours.withColumn("date", F.to_date("hour_ts"))
    if weather is not None:
        out = out.join(weather.withColumnRenamed("datetime", "hour_ts"), "hour_ts", "left")
    if sun is not None:
        out = out.join(sun.select("date", "daylight_hours"), "date", "left")
    if holidays is not None:
        names = holidays.groupBy("date").agg(F.max("holiday_name").alias("holiday_name"))
        out = out.join(names, "date", "left")
    return out


def weighted_mean(value: str, weight: str = "trips") -> Column:
    """Mean over trips of an hourly value; hours without a value carry no weight."""
    w = F.when(F.col(value).isNotNull(), F.col(weight))
    return ratio(F.sum(F.col(value) * F.col(weight)), F.sum(w))


def daily_weather(enriched: DataFrame) -> DataFrame:
    """One row per day. ``trip_weighted_*`` weighs each hour by its trips, ``hourly_*`` does not."""
    has = enriched.columns
    p, n = F.col("precipitation"), F.col("trips")
    aggs = [
        F.sum("trips").alias("trips"), F.sum("member_trips").alias("member_trips"),
        F.sum("casual_trips").alias("casual_trips"), F.sum("ebike_trips").alias("ebike_trips"),
        F.sum("classic_trips").alias("classic_trips"),
        weighted_mean("temperature_2m").alias("temp_c"),
        F.avg("temperature_2m").alias("hourly_temp_c"),
        F.max("precipitation").alias("max_precip_mm"),
        F.sum(p * n).alias("trip_weighted_precip_mm"), F.sum("precipitation").alias("hourly_precip_mm"),
        F.sum(F.when(p > 0, n).otherwise(0)).alias("trip_weighted_rainy_hours"),
        count_if(p > 0).alias("hourly_rainy_hours"),
        ratio(F.sum(p * n), F.count(F.lit(1))).alias("precip_per_hour_mm"),
        F.max(F.when(p > 0, 1).otherwise(0)).alias("had_rain"),
    ]
    for col, name in (("apparent_temperature", "feels_like_c"), ("wind_speed_10m", "wind_kmh"),
                      ("relative_humidity_2m", "humidity")):
        if col in has:
            aggs.append(weighted_mean(col).alias(name))
    if "daylight_hours" in has:
        aggs.append(F.max("daylight_hours").alias("daylight_hours"))
    if "holiday_name" in has:
        aggs += [F.max("holiday_name").alias("holiday"),
                 F.max(F.when(F.col("holiday_name").isNotNull(), 1).otherwise(0)).alias("is_holiday")]
    return enriched.groupBy("date").agg(*aggs)


def active_stations(trips: DataFrame, ts: str = "started_at", start: str = "start_station_id",
                    end: str = "end_station_id") -> DataFrame:
    """Distinct start and end stations per day, and their mean."""
    routes = trips.select(F.to_date(ts).alias("date"), start, end).distinct()  # trips do not fan out per count
    return (routes.groupBy("date")
            .agg(F.countDistinct(start).alias("active_start_stations"),
                 F.countDistinct(end).alias("active_end_stations"))
            .withColumn("active_stations",
                        (F.col("active_start_stations") + F.col("active_end_stations")) / 2))


def calendar_features(daily: DataFrame) -> DataFrame:
    """Date parts, weekend, Monday and Friday flags, °F, days since start."""
    d = F.col("date")
    out = daily.withColumns({
        "year": F.year(d), "month": F.month(d), "dow": dates.dow(d), "day_of_year": F.dayofyear(d),
        "is_weekend": dates.is_weekend(d).cast("int"),
        "is_monday": (dates.dow(d) == 1).cast("int"), "is_friday": (dates.dow(d) == 5).cast("int"),
    })
    if "temp_c" in daily.columns:
        out = out.withColumn("temp_f", bins.fahrenheit(F.col("temp_c")))
    if "feels_like_c" in daily.columns:
        out = out.withColumn("feels_like_f", bins.fahrenheit(F.col("feels_like_c")))
    return dates.days_since_first(out)


def good_weather(daily: DataFrame, low_f: float = 50, high_f: float = 80, wet_mm: float | None = None) -> DataFrame:
    """Mild days without rain (or with less than ``wet_mm`` in any hour) that are no holiday; tests the daily aggregates."""
    dry = F.col("max_precip_mm") == 0 if wet_mm is None else F.col("max_precip_mm") < wet_mm
    return daily.filter(F.col("temp_f").between(low_f, high_f) & dry
                        & (F.col("is_holiday") == 0))


def response_table(daily: DataFrame, value: str, by: Sequence[str], within: Sequence[str] = ("dow",)) -> DataFrame:
    """Percent of the day-of-week mean by weather class: mean, spread, days."""
    from .series import pct_of_mean

    rel = pct_of_mean(daily, value, list(within), "pct_of_expected")
    return rel.groupBy(*by).agg(F.avg("pct_of_expected").alias("mean_pct"),
                                F.stddev_samp("pct_of_expected").alias("std_pct"),
                                F.count(F.lit(1)).alias("days"))
