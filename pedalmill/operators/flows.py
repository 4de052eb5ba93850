"""Trip scenarios, routes, station flow and corridors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numeric import count_if, pct, share_if
from .series import top_per_group


@dataclass(frozen=True)
class Scenario:
    """A named selection of trips. ``None`` leaves a side open."""

    hours: tuple[int, int] = (0, 23)
    days: str | None = None            # 'weekday', 'weekend' or None
    years: tuple[int | None, int | None] = (None, None)
    season: str | None = None
    min_minutes: int | None = None
    max_minutes: int | None = None
    rider: str | None = None
    bike: str | None = None


# The named scenarios.
SCENARIOS = {
    "member_commutes_7min": Scenario(days="weekday", rider="member", min_minutes=7, max_minutes=60),
    "morning_rush": Scenario(hours=(7, 9), days="weekday", rider="member", max_minutes=60),
    "evening_rush": Scenario(hours=(17, 19), days="weekday", rider="member", max_minutes=60),
    "weekend_leisure": Scenario(days="weekend"),
    "long_rides": Scenario(min_minutes=20),
    "ebikes_only": Scenario(bike="electric_bike", years=(2020, None)),
    "tourist": Scenario(rider="casual"),
    "everything": Scenario(),
}


def scenario_predicate(cfg: Scenario, ts: str = "started_at") -> Column:
    """One predicate for a scenario; it reaches the scan like any hand-written filter."""
    when = F.col(ts)
    parts: list[Column] = [dates.in_years(when, *cfg.years)]
    if cfg.hours != (0, 23):
        parts.append(dates.hours_between(when, *cfg.hours))
    if cfg.days == "weekday":
        parts.append(dates.is_weekday(when))
    elif cfg.days == "weekend":
        parts.append(dates.is_weekend(when))
    if cfg.season:
        parts.append(F.month(when).isin(*dates.SEASON_MONTHS[cfg.season]))
    if cfg.min_minutes:
        parts.append(F.col("duration_sec") >= cfg.min_minutes * 60)
    if cfg.max_minutes:
        parts.append(F.col("duration_sec") <= cfg.max_minutes * 60)
    if cfg.rider:
        parts.append(F.col("member_casual") == cfg.rider)
    if cfg.bike:
        parts.append(F.col("rideable_type") == cfg.bike)
    return reduce(lambda a, b: a & b, parts)


def select_scenario(trips: DataFrame, cfg: Scenario | str, one_way: bool = True) -> DataFrame:
    """Trips of a scenario; by default only trips between two located, different stations."""
    cfg = SCENARIOS[cfg] if isinstance(cfg, str) else cfg
    out = trips.filter(scenario_predicate(cfg))
    if one_way:
        out = out.filter((F.col("start_station_id") != F.col("end_station_id"))
                         & F.col("start_lat").isNotNull() & F.col("end_lat").isNotNull())
    return out


ROUTE = ("start_station_id", "end_station_id")


def routes(trips: DataFrame, keys: Sequence[str] = ROUTE, min_trips: int = 1) -> DataFrame:
    """Trips, mean minutes and member share per route."""
    return (trips.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("trips"),
                 (F.avg("duration_sec") / 60).alias("avg_duration_min"),
                 share_if(F.col("member_casual") == "member").alias("member_pct"))
            .filter(F.col("trips") >= min_trips))


def top_routes(trips: DataFrame, n: int = 50, min_trips: int = 500,
               keys: Sequence[str] = ROUTE) -> DataFrame:
    """Busiest routes with mean end points; ties by route key."""
    return (trips.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.avg("start_lat").alias("start_lat"), F.avg("start_lon").alias("start_lon"),
                 F.avg("end_lat").alias("end_lat"), F.avg("end_lon").alias("end_lon"),
                 (F.avg("duration_sec") / 60).alias("avg_duration_min"),
                 share_if(F.col("member_casual") == "member").alias("member_pct"))
            .filter(F.col("trips") >= min_trips)
            .orderBy(F.desc("trips"), *keys).limit(n))


def route_class(member_pct: Column, commuter_above: float = 90, tourist_below: float = 40) -> Column:
    return (F.when(member_pct > commuter_above, "Commuter")
            .when(member_pct < tourist_below, "Tourist").otherwise("Mixed"))


def classed_routes(trips: DataFrame, keys: Sequence[str] = ROUTE, min_trips: int = 1,
                   ebike_from_year: int = 2020) -> DataFrame:
    """Routes with member share, e-bike share (of trips since e-bikes exist) and class."""
    recent = F.year("started_at") >= ebike_from_year
    return (trips.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("trips"),
                 (F.avg("duration_sec") / 60).alias("avg_duration_min"),
                 share_if(F.col("member_casual") == "member").alias("member_pct"),
                 pct(count_if(F.col("rideable_type") == "electric_bike"),
                     count_if(recent)).alias("ebike_pct"))
            .filter(F.col("trips") >= min_trips)
            .withColumn("route_type", route_class(F.col("member_pct"))))


def class_summary(classed: DataFrame) -> DataFrame:
    return classed.groupBy("route_type").agg(
        F.count(F.lit(1)).alias("routes"), F.sum("trips").alias("trips"),
        F.avg("trips").alias("mean_trips"), F.avg("avg_duration_min").alias("avg_duration_min"),
        F.avg("member_pct").alias("member_pct"))


def bike_types_by_route(trips: DataFrame, keys: Sequence[str] = ROUTE, min_trips: int = 1) -> DataFrame:
    """E-bike and classic trips, share and mean minutes per route."""
    e, c = F.col("rideable_type") == "electric_bike", F.col("rideable_type") == "classic_bike"
    return (trips.filter(e | c).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("total_trips"), count_if(e).alias("ebike_trips"),
                 count_if(c).alias("classic_trips"), share_if(e).alias("ebike_pct"),
                 (F.avg(F.when(e, F.col("duration_sec"))) / 60).alias("ebike_min"),
                 (F.avg(F.when(c, F.col("duration_sec"))) / 60).alias("classic_min"))
            .filter(F.col("total_trips") >= min_trips))


def net_flow(trips: DataFrame, start: str = "start_station_id", end: str = "end_station_id") -> DataFrame:
    """Departures, arrivals and arrivals - departures for every station seen at either end.

    A station that only receives bikes is kept. Trips are first counted per
    pair, so what is stacked is pairs, not trips.
    """
    pairs = trips.groupBy(start, end).agg(F.count(F.lit(1)).alias("__n"))
    zero = F.lit(0).cast("long")
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col(start).alias("station_id"), F.col("__n").alias("dep"), zero.alias("arr")),
        F.struct(F.col(end).alias("station_id"), zero.alias("dep"), F.col("__n").alias("arr"))
    )).alias("e")).select("e.*").filter(F.col("station_id").isNotNull())
    return (ends.groupBy("station_id")
            .agg(F.sum("dep").alias("depart_count"), F.sum("arr").alias("arrive_count"))
            .withColumn("net_flow", F.col("arrive_count") - F.col("depart_count")))


def corridors(trips: DataFrame, start: str = "start_station_id", end: str = "end_station_id",
              min_each_way: int = 1) -> DataFrame:
    """Two-way corridors with both counts and their imbalance in percent.

    Both directions fall on one (least, greatest) key, so there is no self join.
    """
    a, b = F.least(F.col(start), F.col(end)), F.greatest(F.col(start), F.col(end))
    forward = F.col(start) == a
    return (trips.filter(F.col(start) != F.col(end))
            .groupBy(a.alias("station_a"), b.alias("station_b"))
            .agg(count_if(forward).alias("a_to_b"), count_if(~forward).alias("b_to_a"))
            .filter((F.col("a_to_b") >= min_each_way) & (F.col("b_to_a") >= min_each_way))
            .withColumn("total", F.col("a_to_b") + F.col("b_to_a"))
            .withColumn("imbalance_pct", pct(F.abs(F.col("a_to_b") - F.col("b_to_a")), F.col("total"))))


def compare_sets(a: DataFrame, b: DataFrame, keys: Sequence[str], name_a: str, name_b: str) -> DataFrame:
    """Each key of either set with ``both``, ``<a>_only`` or ``<b>_only``."""
    left = a.select(*keys).distinct().withColumn("__a", F.lit(True))
    right = b.select(*keys).distinct().withColumn("__b", F.lit(True))
    side = (F.when(F.col("__a") & F.col("__b"), "both")
            .when(F.col("__a"), f"{name_a}_only").otherwise(f"{name_b}_only"))
    return left.join(right, list(keys), "full").select(*keys, side.alias("side"))


def compare_sides(rows: DataFrame, keys: Sequence[str], side: str, name_a: str, name_b: str) -> DataFrame:
    """The same for two sets stacked in one frame with a side column: one aggregate, no join."""
    a, b = F.max(F.col(side) == name_a), F.max(F.col(side) == name_b)
    return rows.groupBy(*keys).agg(F.when(a & b, "both").when(a, f"{name_a}_only")
                                   .otherwise(f"{name_b}_only").alias("side"))


def rank_change(trips: DataFrame, keys: Sequence[str], year_a: int, year_b: int, n: int) -> DataFrame:
    """Routes that are in the top ``n`` of either year, with both ranks and counts.

    One aggregate over both years; ranks come from two short sorted lists.
    """
    when = F.col("started_at")
    both = trips.filter(dates.in_years(when, year_a, year_a) | dates.in_years(when, year_b, year_b))
    counts = both.groupBy(*keys, F.year(when).alias("year")).agg(F.count(F.lit(1)).alias("trips"))
    return top_per_group(counts, ["year"], [F.desc("trips"), *keys], n)


def period_change(counts: DataFrame, key: str, period: str, value: str, first: str, second: str,
                  min_first: int = 1) -> DataFrame:
    """Change of each key between two periods, in percent; no first value gives NULL."""
    wide = counts.groupBy(key).agg(
        F.coalesce(F.sum(F.when(F.col(period) == first, F.col(value))), F.lit(0)).alias("first_value"),
        F.coalesce(F.sum(F.when(F.col(period) == second, F.col(value))), F.lit(0)).alias("second_value"))
    return (wide.withColumn("change_pct", pct(F.col("second_value") - F.col("first_value"),
                                              F.col("first_value")))
            .filter(F.col("first_value") >= min_first))
