"""Weather-adjusted growth: daily table, regression, adjusted series, decomposition."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bins
from ..operators import enrich, regression
from ..session import durable

WEATHER = ["temp_f", "temp_f_sq", "rain_intensity", "is_rainy", "daylight_hours"]
CALENDAR = ["is_weekend", "is_holiday"]


def daily_table(trips: DataFrame, weather: DataFrame, sun: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row per day with trips, weather, calendar and system size.

    Written to reliable storage, because every model makes several passes over it.
    """
    hours = enrich.with_weather(enrich.hourly_counts(trips), weather, sun, holidays)
    daily = enrich.calendar_features(enrich.daily_weather(hours))
    sized = daily.join(enrich.active_stations(trips), "date", "left")
    return durable(sized.withColumns({
        "ebike_pct": F.coalesce(F.col("ebike_trips") * 100.0 / F.col("trips"), F.lit(0.0)),
        "trips_per_station": F.col("trips") / F.col("active_stations")}))


@dataclass(frozen=True)
class Design:
    frame: DataFrame
    weather: list[str]
    calendar: list[str]
    years: list[str]

    @property
    def features(self) -> list[str]:
        return [*self.weather, *self.calendar, *self.years]


def weather_design(daily: DataFrame, years: Sequence[int], base_year: int) -> Design:
    """Quadratic temperature, capped rain, calendar dummies (Monday, July and the base
    year are the reference levels)."""
    frame = daily.withColumns({
        "temp_f_sq": F.col("temp_f") * F.col("temp_f"),
        "is_rainy": (F.col("max_precip_mm") > 0).cast("int"),
        "rain_intensity": bins.clip(F.col("max_precip_mm"), upper=10)})
    dow = bins.one_hot(F.col("dow"), range(7), "dow", drop=1)
    month = bins.one_hot(F.col("month"), range(1, 13), "month", drop=7)
    year = bins.one_hot(F.col("year"), years, "year", drop=base_year)
    return Design(frame.withColumns({**dow, **month, **year}), list(WEATHER),
                  [*CALENDAR, *dow, *month], list(year))


def adjusted(design: Design, y: str = "trips") -> tuple[regression.Fit, DataFrame]:
    """Fit the model and remove weather and calendar effects from the series."""
    clean = design.frame.dropna(subset=[*design.features, y])
    fit = regression.ols(clean, design.features, y)
    series = regression.adjusted_series(clean, fit, y, {"weather": design.weather, "calendar": design.calendar})
    return fit, series


def demand_models(daily: DataFrame, years: Sequence[int], base_year: int,
                  y: str = "trips") -> dict[str, regression.Fit]:
    """Models A (weather, calendar, year), B (+ stations) and C (+ e-bike share), one pass."""
    frame = daily.filter(F.col("year") >= base_year).withColumns({
        **bins.temperature_flags(F.col("temp_f")), **bins.rain_flags(F.col("max_precip_mm"))})
    dow = bins.one_hot(F.col("dow"), range(7), "dow", drop=1)
    year = bins.one_hot(F.col("year"), years, "year", drop=base_year)
    frame = frame.withColumns({**dow, **year})
    base = ["temp_freezing", "temp_cold", "temp_cool", "temp_hot", "temp_very_hot", "rain_light", "rain_heavy",
            "is_weekend", "is_holiday", "daylight_hours", *dow, *year]
    return regression.nested(frame, {"A": base, "B": [*base, "active_stations"],
                                     "C": [*base, "active_stations", "ebike_pct"]}, y)
