"""The weather-adjusted growth plan on a generated year of trips with known effects."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pedalmill.operators import regression
from pedalmill.plans import growth


@pytest.fixture(scope="module")
def daily(spark):
    days = [date(2014, 1, 1) + timedelta(days=i) for i in range(800)]
    rain = {d: 2.0 if i % 5 == 0 else 0.0 for i, d in enumerate(days)}
    temp = {d: 5.0 + (i * 7 % 30) for i, d in enumerate(days)}
    counts = [(d, 20 + int(temp[d]) - (6 if rain[d] else 0) + (10 if d.year > 2014 else 0)) for d in days]
    trips = (spark.createDataFrame(counts, "d date, n int").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
             .select((F.col("d").cast("timestamp") + F.make_dt_interval(hours=F.lit(9))).alias("started_at"),
                     F.when(F.col("i") % 2 == 0, "member").otherwise("casual").alias("member_casual"),
                     F.when(F.col("i") % 4 == 0, "electric_bike").otherwise("classic_bike").alias("rideable_type"),
                     (F.col("i") % 7).alias("start_station_id"), (F.col("i") % 5).alias("end_station_id")))
    weather = spark.createDataFrame([(datetime(d.year, d.month, d.day, 9), temp[d], temp[d], rain[d], 1.0, 50.0) for d in days],
                                    "datetime timestamp, temperature_2m double, apparent_temperature double, precipitation double, "
                                    "wind_speed_10m double, relative_humidity_2m double")
    sun = spark.createDataFrame([(d, 9.0 + (i % 11) / 4) for i, d in enumerate(days)], "date date, daylight_hours double")
    holidays = spark.createDataFrame([(d, "H") for d in days[::50]], "date date, holiday_name string")
    return growth.daily_table(trips, weather, sun, holidays), dict(counts)


def test_daily_table(daily):
    table, counts = daily
    rows = {r.date: r for r in table.collect()}
    assert {d: r.trips for d, r in rows.items()} == counts
    r = rows[date(2014, 1, 1)]
    assert (r.temp_c, r.max_precip_mm, r.is_holiday, r.active_start_stations, r.active_end_stations, r.active_stations) == (5.0, 2.0, 1, 7, 5, 6.0)
    assert r.trips_per_station == r.trips / 6 and r.days_since_start == 0 and r.temp_f == 41.0


def test_adjusted_series_removes_weather(spark, daily):
    table, _ = daily
    design = growth.weather_design(table, [2014, 2015, 2016], 2014)
    fit, series = growth.adjusted(design)
    p = fit.params()
    assert p["temp_f"] == pytest.approx(5 / 9, abs=1e-6) and p["temp_f_sq"] == pytest.approx(0, abs=1e-8)
    # Rain is always 2 mm here, so only the sum of its two effects is determined.
    assert 2 * p["rain_intensity"] + p["is_rainy"] == pytest.approx(-6, abs=1e-6)
    assert p["year_2015"] == pytest.approx(10, abs=1e-6) and fit.r2 == pytest.approx(1.0)
    level = {r.y: (r.lo, r.hi) for r in series.groupBy(F.year("date").alias("y")).agg(
        F.min("adjusted_trips").alias("lo"), F.max("adjusted_trips").alias("hi")).collect()}
    assert level[2014][0] == pytest.approx(level[2014][1], abs=1e-5)
    assert level[2015][0] - level[2014][0] == pytest.approx(10, abs=1e-5)


def test_demand_models_share_one_pass(daily):
    table, _ = daily
    fits = growth.demand_models(table, [2014, 2015, 2016], 2014)
    assert set(fits) == {"A", "B", "C"} and len(fits["C"].names) == len(fits["A"].names) + 2
    assert fits["A"].r2 <= fits["B"].r2 + 1e-9 <= fits["C"].r2 + 2e-9
    annual = table.groupBy("year").agg(F.sum("trips").alias("total"), F.avg("active_stations").alias("active_stations"),
                                       F.avg("ebike_pct").alias("ebike_pct"))
    coef = fits["C"].params()
    out = regression.growth_decomposition(annual, "total", {k: coef[k] for k in ("active_stations", "ebike_pct")}, 2014)
    for r in out.collect():
        assert r.total_growth == pytest.approx(r.active_stations_contribution + r.ebike_pct_contribution + r.organic_growth)
