"""Cohort comparisons: difference-in-differences, ratios, asymmetry, composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import count_if, pct_change, ratio
from ..session import lookup_join
from .series import share


def place_class(trips: DataFrame, places: DataFrame, station: str, out: str) -> DataFrame:
    """Add the class of a station from a (station, class) list.

    A station in several classes takes the first by name, so each trip stays one row.
    """
    one = places.groupBy("station").agg(F.min("place_class").alias(out)).withColumnRenamed("station", station)
    return lookup_join(trips, one, station, "left")


def trips_touching(trips: DataFrame, places: DataFrame, start: str, end: str) -> DataFrame:
    """Trips with either end in the place list (semi join, no duplication)."""
    flag = places.select(F.col("station")).distinct()
    s = flag.select(F.col("station").alias(start), F.lit(True).alias("__s"))
    e = flag.select(F.col("station").alias(end), F.lit(True).alias("__e"))
    both = lookup_join(lookup_join(trips, s, start), e, end)
    return both.filter(F.col("__s") | F.col("__e")).drop("__s", "__e")


def did(df: DataFrame, treated: Column, control: Column, before: Column, after: Column,
        weight: str | None = None, by: Sequence[str] = (), months_before: float = 1.0,
        months_after: float = 1.0) -> DataFrame:
    """Change of treated minus change of control, in percent points.

    Counts (or sums of ``weight``) can be divided by the months of each period.
    All four cells come from one aggregate.
    """
    def cell(group: Column, period: Column, months: float) -> Column:
        hit = group & period
        total = count_if(hit) if weight is None else F.coalesce(F.sum(F.when(hit, F.col(weight))), F.lit(0))
        return total / F.lit(float(months))

    cells = df.groupBy(*by).agg(
        cell(treated, before, months_before).alias("treated_before"),
        cell(treated, after, months_after).alias("treated_after"),
        cell(control, before, months_before).alias("control_before"),
        cell(control, after, months_after).alias("control_after"))
    return (cells
            .withColumn("treated_change_pct", pct_change(F.col("treated_after"), F.col("treated_before")))
            .withColumn("control_change_pct", pct_change(F.col("control_after"), F.col("control_before")))
            .withColumn("did_pp", F.col("treated_change_pct") - F.col("control_change_pct")))


def cohort_ratio(df: DataFrame, by: Sequence[str], young: Column, control: Column) -> DataFrame:
    """Young over control trips per group."""
    return (df.groupBy(*by).agg(count_if(young).alias("young_trips"), count_if(control).alias("control_trips"))
            .withColumn("ratio", ratio(F.col("young_trips"), F.col("control_trips"))))


def seasonal_contrast(ratios: DataFrame, month: str, value: str, months: Sequence[int]) -> DataFrame:
    """Mean inside the months, mean outside, and the difference in percent."""
    inside = F.col(month).isin(*months)
    return ratios.agg(F.avg(F.when(inside, F.col(value))).alias("inside"),
                      F.avg(F.when(~inside, F.col(value))).alias("outside")).withColumn(
        "difference_pct", pct_change(F.col("inside"), F.col("outside")))


def asymmetry(trips: DataFrame, places: DataFrame, start: str, end: str, ts: str = "started_at",
              by: Sequence[str] = (), morning: Sequence[int] = (8, 9, 10),
              evening: Sequence[int] = (17, 18, 19)) -> DataFrame:
    """Morning arrivals over evening departures per place.

    ``places``: (place, station). All places in one job; trips are counted per
    station and hour before the list is joined.
    """
    h = F.hour(ts)
    by = list(by)
    counts = trips.groupBy(start, end, h.alias("hour"), *by).agg(F.count(F.lit(1)).alias("__n"))
    arr = places.withColumnRenamed("station", end).join(counts, end).groupBy("place", *by).agg(
        F.sum(F.when(F.col("hour").isin(*morning), F.col("__n")).otherwise(0)).alias("morning_arrivals"))
    dep = places.withColumnRenamed("station", start).join(counts, start).groupBy("place", *by).agg(
        F.sum(F.when(F.col("hour").isin(*evening), F.col("__n")).otherwise(0)).alias("evening_departures"))
    return (arr.join(dep, ["place", *by], "full").na.fill(0, ["morning_arrivals", "evening_departures"])
            .withColumn("asymmetry", ratio(F.col("morning_arrivals"), F.col("evening_departures"))))


def weekly_ratio(df: DataFrame, ts: str, young: Column, control: Column, by: Sequence[str] = ()) -> DataFrame:
    """Young, control and ratio per week, with a running week number per group."""
    weeks = cohort_ratio(df.withColumn("week", F.date_trunc("week", ts)), ["week", *by], young, control)
    return weeks.withColumn("week_no", F.row_number().over(Window.partitionBy(*by).orderBy("week")))


def composition_shift(df: DataFrame, key: str, period: Column, first: str, second: str) -> DataFrame:
    """Share of each key in two periods and the difference in percent points."""
    counts = (df.withColumn("__p", period).filter(F.col("__p").isin(first, second))
              .groupBy(key, "__p").agg(F.count(F.lit(1)).alias("__n")))
    shares = share(counts, "__n", ["__p"], "__pct")
    return (shares.groupBy(key).agg(
                F.coalesce(F.max(F.when(F.col("__p") == first, F.col("__pct"))), F.lit(0.0)).alias("first_pct"),
                F.coalesce(F.max(F.when(F.col("__p") == second, F.col("__pct"))), F.lit(0.0)).alias("second_pct"))
            .withColumn("shift_pp", F.col("second_pct") - F.col("first_pct")))


def zone_shares(df: DataFrame, zone: Column, cohort: str, a: str, b: str) -> DataFrame:
    """Share of every zone within two cohorts and over-representation of the first."""
    counts = (df.filter(F.col(cohort).isin(a, b)).groupBy(zone.alias("zone"), cohort)
              .agg(F.count(F.lit(1)).alias("__n")))
    shares = share(counts, "__n", [cohort], "__pct")
    return (shares.groupBy("zone").agg(
                F.coalesce(F.max(F.when(F.col(cohort) == a, F.col("__pct"))), F.lit(0.0)).alias("a_pct"),
                F.coalesce(F.max(F.when(F.col(cohort) == b, F.col("__pct"))), F.lit(0.0)).alias("b_pct"))
            .withColumn("over_pp", F.col("a_pct") - F.col("b_pct")))


def age_volume(trips: DataFrame, age: str = "age_at_trip", ts: str = "started_at") -> DataFrame:
    """Trips by age, with summer and fall counts."""
    m = F.month(ts)
    return trips.groupBy(F.col(age).alias("age")).agg(
        F.count(F.lit(1)).alias("trips"), count_if(m.isin(6, 7, 8)).alias("summer"),
        count_if(m.isin(9, 10, 11)).alias("fall"))


