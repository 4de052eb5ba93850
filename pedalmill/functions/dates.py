"""Date parts and calendar labels.

Day-of-week numbers follow SQL's ``0 = Sunday``; Spark's own ``dayofweek`` starts
at 1, so everything goes through :func:`dow`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEASON_MONTHS = {"spring": (3, 4, 5), "summer": (6, 7, 8), "fall": (9, 10, 11),
                 "winter": (12, 1, 2)}


def dow(ts: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(ts) - 1


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def is_weekday(ts: Column) -> Column:
    return F.dayofweek(ts).between(2, 6)


def day_name(ts: Column, short: bool = False) -> Column:
    return F.date_format(ts, "EEE" if short else "EEEE")


def day_name_of(dow_number: Column, short: bool = False) -> Column:
    """Day name of a 0 = Sunday number."""
    # 1970-01-04 was a Sunday.
    return day_name(F.date_add(F.lit("1970-01-04").cast("date"), dow_number.cast("int")), short)


def iso_week_key(ts: Column) -> Column:
    """ISO year and ISO week, e.g. ``2019-1`` for 2018-12-31."""
    return F.concat_ws("-", F.extract(F.lit("YEAROFWEEK"), ts).cast("string"),
                       F.weekofyear(ts).cast("string"))


def calendar_week_key(ts: Column) -> Column:
    """Calendar year with the ISO week, e.g. ``2018-1`` for 2018-12-31.

    Splits the first ISO week of a year over two keys; kept because published
    figures use it. Prefer :func:`iso_week_key`.
    """
    return F.concat_ws("-", F.year(ts).cast("string"), F.weekofyear(ts).cast("string"))


def season(ts_or_month: Column, is_month: bool = False, title: bool = True) -> Column:
    month = ts_or_month if is_month else F.month(ts_or_month)
    out = F.lit(None).cast("string")
    for name, months in SEASON_MONTHS.items():
        label = name.title() if title else name
        out = F.when(month.isin(*months), label).otherwise(out)
    return out


def time_of_day(hour: Column) -> Column:
    """Named half-open hour bands; hours before 5 and from 22 are Night."""
    # Band start hours and names.
    bands = [(5, 7, "Early Morning"), (7, 10, "AM Rush"), (10, 16, "Midday"),
             (16, 19, "PM Rush"), (19, 22, "Evening")]
    return half_open_band(hour, bands, "Night")


def half_open_band(x: Column, bands: Sequence[tuple], default: str | None = None) -> Column:
    """Label ``lo <= x < hi``; NULL input takes the default like any other miss."""
    out = F.lit(default).cast("string")
    for lo, hi, label in reversed(list(bands)):
        out = F.when((x >= F.lit(lo)) & (x < F.lit(hi)), label).otherwise(out)
    return out


def rush_period(ts: Column, am: tuple[int, int] = (6, 9), pm: tuple[int, int] = (17, 20)) -> Column:
    """AM rush / PM rush / Off-Peak, inclusive hours."""
    h = F.hour(ts)
    return (F.when(h.between(*am), f"AM Rush ({am[0]}-{am[1]})")
            .when(h.between(*pm), f"PM Rush ({pm[0]}-{pm[1]})")
            .otherwise("Off-Peak"))


def is_rush(ts: Column, am: tuple[int, int] = (7, 9), pm: tuple[int, int] = (17, 19)) -> Column:
    h = F.hour(ts)
    return h.between(*am) | h.between(*pm)


def hours_between(ts: Column, start: int, end: int) -> Column:
    """Inclusive hour band that may wrap midnight (``start > end``)."""
    h = F.hour(ts)
    return h.between(start, end) if start <= end else (h >= start) | (h <= end)


def in_years(ts: Column, first: int | None, last: int | None) -> Column:
    """Years ``first`` to ``last`` as a plain range, which reaches Parquet statistics. None leaves a side open."""
    parts = []
    if first is not None:
        parts.append(ts >= F.lit(f"{first}-01-01").cast("timestamp"))
    if last is not None:
        parts.append(ts < F.lit(f"{last + 1}-01-01").cast("timestamp"))
    return reduce(lambda a, b: a & b, parts) if parts else ts.isNotNull()


def period_by_date(ts: Column, bounds: Sequence[tuple[str | None, str | None, str]]) -> Column:
    """Label half-open date ranges ``[from, to)``; None leaves a side open.

    Half-open on purpose: ``BETWEEN .. AND '2020-06-30'`` on a timestamp loses
    30 June after midnight.
    """
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(bounds)):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (ts >= F.lit(lo).cast("timestamp"))
        if hi is not None:
            cond = cond & (ts < F.lit(hi).cast("timestamp"))
        out = F.when(cond, label).otherwise(out)
    return out


def period_by_year(year: Column, periods: Sequence[tuple[int | None, int | None, str]]) -> Column:
    """Label inclusive year ranges."""
    out = F.lit(None).cast("string")
    for lo, hi, label in reversed(list(periods)):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (year >= lo)
        if hi is not None:
            cond = cond & (year <= hi)
        out = F.when(cond, label).otherwise(out)
    return out


def daylight_hours(sunrise: Column, sunset: Column) -> Column:
    return (F.unix_timestamp(sunset) - F.unix_timestamp(sunrise)) / 3600.0


def with_date_parts(df: DataFrame, ts: str = "started_at") -> DataFrame:
    """Add the usual parts of a timestamp column in one projection."""
    c = F.col(ts)
    return df.withColumns({
        "date": F.to_date(c), "year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c),
        "hour": F.hour(c), "dow": dow(c), "day_name": day_name(c),
        "day_of_year": F.dayofyear(c), "quarter": F.quarter(c), "week": F.weekofyear(c),
        "season": season(c), "is_weekend": is_weekend(c),
    })


def days_since_first(df: DataFrame, date: str = "date", out: str = "days_since_start") -> DataFrame:
    """Days since the earliest date, which is a scalar subquery."""
    return df.withColumn(out, F.datediff(F.col(date), df.agg(F.min(date)).scalar()))
