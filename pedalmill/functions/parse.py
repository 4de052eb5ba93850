"""Dirty text to typed values. Everything here gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """Timestamps of all eras.

    ISO with 0 to 6 fraction digits, or month/day/year with one- or two-digit
    parts and optional seconds. Month comes first; day-first is never guessed. A cast reads the usual ISO form at a
    fraction of a pattern's cost; whatever else there is meets the patterns.
    """
    usual = text.rlike(r"\A(?!0000)\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:\.\d{1,6})?\z")
    return F.when(usual, text.try_cast("timestamp")).otherwise(F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss[.SSSSSS]")),
        F.try_to_timestamp(text, F.lit("M/d/yyyy H:mm[:ss]")),
    ))


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two timestamps, rounded half to even; NULL beyond the range of INT."""
    return F.rint(end.cast("double") - start.cast("double")).try_cast("int")


def try_double(text: Column) -> Column:
    return text.cast("string").try_cast("double")


def try_int(text: Column) -> Column:
    """``1986`` and ``1986.0`` both parse; the value is rounded half to even."""
    return F.rint(try_double(text)).try_cast("int")


def synthetic_key(*parts: Column) -> Column:
    """MD5 over the parts, NULL counting as empty text."""
    return F.md5(F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def rider_type(text: Column) -> Column:
    return (F.when(text == "Subscriber", "member").when(text == "Customer", "casual")
            .otherwise(text))


def null_of(sql_type: str) -> Column:
    return F.lit(None).cast(sql_type)


def _default_birth_year(birth_year: Column, member_casual: Column, year: Column) -> Column:
    # Casual riders from 2018 on carry 1969 when the year was not given.
    return (birth_year == 1969) & F.coalesce(member_casual == "casual", F.lit(False)) & (year >= 2018)


def birth_year_valid(birth_year: Column, member_casual: Column, started_at: Column) -> Column:
    """NULL without a birth year, else whether it is believable."""
    year = F.year(started_at)
    age = year - birth_year
    return (F.when(birth_year.isNull(), F.lit(None).cast("boolean"))
            .when(_default_birth_year(birth_year, member_casual, year), F.lit(False))
            .when((age < 10) | (age > 100), F.lit(False))
            .otherwise(F.lit(True)))


def gender_valid(gender: Column) -> Column:
    return F.when(gender.isNull(), F.lit(None).cast("boolean")).otherwise(gender.isin(1, 2))


def age_at_trip(birth_year: Column, member_casual: Column, started_at: Column) -> Column:
    """Age in the year of the trip, NULL unless the birth year is valid."""
    ok = birth_year_valid(birth_year, member_casual, started_at)
    return F.when(ok, (F.year(started_at) - birth_year).cast("int"))


def clean_demographics(age: Column, gender: Column, birth_ok: Column) -> Column:
    """Valid birth year, age 16 to 80 and a stated gender."""
    return F.coalesce(birth_ok & age.between(16, 80) & gender.isin(1, 2), F.lit(False))


def clock_hour(text: Column) -> Column:
    """Hour of a schedule time such as ``7:05:00`` or ``25:10:00``."""
    return F.trim(F.substring_index(text, ":", 1)).try_cast("int")


# Service periods as inclusive hours, with the hours each spans.
SERVICE_PERIODS = [
    ("AM Peak", 7, 9, 3.0),
    ("Midday", 10, 15, 6.0),
    ("PM Peak", 16, 19, 4.0),
    ("Evening", 20, 23, 4.0),
]
NIGHT_HOURS = 7.0


def service_period(hour: Column) -> Column:
    """Service period of a schedule hour; 24 and above count as Night."""
    out = F.lit("Night")
    for name, lo, hi, _ in SERVICE_PERIODS:
        out = F.when(hour.between(lo, hi), name).otherwise(out)
    return out


def service_period_hours(period: Column) -> Column:
    out = F.lit(NIGHT_HOURS)
    for name, _, _, hours in SERVICE_PERIODS:
        out = F.when(period == name, F.lit(hours)).otherwise(out)
    return out


def day_type(monday: Column, saturday: Column, sunday: Column) -> Column:
    return (F.when(monday == 1, "Weekday").when(saturday == 1, "Saturday")
            .when(sunday == 1, "Sunday").otherwise("Other"))


# Fixed value: a year-month stamp in front of a dash and a word.
NAMED_STAMP = r"(\d{4})(\d{2})-[a-z]"


def expected_year_month(file_name: Column, first: int = 2013, last: int = 9999) -> Column:
    """Struct (year, month) the file name promises, NULL fields when it names none.

    A bare six-digit stamp counts from the first year of the system on.
    """
    named_y = F.regexp_extract(file_name, NAMED_STAMP, 1)
    named_m = F.regexp_extract(file_name, NAMED_STAMP, 2)
    any_y = F.regexp_extract(file_name, r"(\d{4})(\d{2})", 1)
    any_m = F.regexp_extract(file_name, r"(\d{4})(\d{2})", 2)
    named = named_y != ""
    plausible = (any_y.try_cast("int").between(first, last)) & (any_m.try_cast("int").between(1, 12))
    year = F.when(named, named_y.try_cast("int")).when(plausible, any_y.try_cast("int"))
    month = F.when(named, named_m.try_cast("int")).when(plausible, any_m.try_cast("int"))
    return F.struct(year.alias("year"), month.alias("month"))
