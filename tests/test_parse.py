"""Parsing, recoding and validity rules on literal rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pedalmill.functions import bins, dates, parse, text


def values(spark, rows, schema, **cols):
    df = spark.createDataFrame(rows, schema)
    return df.select(*[c.alias(n) for n, c in cols.items()]).collect()


@pytest.mark.parametrize("raw, expected", [
    ("2014-01-01 00:00:06", datetime(2014, 1, 1, 0, 0, 6)),
    ("2018-01-01 13:50:57.4340", datetime(2018, 1, 1, 13, 50, 57, 434000)),
    ("2024-01-01 13:00:04.563", datetime(2024, 1, 1, 13, 0, 4, 563000)),
    ("9/1/2014 00:00:25", datetime(2014, 9, 1, 0, 0, 25)),
    ("1/1/2015 0:01", datetime(2015, 1, 1, 0, 1)),
    ("12/31/2014 23:59:59", datetime(2014, 12, 31, 23, 59, 59)),
    ("31/12/2014 23:59:59", None),
    ("yesterday", None),
    (None, None),
])
def test_timestamps_of_all_eras(spark, raw, expected):
    assert values(spark, [(raw,)], "x string", t=parse.parse_timestamp(F.col("x")))[0].t == expected


def test_duration_rounds_half_to_even(spark):
    rows = [("2024-01-01 00:00:00.000", "2024-01-01 00:02:02.836"), ("2024-01-01 00:00:00.000", "2024-01-01 00:01:30.500"),
            ("2024-01-01 00:00:10.000", "2024-01-01 00:00:00.000")]
    s, e = (parse.parse_timestamp(F.col(c)) for c in ("s", "e"))
    assert [r.d for r in values(spark, rows, "s string, e string", d=parse.duration_seconds(s, e))] == [123, 90, -10]


def test_safe_numbers(spark):
    got = values(spark, [("1986.0",), ("1986",), ("NULL",), ("",), (None,), ("2.5",)], "x string",
                 i=parse.try_int(F.col("x")), d=parse.try_double(F.col("x")))
    assert [r.i for r in got] == [1986, 1986, None, None, None, 2]
    assert [r.d for r in got] == [1986.0, 1986.0, None, None, None, 2.5]


def test_ids_keep_their_zeros(spark):
    got = values(spark, [("519.0",), ("5636.10",), ("4028.03",), ("JC003",), (None,)], "x string",
                 s=text.strip_float_suffix(F.col("x")), c=text.id_class(F.col("x")))
    assert [r.s for r in got] == ["519", "5636.10", "4028.03", "JC003", None]
    assert [r.c for r in got] == ["legacy", "legacy", "legacy", "modern", "legacy"]


def test_synthetic_key_ignores_nulls(spark):
    import hashlib
    got = values(spark, [("a", None, "c")], "a string, b string, c string", k=parse.synthetic_key(F.col("a"), F.col("b"), F.col("c")))
    assert got[0].k == hashlib.md5(b"ac").hexdigest()


@pytest.mark.parametrize("birth, rider, year, valid, age", [
    (1969, "casual", 2017, True, 48), (1969, "casual", 2018, False, None), (1969, "member", 2018, True, 49),
    (2009, "member", 2018, False, None), (2008, "member", 2018, True, 10), (1918, "member", 2018, True, 100),
    (1917, "member", 2018, False, None), (None, "member", 2018, None, None), (1969, None, 2019, True, 50)])
def test_birth_years(spark, birth, rider, year, valid, age):
    args = (F.col("b"), F.col("r"), F.col("t"))
    got = values(spark, [(birth, rider, datetime(year, 6, 1))], "b int, r string, t timestamp",
                 v=parse.birth_year_valid(*args), a=parse.age_at_trip(*args))[0]
    assert (got.v, got.a) == (valid, age)


def test_gender_is_three_valued(spark):
    got = values(spark, [(0,), (1,), (2,), (None,)], "g int", v=parse.gender_valid(F.col("g")))
    assert [r.v for r in got] == [False, True, True, None]


@pytest.mark.parametrize("name, expected", [
    ("201409-bikeshare-tripdata.csv", (2014, 9)), ("2014-bikeshare-tripdata_201401-bikeshare-tripdata_1.csv", (2014, 1)),
    ("JC-202012.csv", (2020, 12)), ("x209913.csv", (None, None)), ("201213.csv", (None, None)), ("readme.csv", (None, None))])
def test_month_from_file_name(spark, name, expected):
    got = values(spark, [(name,)], "n string", e=parse.expected_year_month(F.col("n")))[0].e
    assert (got.year, got.month) == expected


def test_weekday_numbers_start_on_sunday(spark):
    rows = [(datetime(2024, 1, 7 + i),) for i in range(7)]
    got = values(spark, rows, "t timestamp", d=dates.dow(F.col("t")), n=dates.day_name(F.col("t"), True),
                 m=dates.day_name_of(dates.dow(F.col("t")), True))
    assert [r.d for r in got] == list(range(7))
    assert [r.n for r in got] == [r.m for r in got] == ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def test_week_keys_at_new_year(spark):
    got = values(spark, [(datetime(2018, 12, 31),)], "t timestamp", i=dates.iso_week_key(F.col("t")),
                 c=dates.calendar_week_key(F.col("t")))[0]
    assert (got.i, got.c) == ("2019-1", "2018-1")


def test_date_periods_keep_their_last_day(spark):
    bounds = [(None, "2020-03-01", "before"), ("2020-03-01", "2020-07-01", "lockdown"), ("2020-07-01", None, "after")]
    got = values(spark, [(datetime(2020, 6, 30, 18),), (datetime(2020, 7, 1),), (datetime(2020, 2, 29, 23, 59),)],
                 "t timestamp", p=dates.period_by_date(F.col("t"), bounds))
    assert [r.p for r in got] == ["lockdown", "after", "before"]


def test_cut_is_right_closed(spark):
    got = values(spark, [(0.0,), (32.0,), (32.1,), (100.0,), (100.5,), (None,)], "x double",
                 b=bins.cut(F.col("x"), bins.FEELS_LIKE_EDGES, bins.FEELS_LIKE_LABELS))
    assert [r.b for r in got] == [None, "<32°F", "32-45°F", "85°F+", None, None]


def test_equal_width_bins_cover_both_ends(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 5, 5.1, 100)] + [(None,)], "x double")
    got = [r.bin for r in bins.equal_width_bins(df, "x", 20).orderBy(F.col("x").asc_nulls_last()).collect()]
    assert got == [1, 1, 2, 20, None]


def test_clip_keeps_null(spark):
    got = values(spark, [(12.0,), (3.0,), (None,)], "x double", c=bins.clip(F.col("x"), upper=10))
    assert [r.c for r in got] == [10.0, 3.0, None]


def test_hours_wrap_midnight(spark):
    rows = [(datetime(2024, 1, 1, h),) for h in (21, 22, 23, 0, 4, 5)]
    got = values(spark, rows, "t timestamp", k=dates.hours_between(F.col("t"), 22, 4))
    assert [r.k for r in got] == [False, True, True, True, True, False]


def test_schedule_hours(spark):
    got = values(spark, [("7:05:00",), ("25:10:00",), ("09:59:59",), ("x",), (None,)], "a string",
                 h=parse.clock_hour(F.col("a")), p=parse.service_period(parse.clock_hour(F.col("a"))))
    assert [(r.h, r.p) for r in got] == [(7, "AM Peak"), (25, "Night"), (9, "AM Peak"), (None, "Night"), (None, "Night")]


def test_brackets_and_counts(spark):
    day, holiday = text.bracket_prefix(F.col("x"))
    got = values(spark, [("(MLK Day) Monday",), (" Friday ",), (None,)], "x string", d=day, h=holiday)
    assert [(r.d, r.h) for r in got] == [("Monday", "MLK Day"), ("Friday", None), ("", None)]
    got = values(spark, [("1,234",), ("",), ("12.7",), ("n/a",), (None,), ("NaN",)], "x string", n=text.clean_count(F.col("x")))
    assert [r.n for r in got] == [1234, 0, 12, 0, 0, 0]


def test_test_stations(spark):
    names = ["NYCBS Depot - DEL", "Don't use 8D", "Central Park S", "W 20 St (TEMP)", "Label St", None]
    got = values(spark, [(n,) for n in names], "x string", t=text.is_test_station(F.col("x")))
    assert [r.t for r in got] == [True, True, False, True, True, None]


def test_observed_holidays(spark):
    name, kind = text.split_observed(F.col("x"))
    got = values(spark, [("Independence Day (Observed)",), ("Labor Day",), ("X (observed)",)], "x string", n=name, k=kind)
    assert [(r.n, r.k) for r in got] == [("Independence Day", "observed"), ("Labor Day", "federal"), ("X", "observed")]


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_similarity_against_dynamic_programming(spark):
    import random
    rng = random.Random(5)
    pairs = [("".join(rng.choice("ab cdé") for _ in range(rng.randint(0, 80))), "".join(rng.choice("ab cdé") for _ in range(rng.randint(0, 80))))
             for _ in range(300)] + [("", ""), ("", "x")]
    got = values(spark, pairs, "a string, b string", a=F.col("a"), b=F.col("b"), s=text.similarity(F.col("a"), F.col("b")))
    for r in got:
        n = len(r.a) + len(r.b)
        assert r.s == pytest.approx(100.0 if n == 0 else 200.0 * brute_lcs(r.a, r.b) / n)


def test_token_sort(spark):
    got = values(spark, [("W 14 St & The High Line", "10 Ave & W 14 St"), ("A b", "B  a"), (None, "x")], "a string, b string",
                 s=text.token_sort_ratio(F.col("a"), F.col("b")))
    assert got[1].s == 100.0 and got[2].s is None and 50 <= got[0].s < 65


def test_long_quoted_cells_are_counted(spark):
    from pedalmill.sources import trips
    rows = ['a,"' + 'b,""' * 20000 + '",c', 'a,"b"c,d', '"a""b",,"c,d"', "", '"', '"",""']
    df = spark.createDataFrame([(r,) for r in rows], "r string")
    assert [r[0] for r in df.select(trips._cell_count(F.col("r"))).collect()] == [3, 3, 3, 1, 1, 2]


def test_usual_stamps_are_read_as_the_patterns_read_them(spark):
    rows = ["2024-02-29 23:59:59", "2023-02-29 00:00:00", "2024-01-01 24:00:00", "2024-01-01 00:00:60", "0000-01-01 00:00:00", "0001-01-01 00:00:00",
            "2024-01-01 00:00:00.5", "2024-01-01 00:00:00.123456", "2024-01-01 00:00:00.1234567", "2024-01-01 00:00:00.", "2024-01-01T00:00:00", "2024-01-01",
            "2024-01-01 00:00:00Z", "2024-01-01 00:00:00 ", "2024-01-01 00:00:00\n", "1/2/2024 3:04", "12/31/2024 13:04:05", "13/1/2024 3:04", "", "x", None]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    patterns = F.coalesce(*[F.try_to_timestamp("t", F.lit(p)) for p in ("yyyy-MM-dd HH:mm:ss[.SSSSSS]", "M/d/yyyy H:mm[:ss]")])
    got = df.select("t", parse.parse_timestamp(F.col("t")).cast("double").alias("a"), patterns.cast("double").alias("b")).collect()
    assert [(r.t, r.a) for r in got] == [(r.t, r.b) for r in got]
    # the patterns are compiled into the plan only behind the usual form
    plan = df.select(parse.parse_timestamp(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("gettimestamp")


def test_month_of_a_file_is_read_once_per_file(spark, tmp_path):
    from pedalmill.sources import manifest, trips
    head = ",".join(trips.MODERN.values())
    (tmp_path / "202403-x-tripdata.csv").write_text(head + "\n" + ",".join(["r", "b", "2024-03-01 00:00:00", "2024-03-01 00:10:00", *["1"] * 8, "member"]) + "\n")
    rows = trips.read_files(spark, manifest.trip_files(spark, f"file:{tmp_path}"))
    assert [(tuple(r.expected), r.duration_sec) for r in rows.collect()] == [((2024, 3), 600)]
    plan = rows.select("source_path", "started_at", "expected")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "regexp_extract" not in plan.split("Join Inner")[0]
