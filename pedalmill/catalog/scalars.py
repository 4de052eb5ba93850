"""Projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bins, dates, geo, parse, text
from ..operators import identity, reshape
from ..sources import trips as trip_source
from . import views as v
from .registry import query, r, table

# --- raw projections -------------------------------------------------------------

_MODERN_SQL = f"""WITH {v.TRIPS}
SELECT CAST(ride_id AS VARCHAR) AS ride_id, rideable_type,
  strftime(date_trunc('milliseconds', started_at), '%Y-%m-%d %H:%M:%S.%g') AS started_at,
  CAST(epoch(date_trunc('second', started_at) + to_seconds(duration_sec)
       - date_trunc('milliseconds', started_at)) AS INTEGER)::BIGINT AS duration_sec,
  CAST(start_station_id AS VARCHAR) || '.10' AS start_station_id_raw, start_lat AS start_lat_raw,
  CASE WHEN ride_id % 9 = 0 THEN NULL ELSE end_lat END AS end_lat_raw, member_casual
FROM trips"""


@query("P1", "P5", "P6", "P10", sql=_MODERN_SQL)
def modern_projection(spark, sf):
    """Raw modern text columns made from trips, brought to the common schema."""
    t = v.trips(spark, sf)
    end = F.date_trunc("second", "started_at") + F.make_dt_interval(secs=F.col("duration_sec"))
    raw = t.select(
        F.col("ride_id").cast("string").alias("ride_id"), "rideable_type",
        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("started_at"),
        F.date_format(end, "yyyy-MM-dd HH:mm:ss").alias("ended_at"),
        F.lit("n").alias("start_station_name"),
        F.concat(F.col("start_station_id").cast("string"), F.lit(".10")).alias("start_station_id"),
        F.lit("m").alias("end_station_name"), F.col("end_station_id").cast("string").alias("end_station_id"),
        F.col("start_lat").cast("string").alias("start_lat"), F.col("start_lon").cast("string").alias("start_lng"),
        F.when(F.col("ride_id") % 9 == 0, "NULL").otherwise(F.col("end_lat").cast("string")).alias("end_lat"),
        F.col("end_lon").cast("string").alias("end_lng"), "member_casual")
    out = trip_source.project(raw, "modern")
    return out.select("ride_id", "rideable_type",
                      F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("started_at"), "duration_sec",
                      "start_station_id_raw", "start_lat_raw", "end_lat_raw", "member_casual")


def _legacy_raw(spark, sf, family):
    t = v.trips(spark, sf)
    names = trip_source.COLUMN_NAMES[family]
    stamp = (F.when(F.col("ride_id") % 4 == 0, F.date_format("started_at", "yyyy-MM-dd HH:mm:ss"))
             .when(F.col("ride_id") % 4 == 1, F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
             .when(F.col("ride_id") % 4 == 2, F.date_format("started_at", "M/d/yyyy HH:mm:ss"))
             .otherwise(F.date_format("started_at", "M/d/yyyy H:mm")))
    cells = {
        "seconds": F.col("duration_sec").cast("string"), "start": stamp,
        "end": F.when(F.col("ride_id") % 13 == 0, "not a time").otherwise(stamp),
        "start_id": F.concat(F.col("start_station_id").cast("string"), F.lit(".0")), "start_name": F.lit("a"),
        "start_lat": F.col("start_lat").cast("string"), "start_lon": F.col("start_lon").cast("string"),
        "end_id": F.col("end_station_id").cast("string"), "end_name": F.lit("b"),
        "end_lat": F.col("end_lat").cast("string"), "end_lon": F.col("end_lon").cast("string"),
        "bike": F.col("ride_id").cast("string"),
        "rider": F.when(F.col("member_casual") == "member", "Subscriber").when(
            F.col("ride_id") % 17 == 0, "Dependent").otherwise("Customer"),
        "birth": F.when(F.col("ride_id") % 5 == 0, F.lit(None)).otherwise(
            F.concat((F.lit(2024) - F.col("age_at_trip")).cast("string"),
                     F.when(F.col("ride_id") % 2 == 0, ".0").otherwise(""))),
        "gender": F.col("gender").cast("string"),
    }
    raw = t.select(*[cells[k].alias(n) for k, n in names.items()])
    out = trip_source.project(raw, family)
    return out.select("ride_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"),
                      F.col("ended_at").isNull().cast("int").alias("bad_end"), "duration_sec",
                      "start_station_id_raw", "end_station_id_raw", "start_lon_raw", "member_casual", "bike_id",
                      F.coalesce("birth_year", F.lit(-1)).alias("birth_year"), "gender")


_LEGACY_SQL = f"""WITH {v.TRIPS}, raw AS (SELECT *, CASE ride_id % 4
    WHEN 0 THEN strftime(started_at, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(started_at, '%Y-%m-%d %H:%M:%S.%f')
    WHEN 2 THEN strftime(started_at, '%-m/%-d/%Y %H:%M:%S') ELSE strftime(started_at, '%-m/%-d/%Y %-H:%M') END AS stamp
  FROM trips)
SELECT md5(stamp || CAST(start_station_id AS VARCHAR) || '.0' || CAST(ride_id AS VARCHAR)) AS ride_id,
  CASE WHEN ride_id % 4 = 3 THEN strftime(date_trunc('minute', started_at), '%Y-%m-%d %H:%M:%S')
       ELSE strftime(started_at, '%Y-%m-%d %H:%M:%S') END AS started_at,
  (CASE WHEN ride_id % 13 = 0 THEN 1 ELSE 0 END)::BIGINT AS bad_end, duration_sec::BIGINT AS duration_sec,
  CAST(start_station_id AS VARCHAR) AS start_station_id_raw, CAST(end_station_id AS VARCHAR) AS end_station_id_raw,
  start_lon AS start_lon_raw,
  CASE WHEN member_casual = 'member' THEN 'member' WHEN ride_id % 17 = 0 THEN 'Dependent' ELSE 'casual' END
    AS member_casual, CAST(ride_id AS VARCHAR) AS bike_id,
  (CASE WHEN ride_id % 5 = 0 THEN -1 ELSE 2024 - age_at_trip END)::BIGINT AS birth_year, gender::BIGINT AS gender
FROM raw"""


@query("P2", "P4", "P6", "P7", "P8", "P9", sql=_LEGACY_SQL)
def legacy_projection(spark, sf):
    return _legacy_raw(spark, sf, "legacy")


@query("P3", sql=_LEGACY_SQL)
def titlecase_projection(spark, sf):
    return _legacy_raw(spark, sf, "legacy_titlecase")


@query("P11", "F5", sql=f"""WITH {v.STATION_ENDS}, ids AS (
  SELECT CASE ride_id % 4 WHEN 0 THEN 'JC' || station_id WHEN 1 THEN 'a-' || station_id
    WHEN 2 THEN regexp_replace(station_id, '\\.0$', '') ELSE 'HB1' END AS id FROM ends)
SELECT CASE WHEN id LIKE '%-%' OR id LIKE 'JC%' OR id LIKE 'HB%' THEN 'modern' ELSE 'legacy' END AS id_class,
  regexp_matches(id, '^[0-9]+$') AND COALESCE(TRY_CAST(id AS INTEGER) BETWEEN 3000 AND 4999, FALSE) AS numeric_legacy,
  id NOT LIKE '%-%' AND length(id) < 10 AS short_legacy, count(*) AS n FROM ids GROUP BY ALL""")
def station_id_classes(spark, sf):
    e = v.station_ends(spark, sf)
    rid = F.col("ride_id") % 4
    ids = e.select(F.when(rid == 0, F.concat(F.lit("JC"), "station_id"))
                   .when(rid == 1, F.concat(F.lit("a-"), "station_id"))
                   .when(rid == 2, text.strip_float_suffix(F.col("station_id"))).otherwise("HB1").alias("id"))
    return ids.groupBy(
        text.id_class(F.col("id")).alias("id_class"),
        F.coalesce(text.is_legacy_numeric_id(F.col("id")), F.lit(False)).alias("numeric_legacy"),
        text.is_legacy_short_id(F.col("id")).alias("short_legacy")).agg(F.count(F.lit(1)).alias("n"))


@query("P14", "F20", sql=f"""WITH {v.ORDER_TRIPS}, b AS (
  SELECT *, CASE WHEN ride_id % 10 = 0 THEN NULL WHEN ride_id % 10 = 1 THEN 1969
      ELSE 1890 + CAST(ride_id * 13 % 110 AS INTEGER) END AS birth_year,
    CASE WHEN ride_id % 7 = 0 THEN NULL ELSE CAST(ride_id % 4 AS INTEGER) END AS gender,
    year(started_at) + 19 AS y FROM ot), f AS (
  SELECT *, CASE WHEN birth_year IS NULL THEN NULL
      WHEN birth_year = 1969 AND member_casual = 'casual' AND y >= 2018 THEN FALSE
      WHEN y - birth_year < 10 OR y - birth_year > 100 THEN FALSE ELSE TRUE END AS ok FROM b)
SELECT CASE WHEN ok IS NULL THEN 'unknown' WHEN ok THEN 'valid' ELSE 'invalid' END AS birth_year_valid,
  CASE WHEN gender IS NULL THEN 'unknown' WHEN gender IN (1, 2) THEN 'valid' ELSE 'invalid' END AS gender_valid,
  COALESCE(ok AND (y - birth_year) BETWEEN 16 AND 80 AND gender IN (1, 2), FALSE) AS usable,
  count(*) AS n, CAST(COALESCE(sum(CASE WHEN ok THEN y - birth_year END), 0) AS BIGINT) AS age_sum
FROM f GROUP BY ALL""")
def rider_demographics(spark, sf):
    """Validity flags and ages; order years are moved by 19 to reach the eras of the rules."""
    t = v.order_trips(spark, sf)
    rid = F.col("ride_id")
    when = F.add_months("started_at", 19 * 12).cast("timestamp")
    b = t.select(
        "member_casual", when.alias("started_at"),
        F.when(rid % 10 == 0, F.lit(None)).when(rid % 10 == 1, 1969).otherwise(
            1890 + (rid * 13 % 110).cast("int")).alias("birth_year"),
        F.when(rid % 7 == 0, F.lit(None)).otherwise((rid % 4).cast("int")).alias("gender"))
    args = (F.col("birth_year"), F.col("member_casual"), F.col("started_at"))
    b = b.withColumns({"ok": parse.birth_year_valid(*args), "g": parse.gender_valid(F.col("gender")),
                       "age": parse.age_at_trip(*args)})

    def word(c):
        return F.when(F.col(c).isNull(), "unknown").when(F.col(c), "valid").otherwise("invalid")

    return b.groupBy(word("ok").alias("birth_year_valid"), word("g").alias("gender_valid"),
                     parse.clean_demographics(F.col("age"), F.col("gender"), F.col("ok")).alias("usable")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("age"), F.lit(0)).alias("age_sum"))


# --- dates -----------------------------------------------------------------------

@query("P15", sql=f"""WITH {v.TRIPS}
SELECT year(started_at) AS year, month(started_at) AS month, hour(started_at) AS hour, dayofweek(started_at) AS dow,
  dayname(started_at) AS day_name, dayofyear(started_at) AS day_of_year, count(*) AS trips
FROM trips GROUP BY ALL""")
def date_parts(spark, sf):
    t = dates.with_date_parts(v.trips(spark, sf))
    return t.groupBy("year", "month", "hour", "dow", "day_name", "day_of_year").agg(F.count(F.lit(1)).alias("trips"))


@query("P16", sql=f"""WITH {v.TRIPS}
SELECT 'hour' AS unit, strftime(date_trunc('hour', started_at), '%Y-%m-%d %H:%M') AS bucket, count(*) AS trips
  FROM trips GROUP BY ALL
UNION ALL SELECT 'day', strftime(date_trunc('day', started_at), '%Y-%m-%d %H:%M'), count(*) FROM trips GROUP BY ALL
UNION ALL SELECT 'week', strftime(date_trunc('week', started_at), '%Y-%m-%d %H:%M'), count(*) FROM trips GROUP BY ALL
UNION ALL SELECT 'month', strftime(date_trunc('month', started_at), '%Y-%m-%d %H:%M'), count(*) FROM trips GROUP BY ALL""")
def truncated_buckets(spark, sf):
    """All four units from one hourly aggregate: coarser buckets add up the hours."""
    hours = v.trips(spark, sf).groupBy(F.date_trunc("hour", "started_at").alias("h")).agg(
        F.count(F.lit(1)).alias("n"))
    units = F.explode(F.array(*[
        F.struct(F.lit(u).alias("unit"), F.date_format(F.date_trunc(u, "h"), "yyyy-MM-dd HH:mm").alias("bucket"))
        for u in ("hour", "day", "week", "month")])).alias("b")
    return hours.select("n", units).groupBy("b.unit", "b.bucket").agg(F.sum("n").alias("trips"))


@query("P17", sql=f"""WITH {v.DAILY}
SELECT strftime(date, '%Y-%m-%d') AS date, CAST(isoyear(date) AS VARCHAR) || '-' || CAST(week(date) AS VARCHAR) AS iso_key,
  CAST(year(date) AS VARCHAR) || '-' || CAST(week(date) AS VARCHAR) AS calendar_key FROM daily""")
def week_keys(spark, sf):
    """ISO week key next to the mixed calendar-year key, which splits weeks at new year."""
    d = v.order_trips(spark, sf).select(F.to_date("started_at").alias("date")).distinct()
    return d.select("date", dates.iso_week_key(F.col("date")).alias("iso_key"),
                    dates.calendar_week_key(F.col("date")).alias("calendar_key"))


@query("P18", "P20", sql=f"""WITH {v.DAILY}
SELECT strftime(date, '%Y-%m-%d') AS date, quarter(date) AS quarter, dayofweek(date) IN (0, 6) AS is_weekend,
  CASE WHEN month(date) IN (12, 1, 2) THEN 'Winter' WHEN month(date) IN (3, 4, 5) THEN 'Spring'
       WHEN month(date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  date - min(date) OVER () AS days_since_start FROM daily""")
def calendar_columns(spark, sf):
    d = v.order_trips(spark, sf).select(F.to_date("started_at").alias("date")).distinct()
    d = d.select("date", F.quarter("date").alias("quarter"), dates.is_weekend(F.col("date")).alias("is_weekend"),
                 dates.season(F.col("date")).alias("season"))
    return dates.days_since_first(d)


@query("P19", sql=f"""WITH {v.TRIPS}
SELECT dayofweek(started_at) AS dow, dayname(started_at) AS day_name, left(dayname(started_at), 3) AS short_name,
  count(*) AS trips FROM trips GROUP BY ALL""")
def day_names(spark, sf):
    n = v.trips(spark, sf).groupBy(dates.dow(F.col("started_at")).alias("dow")).agg(F.count(F.lit(1)).alias("trips"))
    return n.select("dow", dates.day_name_of(F.col("dow")).alias("day_name"),
                    dates.day_name_of(F.col("dow"), True).alias("short_name"), "trips")


@query("P21", sql=f"""WITH {v.TRIPS}
SELECT CASE WHEN hour(started_at) BETWEEN 5 AND 6 THEN 'Early Morning' WHEN hour(started_at) BETWEEN 7 AND 9 THEN 'AM Rush'
    WHEN hour(started_at) BETWEEN 10 AND 15 THEN 'Midday' WHEN hour(started_at) BETWEEN 16 AND 18 THEN 'PM Rush'
    WHEN hour(started_at) BETWEEN 19 AND 21 THEN 'Evening' ELSE 'Night' END AS period,
  CASE WHEN hour(started_at) BETWEEN 6 AND 9 THEN 'AM Rush (6-9)'
    WHEN hour(started_at) BETWEEN 17 AND 20 THEN 'PM Rush (17-20)' ELSE 'Off-Peak' END AS rush,
  count(*) AS trips FROM trips GROUP BY ALL""")
def hour_bands(spark, sf):
    t = v.trips(spark, sf)
    return t.groupBy(dates.time_of_day(F.hour("started_at")).alias("period"),
                     dates.rush_period(F.col("started_at")).alias("rush")).agg(F.count(F.lit(1)).alias("trips"))


_DATE_PERIODS = [(None, "1998-03-01", "before"), ("1998-03-01", "1998-07-01", "closure"),
                 ("1998-07-01", "1999-01-01", "recovery"), ("1999-01-01", None, "after")]


@query("P22", sql=f"""WITH {v.ORDER_TRIPS}
SELECT CASE WHEN started_at < '1998-03-01' THEN 'before' WHEN started_at < '1998-07-01' THEN 'closure'
    WHEN started_at < '1999-01-01' THEN 'recovery' ELSE 'after' END AS period,
  CASE WHEN year(started_at) <= 1997 THEN 'pre' WHEN year(started_at) = 1998 THEN 'during' ELSE 'post' END AS era,
  count(*) AS trips FROM ot GROUP BY ALL""")
def period_labels(spark, sf):
    t = v.order_trips(spark, sf)
    return t.groupBy(dates.period_by_date(F.col("started_at"), _DATE_PERIODS).alias("period"),
                     dates.period_by_year(F.year("started_at"), [(None, 1997, "pre"), (1998, 1998, "during"),
                                                                 (1999, None, "post")]).alias("era")).agg(
        F.count(F.lit(1)).alias("trips"))


# --- bins and classes -------------------------------------------------------------

_BUCKET_SQL = """CASE WHEN duration_sec < 300 THEN '< 5 min' WHEN duration_sec < 600 THEN '5-10 min'
  WHEN duration_sec < 900 THEN '10-15 min' WHEN duration_sec < 1200 THEN '15-20 min'
  WHEN duration_sec < 1800 THEN '20-30 min' WHEN duration_sec < 3600 THEN '30-60 min' ELSE '60+ min' END"""


@query("P23", "W1", "T-3", sql=f"""WITH {v.GOOD}, b AS (SELECT {_BUCKET_SQL} AS bucket, count(*) AS trips FROM good GROUP BY 1)
SELECT bucket, CASE bucket WHEN '< 5 min' THEN 1 WHEN '5-10 min' THEN 2 WHEN '10-15 min' THEN 3 WHEN '15-20 min' THEN 4
  WHEN '20-30 min' THEN 5 WHEN '30-60 min' THEN 6 ELSE 7 END::BIGINT AS bucket_order, trips,
  round(trips * 100.0::DOUBLE / sum(trips) OVER (), 6) AS pct FROM b""")
def duration_buckets(spark, sf):
    from ..operators.series import share
    t = v.good_trips(spark, sf)
    b = t.groupBy(bins.duration_bucket(F.col("duration_sec")).alias("bucket")).agg(F.count(F.lit(1)).alias("trips"))
    return share(b, "trips").select("bucket", bins.duration_bucket_order(F.col("bucket")).alias("bucket_order"),
                                    "trips", r("pct").alias("pct")).orderBy("bucket_order")


@query("P24", "P25", sql=f"""WITH {v.TRIPS}
SELECT CASE WHEN age_at_trip BETWEEN 20 AND 25 THEN 'young_20_25' WHEN age_at_trip BETWEEN 26 AND 30 THEN 'young_26_30'
    WHEN age_at_trip BETWEEN 35 AND 45 THEN 'control_35_45' ELSE 'other' END AS age_group,
  CASE WHEN dayofweek(started_at) NOT IN (0, 6) AND (hour(started_at) BETWEEN 7 AND 9 OR hour(started_at) BETWEEN 17 AND 19)
    THEN 'commute' ELSE 'non_commute' END AS trip_type,
  CASE WHEN start_station_id IN (1, 2, 3) THEN 'bank' WHEN start_station_id IN (4, 5) THEN 'university'
    WHEN start_station_id IN (6, 7, 8) THEN 'control' ELSE 'other' END AS origin_type, count(*) AS trips
FROM trips GROUP BY ALL""")
def trip_classes(spark, sf):
    t = v.trips(spark, sf)
    ts, s = F.col("started_at"), F.col("start_station_id")
    return t.groupBy(
        bins.age_band(F.col("age_at_trip"), [(20, 25, "young_20_25"), (26, 30, "young_26_30"),
                                             (35, 45, "control_35_45")], "other").alias("age_group"),
        F.when(dates.is_weekday(ts) & dates.is_rush(ts), "commute").otherwise("non_commute").alias("trip_type"),
        F.when(s.isin(1, 2, 3), "bank").when(s.isin(4, 5), "university").when(s.isin(6, 7, 8), "control")
        .otherwise("other").alias("origin_type")).agg(F.count(F.lit(1)).alias("trips"))


@query("P27", sql="""SELECT CASE WHEN value > 0 AND value <= 32 THEN '<32°F' WHEN value > 32 AND value <= 45 THEN '32-45°F'
    WHEN value > 45 AND value <= 55 THEN '45-55°F' WHEN value > 55 AND value <= 65 THEN '55-65°F'
    WHEN value > 65 AND value <= 75 THEN '65-75°F' WHEN value > 75 AND value <= 85 THEN '75-85°F'
    WHEN value > 85 AND value <= 100 THEN '85°F+' ELSE 'outside' END AS temp_bin, count(*) AS n FROM events GROUP BY 1""")
def right_closed_bins(spark, sf):
    e = table(spark, sf, "events")
    b = bins.cut(F.col("value"), bins.FEELS_LIKE_EDGES, bins.FEELS_LIKE_LABELS)
    return e.groupBy(F.coalesce(b, F.lit("outside")).alias("temp_bin")).agg(F.count(F.lit(1)).alias("n"))


@query("P28", "A28", sql="""WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT CAST(least(20, greatest(1, ceil((value - lo) / ((hi - lo) / 20.0::DOUBLE)))) AS BIGINT) AS bin, count(*) AS n,
  min(value) AS lowest, max(value) AS highest FROM events, b GROUP BY 1""")
def equal_width_histogram(spark, sf):
    e = bins.equal_width_bins(table(spark, sf, "events"), "value", 20)
    return e.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lowest"),
                                F.max("value").alias("highest"))


@query("P29", "P33", sql="""SELECT CASE WHEN value > 15 THEN 'Heavy Rain' WHEN value > 5 THEN 'Moderate Rain'
    WHEN value > 0 THEN 'Light Rain' ELSE 'No Rain' END AS rain_class,
  (value < 32)::BIGINT AS freezing, (value >= 32 AND value < 50)::BIGINT AS cold, (value >= 90)::BIGINT AS very_hot,
  (value >= 3)::BIGINT AS rain_heavy, count(*) AS n, round(sum(least(value, 10)), 4) AS capped_sum
FROM events GROUP BY ALL""")
def weather_flags(spark, sf):
    e = table(spark, sf, "events")
    temp, rain = bins.temperature_flags(F.col("value")), bins.rain_flags(F.col("value"))
    return e.groupBy(bins.rain_class(F.col("value")).alias("rain_class"), temp["temp_freezing"].alias("freezing"),
                     temp["temp_cold"].alias("cold"), temp["temp_very_hot"].alias("very_hot"),
                     rain["rain_heavy"].alias("rain_heavy")).agg(
        F.count(F.lit(1)).alias("n"), r(F.sum(bins.clip(F.col("value"), upper=10)), 4).alias("capped_sum"))


@query("P32", sql=f"""WITH {v.DAILY}
SELECT year(date) AS year, count(*) FILTER (WHERE dayofweek(date) = 0) AS dow_0, count(*) FILTER (WHERE dayofweek(date) = 2) AS dow_2,
  count(*) FILTER (WHERE dayofweek(date) = 3) AS dow_3, count(*) FILTER (WHERE dayofweek(date) = 4) AS dow_4,
  count(*) FILTER (WHERE dayofweek(date) = 5) AS dow_5, count(*) FILTER (WHERE dayofweek(date) = 6) AS dow_6
FROM daily GROUP BY 1""")
def day_dummies(spark, sf):
    """Weekday dummies without Monday, summed per year."""
    d = v.order_trips(spark, sf).select(F.to_date("started_at").alias("date")).distinct()
    cols = bins.one_hot(dates.dow(F.col("date")), range(7), "dow", drop=1)
    return d.withColumns(cols).groupBy(F.year("date").alias("year")).agg(*[F.sum(c).alias(c) for c in cols])


@query("P30", "A1", sql=f"""WITH {v.NAMED}
SELECT start_station_name || ' → ' || end_station_name AS route, count(*) AS trips FROM named GROUP BY 1""")
def route_labels(spark, sf):
    """Labels are made after counting by key, so text is not shuffled per trip."""
    t = v.trips(spark, sf).groupBy("start_station_id", "end_station_id").agg(F.count(F.lit(1)).alias("trips"))
    names = v.station_names(spark, sf)
    s = names.toDF("start_station_id", "a")
    e = names.toDF("end_station_id", "b")
    return t.join(s, "start_station_id").join(e, "end_station_id").select(
        text.route_label(F.col("a"), F.col("b")).alias("route"), "trips")


@query("P31", "P49", sql=f"""WITH {v.TRIPS}
SELECT ride_id, round(duration_sec / 60.0::DOUBLE, 1) AS minutes, round(duration_sec * 9 / 5.0::DOUBLE + 32, 2) AS as_fahrenheit,
  round(start_lat, 5) AS lat5, round(start_lon, 4) AS lon4 FROM trips""")
def unit_conversions(spark, sf):
    t = v.trips(spark, sf)
    return t.select("ride_id", r(F.col("duration_sec") / 60, 1).alias("minutes"),
                    r(bins.fahrenheit(F.col("duration_sec")), 2).alias("as_fahrenheit"),
                    r("start_lat", 5).alias("lat5"), r("start_lon", 4).alias("lon4"))


# --- text ------------------------------------------------------------------------

@query("P42", "S15", sql="""WITH raw AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '(' || o_orderpriority || ') ' || dayname(o_orderdate)
    WHEN 1 THEN ' ' || dayname(o_orderdate) || ' ' WHEN 2 THEN '(no day)' ELSE dayname(o_orderdate) END AS txt,
  o_orderpriority || CASE o_orderkey % 3 WHEN 0 THEN ' (Observed)' WHEN 1 THEN ' (observed)' ELSE '' END AS hol,
  o_orderpriority AS p, dayname(o_orderdate) AS d FROM orders)
SELECT CASE o_orderkey % 4 WHEN 2 THEN '(no day)' ELSE d END AS day_name, CASE WHEN o_orderkey % 4 = 0 THEN p ELSE '' END AS holiday,
  p AS holiday_name, CASE WHEN o_orderkey % 3 < 2 THEN 'observed' ELSE 'federal' END AS holiday_type, count(*) AS n
FROM raw GROUP BY ALL""")
def bracketed_holidays(spark, sf):
    o = table(spark, sf, "orders")
    k, d, p = F.col("o_orderkey"), F.date_format("o_orderdate", "EEEE"), F.col("o_orderpriority")
    raw = o.select(
        F.when(k % 4 == 0, F.concat(F.lit("("), p, F.lit(") "), d)).when(k % 4 == 1, F.concat(F.lit(" "), d, F.lit(" ")))
        .when(k % 4 == 2, "(no day)").otherwise(d).alias("txt"),
        F.concat(p, F.when(k % 3 == 0, " (Observed)").when(k % 3 == 1, " (observed)").otherwise("")).alias("hol"))
    day, holiday = text.bracket_prefix(F.col("txt"))
    name, kind = text.split_observed(F.col("hol"))
    return raw.groupBy(day.alias("day_name"), F.coalesce(holiday, F.lit("")).alias("holiday"),
                       name.alias("holiday_name"), kind.alias("holiday_type")).agg(F.count(F.lit(1)).alias("n"))


@query("P43", sql="""SELECT CASE o_orderkey % 5 WHEN 0 THEN 'NY Waterway' WHEN 1 THEN 'Billy Bey' WHEN 2 THEN 'Water Taxi'
  WHEN 3 THEN 'Liberty Landing' ELSE o_orderpriority END AS operator, count(*) AS n FROM orders GROUP BY 1""")
def operator_names(spark, sf):
    from ..sources.feeds import normalise_operator
    k = F.col("o_orderkey") % 5
    raw = table(spark, sf, "orders").select(
        F.when(k == 0, "NYWW (Port Imperial FC) ").when(k == 1, "NY Waterway-(Billy Bey FC)")
        .when(k == 2, " New York Water Taxi").when(k == 3, "Liberty Landing Ferry")
        .otherwise(F.col("o_orderpriority")).alias("operator"))
    return normalise_operator(raw).groupBy("operator").agg(F.count(F.lit(1)).alias("n"))


@query("P44", sql="""SELECT l_returnflag, l_linenumber::BIGINT AS l_linenumber, CAST(sum(CASE l_orderkey % 5 WHEN 0 THEN CAST(trunc(l_extendedprice) AS BIGINT)
    WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN CAST(l_quantity AS BIGINT) ELSE 1000 + l_linenumber END) AS BIGINT) AS total,
  CAST(sum(CASE l_orderkey % 5 WHEN 1 THEN -1 WHEN 2 THEN -1 WHEN 4 THEN -1 WHEN 0 THEN CAST(trunc(l_extendedprice) AS BIGINT) ELSE CAST(l_quantity AS BIGINT) END) AS BIGINT) AS coerced
FROM lineitem GROUP BY ALL""")
def dirty_counts(spark, sf):
    """Blank, text, decimals and thousands commas in count cells."""
    li = table(spark, sf, "lineitem")
    k = F.col("l_orderkey") % 5
    # Two decimals as plain text; doubles of this size would print in full anyway.
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    price = F.concat((cents / 100).cast("long").cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
    raw = li.select("l_returnflag", "l_linenumber", F.when(k == 0, price).when(k == 1, " ").when(k == 2, "n/a").when(
        k == 3, F.col("l_quantity").cast("int").cast("string")).otherwise(
        F.concat(F.lit("1,00"), F.col("l_linenumber").cast("string"))).alias("cell"))
    return raw.groupBy("l_returnflag", "l_linenumber").agg(
        F.sum(text.clean_count(F.col("cell"))).alias("total"),
        F.sum(text.coerce_int(F.col("cell"), -1)).alias("coerced"))


@query("P45", sql="""WITH s AS (SELECT CASE s_suppkey % 6 WHEN 0 THEN s_name || ' - Manhattan' WHEN 1 THEN s_name || ' - Brooklyn'
    WHEN 2 THEN s_name || ' - Queens' WHEN 3 THEN s_name || ' - Bronx' ELSE s_name END AS nm, s_suppkey,
  substr('ACEBDFMGJZLNQRW1234567S8', CAST(s_suppkey % 24 + 1 AS INTEGER), 1) AS line FROM supplier)
SELECT CASE s_suppkey % 6 WHEN 0 THEN 'Manhattan' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Queens' WHEN 3 THEN 'Bronx' ELSE 'none' END AS borough,
  CASE WHEN line IN ('A','C','E') THEN '8th Ave' WHEN line IN ('B','D','F','M') THEN '6th Ave' WHEN line = 'G' THEN 'Crosstown'
    WHEN line IN ('J','Z') THEN 'Nassau' WHEN line = 'L' THEN '14th St-Canarsie' WHEN line IN ('N','Q','R','W') THEN 'Broadway'
    WHEN line IN ('1','2','3') THEN '7th Ave' WHEN line IN ('4','5','6') THEN 'Lexington' WHEN line = '7' THEN 'Flushing'
    WHEN line = 'S' THEN 'Shuttle' ELSE 'Other' END AS line_group, count(*) AS n FROM s GROUP BY ALL""")
def boroughs_and_lines(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    names = F.element_at(F.array(*[F.lit(f" - {b}") for b in text.BOROUGH_SUFFIXES], F.lit(""), F.lit("")),
                         (k % 6 + 1).cast("int"))
    line = F.substring(F.lit("ACEBDFMGJZLNQRW1234567S8"), (k % 24 + 1).cast("int"), F.lit(1))
    return s.groupBy(F.coalesce(text.borough_of(F.concat("s_name", names)), F.lit("none")).alias("borough"),
                     text.line_group(line).alias("line_group")).agg(F.count(F.lit(1)).alias("n"))


@query("P46", "P47", sql="""WITH s AS (SELECT CAST(l_partkey % 28 AS INTEGER) AS h, l_orderkey % 4 AS c FROM lineitem)
SELECT CASE WHEN h BETWEEN 7 AND 9 THEN 'AM Peak' WHEN h BETWEEN 10 AND 15 THEN 'Midday' WHEN h BETWEEN 16 AND 19 THEN 'PM Peak'
    WHEN h BETWEEN 20 AND 23 THEN 'Evening' ELSE 'Night' END AS period,
  CASE c WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Saturday' WHEN 2 THEN 'Sunday' ELSE 'Other' END AS day_type,
  count(*) AS stops FROM s GROUP BY ALL""")
def schedule_periods(spark, sf):
    li = table(spark, sf, "lineitem")
    c = F.col("l_orderkey") % 4
    clock = F.concat((F.col("l_partkey") % 28).cast("string"), F.lit(":05:00"))
    return li.groupBy(parse.service_period(parse.clock_hour(clock)).alias("period"),
                      parse.day_type((c == 0).cast("int"), (c == 1).cast("int"), (c == 2).cast("int"))
                      .alias("day_type")).agg(F.count(F.lit(1)).alias("stops"))


@query("P36", "P37", sql=f"""WITH p AS (SELECT DISTINCT p_name, p_type, p_brand FROM part), n AS (
  SELECT *, {v.sql_sorted_tokens("p_name || ' ' || p_brand")} AS a,
    {v.sql_sorted_tokens("p_brand || ' ' || split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) || ' ' || p_type")} AS b FROM p)
SELECT p_name, p_type, p_brand, round({v.sql_indel('a', 'b')}, 4) AS ratio,
  round({v.sql_indel('a', 'b')} * 0.7::DOUBLE + (1 - length(a) / 150.0::DOUBLE) * 100 * 0.3::DOUBLE, 4) AS score FROM n""")
def name_similarity(spark, sf):
    """Token-sort ratio of distinct part names against a shuffled longer form, and the match score."""
    p = table(spark, sf, "part").select("p_name", "p_type", "p_brand").distinct()
    a = F.concat_ws(" ", "p_name", "p_brand")
    b = F.concat_ws(" ", "p_brand", F.array_join(F.reverse(F.split("p_name", " ")), " "), "p_type")
    out = p.withColumn("x", text.token_sort_ratio(a, b)).withColumn("d", F.length(text.sorted_tokens(a)).cast("double"))
    return out.select("p_name", "p_type", "p_brand", r("x", 4).alias("ratio"),
                      r(identity.match_score(F.col("x"), F.col("d")), 4).alias("score"))


@query("P48", sql="""WITH n AS (SELECT DISTINCT p_name AS name FROM part), k AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS known FROM part
    UNION SELECT DISTINCT split_part(p_name, ' ', 1) || ' deck' FROM part),
  c AS (SELECT name, known, 1 AS step FROM n, k WHERE contains(lower(name), lower(known)) OR contains(lower(known), lower(name))
    UNION ALL SELECT name, known, 2 FROM n, k WHERE list_bool_or([contains(lower(known), w) FOR w IN string_split(lower(name), ' ') IF length(w) > 3]))
SELECT n.name, COALESCE(min_by(known, (step, known)), '') AS match FROM n LEFT JOIN c ON n.name = c.name GROUP BY 1""")
def loose_name_match(spark, sf):
    p = table(spark, sf, "part").select("p_name").distinct()
    words = F.split("p_name", " ")
    known = p.select(F.explode(F.array(F.get(words, 1), F.concat(F.get(words, 0), F.lit(" deck")))).alias("known")).distinct()
    return reshape.match_names(p, known, "p_name").select("name", F.coalesce("match", F.lit("")).alias("match"))


# --- geometry --------------------------------------------------------------------

@query("P34", "P35", sql=f"""WITH {v.TRIPS}
SELECT ride_id, round(2 * 6371000.0::DOUBLE * atan2(sqrt(h), sqrt(1 - h)), 4) AS haversine_m, round(sqrt(dy * dy + dx * dx), 4) AS flat_m
FROM (SELECT ride_id, sin(radians(end_lat - start_lat) / 2) ** 2 + cos(radians(start_lat)) * cos(radians(end_lat))
    * sin(radians(end_lon - start_lon) / 2) ** 2 AS h, (start_lat - end_lat) * 111139 AS dy,
    (start_lon - end_lon) * 111139 * cos(radians(40.7::DOUBLE)) AS dx FROM trips)""")
def trip_distances(spark, sf):
    t = v.trips(spark, sf)
    args = [F.col(c) for c in ("start_lat", "start_lon", "end_lat", "end_lon")]
    return t.select("ride_id", r(geo.haversine_m(*args), 4).alias("haversine_m"),
                    r(geo.flat_distance_m(*args), 4).alias("flat_m"))


@query("P41", sql=f"""SELECT CASE WHEN lat > 40.78 THEN 'Upper Manhattan (>96th)' WHEN lat > 40.75 THEN 'Midtown/UES/UWS'
    WHEN lat > 40.72 THEN 'Chelsea/Gramercy/Murray Hill' WHEN lat > 40.70 AND lon > -74.01 THEN 'East Village/LES'
    WHEN lat > 40.70 THEN 'West Village/SoHo/Tribeca' WHEN lon < -73.98 THEN 'Brooklyn (Williamsburg area)' ELSE 'Other' END AS zone,
  count(*) AS n FROM (SELECT {v.sql_lat('c_custkey')} AS lat, {v.sql_lon('c_custkey')} AS lon FROM customer) GROUP BY 1""")
def zones(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.groupBy(geo.zone_of(v.lat_of(k), v.lon_of(k), geo.CITY_ZONES, "Other").alias("zone")).agg(
        F.count(F.lit(1)).alias("n"))
