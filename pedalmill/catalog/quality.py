"""Filters, accounting, drift, timelines and anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import quality, series
from . import views as v
from .registry import query, r, table

_JUDGED_SQL = f"""WITH {v.TRIPS}, judged AS (SELECT *,
    CASE WHEN ride_id % 101 = 0 THEN NULL ELSE started_at END AS s_at,
    CASE WHEN ride_id % 53 = 0 THEN '' WHEN ride_id % 59 = 0 THEN NULL ELSE CAST(start_station_id AS VARCHAR) END AS sid,
    CASE WHEN ride_id % 71 = 0 THEN -duration_sec WHEN ride_id % 73 = 0 THEN NULL ELSE duration_sec END AS d,
    CASE WHEN ride_id % 2 = 0 THEN 1 ELSE 2 END AS expected_month, 'file_' || CAST(ride_id % 3 AS VARCHAR) AS source_file
  FROM trips), f AS (SELECT *, s_at IS NULL AS bad_time, sid IS NULL OR sid = '' AS no_station,
    COALESCE(month(s_at) <> expected_month, FALSE) AS wrong FROM judged),
  g AS (SELECT *, CASE WHEN bad_time THEN 'invalid_timestamp' WHEN no_station THEN 'missing_station'
    WHEN d IS NULL THEN 'missing_duration' WHEN d < 0 THEN 'negative_duration' WHEN d < 90 THEN 'duration_too_short'
    WHEN d > 14400 THEN 'duration_too_long' WHEN wrong THEN 'wrong_month' END AS reason FROM f)"""


def _judged(spark, sf):
    t = v.trips(spark, sf)
    k = F.col("ride_id")
    return t.select(
        "ride_id", F.when(k % 101 == 0, F.lit(None)).otherwise(F.col("started_at")).alias("started_at"),
        F.col("started_at").alias("ended_at"),
        F.when(k % 53 == 0, "").when(k % 59 == 0, F.lit(None)).otherwise(F.col("start_station_id").cast("string"))
        .alias("start_station_id_raw"),
        F.col("end_station_id").cast("string").alias("end_station_id_raw"),
        F.when(k % 71 == 0, -F.col("duration_sec")).when(k % 73 == 0, F.lit(None)).otherwise(F.col("duration_sec"))
        .alias("duration_sec"),
        F.struct(F.lit(2024).alias("year"), F.when(k % 2 == 0, 1).otherwise(2).alias("month")).alias("expected"),
        F.concat(F.lit("file_"), (k % 3).cast("string")).alias("source_file"), "member_casual")


@query("F1", "F2", "A10", sql=_JUDGED_SQL + """
SELECT source_file, count(*) AS rows_in, count(*) FILTER (WHERE reason IS NULL) AS rows_out,
  count(*) FILTER (WHERE bad_time) AS invalid_timestamp, count(*) FILTER (WHERE no_station) AS missing_station,
  count(*) FILTER (WHERE d < 90) AS duration_too_short, count(*) FILTER (WHERE d > 14400) AS duration_too_long,
  count(*) FILTER (WHERE wrong) AS wrong_month,
  count(*) FILTER (WHERE reason = 'missing_station') AS first_missing_station,
  count(*) FILTER (WHERE reason = 'negative_duration') AS first_negative_duration,
  count(*) FILTER (WHERE reason = 'duration_too_short') AS first_duration_too_short,
  count(*) FILTER (WHERE reason = 'wrong_month') AS first_wrong_month FROM g GROUP BY 1""")
def filter_accounting(spark, sf):
    """Rows in, rows out and every reason, per source file, in one aggregate."""
    out = quality.filter_accounting(_judged(spark, sf), quality.quality_reasons(month_check=True), ["source_file"])
    return out.select("source_file", "rows_in", "rows_out", "invalid_timestamp", "missing_station",
                      "duration_too_short", "duration_too_long", "wrong_month", "first_missing_station",
                      "first_negative_duration", "first_duration_too_short", "first_wrong_month")


@query("F1", "F2", sql=_JUDGED_SQL + """
SELECT COALESCE(reason, 'kept') AS reason, count(*) AS n, min(ride_id) AS first_ride FROM g GROUP BY 1""")
def first_drop_reason(spark, sf):
    out = quality.with_reason(_judged(spark, sf), quality.quality_reasons(month_check=True))
    return out.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ride_id").alias("first_ride"))


@query("A11", sql=f"""WITH {v.TRIPS}, x AS (SELECT day(started_at) % 5 AS grp, if(ride_id % 31 = 0, NULL, started_at) AS until, if(ride_id % 23 = 0, NULL, start_station_id) AS sid,
  if(ride_id % 19 = 0, NULL, end_station_id) AS eid, if(ride_id % 37 = 0, -5, duration_sec) AS d, if(ride_id % 43 = 0, NULL, start_lat) AS slat, start_lon, if(ride_id % 29 = 0, NULL, end_lat) AS elat, end_lon FROM trips)
SELECT grp, count(*) AS total_rows, count(*) - count(until) AS invalid_timestamp, count(*) - count(sid) AS missing_start_station, count(*) - count(eid) AS missing_end_station,
  count(*) FILTER (WHERE d < 0) AS negative_duration, count(*) FILTER (WHERE d BETWEEN 0 AND 89) AS duration_under_90s, count(*) FILTER (WHERE d > 14400) AS duration_over_4h,
  count(*) - count(slat) AS missing_start_coords, count(*) - count(elat) AS missing_end_coords,
  count(*) FILTER (WHERE NOT (slat BETWEEN 40.4 AND 40.9 AND start_lon BETWEEN -74.05 AND -73.75)) AS invalid_start_coords,
  count(*) FILTER (WHERE NOT (elat BETWEEN 40.4 AND 40.9 AND end_lon BETWEEN -74.05 AND -73.75)) AS invalid_end_coords
FROM x GROUP BY 1""")
def reason_audit(spark, sf):
    """All ten counters, over trips with a fault of every kind."""
    k = F.col("ride_id")

    def spoiled(every: int, column: str, bad=None):
        return F.when(k % every == 0, F.lit(bad)).otherwise(F.col(column))

    t = v.trips(spark, sf).withColumns({
        "grp": F.dayofmonth("started_at") % 5, "ended_at": spoiled(31, "started_at"), "start_station_id": spoiled(23, "start_station_id").cast("string"),
        "end_station_id": F.when(k % 19 == 0, "").otherwise(F.col("end_station_id").cast("string")), "duration_sec": spoiled(37, "duration_sec", -5),
        "start_lat": spoiled(43, "start_lat"), "end_lat": spoiled(29, "end_lat")})
    return quality.reason_audit(t, ["grp"], (40.4, 40.9, -74.05, -73.75))


@query("F3", sql=f"""WITH {v.STATION_ENDS}
SELECT name, count(*) AS n FROM ends WHERE NOT (lower(name) LIKE '%depot temp%' OR lower(name) LIKE '%temp%' OR lower(name) LIKE '%lab%'
  OR lower(name) LIKE '%demo%' OR lower(name) LIKE '%facility%' OR lower(name) LIKE '%warehouse%' OR lower(name) LIKE '%deployment%') GROUP BY 1""")
def without_test_stations(spark, sf):
    """Test stations by name. Names repeat, so they are judged once per distinct name."""
    e = v.station_ends(spark, sf).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return e.filter(~text.is_test_station(F.col("name")))


@query("F4", "T-1", sql=f"""WITH {v.TRIPS}
SELECT start_station_id, round(avg(start_lat), 5) AS lat, round(avg(start_lon), 5) AS lon, count(*) AS trips,
  round(100.0::DOUBLE * count(*) FILTER (WHERE member_casual = 'member') / count(*), 6) AS member_pct
FROM trips WHERE start_lat BETWEEN 40.65 AND 40.85 AND start_lon BETWEEN -74.09 AND -73.8 GROUP BY 1
ORDER BY trips DESC, start_station_id LIMIT 15""")
def stations_in_box(spark, sf):
    from ..functions.numeric import share_if
    t = v.trips(spark, sf).filter(geo.in_box(F.col("start_lat"), F.col("start_lon"), (40.65, 40.85, -74.09, -73.8)))
    return t.groupBy("start_station_id").agg(
        r(F.avg("start_lat"), 5).alias("lat"), r(F.avg("start_lon"), 5).alias("lon"), F.count(F.lit(1)).alias("trips"),
        r(share_if(F.col("member_casual") == "member")).alias("member_pct")).orderBy(
        F.desc("trips"), "start_station_id").limit(15)


@query("F12", sql=f"""WITH {v.HOURLY}, {v.TRIPS}, h AS (SELECT date_trunc('hour', started_at) AS hour_ts, count(*) AS trips FROM trips GROUP BY 1)
SELECT count(*) AS complete_hours, CAST(sum(trips) AS BIGINT) AS trips FROM h JOIN weather ON hour_ts = datetime""")
def complete_hours(spark, sf):
    """Hours with every feature present."""
    from ..operators import enrich
    h = enrich.with_weather(enrich.hourly_counts(v.trips(spark, sf)), v.hourly_weather(spark, sf))
    return h.dropna(subset=["temperature_2m", "precipitation"]).agg(
        F.count(F.lit(1)).alias("complete_hours"), F.sum("trips").alias("trips"))


@query("F13", "A27", sql="""WITH x AS (SELECT event_type, CASE WHEN value < 20 THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS boardings,
    CAST(event_id % 26 - 1 AS BIGINT) AS hour FROM events)
SELECT event_type, count(*) AS total_records, count(*) FILTER (WHERE boardings = 0) AS zero_records,
  round(avg(CASE WHEN boardings = 0 THEN 100.0::DOUBLE ELSE 0 END), 6) AS zero_pct,
  count(*) FILTER (WHERE hour NOT BETWEEN 0 AND 23) AS invalid_hours FROM x GROUP BY 1""")
def zero_boardings(spark, sf):
    e = table(spark, sf, "events").select(
        "event_type", F.when(F.col("value") < 20, 0).otherwise(F.floor("value")).alias("boardings"),
        (F.col("event_id") % 26 - 1).alias("hour"))
    bad = F.count(F.when(~F.col("hour").between(0, 23), 1)).alias("invalid_hours")
    return quality.zero_rate(e, "boardings", ["event_type"], bad).withColumn("zero_pct", r("zero_pct"))


@query("F14", sql="""SELECT p_name, count(*) AS n FROM part WHERE regexp_matches(p_name, '(?i)RING|Bolt|gear') GROUP BY 1""")
def regex_alternation(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").rlike("(?i)RING|Bolt|gear")).groupBy("p_name").agg(
        F.count(F.lit(1)).alias("n"))


@query("F16", sql=f"""WITH {v.TRIPS}
SELECT member_casual, count(*) FILTER (WHERE started_at > TIMESTAMP '2024-01-25 12:00:00') AS future_dates,
  count(*) FILTER (WHERE started_at < TIMESTAMP '2024-01-03') AS pre_launch_dates,
  count(*) FILTER (WHERE start_station_id = end_station_id) AS round_trips FROM trips GROUP BY 1""")
def anomaly_counts(spark, sf):
    return quality.anomalies(v.trips(spark, sf), ["member_casual"], "2024-01-03",
                             F.lit("2024-01-25 12:00:00").cast("timestamp"))


@query("F19", "S14", sql="""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' AND event_type = 'purchase' ORDER BY ts, event_id LIMIT 200""")
def ridership_slice(spark, sf):
    """Date range, category and row limit on a stored table; the filters reach the Parquet scan."""
    from ..sources.feeds import ridership
    e = table(spark, sf, "events").withColumnRenamed("event_type", "borough")
    rows = ridership(e, "2024-01-05", "2024-01-19", "purchase", ts="ts")
    return rows.orderBy("ts", "event_id").limit(200).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.col("borough").alias("event_type"),
        "value")


@query("A12", "T-2", sql=f"""WITH {v.STATION_ENDS}, c AS (SELECT station_id, count(DISTINCT round(lat, 4)) AS unique_lats, count(DISTINCT round(lon, 4)) AS unique_lons,
    min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon, count(*) AS trips FROM ends GROUP BY 1)
SELECT station_id, unique_lats, unique_lons, round(min_lat, 6) AS min_lat, round(max_lat, 6) AS max_lat, round(min_lon, 6) AS min_lon,
  round(max_lon, 6) AS max_lon, trips FROM c WHERE unique_lats > 1 OR unique_lons > 1
ORDER BY round((max_lat - min_lat) + (max_lon - min_lon), 9) DESC, station_id LIMIT 20""")
def coordinate_spread(spark, sf):
    out = quality.coordinate_spread(v.station_ends(spark, sf), "station_id", "lat", "lon")
    return out.withColumns({c: r(c) for c in ("min_lat", "max_lat", "min_lon", "max_lon")})


_TIMELINE = f"""{v.ORDER_TRIPS}, e AS (SELECT start_station_id AS station_id, started_at FROM ot UNION ALL SELECT end_station_id, started_at FROM ot),
 tl AS (SELECT station_id, min(date_trunc('month', started_at)) AS f, max(date_trunc('month', started_at)) AS l,
   count(DISTINCT date_trunc('month', started_at)) AS months_active, count(*) AS trip_ends FROM e GROUP BY 1)"""


@query("A13", "U1", sql=f"""WITH {_TIMELINE}
SELECT tl.station_id, n_name AS station_name, strftime(f, '%Y-%m') AS first_seen, strftime(l, '%Y-%m') AS last_seen, months_active, trip_ends
FROM tl JOIN nation ON station_id = n_nationkey""")
def station_timeline(spark, sf):
    """Months at either end as bitmaps, merged by OR."""
    t = v.order_trips(spark, sf).withColumns({c: F.lit(None).cast("string") for c in ("start_station_name", "end_station_name")})
    tl = quality.trip_timeline(t).drop("station_name")
    return tl.join(v.station_names(spark, sf), "station_id").select(
        "station_id", F.col("name").alias("station_name"), F.date_format("first_seen", "yyyy-MM").alias("first_seen"),
        F.date_format("last_seen", "yyyy-MM").alias("last_seen"), "months_active", "trip_ends")


@query("A62", sql="""WITH c AS (SELECT o_custkey, min(date_trunc('month', o_orderdate)) AS f FROM orders GROUP BY 1)
SELECT year(f) AS year, count(*) AS stations_added FROM c GROUP BY 1""")
def stations_added(spark, sf):
    """Customers stand for stations: first month seen, then a count per year."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("station_id"), F.col("o_orderdate").alias("started_at"),
                                          F.lit("x").alias("name"))
    return quality.stations_added(quality.station_timeline(o))


@query("A28", sql=_JUDGED_SQL + """, w AS (SELECT count(*) AS t, count(*) FILTER (WHERE s_at IS NULL) AS a, count(*) FILTER (WHERE sid IS NULL) AS b,
  count(*) FILTER (WHERE d IS NULL) AS c FROM judged)
SELECT 'started_at' AS column_name, t AS total_rows, a AS nulls FROM w UNION ALL SELECT 'start_station_id_raw', t, b FROM w
UNION ALL SELECT 'duration_sec', t, c FROM w""")
def null_profile(spark, sf):
    return quality.null_counts(_judged(spark, sf), ["started_at", "start_station_id_raw", "duration_sec"])


@query("A28", sql=f"""WITH {v.GOOD}
SELECT count(*) AS n, round(avg(duration_sec), 4) AS mean, round(stddev_samp(duration_sec), 4) AS std, min(duration_sec)::BIGINT AS min,
  quantile_cont(duration_sec, 0.25)::DOUBLE AS q25, quantile_cont(duration_sec, 0.5)::DOUBLE AS q50,
  quantile_cont(duration_sec, 0.75)::DOUBLE AS q75, max(duration_sec)::BIGINT AS max FROM good""")
def describe_duration(spark, sf):
    """Count, mean, spread and quartiles. Durations are counted per second first (at most
    14,311 values after the duration rule), so the quartiles merge a bounded table."""
    c = v.good_trips(spark, sf).groupBy("duration_sec").agg(F.count(F.lit(1)).alias("n"))
    d, n = F.col("duration_sec"), F.col("n")
    total, s1 = F.sum("n"), F.sum(d * n)
    mean = s1 / total
    var = (F.sum(d.cast("double") * d * n) - s1.cast("double") * s1 / total) / (total - 1)
    q = F.percentile(d, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n)
    out = c.agg(total.alias("n"), r(mean, 4).alias("mean"), r(F.sqrt(var), 4).alias("std"), F.min(d).alias("min"),
                q.alias("q"), F.max(d).alias("max"))
    return out.select("n", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"),
                      F.col("q")[2].alias("q75"), "max")


@query("J17", "U4", sql="""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE day(ts) % 5 <> 2),
 s AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d)
SELECT strftime(date, '%Y-%m-%d') AS date FROM s WHERE date NOT IN (SELECT date FROM d)""")
def missing_days(spark, sf):
    e = table(spark, sf, "events").filter(F.dayofmonth("ts") % 5 != 2)
    return series.missing_dates(e, "ts").withColumnRenamed("ts", "date")


@query("S14", sql="SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids, round(sum(value), 4) AS value FROM events GROUP BY 1")
def combined_batches(spark, sf):
    """Fetched batches, two of which overlap and one of which was fetched twice, combined to one table."""
    import uuid

    from ..session import shared_dir
    from ..sources import feeds
    folder = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    e, part = table(spark, sf, "events"), F.col("event_id") % 4
    for number, chosen in ((0, part == 0), (1, part <= 1), (2, part >= 2), (2, part >= 2)):
        feeds.write_batch(e.filter(chosen), f"{folder}/fetched", number)
    rows = feeds.combine_batches(spark, f"{folder}/fetched", f"{folder}/all", ["event_id"])
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), r(F.sum("value"), 4).alias("value"))
