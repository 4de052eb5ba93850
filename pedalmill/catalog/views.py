"""Views over the given tables, each as a DataFrame and as the same SQL text.

``trips`` turns ``events`` into trips; ``order_trips`` gives years of daily
history from ``orders``; side tables for weather and holidays are aggregates of
``events``; stations are the nations with positions computed from their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table


def lat_of(key: Column) -> Column:
    return F.lit(40.6) + (key * 7919 % 1000) * F.lit(0.0004)


def lon_of(key: Column) -> Column:
    return F.lit(-74.1) + (key * 104729 % 1000) * F.lit(0.0004)


def sql_lat(key: str) -> str:
    return f"(40.6::DOUBLE + (({key}) * 7919 % 1000)::DOUBLE * 0.0004::DOUBLE)"


def sql_lon(key: str) -> str:
    return f"(-74.1::DOUBLE + (({key}) * 104729 % 1000)::DOUBLE * 0.0004::DOUBLE)"


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with station keys and positions; names are joined where a query needs them."""
    # The JSON value is read once, in a projection of its own.
    e = table(spark, sf, "events").select(
        "event_id", "ts", "value", "event_type", "user_id", (F.col("user_id") % 25).cast("long").alias("s"),
        (F.get_json_object("props", "$.k").cast("long") % 25).alias("e"))
    start, end = F.col("s"), F.col("e")
    return e.select(
        F.col("event_id").alias("ride_id"), F.col("ts").alias("started_at"),
        F.rint(F.col("value") * 60).cast("int").alias("duration_sec"),
        start.alias("start_station_id"), end.alias("end_station_id"),
        lat_of(start).alias("start_lat"), lon_of(start).alias("start_lon"),
        lat_of(end).alias("end_lat"), lon_of(end).alias("end_lon"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), "member").otherwise("casual")
        .alias("member_casual"),
        F.when(F.col("event_id") % 3 == 0, "electric_bike").otherwise("classic_bike").alias("rideable_type"),
        (18 + F.col("user_id") * 7 % 28).cast("int").alias("age_at_trip"),
        (1 + F.col("event_id") % 2).cast("int").alias("gender"))


TRIPS = f"""trips AS (
  SELECT event_id AS ride_id, ts AS started_at, CAST(value * 60 AS INTEGER) AS duration_sec,
    user_id % 25 AS start_station_id, CAST(json_extract(props, '$.k') AS BIGINT) % 25 AS end_station_id,
    {sql_lat('user_id % 25')} AS start_lat, {sql_lon('user_id % 25')} AS start_lon,
    {sql_lat("CAST(json_extract(props, '$.k') AS BIGINT) % 25")} AS end_lat,
    {sql_lon("CAST(json_extract(props, '$.k') AS BIGINT) % 25")} AS end_lon,
    CASE WHEN event_type IN ('view','click','purchase') THEN 'member' ELSE 'casual' END AS member_casual,
    CASE WHEN event_id % 3 = 0 THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    CAST(18 + user_id * 7 % 28 AS INTEGER) AS age_at_trip, CAST(1 + event_id % 2 AS INTEGER) AS gender
  FROM events)"""


def good_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Trips that pass the duration rule."""
    return trips(spark, sf).filter(F.col("duration_sec").between(90, 14400))


GOOD = TRIPS + ",\ngood AS (SELECT * FROM trips WHERE duration_sec BETWEEN 90 AND 14400)"


def station_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("station_id"),
                                             F.col("n_name").alias("name"))


def named_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with both station names (the nation table is one small file)."""
    names = station_names(spark, sf)
    t = trips(spark, sf)
    s = names.withColumnsRenamed({"station_id": "start_station_id", "name": "start_station_name"})
    e = names.withColumnsRenamed({"station_id": "end_station_id", "name": "end_station_name"})
    return t.join(s, "start_station_id").join(e, "end_station_id")


NAMED = TRIPS + """,
named AS (SELECT t.*, s.n_name AS start_station_name, e.n_name AS end_station_name FROM trips t
  JOIN nation s ON t.start_station_id = s.n_nationkey JOIN nation e ON t.end_station_id = e.n_nationkey)"""


def order_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as trips: seven years of daily history."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("ride_id"), F.col("o_orderdate").alias("started_at"),
        (F.col("o_custkey") % 25).alias("start_station_id"),
        (F.col("o_orderkey") % 25).alias("end_station_id"),
        F.when(F.col("o_orderstatus") == "F", "casual").otherwise("member").alias("member_casual"),
        F.when(F.col("o_orderkey") % 3 == 0, "electric_bike").otherwise("classic_bike").alias("rideable_type"),
        (F.col("o_orderkey") * 37 % 15000).cast("int").alias("duration_sec"),
        (18 + F.col("o_custkey") * 7 % 28).cast("int").alias("age_at_trip"),
        "o_custkey", "o_totalprice")


ORDER_TRIPS = """ot AS (
  SELECT o_orderkey AS ride_id, o_orderdate AS started_at, o_custkey % 25 AS start_station_id,
    o_orderkey % 25 AS end_station_id,
    CASE WHEN o_orderstatus = 'F' THEN 'casual' ELSE 'member' END AS member_casual,
    CASE WHEN o_orderkey % 3 = 0 THEN 'electric_bike' ELSE 'classic_bike' END AS rideable_type,
    CAST(o_orderkey * 37 % 15000 AS INTEGER) AS duration_sec,
    CAST(18 + o_custkey * 7 % 28 AS INTEGER) AS age_at_trip, o_custkey, o_totalprice
  FROM orders)"""


def daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One row per day: trips, member trips, largest price in cents."""
    return (order_trips(spark, sf).groupBy(F.to_date("started_at").alias("date"))
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.count(F.when(F.col("member_casual") == "member", 1)).alias("member_trips"),
                 F.countDistinct("start_station_id").alias("active_stations"),
                 F.max(F.rint(F.col("o_totalprice") * 100).cast("long")).alias("max_cents")))


DAILY = ORDER_TRIPS + """,
daily AS (SELECT CAST(started_at AS DATE) AS date, count(*) AS trips,
    count(*) FILTER (WHERE member_casual = 'member') AS member_trips,
    count(DISTINCT start_station_id) AS active_stations,
    max(CAST(o_totalprice * 100 AS BIGINT)) AS max_cents
  FROM ot GROUP BY 1)"""


def hourly_weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly side table from ``events``; some hours are missing on purpose."""
    e = table(spark, sf, "events")
    h = e.groupBy(F.date_trunc("hour", "ts").alias("datetime")).agg(
        F.min("value").alias("temperature_2m"), F.max("value").alias("apparent_temperature"))
    rain = F.when(F.col("apparent_temperature") > 150, (F.col("apparent_temperature") - 150) / 10).otherwise(0.0)
    return (h.filter((F.unix_timestamp("datetime") / 3600).cast("long") % 17 != 0)
            .withColumn("precipitation", rain))


HOURLY = """weather AS (
  SELECT * FROM (SELECT date_trunc('hour', ts) AS datetime, min(value) AS temperature_2m,
      max(value) AS apparent_temperature,
      CASE WHEN max(value) > 150 THEN (max(value) - 150) / 10 ELSE 0.0::DOUBLE END AS precipitation
    FROM events GROUP BY 1)
  WHERE CAST(epoch(datetime) / 3600 AS BIGINT) % 17 <> 0)"""


def holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Days of the event calendar whose day of month is a multiple of seven."""
    d = table(spark, sf, "events").select(F.to_date("ts").alias("date")).distinct()
    day = F.dayofmonth("date")
    return d.filter(day % 7 == 0).select(
        "date", F.concat(F.lit("Holiday "), day.cast("string")).alias("holiday_name"))


HOLIDAYS = """holidays AS (
  SELECT DISTINCT CAST(ts AS DATE) AS date, 'Holiday ' || CAST(day(ts) AS VARCHAR) AS holiday_name
  FROM events WHERE day(ts) % 7 = 0)"""


def crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Legacy ids 0..24: two in three map to ``M-<key>``, one in three is a ghost; every
    sixth key is missing."""
    k = F.col("n_nationkey").cast("long")
    mapped = k % 3 != 0
    return table(spark, sf, "nation").filter(k % 6 != 5).select(
        k.cast("string").alias("legacy_id"), F.lower("n_name").alias("legacy_name"),
        (lat_of(k) + 0.0002).alias("legacy_lat"), (lon_of(k) + 0.0001).alias("legacy_lon"),
        (k * 10).alias("trip_count"),
        F.when(mapped, F.concat(F.lit("M-"), k.cast("string"))).otherwise("").alias("modern_id"),
        F.when(mapped, F.concat(F.lit("Modern "), "n_name")).otherwise("").alias("modern_name"),
        F.when(mapped, F.lit(90.0)).otherwise(0.0).alias("match_score"),
        F.when(mapped, "high").otherwise("none").alias("match_confidence"),
        F.when(mapped, F.lit(5.0)).otherwise(0.0).alias("match_distance_m"))


CROSSWALK = f"""crosswalk AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS legacy_id, lower(n_name) AS legacy_name,
    {sql_lat('n_nationkey::BIGINT')} + 0.0002::DOUBLE AS legacy_lat,
    {sql_lon('n_nationkey::BIGINT')} + 0.0001::DOUBLE AS legacy_lon,
    CASE WHEN n_nationkey % 3 <> 0 THEN 'M-' || CAST(n_nationkey AS VARCHAR) ELSE '' END AS modern_id,
    CASE WHEN n_nationkey % 3 <> 0 THEN 'Modern ' || n_name ELSE '' END AS modern_name
  FROM nation WHERE n_nationkey % 6 <> 5)"""


def current_stations(spark: SparkSession, sf: str) -> DataFrame:
    """Current stations ``M-<key>`` for keys not divisible by four."""
    k = F.col("n_nationkey").cast("long")
    return table(spark, sf, "nation").filter(k % 4 != 0).select(
        F.concat(F.lit("M-"), k.cast("string")).alias("station_id"),
        F.concat("n_name", F.lit(" Plaza")).alias("name"),
        (lat_of(k) + 0.0003).alias("lat"), (lon_of(k) - 0.0001).alias("lon"))


CURRENT = f"""cur AS (
  SELECT 'M-' || CAST(n_nationkey AS VARCHAR) AS station_id, n_name || ' Plaza' AS name,
    {sql_lat('n_nationkey::BIGINT')} + 0.0003::DOUBLE AS lat,
    {sql_lon('n_nationkey::BIGINT')} - 0.0001::DOUBLE AS lon
  FROM nation WHERE n_nationkey % 4 <> 0)"""


def raw_resolvable(spark: SparkSession, sf: str) -> DataFrame:
    """Trips with raw ids: legacy number, modern ``M-<key>`` on every second trip."""
    t = trips(spark, sf)

    def raw(side: str) -> dict[str, Column]:
        k = F.col(f"{side}_station_id")
        rid = F.when(F.col("ride_id") % 2 == 0, k.cast("string")).otherwise(
            F.concat(F.lit("M-"), k.cast("string")))
        return {f"{side}_station_id_raw": rid,
                f"{side}_station_name_raw": F.concat(F.lit("raw "), k.cast("string")),
                f"{side}_lat_raw": F.col(f"{side}_lat"), f"{side}_lon_raw": F.col(f"{side}_lon")}

    cols = {**raw("start"), **raw("end")}
    return t.select("ride_id", "started_at", "duration_sec", "member_casual",
                    *[c.alias(n) for n, c in cols.items()])


RAW_RESOLVABLE = TRIPS + """,
raw_trips AS (SELECT ride_id, started_at, duration_sec, member_casual,
    CASE WHEN ride_id % 2 = 0 THEN CAST(start_station_id AS VARCHAR)
         ELSE 'M-' || CAST(start_station_id AS VARCHAR) END AS start_station_id_raw,
    'raw ' || CAST(start_station_id AS VARCHAR) AS start_station_name_raw,
    start_lat AS start_lat_raw, start_lon AS start_lon_raw,
    CASE WHEN ride_id % 2 = 0 THEN CAST(end_station_id AS VARCHAR)
         ELSE 'M-' || CAST(end_station_id AS VARCHAR) END AS end_station_id_raw,
    'raw ' || CAST(end_station_id AS VARCHAR) AS end_station_name_raw,
    end_lat AS end_lat_raw, end_lon AS end_lon_raw FROM trips)"""


def resolved_sql(side: str, source: str) -> str:
    """SQL for one resolved end: every raw id falls into one of three sets, each with its own place.

    Ids of the current system stand for themselves. Ids that the crosswalk maps stand for their
    current station, which has the crosswalk's name and position where it is no longer listed. All
    others keep their id, with the crosswalk's legacy name and position if it knows them.
    """
    raw, own = f"{side}_station_id_raw", f"{side}_station_name_raw"
    return f"""WITH used AS (SELECT DISTINCT {raw} AS id, regexp_matches({raw}, '-|^JC|^HB') AS is_new FROM {source}),
      fresh AS (SELECT id, id AS place_id, name, lat, lon, if(cur.station_id IS NULL, 'unmatched', 'direct') AS kind
        FROM used LEFT JOIN cur ON cur.station_id = id WHERE is_new),
      mapped AS (SELECT id, m.modern_id AS place_id, ifnull(cur.name, m.modern_name) AS name, ifnull(cur.lat, m.legacy_lat) AS lat,
          ifnull(cur.lon, m.legacy_lon) AS lon, 'crosswalk' AS kind
        FROM used JOIN crosswalk m ON m.legacy_id = id LEFT JOIN cur ON cur.station_id = m.modern_id WHERE NOT is_new AND m.modern_id > ''),
      kept AS (SELECT id, id AS place_id, legacy_name AS name, legacy_lat AS lat, legacy_lon AS lon, if(legacy_id IS NULL, 'unmatched', 'ghost') AS kind
        FROM used LEFT JOIN crosswalk ON legacy_id = id WHERE NOT is_new AND id NOT IN (SELECT id FROM mapped)),
      places AS (FROM fresh UNION ALL FROM mapped UNION ALL FROM kept)
    SELECT s.*, place_id AS {side}_station_id, ifnull(name, {own}) AS {side}_station_name, ifnull(lat, {side}_lat_raw) AS {side}_lat,
      ifnull(lon, {side}_lon_raw) AS {side}_lon, kind AS {side}_match_type
    FROM {source} s LEFT JOIN places ON places.id = {raw}"""


RESOLVED = (RAW_RESOLVABLE + ",\n" + CROSSWALK + ",\n" + CURRENT + ",\nws AS (" + resolved_sql("start", "raw_trips")
            + "),\nresolved AS (" + resolved_sql("end", "ws") + ")")


def station_ends(spark: SparkSession, sf: str) -> DataFrame:
    """Start-station observations with noisy positions, name variants and a file name."""
    t = trips(spark, sf)
    names = station_names(spark, sf).withColumnRenamed("station_id", "start_station_id")
    noise = (F.col("ride_id") % 7) * F.lit(0.00001)
    label = F.when(F.col("ride_id") % 11 == 0, F.concat("name", F.lit(" (old)"))).when(
        F.col("ride_id") % 501 == 0, F.concat("name", F.lit(" Depot TEMP"))).otherwise(F.col("name"))
    return t.join(names, "start_station_id").select(
        F.concat((F.col("start_station_id") + 3000).cast("string"),
                 F.when(F.col("ride_id") % 5 == 0, ".0").otherwise("")).alias("station_id"),
        label.alias("name"), (F.col("start_lat") + noise).alias("lat"), (F.col("start_lon") - noise).alias("lon"),
        F.concat(F.lit("2024"), F.lpad(F.dayofmonth("started_at").cast("string"), 2, "0"), F.lit(".csv"))
        .alias("source_file"),
        (2020 + F.dayofmonth("started_at") % 5).cast("int").alias("file_year"), "ride_id", "started_at")


STATION_ENDS = TRIPS + """,
ends AS (SELECT CAST(start_station_id + 3000 AS VARCHAR) || CASE WHEN ride_id % 5 = 0 THEN '.0' ELSE '' END AS station_id,
    CASE WHEN ride_id % 11 = 0 THEN n_name || ' (old)' WHEN ride_id % 501 = 0 THEN n_name || ' Depot TEMP'
         ELSE n_name END AS name,
    start_lat + (ride_id % 7) * 0.00001::DOUBLE AS lat, start_lon - (ride_id % 7) * 0.00001::DOUBLE AS lon,
    '2024' || lpad(CAST(day(started_at) AS VARCHAR), 2, '0') || '.csv' AS source_file,
    CAST(2020 + day(started_at) % 5 AS INTEGER) AS file_year, ride_id, started_at
  FROM trips JOIN nation ON start_station_id = n_nationkey)"""


def sql_sorted_tokens(expr: str) -> str:
    """SQL for lower-cased words in sorted order."""
    return (f"array_to_string(list_sort(regexp_split_to_array(trim(lower({expr})), '\\s+')), ' ')")


def sql_indel(a: str, b: str) -> str:
    """SQL for the indel ratio of two plain columns: the common subsequence as a fold over
    characters, one list of lengths per character."""
    lcs = f"""list_reduce(string_split({a}, ''), lambda prev, ch: list_reduce(range(1, length({b}) + 1)::BIGINT[],
      lambda cur, j: list_append(cur, CASE WHEN {b}[j] = ch THEN prev[j] + 1 ELSE greatest(prev[j + 1], cur[j]) END),
      [0::BIGINT]), list_transform(range(length({b}) + 1), lambda x: 0::BIGINT))[-1]"""
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {lcs} / (length({a}) + length({b})) END)"
