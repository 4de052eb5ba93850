"""Station resolution, weather joins, star joins and other lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bins
from ..operators import enrich, identity
from ..session import lookup_join
from . import views as v
from .registry import query, r, table


def _resolved(spark, sf):
    smap = identity.station_map(v.crosswalk(spark, sf), v.current_stations(spark, sf))
    return identity.resolve_stations(v.raw_resolvable(spark, sf), smap)


@query("J1", "P12", "P13", sql=f"""WITH {v.RESOLVED}
SELECT ride_id, start_station_id, start_station_name, round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon, start_match_type,
  end_station_id, end_station_name, round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon, end_match_type FROM resolved""")
def resolved_trips(spark, sf):
    """Canonical ids, names and positions of both ends: one lookup per end."""
    t = _resolved(spark, sf)
    return t.select("ride_id", "start_station_id", "start_station_name", r("start_lat").alias("start_lat"),
                    r("start_lon").alias("start_lon"), "start_match_type", "end_station_id", "end_station_name",
                    r("end_lat").alias("end_lat"), r("end_lon").alias("end_lon"), "end_match_type")


@query("A10", "P13", sql=f"""WITH {v.RESOLVED}
SELECT member_casual, count(*) AS total, count(*) FILTER (WHERE start_match_type = 'direct') AS direct, count(*) FILTER (WHERE start_match_type = 'crosswalk') AS crosswalk,
  count(*) FILTER (WHERE start_match_type = 'ghost') AS ghost, count(*) FILTER (WHERE start_match_type = 'unmatched') AS unmatched FROM resolved GROUP BY 1""")
def match_type_counts(spark, sf):
    from ..operators.quality import match_counts
    smap = identity.station_map(v.crosswalk(spark, sf), v.current_stations(spark, sf))
    return match_counts(identity.resolve_end(v.raw_resolvable(spark, sf), smap, "start"), ["member_casual"])


@query("J2", "U1", sql=f"""WITH {v.CROSSWALK}, o AS (SELECT legacy_id, 'fixed ' || legacy_name AS legacy_name, legacy_lat, legacy_lon, 'M-99' AS modern_id, 'Override' AS modern_name
   FROM crosswalk WHERE CAST(legacy_id AS INTEGER) % 4 = 0 UNION ALL SELECT NULL, 'no id', 0.0, 0.0, '', '')
SELECT COALESCE(legacy_id, 'null') AS legacy_id, legacy_name, modern_id FROM (SELECT * FROM crosswalk c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.legacy_id = c.legacy_id) UNION ALL SELECT * FROM o)""")
def crosswalk_overrides(spark, sf):
    """Overrides replace crosswalk rows; an override without id adds a row and removes none."""
    cw = v.crosswalk(spark, sf)
    o = cw.filter(F.col("legacy_id").cast("int") % 4 == 0).withColumns({
        "legacy_name": F.concat(F.lit("fixed "), "legacy_name"), "modern_id": F.lit("M-99"), "modern_name": F.lit("Override")})
    blank = cw.filter(F.col("legacy_id") == "0").withColumns({
        "legacy_id": F.lit(None).cast("string"), "legacy_name": F.lit("no id"), "modern_id": F.lit("")})
    out = identity.apply_overrides(cw, o.unionByName(blank))
    return out.select(F.coalesce("legacy_id", F.lit("null")).alias("legacy_id"), "legacy_name", "modern_id")


@query("J3", "A17", sql=f"""WITH {v.RESOLVED}, linked AS (
    SELECT r.*, m.legacy_id, m.legacy_lat, m.legacy_lon FROM resolved r JOIN crosswalk m ON m.modern_id = r.start_station_id WHERE r.start_match_type = 'crosswalk'
    UNION ALL SELECT r.*, m.legacy_id, m.legacy_lat, m.legacy_lon FROM resolved r JOIN crosswalk m ON m.legacy_id = r.start_station_id WHERE r.start_match_type = 'ghost'),
  apart AS (SELECT legacy_id, start_station_id AS canonical_id, start_match_type AS match_type,
    list(111139 * sqrt(power(legacy_lat - start_lat, 2) + power((legacy_lon - start_lon) * cos(radians(40.7::DOUBLE)), 2))) AS metres FROM linked GROUP BY ALL),
  summary AS (SELECT legacy_id, canonical_id, match_type, len(metres) AS trip_count, list_aggregate(metres, 'median') AS mid, list_aggregate(metres, 'avg') AS mean,
    list_aggregate(metres, 'max') AS top, list_aggregate(metres, 'quantile_cont', 0.95) AS high, 100.0::DOUBLE * len(list_filter(metres, lambda x: x > 20)) / len(metres) AS share FROM apart)
SELECT legacy_id, canonical_id, match_type, trip_count, round(mid, 4) AS median_m, round(mean, 4) AS avg_m, round(top, 4) AS max_m, round(high, 4) AS p95_m, round(share, 4) AS pct_over,
  CASE WHEN mid > 20 THEN 'suspicious' WHEN share > 5 THEN 'bad_data' ELSE 'good' END AS verdict FROM summary""")
def mapping_validation(spark, sf):
    """Distances between used and legacy positions; the OR join is a union of two equi joins."""
    out = identity.validate_mapping(_resolved(spark, sf), v.crosswalk(spark, sf), threshold_m=20)
    return out.select("legacy_id", F.col("start_station_id").alias("canonical_id"), F.col("start_match_type").alias("match_type"),
                      "trip_count", r("median_distance_m", 4).alias("median_m"), r("avg_distance_m", 4).alias("avg_m"),
                      r("max_distance_m", 4).alias("max_m"), r("p95_distance_m", 4).alias("p95_m"),
                      r("pct_over_threshold", 4).alias("pct_over"), "verdict")


_ENRICHED = f"""{v.TRIPS}, {v.HOURLY}, {v.HOLIDAYS}, j AS (SELECT t.*, w.*, h.holiday_name, CAST(started_at AS DATE) AS d FROM trips t
   LEFT JOIN weather w ON date_trunc('hour', t.started_at) = w.datetime LEFT JOIN holidays h ON CAST(t.started_at AS DATE) = h.date)"""


def off_tie(name: str):
    """Round after a small shift: short decimals would otherwise sit exactly on a rounding edge."""
    return r(F.col(name) + F.lit(1e-8))


def _daily(spark, sf):
    h = enrich.with_weather(enrich.hourly_counts(v.trips(spark, sf)), v.hourly_weather(spark, sf), None, v.holidays(spark, sf))
    return enrich.daily_weather(h)


@query("J11", "A55", "P31", sql=f"""WITH {_ENRICHED}
SELECT strftime(d, '%Y-%m-%d') AS date, count(*) AS trips, count(*) FILTER (WHERE member_casual = 'member') AS member_trips, round(avg(temperature_2m) * 9 / 5 + 32 + 1e-8::DOUBLE, 6) AS temp_f,
  round(avg(apparent_temperature) * 9 / 5 + 32 + 1e-8::DOUBLE, 6) AS feels_like_f, max(precipitation) AS max_precip_mm, round(sum(precipitation), 6) AS trip_weighted_precip_mm,
  round(sum(precipitation) / count(DISTINCT date_trunc('hour', started_at)), 6) AS precip_per_hour_mm, count(*) FILTER (WHERE precipitation > 0) AS trip_weighted_rainy_hours,
  COALESCE(max(holiday_name), '') AS holiday FROM j GROUP BY 1""")
def daily_with_weather(spark, sf):
    """Trips per day with weather and holiday. Hours are joined, not trips, and trip-weighted
    means stay exact because counts are carried as weights."""
    d = enrich.calendar_features(_daily(spark, sf))
    return d.select("date", "trips", "member_trips", off_tie("temp_f").alias("temp_f"), off_tie("feels_like_f").alias("feels_like_f"), "max_precip_mm",
                    r("trip_weighted_precip_mm").alias("trip_weighted_precip_mm"), r("precip_per_hour_mm").alias("precip_per_hour_mm"),
                    "trip_weighted_rainy_hours", F.coalesce("holiday", F.lit("")).alias("holiday"))


@query("J11", "A55", "F15", sql=f"""WITH {_ENRICHED}
SELECT strftime(d, '%Y-%m-%d') AS date, hour(started_at) AS hour, count(*) AS trips, count(*) FILTER (WHERE member_casual = 'casual') AS casual_trips,
  COALESCE(round(avg(apparent_temperature) * 9 / 5 + 32, 6), -1) AS feels_like_f, COALESCE(round(avg(precipitation), 6), -1) AS precip_mm
FROM j WHERE d IN (DATE '2024-01-04', DATE '2024-01-09', DATE '2024-01-16') GROUP BY ALL""")
def hours_of_chosen_days(spark, sf):
    days = [F.lit(x).cast("date") for x in ("2024-01-04", "2024-01-09", "2024-01-16")]
    t = v.trips(spark, sf).filter(F.to_date("started_at").isin(*days))
    h = enrich.with_weather(enrich.hourly_counts(t), v.hourly_weather(spark, sf))
    return h.select("date", F.hour("hour_ts").alias("hour"), "trips", "casual_trips",
                    F.coalesce(r(bins.fahrenheit(F.col("apparent_temperature"))), F.lit(-1.0)).alias("feels_like_f"),
                    F.coalesce(r("precipitation"), F.lit(-1.0)).alias("precip_mm"))


@query("F11", "J11", sql=f"""WITH {_ENRICHED}, g AS (SELECT d, count(*) AS trips, avg(temperature_2m) * 9 / 5 + 32 AS temp_f, max(precipitation) AS p, max(CASE WHEN holiday_name IS NOT NULL THEN 1 ELSE 0 END) AS hol
  FROM j GROUP BY 1 HAVING temp_f BETWEEN 30 AND 80 AND p < 20 AND hol = 0)
SELECT strftime(d, '%Y-%m-%d') AS date, trips, round(temp_f + 1e-8::DOUBLE, 6) AS temp_f FROM g""")
def good_weather_days(spark, sf):
    d = enrich.calendar_features(_daily(spark, sf))
    return enrich.good_weather(d, 30, 80, wet_mm=20).select(
        "date", "trips", off_tie("temp_f").alias("temp_f"))


@query("J11", sql=f"""WITH {v.TRIPS} SELECT strftime(CAST(started_at AS DATE), '%Y-%m-%d') AS date, count(DISTINCT start_station_id) AS active_start_stations,
  count(DISTINCT end_station_id) AS active_end_stations, (count(DISTINCT start_station_id) + count(DISTINCT end_station_id)) / 2.0::DOUBLE AS active_stations FROM trips GROUP BY 1""")
def active_stations(spark, sf):
    """Distinct stations cannot be added over hours, so they have their own daily aggregate."""
    return enrich.active_stations(v.trips(spark, sf))


@query("A56", "W3", "P27", sql=f"""WITH {_ENRICHED}, d AS (SELECT d, dayofweek(d) AS dow, count(*) FILTER (WHERE member_casual = 'member') AS member_trips, avg(apparent_temperature) AS fl,
    sum(precipitation) AS tp FROM j GROUP BY ALL), e AS (SELECT *, 100.0::DOUBLE * member_trips / avg(member_trips) OVER (PARTITION BY dow) AS rel,
  CASE WHEN tp > 300 THEN 'wet' ELSE 'dry' END AS rain, CASE WHEN fl > 0 AND fl <= 150 THEN 'low' WHEN fl > 150 AND fl <= 180 THEN 'mid' WHEN fl > 180 AND fl <= 1000 THEN 'high' END AS tb FROM d)
SELECT rain, tb AS temp_bin, round(avg(rel), 6) AS mean_pct, COALESCE(round(stddev_samp(rel), 6), -1) AS std_pct, count(*) AS days FROM e GROUP BY ALL""")
def weather_response(spark, sf):
    """Percent of the weekday's usual trips by rain class and temperature bin."""
    d = enrich.calendar_features(_daily(spark, sf))
    d = d.withColumns({"rain": F.when(F.col("trip_weighted_precip_mm") > 300, "wet").otherwise("dry"),
                       "temp_bin": bins.cut(F.col("feels_like_c"), [0, 150, 180, 1000], ["low", "mid", "high"])})
    out = enrich.response_table(d, "member_trips", ["rain", "temp_bin"])
    return out.withColumns({"mean_pct": r("mean_pct"), "std_pct": F.coalesce(r("std_pct"), F.lit(-1.0))})


@query("J12", sql="""SELECT e.s_name AS entrance, e.s_suppkey AS entrance_id, COALESCE(p.s_name, '') AS station
FROM supplier e LEFT JOIN supplier p ON p.s_suppkey = CASE WHEN e.s_suppkey % 11 = 5 THEN -1 ELSE e.s_suppkey // 10 * 10 END WHERE e.s_suppkey % 10 <> 0""")
def entrance_parents(spark, sf):
    """Entrances with their station: a self join on the parent id, unknown parents kept."""
    from ..operators import transit
    k = F.col("s_suppkey")
    parent = F.when(k % 11 == 5, F.lit(-1).cast("long")).otherwise((k - k % 10))
    s = table(spark, sf, "supplier").select(
        k.cast("string").alias("stop_id"), F.col("s_name").alias("stop_name"), F.lit(0.0).alias("stop_lat"), F.lit(0.0).alias("stop_lon"),
        F.when(k % 10 == 0, "1").otherwise("2").alias("location_type"), F.when(k % 10 != 0, parent.cast("string")).alias("parent_station"))
    return transit.entrances(s).select(F.col("entrance_name").alias("entrance"), F.col("entrance_id").cast("long").alias("entrance_id"),
                                       F.coalesce("station_name", F.lit("")).alias("station"))


@query("J13", "F8", sql="""SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000)""")
def semi_joined_orders(spark, sf):
    c = table(spark, sf, "customer").filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000))
    return table(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")


@query("J14", sql="""SELECT r_name, n_name, p_brand, year(o_orderdate) AS year, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
 JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def star_join(spark, sf):
    """A fact table with its dimensions. Sizes decide the join kinds; region and nation are
    folded into the supplier first, so the fact table meets three tables."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    s = (table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "n_name", "r_name"))
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    j = (li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
         .join(o, F.col("l_orderkey") == F.col("o_orderkey")))
    return j.groupBy("r_name", "n_name", "p_brand", "year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("qty"))


@query("J15", sql="""WITH a AS (SELECT l_suppkey AS k, count(*) AS a FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey % 3 <> 0 GROUP BY 1),
 b AS (SELECT l_suppkey AS k, count(*) AS b FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 3 <> 1 GROUP BY 1)
SELECT COALESCE(a.k, b.k) AS k, COALESCE(a, 0) AS a, COALESCE(b, 0) AS b FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_zeros(spark, sf):
    """Two series on one key with zeros for missing sides."""
    li = table(spark, sf, "lineitem")
    a = li.filter((F.col("l_returnflag") == "A") & (F.col("l_suppkey") % 3 != 0)).groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("a"))
    b = li.filter((F.col("l_returnflag") == "R") & (F.col("l_suppkey") % 3 != 1)).groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("b"))
    return a.join(b, "k", "full").na.fill(0, ["a", "b"])


@query("J18", "W3", sql="""SELECT o_orderkey, round(100.0::DOUBLE * o_totalprice / avg(o_totalprice) OVER (PARTITION BY o_custkey), 4) AS pct_of_customer FROM orders""")
def price_against_customer_mean(spark, sf):
    """Each row in relation to its group's mean: an aggregate joined back, so a group with most
    of the rows is averaged in parts instead of sitting in one window."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    mean = o.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("m"))
    j = lookup_join(o, mean, "o_custkey", "inner")
    return j.select("o_orderkey", r(F.col("o_totalprice") * 100 / F.col("m"), 4).alias("pct_of_customer"))


@query("J21", sql="""SELECT CASE event_type WHEN 'view' THEN 'View point' WHEN 'click' THEN 'Click pier' ELSE event_type END AS terminal, count(*) AS n, CASE event_type WHEN 'view' THEN 40.7::DOUBLE WHEN 'click' THEN 40.71::DOUBLE ELSE 0 END AS lat FROM events GROUP BY ALL""")
def constant_map_lookup(spark, sf):
    """Names and positions from a constant map, applied after counting."""
    names = F.create_map(F.lit("view"), F.lit("View point"), F.lit("click"), F.lit("Click pier"))
    lats = F.create_map(F.lit("view"), F.lit(40.7), F.lit("click"), F.lit(40.71))
    n = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.coalesce(F.try_element_at(names, "event_type"), "event_type").alias("terminal"), "n",
                    F.coalesce(F.try_element_at(lats, "event_type"), F.lit(0.0)).alias("lat"))


@query("J10", "A1", sql=f"""WITH {v.TRIPS} SELECT COALESCE(r_name, 'outside') AS area, count(*) AS trips FROM trips LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  WHERE n_nationkey % 7 <> 3) ON start_station_id = n_nationkey GROUP BY 1""")
def trips_by_area(spark, sf):
    """Trips by the pre-computed area of their station: counted by station, then looked up."""
    lookup = (table(spark, sf, "nation").filter(F.col("n_nationkey") % 7 != 3)
              .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
              .select(F.col("n_nationkey").cast("long").alias("start_station_id"), F.col("r_name").alias("area")))
    n = v.trips(spark, sf).groupBy("start_station_id").agg(F.count(F.lit(1)).alias("n"))
    return n.join(lookup, "start_station_id", "left").groupBy(F.coalesce("area", F.lit("outside")).alias("area")).agg(F.sum("n").alias("trips"))


@query("U5", sql="""SELECT DISTINCT o_custkey % 100 AS c, o_orderpriority AS p FROM orders""")
def distinct_pairs(spark, sf):
    return table(spark, sf, "orders").select((F.col("o_custkey") % 100).alias("c"), F.col("o_orderpriority").alias("p")).distinct()


@query("U2", "U1", sql=f"""WITH u AS (SELECT event_type AS kind, ts, 'events' AS src FROM events UNION ALL SELECT o_orderstatus, o_orderdate, 'orders' FROM orders)
SELECT src, kind, count(*) AS n, strftime(max(ts), '%Y-%m-%d') AS last FROM u GROUP BY ALL""")
def stacked_sources(spark, sf):
    """Frames with different columns stacked by name."""
    from ..session import same_rows_union
    a = table(spark, sf, "events").select(F.col("event_type").alias("kind"), "ts", F.lit("events").alias("src"), "user_id")
    b = table(spark, sf, "orders").select(F.lit("orders").alias("src"), F.col("o_orderdate").alias("ts"), F.col("o_orderstatus").alias("kind"))
    return same_rows_union([a, b]).groupBy("src", "kind").agg(F.count(F.lit(1)).alias("n"), F.to_date(F.max("ts")).alias("last"))


