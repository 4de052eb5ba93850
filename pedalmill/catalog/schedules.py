"""Schedule tables and two-header sheets built from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reshape, transit
from . import views as v
from .registry import query, r, table

# Orders play schedule trips, line items stop times, suppliers stops, regions lines.


def _stops(spark, sf):
    k = F.col("s_suppkey")
    kind = F.when(k % 10 == 0, F.when(k % 20 == 0, "1")).otherwise("0")
    return table(spark, sf, "supplier").select(
        k.cast("string").alias("stop_id"),
        F.concat("s_name", F.when(k % 20 == 0, F.lit(" - Queens")).otherwise("")).alias("stop_name"), v.lat_of(k).alias("stop_lat"),
        v.lon_of(k).alias("stop_lon"), kind.alias("location_type"),
        F.when((k % 10 != 0) & (k % 10 != 9), (k - k % 10).cast("string")).alias("parent_station"))


def _routes(spark, sf):
    k = F.col("r_regionkey")
    return table(spark, sf, "region").select(
        k.cast("string").alias("route_id"), F.substring(F.lit("AGL7X"), k + 1, F.lit(1)).alias("route_short_name"),
        F.col("r_name").alias("route_long_name"), F.when(k == 3, "3").otherwise("1").alias("route_type"),
        F.concat(F.lit("00"), k.cast("string")).alias("route_color"), F.lit("FFF").alias("route_text_color"))


def _trips(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("trip_id"),
                                             (F.col("o_custkey") % 5).cast("string").alias("route_id"),
                                             (F.col("o_orderkey") % 4).cast("string").alias("service_id"))


def _stop_times(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"), F.col("l_suppkey").cast("string").alias("stop_id"),
        F.concat((F.col("l_partkey") % 28).cast("string"), F.lit(":05:00")).alias("arrival_time"))


def _calendar(spark, sf):
    s = table(spark, sf, "orders").select((F.col("o_orderkey") % 4).alias("k")).distinct()
    return s.select(F.col("k").cast("string").alias("service_id"), (F.col("k") == 0).cast("int").alias("monday"),
                    (F.col("k") == 1).cast("int").alias("saturday"), (F.col("k") == 2).cast("int").alias("sunday"))


_LINE = "substr('AGL7X', CAST(o_custkey % 5 + 1 AS INTEGER), 1)"
_PLAT = """plat AS (SELECT s.s_suppkey AS stop, CASE WHEN s.s_suppkey % 10 IN (0, 9) THEN s.s_suppkey ELSE s.s_suppkey - s.s_suppkey % 10 END AS station FROM supplier s),
 st AS (SELECT plat.*, p.s_name || CASE WHEN p.s_suppkey % 20 = 0 THEN ' - Queens' ELSE '' END AS station_name FROM plat LEFT JOIN supplier p ON station = p.s_suppkey)"""


@query("A48", "S19", sql=f"""SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name || CASE WHEN s_suppkey % 20 = 0 THEN ' - Queens' ELSE '' END AS station_name, round({v.sql_lat('s_suppkey')}, 6) AS latitude,
  CASE WHEN s_suppkey % 20 = 0 THEN 'Queens' ELSE '' END AS borough FROM supplier WHERE s_suppkey % 10 = 0""")
def schedule_stations(spark, sf):
    """Station complexes: typed, or untyped and without parent."""
    s = transit.stations(_stops(spark, sf))
    return s.select("station_id", "station_name", r("latitude").alias("latitude"), F.coalesce("borough", F.lit("")).alias("borough"))


@query("A48", "P45", sql="""SELECT CAST(r_regionkey AS VARCHAR) AS route_id, substr('AGL7X', r_regionkey + 1, 1) AS line_name, r_name AS route_name,
 CASE r_regionkey WHEN 0 THEN '8th Ave' WHEN 1 THEN 'Crosstown' WHEN 2 THEN '14th St-Canarsie' ELSE 'Other' END AS line_group FROM region WHERE r_regionkey <> 3""")
def schedule_lines(spark, sf):
    return transit.lines(_routes(spark, sf)).select("route_id", "line_name", "route_name", "line_group")


@query("A48", "J14", "U5", sql=f"""WITH {_PLAT} SELECT DISTINCT CAST(station AS VARCHAR) AS station_id, COALESCE(station_name, '') AS station_name, {_LINE} AS line_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN st ON l_suppkey = stop WHERE o_custkey % 5 <> 3""")
def station_lines(spark, sf):
    """Which lines serve which station."""
    s = transit.station_lines(_stop_times(spark, sf), _trips(spark, sf), _routes(spark, sf), _stops(spark, sf))
    return s.select("station_id", F.coalesce("station_name", F.lit("")).alias("station_name"), "line_name")


@query("A48", "P46", "P47", "J14", sql=f"""WITH {_PLAT}, x AS (SELECT station, station_name, {_LINE} AS line_name, CASE o_orderkey % 4 WHEN 0 THEN 'Weekday' WHEN 1 THEN 'Saturday' WHEN 2 THEN 'Sunday' ELSE 'Other' END AS day_type,
   CASE WHEN l_partkey % 28 BETWEEN 7 AND 9 THEN 'AM Peak' WHEN l_partkey % 28 BETWEEN 10 AND 15 THEN 'Midday' WHEN l_partkey % 28 BETWEEN 16 AND 19 THEN 'PM Peak' WHEN l_partkey % 28 BETWEEN 20 AND 23 THEN 'Evening' ELSE 'Night' END AS time_period
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN st ON l_suppkey = stop WHERE o_custkey % 5 <> 3)
SELECT CAST(station AS VARCHAR) AS station_id, COALESCE(station_name, '') AS station_name, line_name, day_type, time_period, count(*) AS trips_in_period,
  round(count(*) / CASE time_period WHEN 'AM Peak' THEN 3.0::DOUBLE WHEN 'Midday' THEN 6 WHEN 'PM Peak' THEN 4 WHEN 'Evening' THEN 4 ELSE 7 END, 1) AS trains_per_hour FROM x GROUP BY station, station_name, line_name, day_type, time_period""")
def service_frequency(spark, sf):
    """Trains per hour by station, line, day type and period."""
    f = transit.service_frequency(_stop_times(spark, sf), _trips(spark, sf), _routes(spark, sf), _stops(spark, sf), _calendar(spark, sf))
    return f.withColumn("station_name", F.coalesce("station_name", F.lit("")))


def _sheet_cells(spark, sf):
    """Line items as ferry sheets: a file per year, a sheet per return flag, a row per day and a
    column per supplier group; odd sheets leave rows between header and data."""
    li = table(spark, sf, "lineitem")
    day = F.to_date("l_shipdate")
    base = li.groupBy(F.year(day).alias("y"), F.col("l_returnflag").alias("sheet"), day.alias("d"), (F.col("l_suppkey") % 6).alias("g")).agg(
        (F.count(F.lit(1)) * 700).alias("n"))
    file = F.concat(F.lit("ferry_"), F.col("y").cast("string"))
    gap = F.when(F.col("sheet") == "A", 1).otherwise(3)
    row = gap + F.dayofyear("d") + 1
    col = (F.col("g") + 2 + F.when(F.col("g") >= 3, 1).otherwise(0)).cast("int")
    data = base.select(file.alias("file"), "sheet", row.alias("row"), col.alias("col"), F.format_number("n", 0).alias("value"))
    days = base.select("y", "sheet", "d").distinct()
    label = F.when(F.dayofmonth("d") == 1, F.concat(F.lit("(First) "), F.date_format("d", "EEEE"))).otherwise(F.date_format("d", "EEEE"))
    lead = days.select(file.alias("file"), "sheet", row.alias("row"), F.explode(F.array(
        F.struct(F.lit(0).alias("col"), label.alias("value")), F.struct(F.lit(1).alias("col"), F.date_format("d", "yyyy-MM-dd").alias("value")))).alias("c"))
    lead = lead.select("file", "sheet", "row", "c.col", "c.value")
    sheets = days.select("y", "sheet").distinct()
    # Header rows: destinations over merged columns, a total column, Day/Date with the stops,
    # and a summary row below the data.
    cells = [(0, 2, "Pier A"), (0, 6, "Pier B"), (0, 9, "Total"), (1, 0, "Day"), (1, 1, "Date"), (1, 2, "S0"), (1, 3, "S1"), (1, 4, "S2"), (1, 6, "S3"),
             (1, 7, "S4"), (1, 8, "S5"), (1, 9, "Total"), (500, 0, "Weekday Total"), (500, 1, "2001-01-01"), (500, 2, "99,999")]
    heads = sheets.select(file.alias("file"), "sheet", F.explode(F.array(*[
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.lit(c).alias("value")) for a, b, c in cells])).alias("h")).select("file", "sheet", "h.*")
    return data.unionByName(lead).unionByName(heads)


@query("S16", "W13", "P42", "P44", sql="""WITH x AS (SELECT year(l_shipdate) AS y, l_returnflag AS sheet, CAST(l_shipdate AS DATE) AS d, l_suppkey % 6 AS g, count(*) * 700 AS n FROM lineitem GROUP BY ALL),
 days AS (SELECT DISTINCT y, sheet, d FROM x), f AS (SELECT days.*, k.g FROM days, range(6) k(g))
SELECT 'ferry_' || CAST(f.y AS VARCHAR) AS file, f.sheet, strftime(f.d, '%Y-%m-%d') AS date, dayname(f.d) AS day_of_week, CASE WHEN day(f.d) = 1 THEN 'First' ELSE '' END AS holiday,
 CASE WHEN f.g < 3 THEN 'Pier A' ELSE 'Pier B' END AS destination, 'S' || CAST(f.g AS VARCHAR) AS origin, COALESCE(n, 0) AS ridership FROM f LEFT JOIN x ON f.y = x.y AND f.sheet = x.sheet AND f.d = x.d AND f.g = x.g""")
def sheet_records(spark, sf):
    """Sheets with merged headers, blank cells, totals and summary rows to ridership records."""
    out = reshape.sheet_records(_sheet_cells(spark, sf))
    return out.withColumn("holiday", F.coalesce("holiday", F.lit("")))
