"""Scenarios, routes, station flow and corridors."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, geo, text
from ..functions.numeric import count_if, share_if
from ..operators import flows, series
from ..operators.flows import Scenario
from . import views as v
from .registry import query, r

_ONE_WAY = "start_station_id <> end_station_id AND start_lat IS NOT NULL AND end_lat IS NOT NULL"
_WEEKDAY = "dayofweek(started_at) BETWEEN 1 AND 5"
_SCENARIO_SQL = {
    "member_commutes_7min": f"{_WEEKDAY} AND member_casual = 'member' AND duration_sec BETWEEN 420 AND 3600",
    "morning_rush": f"hour(started_at) BETWEEN 7 AND 9 AND {_WEEKDAY} AND member_casual = 'member' AND duration_sec <= 3600",
    "evening_rush": f"hour(started_at) BETWEEN 17 AND 19 AND {_WEEKDAY} AND member_casual = 'member' AND duration_sec <= 3600",
    "weekend_leisure": "dayofweek(started_at) IN (0, 6)",
    "long_rides": "duration_sec >= 1200",
    "ebikes_only": "rideable_type = 'electric_bike'",
    "tourist": "member_casual = 'casual'",
    "everything": "TRUE",
}


@query("F6", sql=f"WITH {v.TRIPS}\n" + "\nUNION ALL ".join(
    f"SELECT '{name}' AS scenario, count(*) AS trips, CAST(sum(duration_sec) AS BIGINT) AS seconds FROM trips "
    f"WHERE {_ONE_WAY} AND {cond}" for name, cond in _SCENARIO_SQL.items()))
def scenario_totals(spark, sf):
    """All eight named scenarios in one scan: each is a conditional count, not a job of its own."""
    t = flows.select_scenario(v.trips(spark, sf), Scenario())
    preds = {name: flows.scenario_predicate(cfg) for name, cfg in flows.SCENARIOS.items()}
    wide = t.agg(*[F.struct(count_if(p).alias("trips"), F.sum(F.when(p, F.col("duration_sec"))).alias("seconds"))
                   .alias(name) for name, p in preds.items()])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.col(f"{n}.trips").alias("trips"),
                                        F.col(f"{n}.seconds").alias("seconds")) for n in preds])).alias("s")
    return wide.select(rows).select("s.*")


@query("F7", "F6", sql=f"""WITH {v.TRIPS}
SELECT hour(started_at) AS hour, count(*) AS trips FROM trips WHERE (hour(started_at) >= 22 OR hour(started_at) <= 4)
  AND month(started_at) IN (12, 1, 2) AND {_ONE_WAY} AND duration_sec BETWEEN 300 AND 7200 GROUP BY 1""")
def late_night_winter(spark, sf):
    """An hour band that wraps midnight, with season and duration limits."""
    cfg = Scenario(hours=(22, 4), season="winter", min_minutes=5, max_minutes=120)
    return flows.select_scenario(v.trips(spark, sf), cfg).groupBy(F.hour("started_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("trips"))


@query("A19", "T-1", sql=f"""WITH {v.GOOD}, r AS (SELECT start_station_id, end_station_id, count(*) AS trips, round(avg(start_lat), 5) AS start_lat,
    round(avg(start_lon), 5) AS start_lon, round(avg(end_lat), 5) AS end_lat, round(avg(end_lon), 5) AS end_lon,
    round(avg(duration_sec) / 60, 6) AS avg_duration_min,
    round(count(*) FILTER (WHERE member_casual = 'member') * 100.0::DOUBLE / count(*), 6) AS member_pct
  FROM good WHERE {_ONE_WAY} AND {_WEEKDAY} GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY trips DESC, 1, 2 LIMIT 50)
SELECT r.*, s.n_name AS start_station_name, e.n_name AS end_station_name FROM r JOIN nation s ON start_station_id = s.n_nationkey
  JOIN nation e ON end_station_id = e.n_nationkey""")
def top_routes(spark, sf):
    """Busiest weekday routes; names join the fifty rows that remain."""
    t = flows.select_scenario(v.good_trips(spark, sf), Scenario(days="weekday"))
    top = flows.top_routes(t, 50, 2)
    names = v.station_names(spark, sf)
    top = top.join(names.toDF("start_station_id", "start_station_name"), "start_station_id").join(
        names.toDF("end_station_id", "end_station_name"), "end_station_id")
    places = {"start_lat": 5, "start_lon": 5, "end_lat": 5, "end_lon": 5, "avg_duration_min": 6, "member_pct": 6}
    return top.withColumns({c: r(c, n) for c, n in places.items()})


_CLASSED = f"""{v.GOOD}, rs AS (SELECT start_station_id, end_station_id, count(*) AS trips, avg(duration_sec) / 60 AS avg_min,
    count(*) FILTER (WHERE member_casual = 'member') * 100.0::DOUBLE / count(*) AS member_pct,
    count(*) FILTER (WHERE rideable_type = 'electric_bike') * 100.0::DOUBLE / NULLIF(count(*) FILTER (WHERE year(started_at) >= 2020), 0) AS ebike_pct
  FROM good WHERE {_ONE_WAY} GROUP BY 1, 2 HAVING count(*) >= 2), cl AS (SELECT *, CASE WHEN member_pct > 90 THEN 'Commuter'
    WHEN member_pct < 40 THEN 'Tourist' ELSE 'Mixed' END AS route_type FROM rs)"""


def _classed(spark, sf):
    return flows.classed_routes(flows.select_scenario(v.good_trips(spark, sf), Scenario()), min_trips=2)


@query("A20", "P26", sql=f"""WITH {_CLASSED}
SELECT start_station_id, end_station_id, trips, round(avg_min, 6) AS avg_duration_min, round(member_pct, 6) AS member_pct,
  round(ebike_pct, 6) AS ebike_pct, route_type FROM cl""")
def classed_routes(spark, sf):
    return _classed(spark, sf).withColumns({c: r(c) for c in ("avg_duration_min", "member_pct", "ebike_pct")})


@query("A20", sql=f"""WITH {_CLASSED}
SELECT route_type, count(*) AS routes, CAST(sum(trips) AS BIGINT) AS trips, round(avg(trips), 6) AS mean_trips,
  round(avg(avg_min), 6) AS avg_duration_min, round(avg(member_pct), 6) AS member_pct FROM cl GROUP BY 1""")
def route_class_summary(spark, sf):
    out = flows.class_summary(_classed(spark, sf))
    return out.withColumns({c: r(c) for c in ("mean_trips", "avg_duration_min", "member_pct")})


@query("T-4", sql=f"""WITH {_CLASSED}
SELECT route_type, start_station_id, end_station_id, trips FROM cl
QUALIFY row_number() OVER (PARTITION BY route_type ORDER BY trips DESC, start_station_id, end_station_id) <= 5""")
def top_routes_per_class(spark, sf):
    return series.top_per_group(_classed(spark, sf), ["route_type"], [F.desc("trips"), "start_station_id", "end_station_id"],
                                5).select("route_type", "start_station_id", "end_station_id", "trips")


@query("A21", "T-2", sql=f"""WITH {v.GOOD}, d AS (SELECT start_station_id AS station_id, count(*) AS n FROM good GROUP BY 1),
 a AS (SELECT end_station_id AS station_id, count(*) AS n FROM good WHERE end_station_id <> 3 GROUP BY 1)
SELECT COALESCE(d.station_id, a.station_id) AS station_id, COALESCE(d.n, 0) AS depart_count, COALESCE(a.n, 0) AS arrive_count,
  COALESCE(a.n, 0) - COALESCE(d.n, 0) AS net_flow, n_name AS name FROM d FULL JOIN a ON d.station_id = a.station_id
  JOIN nation ON COALESCE(d.station_id, a.station_id) = n_nationkey
ORDER BY abs(net_flow) DESC, station_id LIMIT 20""")
def net_flow(spark, sf):
    """Arrivals less departures, largest imbalance first; stations seen at one end only are kept."""
    t = v.good_trips(spark, sf).withColumn("end_station_id", F.when(F.col("end_station_id") != 3, F.col("end_station_id")))
    out = flows.net_flow(t).orderBy(F.desc(F.abs("net_flow")), "station_id").limit(20)
    return out.join(v.station_names(spark, sf), "station_id")


@query("A22", "J16", sql=f"""WITH {v.GOOD}, p AS (SELECT start_station_id AS f, end_station_id AS t, count(*) AS n FROM good
  WHERE start_station_id <> end_station_id GROUP BY 1, 2)
SELECT x.f AS station_a, x.t AS station_b, x.n AS a_to_b, y.n AS b_to_a, x.n + y.n AS total,
  round(abs(x.n - y.n) * 100.0::DOUBLE / (x.n + y.n), 6) AS imbalance_pct
FROM p x JOIN p y ON x.f = y.t AND x.t = y.f WHERE x.f < x.t""")
def corridors(spark, sf):
    return flows.corridors(v.good_trips(spark, sf)).withColumn("imbalance_pct", r("imbalance_pct"))


@query("A23", sql=f"""WITH {v.GOOD}
SELECT start_station_id, end_station_id, count(*) AS total_trips, count(*) FILTER (WHERE rideable_type = 'electric_bike') AS ebike_trips,
  count(*) FILTER (WHERE rideable_type = 'classic_bike') AS classic_trips,
  round(count(*) FILTER (WHERE rideable_type = 'electric_bike') * 100.0::DOUBLE / count(*), 6) AS ebike_pct,
  round(avg(duration_sec) FILTER (WHERE rideable_type = 'electric_bike') / 60, 6) AS ebike_min,
  round(avg(duration_sec) FILTER (WHERE rideable_type = 'classic_bike') / 60, 6) AS classic_min
FROM good GROUP BY 1, 2 HAVING count(*) >= 2""")
def bike_types_by_route(spark, sf):
    out = flows.bike_types_by_route(v.good_trips(spark, sf), min_trips=2)
    return out.withColumns({c: r(c) for c in ("ebike_pct", "ebike_min", "classic_min")})


@query("U3", "A52", sql=f"""WITH {v.GOOD}, am AS (SELECT start_station_id, end_station_id, count(*) AS n FROM good WHERE hour(started_at) BETWEEN 7 AND 9
    GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 30), pm AS (SELECT start_station_id, end_station_id, count(*) AS n FROM good
    WHERE hour(started_at) BETWEEN 17 AND 19 GROUP BY 1, 2 ORDER BY n DESC, 1, 2 LIMIT 30)
SELECT COALESCE(am.start_station_id, pm.start_station_id) AS start_station_id, COALESCE(am.end_station_id, pm.end_station_id) AS end_station_id,
  CASE WHEN am.n IS NOT NULL AND pm.n IS NOT NULL THEN 'both' WHEN am.n IS NOT NULL THEN 'am_only' ELSE 'pm_only' END AS side
FROM am FULL JOIN pm ON am.start_station_id = pm.start_station_id AND am.end_station_id = pm.end_station_id""")
def rush_route_sets(spark, sf):
    """Routes in the morning top 30, the evening top 30, or both."""
    ts = F.col("started_at")
    rush = F.when(dates.hours_between(ts, 7, 9), "am").when(dates.hours_between(ts, 17, 19), "pm")
    # Counted once for both periods; the two lists come from one short sorted set.
    counts = (v.good_trips(spark, sf).withColumn("rush", rush).filter(F.col("rush").isNotNull())
              .groupBy("rush", *flows.ROUTE).agg(F.count(F.lit(1)).alias("trips")))
    top = series.top_per_group(counts, ["rush"], [F.desc("trips"), *flows.ROUTE], 30)
    return flows.compare_sides(top, flows.ROUTE, "rush", "am", "pm")


@query("W11", "T-4", sql=f"""WITH {v.ORDER_TRIPS}, c AS (SELECT start_station_id, end_station_id, year(started_at) AS year, count(*) AS trips FROM ot
  WHERE year(started_at) IN (1995, 2000) GROUP BY ALL)
SELECT *, row_number() OVER (PARTITION BY year ORDER BY trips DESC, start_station_id, end_station_id) AS rank FROM c
QUALIFY rank <= 20""")
def route_ranks_by_year(spark, sf):
    t = v.order_trips(spark, sf)
    top = flows.rank_change(t, flows.ROUTE, 1995, 2000, 20)
    return series.ranked(top, [F.desc("trips"), "start_station_id", "end_station_id"], ["year"])


@query("A1", "A25", sql=f"""WITH {v.ORDER_TRIPS}, top AS (SELECT start_station_id, end_station_id FROM ot WHERE year(started_at) = 2000
  GROUP BY 1, 2 ORDER BY count(*) DESC, 1, 2 LIMIT 10)
SELECT year(started_at) AS year, ot.start_station_id, ot.end_station_id, count(*) AS trips FROM ot JOIN top USING (start_station_id, end_station_id) GROUP BY ALL""")
def top_route_history(spark, sf):
    """Yearly counts of the latest top ten routes (semi join on ten rows)."""
    t = v.order_trips(spark, sf)
    counts = t.groupBy(F.year("started_at").alias("year"), *flows.ROUTE).agg(F.count(F.lit(1)).alias("trips"))
    top = counts.filter(F.col("year") == 2000).orderBy(F.desc("trips"), *flows.ROUTE).limit(10)
    return counts.join(top.select(*flows.ROUTE), list(flows.ROUTE), "left_semi")


@query("F10", "A50", sql=f"""WITH {v.TRIPS}
SELECT dayofmonth(started_at) % 4 AS wk, count(*) FILTER (WHERE start_lon < -73.95 AND end_lon > -73.95) AS west_to_east,
  count(*) FILTER (WHERE start_lon > -73.95 AND end_lon < -73.95 AND end_lat BETWEEN 40.68 AND 40.78) AS east_to_west,
  count(*) AS total_trips, round(100.0::DOUBLE * count(*) FILTER (WHERE start_lon < -73.95 AND end_lon > -73.95) / count(*), 6) AS pct
FROM trips GROUP BY 1""")
def river_crossings(spark, sf):
    t = v.trips(spark, sf)
    we = geo.crosses_west_to_east(F.col("start_lon"), F.col("end_lon"), -73.95)
    ew = geo.crosses_east_to_west(F.col("start_lon"), F.col("end_lon"), F.col("end_lat"), -73.95)
    return t.groupBy((F.dayofmonth("started_at") % 4).alias("wk")).agg(
        count_if(we).alias("west_to_east"), count_if(ew).alias("east_to_west"), F.count(F.lit(1)).alias("total_trips"),
        r(share_if(we)).alias("pct"))


@query("F9", "A54", sql=f"""WITH {v.NAMED}, f AS (SELECT *, (contains(lower(start_station_name), 'united') OR contains(lower(start_station_name), 'ir')) AS s,
   (contains(lower(end_station_name), 'united') OR contains(lower(end_station_name), 'ir')) AS e,
   CASE WHEN hour(started_at) BETWEEN 6 AND 9 THEN 'AM Rush (6-9)' WHEN hour(started_at) BETWEEN 17 AND 20 THEN 'PM Rush (17-20)' ELSE 'Off-Peak' END AS period
  FROM named WHERE {_WEEKDAY})
SELECT period, count(*) FILTER (WHERE s) AS departures, count(*) FILTER (WHERE e) AS arrivals,
  round(100.0::DOUBLE * count(*) FILTER (WHERE s) / NULLIF(count(*) FILTER (WHERE s) + count(*) FILTER (WHERE e), 0), 6) AS pct_departures
FROM f GROUP BY 1""")
def transit_place_flow(spark, sf):
    """Departures and arrivals at stations whose name contains given words.

    Names are tested once per station, and trips carry the two flags of their stations.
    """
    flags = v.station_names(spark, sf).select("station_id", text.contains_any(F.col("name"), ["united", "ir"]).alias("f"))
    t = v.trips(spark, sf).filter(dates.is_weekday(F.col("started_at")))
    t = t.join(flags.toDF("start_station_id", "s"), "start_station_id").join(flags.toDF("end_station_id", "e"), "end_station_id")
    out = t.groupBy(dates.rush_period(F.col("started_at")).alias("period")).agg(
        count_if(F.col("s")).alias("departures"), count_if(F.col("e")).alias("arrivals"))
    from ..functions.numeric import pct
    return out.withColumn("pct_departures", r(pct(F.col("departures"), F.col("departures") + F.col("arrivals"))))


@query("F8", "A54", sql=f"""WITH {v.NAMED}
SELECT start_station_name, count(*) AS trips, round(avg(CASE WHEN member_casual = 'member' THEN 100.0::DOUBLE ELSE 0 END), 6) AS member_pct,
  round(avg(CASE WHEN hour(started_at) BETWEEN 7 AND 9 THEN 100.0::DOUBLE ELSE 0 END), 6) AS am_rush_pct,
  round(avg(CASE WHEN hour(started_at) BETWEEN 17 AND 19 THEN 100.0::DOUBLE ELSE 0 END), 6) AS pm_rush_pct
FROM named WHERE start_station_name IN (SELECT n_name FROM nation WHERE n_regionkey = 1) GROUP BY 1""")
def listed_station_use(spark, sf):
    """Use of a list of stations; the list is a table joined to trips, not SQL text."""
    from .registry import table
    listed = table(spark, sf, "nation").filter(F.col("n_regionkey") == 1).select(
        F.col("n_nationkey").cast("long").alias("start_station_id"), F.col("n_name").alias("start_station_name"))
    h = F.col("started_at")
    t = v.trips(spark, sf).groupBy("start_station_id").agg(
        F.count(F.lit(1)).alias("trips"), r(share_if(F.col("member_casual") == "member")).alias("member_pct"),
        r(share_if(dates.hours_between(h, 7, 9))).alias("am_rush_pct"),
        r(share_if(dates.hours_between(h, 17, 19))).alias("pm_rush_pct"))
    return t.join(listed, "start_station_id").drop("start_station_id")


@query("T-5", sql=f"""WITH {v.ORDER_TRIPS}, c AS (SELECT start_station_id, count(*) FILTER (WHERE month(started_at) = 7) AS first_value,
    count(*) FILTER (WHERE month(started_at) = 9) AS second_value FROM ot GROUP BY 1), x AS (SELECT *, round((second_value - first_value) * 100.0::DOUBLE / NULLIF(first_value, 0), 6) AS change_pct
  FROM c WHERE first_value >= 1)
(SELECT 'increase' AS direction, * FROM x ORDER BY change_pct DESC, start_station_id LIMIT 10) UNION ALL
(SELECT 'decrease' AS direction, * FROM x ORDER BY change_pct, start_station_id LIMIT 10)""")
def largest_changes(spark, sf):
    """Origins with the largest rise and fall between two months."""
    t = v.order_trips(spark, sf)
    counts = t.filter(F.month("started_at").isin(7, 9)).groupBy(
        "start_station_id", F.month("started_at").cast("string").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    x = flows.period_change(counts, "start_station_id", "m", "n", "7", "9").withColumn("change_pct", r("change_pct"))
    up = x.orderBy(F.desc("change_pct"), "start_station_id").limit(10).withColumn("direction", F.lit("increase"))
    down = x.orderBy("change_pct", "start_station_id").limit(10).withColumn("direction", F.lit("decrease"))
    return up.unionByName(down)


@query("T-1", sql=f"""WITH {v.TRIPS}
SELECT ride_id, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, start_station_id, end_station_id, round(duration_sec / 60.0::DOUBLE, 1) AS duration_min, member_casual
FROM trips ORDER BY duration_sec DESC, ride_id LIMIT 10""")
def longest_trips(spark, sf):
    t = v.trips(spark, sf).orderBy(F.desc("duration_sec"), "ride_id").limit(10)
    return t.select("ride_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"), "start_station_id",
                    "end_station_id", r(F.col("duration_sec") / 60, 1).alias("duration_min"), "member_casual")


@query("T-1", sql=f"""WITH {v.DAILY}
(SELECT 'busiest' AS kind, strftime(date, '%Y-%m-%d') AS date, dayname(date) AS day_name, trips FROM daily ORDER BY trips DESC, date LIMIT 10) UNION ALL
(SELECT 'slowest', strftime(date, '%Y-%m-%d'), dayname(date), trips FROM daily WHERE year(date) >= 1998 ORDER BY trips, date LIMIT 10)""")
def extreme_days(spark, sf):
    d = v.order_trips(spark, sf).groupBy(F.to_date("started_at").alias("date")).agg(F.count(F.lit(1)).alias("trips"))
    # Each day is offered to both lists, so the trips are read once.
    recent = F.col("date") >= F.lit("1998-01-01").cast("date")
    kinds = d.withColumn("k", F.explode(F.array_compact(F.array(
        F.struct(F.lit("busiest").alias("kind"), (-F.col("trips")).alias("o")),
        F.when(recent, F.struct(F.lit("slowest").alias("kind"), F.col("trips").alias("o")))))))
    out = series.top_per_group(kinds.select("date", "trips", "k.*"), ["kind"], ["o", "date"], 10)
    return out.select("kind", "date", dates.day_name(F.col("date")).alias("day_name"), "trips")


@query("T-6", "T-7", sql=f"""WITH {v.TRIPS} SELECT ride_id, start_station_id FROM trips ORDER BY md5(CAST(ride_id AS VARCHAR) || '-7'), ride_id LIMIT 100""")
def repeatable_sample(spark, sf):
    """A uniform sample that is the same in every run: the first rows by a hash of the key."""
    return v.trips(spark, sf).orderBy(F.md5(F.concat(F.col("ride_id").cast("string"), F.lit("-7"))), "ride_id").limit(
        100).select("ride_id", "start_station_id")
