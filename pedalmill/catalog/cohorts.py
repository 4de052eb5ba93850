"""Cohort comparisons on orders with their customer's segment as the place class."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bins, dates, geo
from ..functions.numeric import count_if
from ..operators import cohorts, series
from . import views as v
from .registry import query, r, table

_SEG = f"""{v.ORDER_TRIPS}, co AS (SELECT ot.*, CASE c_mktsegment WHEN 'BUILDING' THEN 'Banks' WHEN 'MACHINERY' THEN 'Universities' END AS location,
   year(started_at) AS y, month(started_at) AS m FROM ot JOIN customer ON o_custkey = c_custkey)"""


def _cohort(spark, sf):
    """Order trips with the place class of their customer. Only the two columns needed travel."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(
        F.col("c_mktsegment") == "BUILDING", "Banks").when(F.col("c_mktsegment") == "MACHINERY", "Universities").alias("location"))
    return v.order_trips(spark, sf).join(c, "o_custkey")


_DID = """(fb - sb) * 100.0::DOUBLE / NULLIF(sb, 0)"""


@query("A37", sql=f"""WITH {_SEG}, c AS (SELECT count(*) FILTER (WHERE location = 'Banks' AND m IN (6, 7, 8)) AS tb, count(*) FILTER (WHERE location = 'Banks' AND m IN (9, 10)) AS ta,
  count(*) FILTER (WHERE location = 'Universities' AND m IN (6, 7, 8)) AS cb, count(*) FILTER (WHERE location = 'Universities' AND m IN (9, 10)) AS ca FROM co WHERE age_at_trip BETWEEN 20 AND 25)
SELECT tb::DOUBLE AS treated_before, ta::DOUBLE AS treated_after, cb::DOUBLE AS control_before, ca::DOUBLE AS control_after, round((ta - tb) * 100.0::DOUBLE / tb, 6) AS treated_change_pct,
  round((ca - cb) * 100.0::DOUBLE / cb, 6) AS control_change_pct, round((ta - tb) * 100.0::DOUBLE / tb - (ca - cb) * 100.0::DOUBLE / cb, 6) AS did_pp FROM c""")
def summer_fall_did(spark, sf):
    """Change of one place class less change of the other, summer to fall, young riders."""
    t = _cohort(spark, sf).filter(F.col("age_at_trip").between(20, 25))
    m = F.month("started_at")
    out = cohorts.did(t, F.col("location") == "Banks", F.col("location") == "Universities", m.isin(6, 7, 8), m.isin(9, 10))
    return out.withColumns({c: r(c) for c in ("treated_change_pct", "control_change_pct", "did_pp")})


@query("A37", sql=f"""WITH {_SEG}, c AS (SELECT y, count(*) FILTER (WHERE location = 'Banks' AND m NOT IN (6, 7, 8)) / 9.0::DOUBLE AS tb, count(*) FILTER (WHERE location = 'Banks' AND m IN (6, 7, 8)) / 3.0::DOUBLE AS ta,
  count(*) FILTER (WHERE location = 'Universities' AND m NOT IN (6, 7, 8)) / 9.0::DOUBLE AS cb, count(*) FILTER (WHERE location = 'Universities' AND m IN (6, 7, 8)) / 3.0::DOUBLE AS ca FROM co GROUP BY 1)
SELECT y AS year, round(tb, 6) AS treated_before, round(ta, 6) AS treated_after, round((ta - tb) * 100 / NULLIF(tb, 0) - (ca - cb) * 100 / NULLIF(cb, 0), 6) AS did_pp FROM c""")
def yearly_did_per_month(spark, sf):
    """The same by year, counts normalised by the months of each season."""
    t = _cohort(spark, sf).withColumn("year", F.year("started_at"))
    summer = F.month("started_at").isin(6, 7, 8)
    out = cohorts.did(t, F.col("location") == "Banks", F.col("location") == "Universities", ~summer, summer, by=["year"],
                      months_before=9, months_after=3)
    return out.select("year", r("treated_before").alias("treated_before"), r("treated_after").alias("treated_after"), r("did_pp").alias("did_pp"))


_RATIO = f"""{_SEG}, rt AS (SELECT location, m AS month, count(*) FILTER (WHERE age_at_trip BETWEEN 20 AND 25) AS young_trips, count(*) FILTER (WHERE age_at_trip BETWEEN 35 AND 45) AS control_trips
  FROM co WHERE location IS NOT NULL GROUP BY ALL)"""


def _ratios(spark, sf):
    t = _cohort(spark, sf).filter(F.col("location").isNotNull()).withColumn("month", F.month("started_at"))
    return cohorts.cohort_ratio(t, ["location", "month"], F.col("age_at_trip").between(20, 25), F.col("age_at_trip").between(35, 45))


@query("A38", "W4", sql=f"""WITH {_RATIO}, x AS (SELECT *, young_trips::DOUBLE / NULLIF(control_trips, 0) AS ratio FROM rt)
SELECT location, month, young_trips, control_trips, COALESCE(round(ratio, 6), -1) AS ratio, COALESCE(round(ratio / max(CASE WHEN month = 1 THEN ratio END) OVER (PARTITION BY location), 6), -1) AS indexed FROM x""")
def cohort_crossover(spark, sf):
    """Young/control ratio by month and place, indexed to January."""
    out = series.index_to_base(_ratios(spark, sf), "ratio", F.col("month") == 1, ["location"], scale=1.0)
    return out.withColumns({c: F.coalesce(r(c), F.lit(-1.0)) for c in ("ratio", "indexed")})


@query("A38", sql=f"""WITH {_RATIO}, x AS (SELECT month, young_trips::DOUBLE / NULLIF(control_trips, 0) AS ratio FROM rt WHERE location = 'Banks'),
 y AS (SELECT avg(ratio) FILTER (WHERE month IN (6, 7, 8)) AS i, avg(ratio) FILTER (WHERE month NOT IN (6, 7, 8)) AS o FROM x)
SELECT COALESCE(round(i, 6), -1) AS inside, COALESCE(round(o, 6), -1) AS outside, COALESCE(round((i - o) * 100 / o, 6), -1) AS difference_pct FROM y""")
def seasonal_ratio_contrast(spark, sf):
    x = _ratios(spark, sf).filter(F.col("location") == "Banks")
    out = cohorts.seasonal_contrast(x, "month", "ratio", [6, 7, 8])
    return out.withColumns({c: F.coalesce(r(c), F.lit(-1.0)) for c in out.columns})


@query("A39", "O6", sql=f"""WITH {v.TRIPS}, pl AS (SELECT n_nationkey::BIGINT AS st, CASE WHEN n_regionkey = 0 THEN 'bank_' || CAST(n_nationkey % 2 AS VARCHAR) ELSE 'uni' END AS place FROM nation WHERE n_regionkey < 2),
 a AS (SELECT place, member_casual, count(*) FILTER (WHERE hour(started_at) IN (8, 9, 10)) AS am FROM trips JOIN pl ON end_station_id = st GROUP BY ALL),
 d AS (SELECT place, member_casual, count(*) FILTER (WHERE hour(started_at) IN (17, 18, 19)) AS pm FROM trips JOIN pl ON start_station_id = st GROUP BY ALL)
SELECT COALESCE(a.place, d.place) AS place, COALESCE(a.member_casual, d.member_casual) AS member_casual, COALESCE(am, 0) AS morning_arrivals, COALESCE(pm, 0) AS evening_departures,
  COALESCE(round(COALESCE(am, 0)::DOUBLE / NULLIF(COALESCE(pm, 0), 0), 6), -1) AS asymmetry FROM a FULL JOIN d ON a.place = d.place AND a.member_casual = d.member_casual""")
def arrival_asymmetry(spark, sf):
    """Morning arrivals over evening departures for every place at once."""
    n = table(spark, sf, "nation").filter(F.col("n_regionkey") < 2)
    pl = n.select(F.col("n_nationkey").cast("long").alias("station"), F.when(F.col("n_regionkey") == 0, F.concat(
        F.lit("bank_"), (F.col("n_nationkey") % 2).cast("string"))).otherwise("uni").alias("place"))
    out = cohorts.asymmetry(v.trips(spark, sf), pl, "start_station_id", "end_station_id", by=["member_casual"])
    return out.withColumn("asymmetry", F.coalesce(r("asymmetry"), F.lit(-1.0)))


@query("A40", sql=f"""WITH {_SEG}, w AS (SELECT location, date_trunc('week', started_at) AS week, count(*) FILTER (WHERE age_at_trip BETWEEN 20 AND 25) AS young_trips,
   count(*) FILTER (WHERE age_at_trip BETWEEN 35 AND 45) AS control_trips FROM co WHERE location IS NOT NULL AND started_at >= '1998-05-01' AND started_at < '1998-10-01' GROUP BY ALL)
SELECT location, strftime(week, '%Y-%m-%d') AS week, young_trips, control_trips, COALESCE(round(young_trips::DOUBLE / NULLIF(control_trips, 0), 6), -1) AS ratio,
  row_number() OVER (PARTITION BY location ORDER BY week) AS week_no FROM w""")
def weekly_cohort_ratio(spark, sf):
    """Weekly ratio of two age groups over a transition window."""
    t = _cohort(spark, sf).filter(F.col("location").isNotNull() & (F.col("started_at") >= "1998-05-01") & (F.col("started_at") < "1998-10-01"))
    out = cohorts.weekly_ratio(t, "started_at", F.col("age_at_trip").between(20, 25), F.col("age_at_trip").between(35, 45), ["location"])
    return out.withColumns({"week": F.to_date("week"), "ratio": F.coalesce(r("ratio"), F.lit(-1.0))})


@query("A58", "T-3", sql=f"""WITH {v.ORDER_TRIPS}, c AS (SELECT age_at_trip AS age, CASE WHEN month(started_at) IN (6, 7, 8) THEN 's' WHEN month(started_at) IN (9, 10) THEN 'f' END AS p, count(*) AS n FROM ot
   WHERE age_at_trip BETWEEN 20 AND 30 AND month(started_at) BETWEEN 6 AND 10 GROUP BY ALL), x AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY p) AS pct FROM c)
SELECT age::BIGINT AS age, round(COALESCE(max(pct) FILTER (WHERE p = 's'), 0), 6) AS first_pct, round(COALESCE(max(pct) FILTER (WHERE p = 'f'), 0), 6) AS second_pct,
  round(COALESCE(max(pct) FILTER (WHERE p = 'f'), 0) - COALESCE(max(pct) FILTER (WHERE p = 's'), 0), 6) AS shift_pp FROM x GROUP BY 1""")
def age_composition_shift(spark, sf):
    t = v.order_trips(spark, sf).filter(F.col("age_at_trip").between(20, 30)).withColumnRenamed("age_at_trip", "age")
    m = F.month("started_at")
    out = cohorts.composition_shift(t, "age", F.when(m.isin(6, 7, 8), "s").when(m.isin(9, 10), "f"), "s", "f")
    return out.withColumns({c: r(c) for c in ("first_pct", "second_pct", "shift_pp")})


@query("A57", "P41", sql=f"""WITH {v.TRIPS}, o AS (SELECT CASE WHEN start_lat > 40.85 THEN 'north' WHEN start_lat > 40.72 THEN 'middle' ELSE 'south' END AS zone,
   CASE WHEN age_at_trip BETWEEN 20 AND 23 THEN 'young' WHEN age_at_trip BETWEEN 30 AND 40 THEN 'experienced' END AS cohort, count(*) AS n FROM trips
   WHERE end_station_id IN (1, 2, 3, 4, 5, 6) AND hour(started_at) BETWEEN 7 AND 10 GROUP BY ALL), x AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY cohort) AS pct FROM o WHERE cohort IS NOT NULL)
SELECT zone, round(COALESCE(max(pct) FILTER (WHERE cohort = 'young'), 0), 6) AS a_pct, round(COALESCE(max(pct) FILTER (WHERE cohort = 'experienced'), 0), 6) AS b_pct,
  round(COALESCE(max(pct) FILTER (WHERE cohort = 'young'), 0) - COALESCE(max(pct) FILTER (WHERE cohort = 'experienced'), 0), 6) AS over_pp FROM x GROUP BY 1""")
def origin_zone_shares(spark, sf):
    """Where trips to a place class start, by cohort, and who is over-represented."""
    t = v.trips(spark, sf).filter(F.col("end_station_id").isin(1, 2, 3, 4, 5, 6) & dates.hours_between(F.col("started_at"), 7, 10))
    t = t.withColumn("cohort", bins.age_band(F.col("age_at_trip"), [(20, 23, "young"), (30, 40, "experienced")]))
    zone = geo.zone_of(F.col("start_lat"), F.col("start_lon"), [(40.85, None, None, "north"), (40.72, None, None, "middle")], "south")
    out = cohorts.zone_shares(t, zone, "cohort", "young", "experienced")
    return out.withColumns({c: r(c) for c in ("a_pct", "b_pct", "over_pp")})


@query("A57", "T-4", sql=f"""WITH {v.TRIPS}, o AS (SELECT start_station_id AS origin, CASE WHEN age_at_trip BETWEEN 20 AND 23 THEN 'young' WHEN age_at_trip BETWEEN 30 AND 40 THEN 'experienced' END AS cohort, count(*) AS n
  FROM trips WHERE end_station_id IN (1, 2, 3, 4, 5, 6) GROUP BY ALL HAVING count(*) >= 2)
SELECT origin, cohort, n FROM o WHERE cohort IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cohort ORDER BY n DESC, origin) <= 5""")
def top_origins_per_cohort(spark, sf):
    t = v.trips(spark, sf).filter(F.col("end_station_id").isin(1, 2, 3, 4, 5, 6))
    t = t.withColumn("cohort", bins.age_band(F.col("age_at_trip"), [(20, 23, "young"), (30, 40, "experienced")])).filter(F.col("cohort").isNotNull())
    o = t.groupBy(F.col("start_station_id").alias("origin"), "cohort").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= 2)
    return series.top_per_group(o, ["cohort"], [F.desc("n"), "origin"], 5)


@query("A3", "F8", sql=f"""WITH {v.ORDER_TRIPS}, pl AS (SELECT n_nationkey AS s FROM nation WHERE n_regionkey = 1)
SELECT age_at_trip::BIGINT AS age, count(*) AS trips, count(*) FILTER (WHERE month(started_at) IN (6, 7, 8)) AS summer, count(*) FILTER (WHERE month(started_at) IN (9, 10, 11)) AS fall
FROM ot WHERE (start_station_id IN (SELECT s FROM pl) OR end_station_id IN (SELECT s FROM pl)) GROUP BY 1""")
def age_volume_at_places(spark, sf):
    """Trips touching a place list at either end, by age."""
    pl = table(spark, sf, "nation").filter(F.col("n_regionkey") == 1).select(F.col("n_nationkey").cast("long").alias("station"))
    return cohorts.age_volume(cohorts.trips_touching(v.order_trips(spark, sf), pl, "start_station_id", "end_station_id"))


@query("P25", "J13", sql=f"""WITH {v.TRIPS}, pl AS (SELECT n_nationkey AS st, CASE n_regionkey WHEN 0 THEN 'bank' WHEN 1 THEN 'university' WHEN 2 THEN 'control' END AS k FROM nation WHERE n_regionkey < 3)
SELECT COALESCE(o.k, 'other') AS origin_type, COALESCE(d.k, 'other') AS dest_type, count(*) AS trips, count(*) FILTER (WHERE gender = 1) AS male FROM trips
 LEFT JOIN pl o ON start_station_id = o.st LEFT JOIN pl d ON end_station_id = d.st GROUP BY ALL""")
def place_class_matrix(spark, sf):
    """Origin class by destination class; the list of places is a joined table."""
    pl = table(spark, sf, "nation").filter(F.col("n_regionkey") < 3).select(
        F.col("n_nationkey").cast("long").alias("station"), F.get(F.array(F.lit("bank"), F.lit("university"), F.lit("control")),
                                                                 F.col("n_regionkey")).alias("place_class"))
    c = v.trips(spark, sf).groupBy("start_station_id", "end_station_id").agg(F.count(F.lit(1)).alias("n"), count_if(F.col("gender") == 1).alias("g"))
    c = cohorts.place_class(cohorts.place_class(c, pl, "start_station_id", "o"), pl, "end_station_id", "d")
    return c.groupBy(F.coalesce("o", F.lit("other")).alias("origin_type"), F.coalesce("d", F.lit("other")).alias("dest_type")).agg(
        F.sum("n").alias("trips"), F.sum("g").alias("male"))
