"""Counts, shares, pivots, summaries and reconciliations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numeric import count_if, pct, ratio, share_if
from ..operators import quantiles, reconcile, reshape, series
from ..sources import tables as positional
from . import views as v
from .registry import query, r, table


@query("A1", "A2", "A9", sql=f"""WITH {v.ORDER_TRIPS}
SELECT year(started_at) AS year, count(*) AS trips, count(DISTINCT started_at) AS days_with_trips,
  round(count(*)::DOUBLE / count(DISTINCT started_at), 6) AS avg_daily, count(DISTINCT start_station_id) AS stations,
  round(count(*)::DOUBLE / count(DISTINCT start_station_id), 6) AS trips_per_station FROM ot GROUP BY 1""")
def yearly_growth(spark, sf):
    """Trips, active days and stations per year. Rows are first reduced to (day, station)."""
    c = v.order_trips(spark, sf).groupBy(F.to_date("started_at").alias("date"), "start_station_id").agg(
        F.count(F.lit(1)).alias("n"))
    out = c.groupBy(F.year("date").alias("year")).agg(
        F.sum("n").alias("trips"), F.countDistinct("date").alias("days_with_trips"),
        F.countDistinct("start_station_id").alias("stations"))
    return out.withColumns({"avg_daily": r(F.col("trips") / F.col("days_with_trips")),
                            "trips_per_station": r(F.col("trips") / F.col("stations"))})


@query("A2", "A5", "A7", sql=f"""WITH {v.GOOD}
SELECT count(*) AS total_trips, count(DISTINCT start_station_id) AS start_stations, count(DISTINCT end_station_id) AS end_stations,
  strftime(min(started_at), '%Y-%m-%d %H:%M:%S') AS first_trip, strftime(max(started_at), '%Y-%m-%d %H:%M:%S') AS last_trip,
  round(avg(duration_sec) / 60, 4) AS avg_min, round(median(duration_sec) / 60, 4) AS median_min,
  count(*) FILTER (WHERE member_casual = 'member') AS member_trips, count(*) FILTER (WHERE member_casual = 'casual') AS casual_trips FROM good""")
def trip_overview(spark, sf):
    """One-row overview. Everything is rolled up from (stations, duration) groups, so the
    median sees a table of at most 14,311 durations."""
    t = v.good_trips(spark, sf)
    per = t.groupBy("duration_sec").agg(F.count(F.lit(1)).alias("n"))
    med = per.agg((F.percentile("duration_sec", F.lit(0.5), F.col("n")) / 60).alias("m")).scalar()
    out = t.groupBy("start_station_id", "end_station_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration_sec").alias("s"), F.min("started_at").alias("a"),
        F.max("started_at").alias("b"), count_if(F.col("member_casual") == "member").alias("m"),
        count_if(F.col("member_casual") == "casual").alias("c"))
    one = out.agg(F.sum("n").alias("total_trips"), F.countDistinct("start_station_id").alias("start_stations"),
                  F.countDistinct("end_station_id").alias("end_stations"),
                  F.date_format(F.min("a"), "yyyy-MM-dd HH:mm:ss").alias("first_trip"),
                  F.date_format(F.max("b"), "yyyy-MM-dd HH:mm:ss").alias("last_trip"),
                  r(F.sum("s") / F.sum("n") / 60, 4).alias("avg_min"), F.sum("m").alias("member_trips"),
                  F.sum("c").alias("casual_trips"))
    return one.withColumn("median_min", F.round(med, 4))


@query("A3", "A4", "A8", sql=f"""WITH {v.TRIPS}
SELECT start_station_id, count(*) FILTER (WHERE rideable_type = 'electric_bike') AS ebike_trips,
  CAST(sum(CASE WHEN member_casual = 'member' THEN 1 ELSE 0 END) AS BIGINT) AS member_trips,
  round(avg(duration_sec) FILTER (WHERE member_casual = 'casual') / 60, 6) AS casual_min,
  round(count(*) FILTER (WHERE rideable_type = 'electric_bike') * 100.0::DOUBLE / NULLIF(count(*) FILTER (WHERE day(started_at) > 28), 0), 6) AS guarded_pct
FROM trips GROUP BY 1""")
def conditional_aggregates(spark, sf):
    t = v.trips(spark, sf)
    e, late = F.col("rideable_type") == "electric_bike", F.dayofmonth("started_at") > 28
    return t.groupBy("start_station_id").agg(
        count_if(e).alias("ebike_trips"), count_if(F.col("member_casual") == "member").alias("member_trips"),
        r(F.avg(F.when(F.col("member_casual") == "casual", F.col("duration_sec"))) / 60).alias("casual_min"),
        r(pct(count_if(e), count_if(late))).alias("guarded_pct"))


@query("A5", "A61", sql=f"""WITH {v.GOOD}
SELECT day(started_at) % 6 AS grp, round(median(duration_sec), 4) AS median_sec, round(quantile_cont(duration_sec, 0.95), 4) AS p95_sec,
  round(avg(duration_sec), 4) AS avg_sec, count(*) AS trips FROM good WHERE start_station_id IN (1, 2, 3, 4) AND {"dayofweek(started_at) BETWEEN 1 AND 5"} GROUP BY 1""")
def duration_quantiles(spark, sf):
    """Exact median and p95 from counts per second (durations are bounded by the quality rule)."""
    t = v.good_trips(spark, sf).filter(F.col("start_station_id").isin(1, 2, 3, 4) & dates.is_weekday(F.col("started_at")))
    c = t.groupBy((F.dayofmonth("started_at") % 6).alias("grp"), "duration_sec").agg(F.count(F.lit(1)).alias("n"))
    q = F.percentile("duration_sec", F.array(F.lit(0.5), F.lit(0.95)), F.col("n"))
    return c.groupBy("grp").agg(q.alias("q"), r(F.sum(F.col("duration_sec") * F.col("n")) / F.sum("n"), 4).alias("avg_sec"),
                                F.sum("n").alias("trips")).select(
        "grp", r(F.col("q")[0], 4).alias("median_sec"), r(F.col("q")[1], 4).alias("p95_sec"), "avg_sec", "trips")


@query("A5", sql="""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median_price, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95_price
FROM lineitem GROUP BY 1""")
def price_quantiles(spark, sf):
    """Exact quantiles of a value with no bound on its distinct values: histogram refinement
    instead of one value table per group."""
    out = quantiles.exact_quantiles(table(spark, sf, "lineitem"), ["l_returnflag"],
                                    {"median_price": ("l_extendedprice", 0.5), "p95_price": ("l_extendedprice", 0.95)})
    return out.withColumns({c: r(c, 4) for c in ("median_price", "p95_price")})


@query("A6", sql="""WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_quantity AS mode, n AS mode_count FROM c QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_quantity) = 1""")
def usual_quantity(spark, sf):
    """Most frequent value per key with a tie rule."""
    return quantiles.modes(table(spark, sf, "lineitem"), ["l_suppkey"], "l_quantity")


@query("A24", "A25", sql=f"""WITH {v.TRIPS}, c AS (SELECT if(isodow(started_at) > 5, 'Weekend', 'Weekday') AS day_type, year(started_at) AS year, member_casual,
   ifnull(if(ride_id % 13 = 0, NULL, rideable_type), 'classic_bike') AS rideable_type, hour(started_at) AS hour, dayofweek(started_at) AS dow, count(*) AS n FROM trips GROUP BY ALL),
 g AS (SELECT DISTINCT day_type, year, member_casual, rideable_type FROM c), s AS (SELECT g.*, h.h AS hour, d.d AS dow FROM g, range(24) h(h), range(7) d(d))
SELECT s.*, COALESCE(n, 0) AS trips FROM s LEFT JOIN c USING (day_type, year, member_casual, rideable_type, hour, dow)""")
def heatmap_cells(spark, sf):
    """The six-key cube, with every hour and weekday present; every 13th trip names no bike."""
    t = v.trips(spark, sf)
    return series.heatmap_cells(t.withColumn("rideable_type", F.when(F.col("ride_id") % 13 != 0, F.col("rideable_type"))))


@query("A25", sql=f"""WITH {v.TRIPS}
SELECT hour(started_at) AS hour, """ + ", ".join(
    f"count(*) FILTER (WHERE left(dayname(started_at), 3) = '{d}') AS {d}" for d in ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"))
    + " FROM trips GROUP BY 1")
def hour_by_weekday_pivot(spark, sf):
    t = v.trips(spark, sf)
    c = t.groupBy(F.hour("started_at").alias("hour"), dates.day_name(F.col("started_at"), True).alias("d")).agg(
        F.count(F.lit(1)).alias("n"))
    return reshape.pivot_sum(c, ["hour"], "d", ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"], "n")


@query("A26", "P51", sql="""WITH x AS (SELECT r_name AS operator, l_shipdate AS d, s_suppkey, s_nationkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem
   JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
 a AS (SELECT operator, CAST(sum(q) AS BIGINT) AS total, round(avg(q), 6) AS mean, max(q) AS maximum, strftime(min(d), '%Y-%m-%d') AS first_date,
   strftime(max(d), '%Y-%m-%d') AS last_date, max(d) AS ld, count(DISTINCT s_suppkey) AS n_s_suppkey, count(DISTINCT s_nationkey) AS n_s_nationkey FROM x GROUP BY 1)
SELECT operator, total, mean, maximum, first_date, last_date, n_s_suppkey, n_s_nationkey, round(100.0::DOUBLE * total / sum(total) OVER (), 6) AS share_pct,
  CASE WHEN year(ld) >= 2001 THEN 'Active' ELSE 'Inactive' END AS status FROM a""")
def operator_summary(spark, sf):
    """Totals per operator (region). Line items are reduced to (supplier, day) before the names join."""
    li = table(spark, sf, "lineitem").groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("q"), F.count(F.lit(1)).alias("n"),
        F.max(F.col("l_quantity").cast("long")).alias("m"))
    s, n, g = (table(spark, sf, x) for x in ("supplier", "nation", "region"))
    dim = s.join(n, s.s_nationkey == n.n_nationkey).join(g, n.n_regionkey == g.r_regionkey).select(
        F.col("s_suppkey").alias("l_suppkey"), "s_suppkey", "s_nationkey", F.col("r_name").alias("operator"))
    out = li.join(dim, "l_suppkey").groupBy("operator").agg(
        F.sum("q").alias("total"), r(F.sum("q") / F.sum("n")).alias("mean"), F.max("m").alias("maximum"),
        F.min("d").alias("first_date"), F.max("d").alias("last_date"), F.countDistinct("s_suppkey").alias("n_s_suppkey"),
        F.countDistinct("s_nationkey").alias("n_s_nationkey"))
    out = series.share(out, "total", None, "share_pct").withColumn("share_pct", r("share_pct"))
    return out.withColumn("status", F.when(F.year("last_date") >= 2001, "Active").otherwise("Inactive"))


@query("A29", sql=f"""WITH {v.DAILY} SELECT year(date) AS year, round(corr(trips, max_cents), 6) AS r_price, round(corr(trips, member_trips), 6) AS r_member FROM daily GROUP BY 1""")
def yearly_correlations(spark, sf):
    d = v.daily_orders(spark, sf)
    return d.groupBy(F.year("date").alias("year")).agg(r(F.corr("trips", "max_cents")).alias("r_price"),
                                                       r(F.corr("trips", "member_trips")).alias("r_member"))


@query("A30", "W2", sql=f"""WITH {v.TRIPS}, c AS (SELECT member_casual, hour(started_at) AS hour, count(*) AS n FROM trips GROUP BY ALL),
 p AS (SELECT *, 100.0::DOUBLE * n / sum(n) OVER (PARTITION BY member_casual) AS share FROM c)
SELECT member_casual, round(stddev_samp(share), 6) AS spread, round(100.0::DOUBLE * stddev_samp(share) / avg(share), 6) AS cv FROM p WHERE hour BETWEEN 7 AND 13 GROUP BY 1""")
def profile_spread(spark, sf):
    """Spread of the morning hours in a rider type's hourly profile."""
    c = v.trips(spark, sf).groupBy("member_casual", F.hour("started_at").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    p = series.share(c, "n", ["member_casual"], "share").filter(F.col("hour").between(7, 13))
    return p.groupBy("member_casual").agg(r(F.stddev_samp("share")).alias("spread"),
                                          r(F.stddev_samp("share") * 100 / F.avg("share")).alias("cv"))


@query("A41", sql="""WITH a AS (SELECT o_orderpriority AS operator, count(*) AS actual FROM orders GROUP BY 1),
 e AS (SELECT o_orderpriority AS operator, CAST(floor(count(*) * (0.8::DOUBLE + 0.08::DOUBLE * CAST(left(o_orderpriority, 1) AS INTEGER))) AS BIGINT) AS expected FROM orders
   WHERE left(o_orderpriority, 1) <> '5' GROUP BY 1 UNION ALL SELECT 'unknown', 10 UNION ALL SELECT 'zero', 0)
SELECT e.operator, expected, COALESCE(actual, 0) AS actual, round(abs(COALESCE(actual, 0) - expected) * 100.0::DOUBLE / expected, 6) AS diff_pct,
  CASE WHEN abs(COALESCE(actual, 0) - expected) * 100.0::DOUBLE / expected > 10 THEN 'warning' ELSE 'passed' END AS status
FROM e LEFT JOIN a USING (operator) WHERE expected <> 0""")
def control_totals(spark, sf):
    """Sums against control totals derived from the table, with a missing and a zero operator."""
    o = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("operator"), F.lit(1).alias("one"))
    level = F.substring("operator", 1, 1).cast("int")
    control = (o.filter(level != 5).groupBy("operator")
               .agg(F.count(F.lit(1)).alias("n")).select("operator", F.floor(F.col("n") * (
                   F.lit(0.8) + F.lit(0.08) * level)).alias("expected")))
    extra = o.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(
        F.struct(F.lit("unknown").alias("operator"), F.lit(10).cast("long").alias("expected")),
        F.struct(F.lit("zero").alias("operator"), F.lit(0).cast("long").alias("expected")))).alias("x")).select("x.*")
    out = reconcile.reconcile(o, control.unionByName(extra), "operator", "one", "expected")
    return out.withColumn("diff_pct", r("diff_pct"))


@query("A42", sql="""WITH y AS (SELECT o_orderpriority AS grp, count(*) FILTER (WHERE year(o_orderdate) = 1995) AS a, count(*) FILTER (WHERE year(o_orderdate) = 2000) AS b FROM orders GROUP BY 1)
SELECT grp, a AS first_value, b AS last_value, round((pow(b::DOUBLE / a, 1.0::DOUBLE / 5) - 1) * 100, 6) AS cagr_pct FROM y""")
def compound_growth(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("grp"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"))
    return reconcile.growth_rate(o, "year", "n", 1995, 2000, ["grp"]).withColumn("cagr_pct", r("cagr_pct"))


@query("A44", sql="""WITH y AS (SELECT year(o_orderdate) AS year, CASE WHEN o_orderpriority = '1-URGENT' THEN 'public' ELSE 'private' END AS grp, count(*) AS total FROM orders GROUP BY ALL)
SELECT year, grp AS "group", total, round(100.0::DOUBLE * total / sum(total) OVER (PARTITION BY year), 6) AS share_pct FROM y""")
def market_share(spark, sf):
    o = table(spark, sf, "orders").withColumn("one", F.lit(1))
    g = F.when(F.col("o_orderpriority") == "1-URGENT", "public").otherwise("private")
    return reconcile.market_share(o, F.year("o_orderdate"), g, "one").withColumn("share_pct", r("share_pct"))


@query("A45", sql=f"""WITH {v.ORDER_TRIPS}, d AS (SELECT start_station_id AS route, started_at, count(*) AS n FROM ot GROUP BY ALL)
SELECT route, round(avg(n) FILTER (WHERE dayofweek(started_at) IN (0, 6)), 6) AS avg_weekend, round(avg(n) FILTER (WHERE dayofweek(started_at) NOT IN (0, 6)), 6) AS avg_weekday,
  round(avg(n) FILTER (WHERE dayofweek(started_at) IN (0, 6)) / avg(n) FILTER (WHERE dayofweek(started_at) NOT IN (0, 6)), 6) AS ratio,
  round(100.0::DOUBLE * sum(n) FILTER (WHERE month(started_at) IN (6, 7, 8)) / sum(n), 6) AS summer_pct FROM d GROUP BY 1""")
def weekend_ratio_and_season(spark, sf):
    d = v.order_trips(spark, sf).groupBy(F.col("start_station_id").alias("route"), "started_at").agg(F.count(F.lit(1)).alias("n"))
    we = dates.is_weekend(F.col("started_at"))
    a, b = F.avg(F.when(we, F.col("n"))), F.avg(F.when(~we, F.col("n")))
    summer = F.sum(F.when(dates.season(F.col("started_at")) == "Summer", F.col("n")))
    return d.groupBy("route").agg(r(a).alias("avg_weekend"), r(b).alias("avg_weekday"), r(ratio(a, b)).alias("ratio"),
                                  r(pct(summer, F.sum("n"))).alias("summer_pct"))


def _permits(spark, sf):
    """Yearly permit rows per place, by structure, from orders."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey") % 4
    return positional.structure_groups(o.groupBy(F.year("o_orderdate").alias("year"), (F.col("o_custkey") % 10).alias("place")).agg(
        count_if(k == 0).alias("units_1"), count_if(k == 1).alias("units_2"), count_if(k == 2).alias("units_3_4"),
        count_if(k == 3).alias("units_5plus")))


_PERMITS = """p AS (SELECT year(o_orderdate) AS year, o_custkey % 10 AS place, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS single_family,
   count(*) FILTER (WHERE o_orderkey % 4 IN (1, 2)) AS small_multi, count(*) FILTER (WHERE o_orderkey % 4 = 3) AS large_multi, count(*) AS total_units FROM orders GROUP BY ALL)"""


@query("A46", "F17", sql=f"""WITH {_PERMITS} SELECT CASE WHEN year <= 1997 THEN 'before' ELSE 'after' END AS period, round(avg(total_units), 6) AS avg_total_units,
 round(avg(single_family), 6) AS avg_single_family, round(avg(small_multi), 6) AS avg_small_multi, round(100.0::DOUBLE * sum(single_family) / sum(total_units), 6) AS pct_single_family,
 round(100.0::DOUBLE * sum(small_multi) / sum(total_units), 6) AS pct_small_multi FROM p WHERE year <= 2000 GROUP BY 1""")
def before_after_policy(spark, sf):
    p = _permits(spark, sf).filter(F.col("year") <= 2000)
    out = reconcile.before_after(p, F.when(F.col("year") <= 1997, "before").otherwise("after"), "total_units", ["single_family", "small_multi"])
    return out.withColumns({c: r(c) for c in out.columns if c != "period"})


@query("P50", "J21", sql=f"""WITH {_PERMITS} SELECT year, place, total_units, round(total_units * 1000.0::DOUBLE / pop, 6) AS per_1000, round(single_family * 100.0::DOUBLE / total_units, 6) AS pct_single
FROM p JOIN (SELECT c_custkey % 10 AS place, count(*) * 50 AS pop FROM customer GROUP BY 1) USING (place)""")
def permits_per_capita(spark, sf):
    """Permits per thousand inhabitants; population in heads, from the customer table."""
    pop = table(spark, sf, "customer").groupBy((F.col("c_custkey") % 10).alias("place")).agg((F.count(F.lit(1)) * 50).alias("population"))
    out = reconcile.per_capita(_permits(spark, sf), pop, "place", "total_units")
    return out.select("year", "place", "total_units", r("per_1000").alias("per_1000"),
                      r(pct(F.col("single_family"), F.col("total_units"))).alias("pct_single"))


@query("S18", "A47", sql="""SELECT o_custkey % 20 AS region_id, year(o_orderdate) AS year, round(avg(n), 6) AS value FROM (SELECT o_custkey % 20 AS o_custkey, date_trunc('month', o_orderdate) AS o_orderdate, count(*) AS n
 FROM orders GROUP BY ALL) GROUP BY ALL""")
def wide_months_to_annual(spark, sf):
    """A wide month matrix made from orders, turned long again and averaged per year."""
    o = table(spark, sf, "orders")
    first, last = o.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))).first()
    months = [f"{y}-{m:02d}-28" for y in range(first, last + 1) for m in range(1, 13)]
    wide = (o.withColumn("m", F.date_format("o_orderdate", "yyyy-MM-28"))
            .groupBy((F.col("o_custkey") % 20).alias("region_id")).pivot("m", months).agg(F.count(F.lit(1))))
    long = reshape.unpivot_months(wide, ["region_id"])
    return reshape.annual_mean(long, ["region_id"]).withColumn("value", r("value"))


@query("A50", sql=f"""WITH {v.GOOD}, u AS (SELECT 'west' AS system, * FROM good WHERE start_lon < -73.9 UNION ALL SELECT 'east', * FROM good WHERE start_lon >= -73.9)
SELECT system, count(*) AS trips, count(DISTINCT CAST(started_at AS DATE)) AS days, round(avg(duration_sec) / 60, 6) AS avg_min,
 round(100.0::DOUBLE * count(*) FILTER (WHERE member_casual = 'member') / count(*), 6) AS member_pct,
 round(100.0::DOUBLE * count(*) FILTER (WHERE dayofweek(started_at) IN (0, 6)) / count(*), 6) AS weekend_pct FROM u GROUP BY 1""")
def system_summary(spark, sf):
    """Two systems side by side: a system column and one aggregate instead of one query per system."""
    t = v.good_trips(spark, sf).withColumn("system", F.when(F.col("start_lon") < -73.9, "west").otherwise("east"))
    return t.groupBy("system").agg(
        F.count(F.lit(1)).alias("trips"), F.countDistinct(F.to_date("started_at")).alias("days"),
        r(F.avg("duration_sec") / 60).alias("avg_min"), r(share_if(F.col("member_casual") == "member")).alias("member_pct"),
        r(share_if(dates.is_weekend(F.col("started_at")))).alias("weekend_pct"))


@query("A52", sql=f"""WITH {v.TRIPS}, x AS (SELECT day(started_at) % 5 AS grp, count(*) FILTER (WHERE hour(started_at) BETWEEN 7 AND 9) AS am_peak,
  count(*) FILTER (WHERE hour(started_at) BETWEEN 17 AND 19) AS pm_peak FROM trips WHERE dayofweek(started_at) BETWEEN 1 AND 5 AND member_casual = 'member' GROUP BY 1)
SELECT *, round(am_peak::DOUBLE / NULLIF(pm_peak, 0), 6) AS am_pm_ratio FROM x""")
def peak_ratio(spark, sf):
    t = v.trips(spark, sf).filter(dates.is_weekday(F.col("started_at")) & (F.col("member_casual") == "member"))
    h = F.col("started_at")
    x = t.groupBy((F.dayofmonth("started_at") % 5).alias("grp")).agg(
        count_if(dates.hours_between(h, 7, 9)).alias("am_peak"), count_if(dates.hours_between(h, 17, 19)).alias("pm_peak"))
    return x.withColumn("am_pm_ratio", r(ratio(F.col("am_peak"), F.col("pm_peak"))))


@query("A52", sql=f"""WITH {v.TRIPS} SELECT strftime(CAST(started_at AS DATE), '%Y-%m-%d') AS date, count(*) AS trips FROM trips
WHERE member_casual = 'member' AND hour(started_at) BETWEEN 7 AND 9 AND month(started_at) IN (1, 2) AND dayofweek(started_at) BETWEEN 1 AND 5 GROUP BY 1""")
def rush_window_by_day(spark, sf):
    t = v.trips(spark, sf)
    c = F.col("started_at")
    return t.filter((F.col("member_casual") == "member") & dates.hours_between(c, 7, 9) & F.month(c).isin(1, 2)
                    & dates.is_weekday(c)).groupBy(F.to_date(c).alias("date")).agg(F.count(F.lit(1)).alias("trips"))


@query("A53", sql=f"""WITH {v.ORDER_TRIPS}, x AS (SELECT *, CASE WHEN started_at < '1998-03-01' THEN 'before' WHEN started_at < '1998-07-01' THEN 'closure' ELSE 'after' END AS period
  FROM ot WHERE started_at >= '1997-01-01' AND started_at < '2000-01-01')
SELECT period, round(count(*)::DOUBLE / count(DISTINCT started_at), 6) AS avg_daily, round(100.0::DOUBLE * count(*) FILTER (WHERE member_casual = 'member') / count(*), 6) AS member_pct,
  round(100.0::DOUBLE * count(*) FILTER (WHERE dayofweek(started_at) IN (0, 6)) / count(*), 6) AS weekend_pct, round(avg(duration_sec) / 60, 6) AS avg_min FROM x GROUP BY 1""")
def period_comparison(spark, sf):
    t = v.order_trips(spark, sf).filter(dates.in_years(F.col("started_at"), 1997, 1999))
    p = dates.period_by_date(F.col("started_at"), [(None, "1998-03-01", "before"), ("1998-03-01", "1998-07-01", "closure"), (None, None, "after")])
    return t.groupBy(p.alias("period")).agg(
        r(F.count(F.lit(1)) / F.countDistinct("started_at")).alias("avg_daily"), r(share_if(F.col("member_casual") == "member")).alias("member_pct"),
        r(share_if(dates.is_weekend(F.col("started_at")))).alias("weekend_pct"), r(F.avg("duration_sec") / 60).alias("avg_min"))


@query("A53", sql=f"""WITH {v.ORDER_TRIPS}, x AS (SELECT month(started_at) AS month, count(*) FILTER (WHERE year(started_at) = 1998) AS trips_a, count(*) FILTER (WHERE year(started_at) = 1999) AS trips_b
  FROM ot WHERE year(started_at) IN (1998, 1999) GROUP BY 1) SELECT *, round(100.0::DOUBLE * (trips_b - trips_a) / NULLIF(trips_a, 0), 6) AS change_pct FROM x""")
def same_month_change(spark, sf):
    t = v.order_trips(spark, sf).filter(dates.in_years(F.col("started_at"), 1998, 1999))
    y = F.year("started_at")
    x = t.groupBy(F.month("started_at").alias("month")).agg(count_if(y == 1998).alias("trips_a"), count_if(y == 1999).alias("trips_b"))
    return x.withColumn("change_pct", r(pct(F.col("trips_b") - F.col("trips_a"), F.col("trips_a"))))


@query("A59", sql=f"""WITH {v.GOOD} SELECT member_casual, count(*) AS trips, round(avg(CASE WHEN start_station_id = end_station_id THEN 100.0::DOUBLE ELSE 0 END), 6) AS round_trip_pct,
 round(avg(CASE WHEN hour(started_at) <= 4 THEN 100.0::DOUBLE ELSE 0 END), 6) AS late_night_pct, round(avg(CASE WHEN dayofweek(started_at) IN (0, 6) THEN 100.0::DOUBLE ELSE 0 END), 6) AS weekend_pct,
 round(avg(CASE WHEN hour(started_at) BETWEEN 7 AND 9 OR hour(started_at) BETWEEN 17 AND 19 THEN 100.0::DOUBLE ELSE 0 END), 6) AS rush_pct, round(median(duration_sec) / 60, 6) AS median_min
FROM good GROUP BY 1""")
def rider_behaviour(spark, sf):
    """Shares per rider type; counted per duration second first, so the median merges bounded tables."""
    t = v.good_trips(spark, sf)
    ts = F.col("started_at")
    c = t.groupBy("member_casual", "duration_sec").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("start_station_id") == F.col("end_station_id")).alias("a"),
        count_if(F.hour(ts) <= 4).alias("b"), count_if(dates.is_weekend(ts)).alias("c"), count_if(dates.is_rush(ts)).alias("d"))
    n = F.sum("n")
    return c.groupBy("member_casual").agg(
        n.alias("trips"), r(pct(F.sum("a"), n)).alias("round_trip_pct"), r(pct(F.sum("b"), n)).alias("late_night_pct"),
        r(pct(F.sum("c"), n)).alias("weekend_pct"), r(pct(F.sum("d"), n)).alias("rush_pct"),
        r(F.percentile("duration_sec", F.lit(0.5), F.col("n")) / 60).alias("median_min"))


@query("A60", sql=f"""WITH {v.TRIPS}, {v.HOLIDAYS}, d AS (SELECT CAST(started_at AS DATE) AS date, count(*) AS n FROM trips GROUP BY 1)
SELECT CASE WHEN h.date IS NOT NULL THEN 'Holiday' ELSE 'Regular Day' END AS kind, round(avg(n), 6) AS mean, CAST(sum(n) AS BIGINT) AS total, count(*) AS days
FROM d LEFT JOIN holidays h ON d.date = h.date GROUP BY 1""")
def holiday_effect(spark, sf):
    d = v.trips(spark, sf).groupBy(F.to_date("started_at").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    j = d.join(v.holidays(spark, sf), "date", "left")
    return j.groupBy(F.when(F.col("holiday_name").isNotNull(), "Holiday").otherwise("Regular Day").alias("kind")).agg(
        r(F.avg("n")).alias("mean"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("days"))


@query("A61", sql=f"""WITH {v.ORDER_TRIPS} SELECT year(started_at) AS year, CASE WHEN month(started_at) = 7 THEN 'July' ELSE 'September' END AS month,
 CASE WHEN end_station_id IN (1, 2, 3) THEN 'core' ELSE 'campus' END AS location, count(*) AS total, count(*) FILTER (WHERE member_casual = 'casual') AS casual,
 round(100.0::DOUBLE * count(*) FILTER (WHERE member_casual = 'casual') / count(*), 6) AS casual_pct
FROM ot WHERE month(started_at) IN (7, 9) AND end_station_id IN (1, 2, 3, 4, 5) AND dayofweek(started_at) BETWEEN 1 AND 5 GROUP BY ALL""")
def two_month_rider_share(spark, sf):
    t = v.order_trips(spark, sf).filter(F.month("started_at").isin(7, 9) & F.col("end_station_id").isin(1, 2, 3, 4, 5)
                                        & dates.is_weekday(F.col("started_at")))
    c = F.col("member_casual") == "casual"
    return t.groupBy(F.year("started_at").alias("year"), F.when(F.month("started_at") == 7, "July").otherwise("September").alias("month"),
                     F.when(F.col("end_station_id").isin(1, 2, 3), "core").otherwise("campus").alias("location")).agg(
        F.count(F.lit(1)).alias("total"), count_if(c).alias("casual"), r(share_if(c)).alias("casual_pct"))


