"""Shares, indexes, lags, rolling means over aggregated series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import series
from . import views as v
from .registry import query, r, table

_MONTHLY = f"""{v.ORDER_TRIPS}, monthly AS (SELECT year(started_at) AS year, month(started_at) AS month, member_casual AS kind, count(*) AS trips
  FROM ot GROUP BY ALL)"""


def _monthly(spark, sf, first_year=1900):
    t = v.order_trips(spark, sf).filter(dates.in_years(F.col("started_at"), first_year, 2100))
    return t.groupBy(F.year("started_at").alias("year"), F.month("started_at").alias("month"),
                                            F.col("member_casual").alias("kind")).agg(F.count(F.lit(1)).alias("trips"))


@query("W1", "A1", sql=f"""WITH {v.TRIPS}, c AS (SELECT start_station_id, count(*) AS trips FROM trips GROUP BY 1)
SELECT start_station_id, trips, round(100.0::DOUBLE * trips / sum(trips) OVER (), 6) AS pct FROM c""")
def share_of_total(spark, sf):
    c = v.trips(spark, sf).groupBy("start_station_id").agg(F.count(F.lit(1)).alias("trips"))
    return series.share(c, "trips").withColumn("pct", r("pct"))


@query("W2", sql=f"""WITH {v.TRIPS}, c AS (SELECT CASE WHEN day(started_at) <= 10 THEN 'first' WHEN day(started_at) <= 20 THEN 'second' ELSE 'third' END AS period,
    hour(started_at) AS hour, count(*) FILTER (WHERE member_casual = 'member') AS member_trips FROM trips WHERE dayofweek(started_at) NOT IN (0, 6) GROUP BY ALL)
SELECT period, hour, member_trips, round(100.0::DOUBLE * member_trips / sum(member_trips) OVER (PARTITION BY period), 6) AS pct_of_day FROM c""")
def hourly_profile_by_period(spark, sf):
    """Share of each hour within its period, weekdays only."""
    t = v.trips(spark, sf).filter(dates.is_weekday(F.col("started_at")))
    day = F.dayofmonth("started_at")
    c = t.groupBy(F.when(day <= 10, "first").when(day <= 20, "second").otherwise("third").alias("period"),
                  F.hour("started_at").alias("hour")).agg(
        F.count(F.when(F.col("member_casual") == "member", 1)).alias("member_trips"))
    return series.share(c, "member_trips", ["period"], "pct_of_day").withColumn("pct_of_day", r("pct_of_day"))


@query("W3", "J18", sql=f"""WITH {v.DAILY}, w AS (SELECT *, dayofweek(date) AS dow, isoyear(date) * 100 + week(date) AS wk FROM daily WHERE dayofweek(date) BETWEEN 1 AND 5)
SELECT strftime(date, '%Y-%m-%d') AS date, trips, round(100.0::DOUBLE * trips / avg(trips) OVER (PARTITION BY wk), 6) AS pct_of_week,
  round(100.0::DOUBLE * member_trips / avg(member_trips) OVER (PARTITION BY dow), 6) AS pct_of_expected FROM w""")
def pct_of_week_and_weekday(spark, sf):
    """Daily trips in relation to the week's mean and to the weekday's mean."""
    d = v.daily_orders(spark, sf).filter(dates.is_weekday(F.col("date")))
    d = d.withColumns({"dow": dates.dow(F.col("date")), "wk": dates.iso_week_key(F.col("date"))})
    out = series.pct_of_mean(series.pct_of_mean(d, "trips", ["wk"], "pct_of_week"), "member_trips", ["dow"], "pct_of_expected")
    return out.select("date", "trips", r("pct_of_week").alias("pct_of_week"), r("pct_of_expected").alias("pct_of_expected"))


@query("W4", sql=f"""WITH {_MONTHLY}, b AS (SELECT *, max(CASE WHEN month = 7 THEN trips END) OVER (PARTITION BY year, kind) AS july FROM monthly)
SELECT year, month, kind, trips, COALESCE(round(100.0::DOUBLE * trips / july, 6), -1) AS indexed FROM b""")
def index_to_july(spark, sf):
    out = series.index_to_base(_monthly(spark, sf), "trips", F.col("month") == 7, ["year", "kind"])
    return out.withColumn("indexed", F.coalesce(r("indexed"), F.lit(-1.0)))


@query("W5", sql=f"""WITH {v.ORDER_TRIPS}, m AS (SELECT month(started_at) AS month, age_at_trip AS age, count(*) AS trips FROM ot WHERE age_at_trip BETWEEN 20 AND 26 GROUP BY ALL)
SELECT month, age::BIGINT AS age, trips, round(100.0::DOUBLE * trips / max(trips) OVER (PARTITION BY age), 6) AS pct_of_peak FROM m""")
def pct_of_peak_month(spark, sf):
    t = v.order_trips(spark, sf).filter(F.col("age_at_trip").between(20, 26))
    m = t.groupBy(F.month("started_at").alias("month"), F.col("age_at_trip").alias("age")).agg(F.count(F.lit(1)).alias("trips"))
    return series.pct_of_peak(m, "trips", ["age"]).withColumn("pct_of_peak", r("pct_of_peak"))


@query("W6", sql=f"""WITH {v.ORDER_TRIPS}, y AS (SELECT year(started_at) AS year, count(*) AS trips FROM ot GROUP BY 1)
SELECT year, trips, COALESCE(round(100.0::DOUBLE * (trips - lag(trips) OVER (ORDER BY year)) / lag(trips) OVER (ORDER BY year), 6), 0) AS yoy_pct FROM y""")
def yearly_change(spark, sf):
    y = v.order_trips(spark, sf).groupBy(F.year("started_at").alias("year")).agg(F.count(F.lit(1)).alias("trips"))
    return series.change_on_previous(y, "trips", ["year"], out="yoy_pct").withColumn("yoy_pct", F.coalesce(r("yoy_pct"), F.lit(0.0)))


@query("W7", "A29", "S18", sql="""WITH y AS (SELECT year(o_orderdate) AS year, o_custkey % 10 AS region, count(*) AS permits,
    CAST(sum(CAST(o_totalprice * 100 AS BIGINT)) AS BIGINT) AS cents FROM orders WHERE NOT (o_custkey % 10 = 3 AND year(o_orderdate) = 1997) GROUP BY ALL),
 j AS (SELECT a.region, a.year, a.permits, b.permits AS lagged, (a.cents - c.cents) * 100.0::DOUBLE / c.cents AS chg FROM y a
   LEFT JOIN y b ON a.region = b.region AND b.year = a.year - 2 LEFT JOIN y c ON a.region = c.region AND c.year = a.year - 1)
SELECT region, count(*) FILTER (WHERE lagged IS NOT NULL AND chg IS NOT NULL) AS pairs, round(corr(lagged, chg), 6) AS r FROM j GROUP BY 1""")
def lagged_correlation(spark, sf):
    """Permits two years earlier against this year's change; lags follow the calendar, so a
    missing year leaves a gap instead of shifting the series."""
    o = table(spark, sf, "orders")
    y = (o.groupBy((F.col("o_custkey") % 10).alias("region"), F.year("o_orderdate").alias("year"))
         .agg(F.count(F.lit(1)).alias("permits"), F.sum(F.rint(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
         .filter(~((F.col("region") == 3) & (F.col("year") == 1997))))
    y = series.value_years_before(y, "permits", "year", 2, ["region"])
    y = series.change_on_year(y, "cents", "year", 1, ["region"], "chg")
    both = F.col("lagged").isNotNull() & F.col("chg").isNotNull()
    return y.groupBy("region").agg(F.count(F.when(both, 1)).alias("pairs"),
                                   r(F.corr(F.when(both, F.col("lagged")), F.when(both, F.col("chg")))).alias("r"))


@query("W8", sql=f"""WITH {v.DAILY}, w AS (SELECT date, trips, avg(trips) OVER x AS m, count(*) OVER x AS n FROM daily
  WINDOW x AS (ORDER BY date ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING))
SELECT strftime(date, '%Y-%m-%d') AS date, trips, CASE WHEN n = 30 THEN round(m, 6) ELSE -1 END AS centred FROM w""")
def centred_mean_30(spark, sf):
    out = series.centred_mean(v.daily_orders(spark, sf), "trips", ["date"], 30, out="centred")
    return out.select("date", "trips", F.coalesce(r("centred"), F.lit(-1.0)).alias("centred"))


@query("W9", sql=f"""WITH {_MONTHLY}, m AS (SELECT year, month, CAST(sum(trips) AS BIGINT) AS trips FROM monthly GROUP BY ALL),
 w AS (SELECT *, avg(trips) OVER x AS a, count(*) OVER x AS n FROM m WINDOW x AS (ORDER BY year, month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT year, month, trips, CASE WHEN n = 12 THEN round(a, 6) ELSE -1 END AS trailing FROM w""")
def trailing_mean_12(spark, sf):
    m = _monthly(spark, sf).groupBy("year", "month").agg(F.sum("trips").alias("trips"))
    out = series.trailing_mean(m, "trips", ["year", "month"], 12, out="trailing")
    return out.withColumn("trailing", F.coalesce(r("trailing"), F.lit(-1.0)))


_STOPS = f"{v.TRIPS}, c AS (SELECT start_station_id, CAST(sum(duration_sec) AS BIGINT) AS total FROM trips GROUP BY 1)"


@query("W10", sql=f"""WITH {_STOPS}
SELECT start_station_id, total, round(100.0::DOUBLE * sum(total) OVER (ORDER BY total DESC, start_station_id ROWS UNBOUNDED PRECEDING) / sum(total) OVER (), 6) AS cumulative_pct FROM c""")
def cumulative_share(spark, sf):
    c = v.trips(spark, sf).groupBy("start_station_id").agg(F.sum("duration_sec").alias("total"))
    return series.running_share(c, "total", ["start_station_id"]).withColumn("cumulative_pct", r("cumulative_pct"))


@query("W10", sql=f"""WITH {_STOPS}, x AS (SELECT 100.0::DOUBLE * sum(total) OVER (ORDER BY total DESC, start_station_id ROWS UNBOUNDED PRECEDING) / sum(total) OVER () AS cp FROM c)
SELECT count(*) FILTER (WHERE cp <= 80) + 1 AS items, count(*) AS of_items FROM x""")
def stations_for_80_pct(spark, sf):
    c = v.trips(spark, sf).groupBy("start_station_id").agg(F.sum("duration_sec").alias("total"))
    return series.items_to_reach(c, "total", ["start_station_id"], 80.0)


_BUYERS = "c AS (SELECT o_custkey, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS total FROM orders GROUP BY 1)"


def _buyers(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum(F.round("o_totalprice").cast("long")).alias("total"))


@query("W1", "W10", sql=f"""WITH {_BUYERS} SELECT o_custkey, total, round(100.0::DOUBLE * total / sum(total) OVER (), 8) AS pct,
  round(100.0::DOUBLE * sum(total) OVER (ORDER BY total DESC, o_custkey ROWS UNBOUNDED PRECEDING) / sum(total) OVER (), 6) AS cumulative_pct FROM c""")
def buyer_cumulative_share(spark, sf):
    """Cumulative share over as many keys as there are customers, by prefix sums over all tasks."""
    c = series.running_share(_buyers(spark, sf), "total", ["o_custkey"])
    return series.share(c, "total").select("o_custkey", "total", r("pct", 8).alias("pct"), r("cumulative_pct").alias("cumulative_pct"))


@query("W10", sql=f"""WITH {_BUYERS}, x AS (SELECT 100.0::DOUBLE * sum(total) OVER (ORDER BY total DESC, o_custkey ROWS UNBOUNDED PRECEDING) / sum(total) OVER () AS cp FROM c)
SELECT count(*) FILTER (WHERE cp <= 80) + 1 AS items, count(*) AS of_items FROM x""")
def buyers_for_80_pct(spark, sf):
    return series.items_to_reach(_buyers(spark, sf), "total", ["o_custkey"], 80.0)


@query("W12", sql=f"""WITH {v.TRIPS}, c AS (SELECT start_station_id AS stop, end_station_id AS route, count(*) AS n FROM trips GROUP BY ALL)
SELECT stop, route, n FROM c QUALIFY row_number() OVER (PARTITION BY stop ORDER BY n DESC, route) = 1""")
def primary_route(spark, sf):
    c = v.trips(spark, sf).groupBy(F.col("start_station_id").alias("stop"), F.col("end_station_id").alias("route")).agg(
        F.count(F.lit(1)).alias("n"))
    return series.best_per_group(c, ["stop"], "n", ["route"], ["route", "n"])


@query("W12", sql=f"""WITH {v.TRIPS}, c AS (SELECT age_at_trip AS age, hour(started_at) AS hour, count(*) AS n FROM trips GROUP BY ALL)
SELECT age::BIGINT AS age, hour AS peak_hour, n FROM c QUALIFY row_number() OVER (PARTITION BY age ORDER BY n DESC, hour) = 1""")
def peak_hour_by_age(spark, sf):
    c = v.trips(spark, sf).groupBy(F.col("age_at_trip").alias("age"), F.hour("started_at").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"))
    return series.best_per_group(c, ["age"], "n", ["hour"], ["hour", "n"]).withColumnRenamed("hour", "peak_hour")


@query("W13", sql=f"""WITH {v.DAILY}, h AS (SELECT date, year(date) AS y, CASE WHEN day(date) % 6 = 1 THEN CAST(day(date) AS VARCHAR) END AS head FROM daily)
SELECT strftime(date, '%Y-%m-%d') AS date, COALESCE(last_value(head IGNORE NULLS) OVER (PARTITION BY y ORDER BY date ROWS UNBOUNDED PRECEDING), '') AS head FROM h""")
def forward_filled(spark, sf):
    d = v.order_trips(spark, sf).select(F.to_date("started_at").alias("date")).distinct()
    d = d.withColumns({"y": F.year("date"), "head": F.when(F.dayofmonth("date") % 6 == 1, F.dayofmonth("date").cast("string"))})
    return series.forward_fill(d, "head", ["date"], ["y"]).select("date", F.coalesce("head", F.lit("")).alias("head"))


_GAP = """SELECT year, round((d1 + d5) / 2, 6) AS mon_fri_avg, round((d2 + d3 + d4) / 3, 6) AS tue_thu_avg,
  round((d2 + d3 + d4) / 3 - (d1 + d5) / 2, 6) AS gap FROM g"""
_GAP_CTE = """g AS (SELECT year, avg(rel) FILTER (WHERE dow = 1) AS d1, avg(rel) FILTER (WHERE dow = 2) AS d2, avg(rel) FILTER (WHERE dow = 3) AS d3,
  avg(rel) FILTER (WHERE dow = 4) AS d4, avg(rel) FILTER (WHERE dow = 5) AS d5 FROM rel GROUP BY 1)"""


@query("W14", "P17", sql=f"""WITH {v.DAILY}, rel AS (SELECT year(date) AS year, dayofweek(date) AS dow,
    100.0::DOUBLE * trips / avg(trips) OVER (PARTITION BY isoyear(date), week(date)) AS rel FROM daily WHERE dayofweek(date) BETWEEN 1 AND 5), {_GAP_CTE} {_GAP}""")
def midweek_gap(spark, sf):
    """Mid-week level less Monday/Friday level, by year."""
    d = v.daily_orders(spark, sf).withColumns({
        "dow": dates.dow(F.col("date")), "wk": dates.iso_week_key(F.col("date")), "year": F.year("date")})
    out = series.weekday_gap(d, "trips", "wk", "dow", ["year"])
    return out.withColumns({c: r(c) for c in ("mon_fri_avg", "tue_thu_avg", "gap")})


@query("A43", sql=f"""WITH {_MONTHLY}, b AS (SELECT *, max(CASE WHEN year = 1997 THEN trips END) OVER (PARTITION BY month, kind) AS base FROM monthly)
SELECT year, month, kind, trips, COALESCE(round(100.0::DOUBLE * trips / base, 6), -1) AS pct_of_base FROM b""")
def recovery_vs_base_year(spark, sf):
    m = _monthly(spark, sf)
    out = series.versus_base_year(m, "trips", "year", 1997, ["month", "kind"])
    return out.withColumn("pct_of_base", F.coalesce(r("pct_of_base"), F.lit(-1.0)))
