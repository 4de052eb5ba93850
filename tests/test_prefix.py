from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pedalmill.functions import dates
from pedalmill.operators import prefix, quality, series


@pytest.mark.parametrize("kind", ["long", "double"])
def test_running_sum_equals_a_serial_sum(spark, kind):
    rng = random.Random(2)
    rows = [(i, None if i % 50 == 0 else 7 if i % 3 else rng.randrange(1000)) for i in range(3000)]  # one value holds two thirds
    df = spark.createDataFrame(rows, "id long, v long").withColumn("v", F.col("v").cast(kind)).repartition(7)
    got = {r.id: r.total for r in prefix.running_sum(df, "v", [F.desc("v"), "id"], "total").collect()}
    total, want = 0, {}
    for i, v in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])):
        total += v or 0
        want[i] = total
    assert got == want
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = prefix.running_sum(df, "v", [F.desc("v"), "id"]).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in tasks) < 1500


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id long, v long, date date")
    assert prefix.running_sum(none, "v", ["id"]).isEmpty() and series.running_share(none, "v", ["id"]).isEmpty()
    assert series.share(none, "v").isEmpty() and dates.days_since_first(none).isEmpty()


def test_no_window_without_keys(spark):
    df = spark.createDataFrame([(1, 30), (2, 70)], "id long, v long")
    for out in (series.running_share(df, "v", ["id"]), series.share(df, "v")):
        assert "SinglePartition" not in out._jdf.queryExecution().optimizedPlan().toString() and "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.id: r.cumulative_pct for r in series.running_share(df, "v", ["id"]).collect()} == {2: 70.0, 1: 100.0}


def test_timeline_counts_each_month_once_over_both_ends(spark):
    rows = [("2024-01-05", 1, 2), ("2024-01-09", 1, 1), ("2024-03-01", 2, 1), ("2025-01-01", 1, None), (None, 3, 3)]
    t = spark.createDataFrame(rows, "d string, start_station_id int, end_station_id int").select(
        F.to_timestamp("d").alias("started_at"), "*", F.lit("a").alias("start_station_name"), F.lit(None).cast("string").alias("end_station_name"))
    got = {r.station_id: (r.months_active, r.trip_ends, str(r.first_seen)[:7], str(r.last_seen)[:7], r.station_name) for r in quality.trip_timeline(t).collect()}
    assert got == {1: (3, 5, "2024-01", "2025-01", "a"), 2: (2, 2, "2024-01", "2024-03", "a"), 3: (0, 2, "None", "None", "a")}
    assert "Generate" not in quality.trip_timeline(t)._jdf.queryExecution().optimizedPlan().toString()
