"""Operators against brute force and closed forms on small fixtures."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pedalmill.operators import (cohorts, enrich, flows, identity, layers, quality, quantiles, reconcile, regression,
                                 reshape, series, spatial, transit)
from pedalmill.session import fits_broadcast, heavy_hashes, lookup_join, split_join


def hav(a, b, c, d):
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


# --- joins and quantiles -----------------------------------------------------------

def test_lookup_join_gives_the_same_rows_on_both_paths(spark):
    facts = spark.createDataFrame([(i, None if i % 10 == 9 else 1 if i % 3 else i, f"x{i}") for i in range(300)], "id long, k long, v string")
    dim = spark.createDataFrame([(k, f"d{k}") for k in range(0, 200)], "k long, name string")
    assert heavy_hashes(facts, ["k"], 0.1) == [spark.range(1).select(F.xxhash64(F.lit(1).cast("long"))).first()[0]]
    for how in ("left", "inner", "left_semi", "left_anti"):
        small = lookup_join(facts, dim, "k", how)
        split = split_join(facts, dim, ["k"], how, share=0.1)
        assert small.columns == split.columns
        assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, split.collect()), key=str)
        assert split.count() == lookup_join(facts, dim, "k", how, max_bytes=0, max_rows=3).count()


def test_split_join_scans_facts_once_and_spreads_a_hot_key(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"), (F.col("id") % 5).alias("v")).write.parquet(path)
    facts, dim = spark.read.parquet(path), spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {c: spark.conf.get(c) for c in off}
    for c, value in off.items():
        spark.conf.set(c, value)
    try:
        joined = split_join(facts, dim, ["k"], "left")
        assert joined._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
        rows = joined.withColumn("p", F.spark_partition_id()).filter("k = 7").groupBy("p").count().collect()
        assert joined.filter("k = 7 AND w = 14").count() == joined.filter("k = 7").count() == 10_001 and joined.count() == 30_000
        assert len(rows) > 1
    finally:
        for c, value in old.items():
            spark.conf.set(c, value)


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    wide = spark.range(50).select("id", F.repeat(F.lit("x"), 100_000).alias("t")).join(spark.range(50), "id")
    assert fits_broadcast(wide, max_bytes=10_000_000) and not fits_broadcast(wide, max_bytes=100_000) and not fits_broadcast(wide, 100, 49)


@pytest.mark.parametrize("fanout", [3, 4096])
def test_exact_quantiles_match_numpy(spark, fanout):
    rng = random.Random(1)
    rows = [("hot", rng.gauss(0, 1e-3) + (1e6 if rng.random() < 0.01 else 0)) for _ in range(3000)]
    rows += [("dup", float(rng.randint(0, 3))) for _ in range(200)] + [("one", 7.0), (None, 1.0), (None, 2.0), ("hot", None)]
    df = spark.createDataFrame(rows, "k string, x double").withColumn("y", -F.col("x"))
    got = {r.k: r for r in quantiles.exact_quantiles(
        df, ["k"], {"m": ("x", 0.5), "p": ("x", 0.95), "lo": ("y", 0.05)}, fanout=fanout).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "x"]).dropna(subset=["x"])
    for k, g in pdf.groupby("k", dropna=False):
        k = None if isinstance(k, float) else k
        assert got[k].m == pytest.approx(np.quantile(g.x, 0.5), rel=1e-12, abs=1e-15)
        assert got[k].p == pytest.approx(np.quantile(g.x, 0.95), rel=1e-12, abs=1e-15)
        assert got[k].lo == pytest.approx(np.quantile(-g.x, 0.05), rel=1e-12, abs=1e-15)
    weighted = df.groupBy("k", "x").agg(F.count("*").alias("n"))
    again = {r.k: r.m for r in quantiles.exact_quantiles(weighted, ["k"], {"m": ("x", 0.5)}, weight="n").collect()}
    assert again == {k: r.m for k, r in got.items()}


def test_modes_break_ties_by_value(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", None), ("b", "z"), ("b", "z"), ("b", "a")], "k string, v string")
    assert sorted(map(tuple, quantiles.modes(df, ["k"], "v").collect())) == [("a", "x", 1), ("b", "z", 2)]


# --- spatial ------------------------------------------------------------------------

def points(rng, n, copies=0):
    pts = [(40.6 + rng.random() * 0.3, -74.1 + rng.random() * 0.3) for _ in range(n)]
    return pts + [pts[0]] * copies


def test_radius_pairs_equal_brute_force(spark):
    rng = random.Random(2)
    a, b = points(rng, 60, 5), points(rng, 200, 20)
    da = spark.createDataFrame([(i, *p) for i, p in enumerate(a)], "id long, lat double, lon double")
    db = spark.createDataFrame([(i, *p) for i, p in enumerate(b)], "id long, lat double, lon double")
    got = {(r.a_id, r.b_id) for r in spatial.pairs_within(da, db, 2500.0).collect()}
    want = {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if hav(*p, *q) <= 2500.0}
    assert got == want and want
    near = {(r.lat, r.lon): (r.nearby, r.closest_m) for r in spatial.neighbours(da, db, 2500.0).collect()}
    for i, p in enumerate(a):
        d = [hav(*p, *q) for q in b if hav(*p, *q) <= 2500.0]
        assert (near[p][0] == len(d) and near[p][1] == pytest.approx(min(d), abs=1e-6)) if d else p not in near


@pytest.mark.parametrize("lat0", [40.0, -70.0, 88.0])
@pytest.mark.parametrize("k", [1, 3])
def test_nearest_k_equals_brute_force(spark, lat0, k):
    rng = random.Random(3)
    b = [(lat0 + rng.random() * 1e-4, 20 + rng.random() * 1e-4) for _ in range(60)]
    b += [(lat0 + rng.random() * 1.5, 20 + rng.random() * 5) for _ in range(40)] + [b[0]] * 6 + [(lat0 - 30, -100.0)]
    a = [(lat0 + rng.random() * 1.5, 20 + rng.random() * 5) for _ in range(25)] + [b[0], (lat0 - 20, 150.0), b[0]]
    da = spark.createDataFrame(a, "lat double, lon double")
    db = spark.createDataFrame([(i, *p) for i, p in enumerate(b)], "id long, lat double, lon double")
    got = {}
    for r in spatial.nearest_k(da, db, k, "id").collect():
        got.setdefault((r.lat, r.lon), []).append((r["rank"], r.distance))
    for p in set(a):
        want = sorted(hav(*p, *q) for q in b)[:k]
        assert [d for _, d in sorted(got[p])] == pytest.approx(want, abs=1e-6)


def test_nearest_k_within_degrees(spark):
    rng = random.Random(4)
    b = [(40 + rng.random() * 0.01, -74 + rng.random() * 0.01) for _ in range(150)]
    a = [(40 + rng.random() * 0.02, -74 + rng.random() * 0.02) for _ in range(40)]
    radius = 150 / 85000
    db = spark.createDataFrame([(f"s{i:03d}", *p) for i, p in enumerate(b)], "id string, lat double, lon double")
    got = {(r.lat, r.lon, r.b_id) for r in spatial.nearest_k(
        spark.createDataFrame(a, "lat double, lon double"), db, 5, "id", max_deg=radius, metric="degrees").collect()}
    want = set()
    for p in a:
        near = sorted((math.sqrt((q[0] - p[0]) ** 2 + (q[1] - p[1]) ** 2), f"s{i:03d}") for i, q in enumerate(b))[:5]
        want |= {(*p, s) for d, s in near if d < radius}
    assert got == want and want


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


def polygons(spark, rows):
    data = [("l", code, code, [[{"lon": float(x), "lat": float(y)} for x, y in ring] for ring in rings]) for code, rings in rows]
    return spark.createDataFrame(data, "layer string, code string, name string, rings array<array<struct<lon double, lat double>>>")


def test_points_in_polygons(spark):
    poly = polygons(spark, [("a", [square(0, 0, 1), square(0.4, 0.4, 0.2)]), ("b", [square(1, 0, 1) + [(1, 0)]]),
                            ("tri", [[(5, 5), (7, 5), (6, 7)]])])
    pts = {(0.1, 0.1): "a", (0.5, 0.5): None, (0.3, 0.5): "a", (0.5, 1.5): "b", (0.0, 0.5): None, (0.5, 1.0): None, (1.0, 0.5): None,
           (5.5, 6.0): "tri", (6.9, 6.5): None, (5.0, 6.0): None, (3.0, 3.0): None}
    df = spark.createDataFrame([*pts] + [(0.1, 0.1)], "lat double, lon double")
    got = spatial.points_in_polygons(df, poly).collect()
    assert len(got) == len(pts) + 1
    assert {(r.lat, r.lon): r.code for r in got} == pts


def test_area_density_and_layer_checks(spark):
    poly = polygons(spark, [("a", [square(0, 0, 1), square(0.4, 0.4, 0.2)]), ("empty", [square(10, 10, 2)])])
    st = spark.createDataFrame([(0.1, 0.1), (0.1, 0.1), (0.5, 0.5)], "lat double, lon double")
    got = {r.code: r for r in spatial.station_density(st, poly, sq_km_per_deg2=100.0).collect()}
    assert (got["a"].station_count, got["empty"].station_count) == (2, 0)
    assert got["a"].area_sq_km == pytest.approx(96.0) and got["empty"].area_sq_km == pytest.approx(400.0)
    check = layers.layer_checks(poly, (0, 20, 0, 20), {"l": (3, 4)}, sliver=1.0).first()
    assert (check.geometry_check, check.bounds_check, check.count_check, check.sliver_check) == ("PASS", "PASS", "WARN", "WARN")
    assert layers.layer_checks(poly, (50, 60, 0, 20)).first().bounds_check == "FAIL"


def test_area_transfer_keeps_totals(spark):
    xw = spark.createDataFrame([("BK19", "BK1303", 78.9), ("BK19", "BK1301", 21.1), ("M1", "M2", 100.0)], "old string, new string, pct double")
    vals = spark.createDataFrame([("BK19", 1000), ("M1", 5)], "old string, trips long")
    got = {r.new: r.trips for r in spatial.transfer(vals, xw, "old", "new", "trips", "pct").collect()}
    assert got == pytest.approx({"BK1303": 789.0, "BK1301": 211.0, "M2": 5.0})
    assert {r.old: r.new for r in spatial.dominant_area(xw, "old", "new", "pct").collect()} == {"BK19": "BK1303", "M1": "M2"}


# --- identity -----------------------------------------------------------------------

def test_match_tiers(spark):
    cases = [(0.0, 5, "high"), (19.9, 0, "high"), (30.0, 49, None), (30.0, 50, "medium"), (30.0, 70, "high"), (100.0, 59, None),
             (100.0, 60, "low"), (100.0, 80, "medium"), (150.0, 100, None)]
    df = spark.createDataFrame([(float(d), float(n), t) for d, n, t in cases], "d double, n double, t string")
    for r in df.withColumn("got", identity.match_confidence(F.col("d"), F.col("n"))).collect():
        assert r.got == r.t, r


def test_best_candidate_is_chosen_before_the_tiers(spark):
    # The farther candidate has the better score, and fails nothing; the nearer one would be "high".
    legacy = spark.createDataFrame([("1", "Main St & Broadway", 40.7, -74.0, 10), ("9", "Nowhere", 41.5, -74.0, 10)],
                                   "legacy_id string, legacy_name string, legacy_lat double, legacy_lon double, trip_count long")
    modern = spark.createDataFrame([("near", "Zzz", 40.7001, -74.0), ("far", "Broadway & Main St", 40.7009, -74.0)],
                                   "station_id string, name string, lat double, lon double")
    rows = {r.legacy_id: r for r in identity.build_crosswalk(legacy, modern).collect()}
    assert rows["1"].modern_id == "far" and rows["1"].match_confidence == "medium"
    assert rows["9"].modern_id == "" and rows["9"].match_confidence == "none" and rows["9"].match_score == 0.0
    s = identity.crosswalk_summary(identity.build_crosswalk(legacy, modern)).first()
    assert (s.legacy_stations, s.matched, s.ghosts, s.match_rate) == (2, 1, 1, 50.0)


def test_only_five_nearest_are_scored(spark):
    legacy = spark.createDataFrame([("1", "Target", 40.7, -74.0, 10)],
                                   "legacy_id string, legacy_name string, legacy_lat double, legacy_lon double, trip_count long")
    modern = spark.createDataFrame([(f"s{i}", "other", 40.7 + i * 0.0001, -74.0) for i in range(1, 6)] + [("s6", "Target", 40.7006, -74.0)],
                                   "station_id string, name string, lat double, lon double")
    got = identity.crosswalk_candidates(legacy, modern).collect()
    assert {r.modern_id for r in got} == {"s1", "s2", "s3", "s4", "s5"}


def test_overrides_with_a_null_id_drop_nothing(spark):
    cols = "legacy_id string, modern_id string"
    cw = spark.createDataFrame([("1", "a"), ("2", "b")], cols)
    o = spark.createDataFrame([("2", "z"), (None, "n")], cols)
    assert sorted(map(tuple, identity.apply_overrides(cw, o).collect()), key=str) == [("1", "a"), ("2", "z"), (None, "n")]


# --- flows and quality ----------------------------------------------------------------

def trips(spark, rows):
    return spark.createDataFrame(rows, "start_station_id string, end_station_id string")


def test_net_flow_keeps_arrival_only_stations(spark):
    got = {r.station_id: (r.depart_count, r.arrive_count, r.net_flow) for r in
           flows.net_flow(trips(spark, [("a", "b"), ("a", "b"), ("b", "a"), ("a", None)])).collect()}
    assert got == {"a": (3, 1, -2), "b": (1, 2, 1)}


def test_corridors_need_both_directions(spark):
    got = flows.corridors(trips(spark, [("a", "b")] * 3 + [("b", "a")] + [("a", "c")] * 5 + [("d", "d")])).collect()
    assert [(r.station_a, r.station_b, r.a_to_b, r.b_to_a, r.total, r.imbalance_pct) for r in got] == [("a", "b", 3, 1, 4, 50.0)]


def test_route_sets_in_both_forms(spark):
    a, b = [("x", "y"), ("y", "z")], [("y", "z"), ("q", "r")]
    cols = "start_station_id string, end_station_id string"
    want = {("x", "y", "am_only"), ("y", "z", "both"), ("q", "r", "pm_only")}
    got = flows.compare_sets(spark.createDataFrame(a, cols), spark.createDataFrame(b, cols), flows.ROUTE, "am", "pm")
    assert set(map(tuple, got.collect())) == want
    stacked = spark.createDataFrame([(*r, "am") for r in a] + [(*r, "pm") for r in b], cols + ", side string")
    assert set(map(tuple, flows.compare_sides(stacked, flows.ROUTE, "side", "am", "pm").collect())) == want


def test_accounting_adds_up(spark):
    t = datetime(2024, 1, 5)
    rows = [(t, t, "1", "2", d) for d in (89, 90, 14400, 14401, -5, None)] + [(None, t, "1", "2", 100), (t, t, "", "2", 100),
            (t, t, "1", None, 10), (datetime(2024, 2, 1), t, "1", "2", 100)]
    df = spark.createDataFrame([(*r, "f", (2024, 1)) for r in rows],
                               "started_at timestamp, ended_at timestamp, start_station_id_raw string, end_station_id_raw string, "
                               "duration_sec int, source_file string, expected struct<year int, month int>")
    a = quality.filter_accounting(df, quality.quality_reasons(month_check=True), ["source_file"]).first().asDict()
    assert a["rows_in"] == 10 and a["rows_out"] == 2
    assert a["rows_in"] == a["rows_out"] + sum(n for c, n in a.items() if c.startswith("first_"))
    assert (a["missing_station"], a["wrong_month"], a["duration_too_short"], a["first_duration_too_short"]) == (2, 1, 3, 1)


# --- series ----------------------------------------------------------------------------

def test_rolling_means_need_full_windows(spark):
    df = spark.createDataFrame([(i, float(i * i)) for i in range(40)], "d int, x double")
    got = [r.rolling for r in series.centred_mean(df, "x", ["d"], 30).orderBy("d").collect()]
    want = pd.Series([float(i * i) for i in range(40)]).rolling(30, center=True).mean()
    assert [None if math.isnan(w) else pytest.approx(w) for w in want] == got
    got = [r.rolling for r in series.trailing_mean(df, "x", ["d"], 12).orderBy("d").collect()]
    want = pd.Series([float(i * i) for i in range(40)]).rolling(12).mean()
    assert [None if math.isnan(w) else pytest.approx(w) for w in want] == got


def test_year_lag_follows_the_calendar(spark):
    df = spark.createDataFrame([(2010, 1.0), (2011, 2.0), (2013, 8.0)], "y int, x double")
    got = {r.y: r.lagged for r in series.value_years_before(df, "x", "y", 2).collect()}
    assert got == {2010: None, 2011: None, 2013: 2.0}


def test_full_grid_and_missing_dates(spark):
    df = spark.createDataFrame([("a", 1, 5)], "g string, h int, n int")
    assert sorted(map(tuple, series.full_grid(df, {"h": range(3)}, ["n"], ["g"]).collect())) == [("a", 0, 0), ("a", 1, 5), ("a", 2, 0)]
    d = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 4),)], "d date")
    assert sorted(r.d.day for r in series.missing_dates(d, "d").collect()) == [2, 3]


def test_items_to_reach_threshold(spark):
    df = spark.createDataFrame([("a", 50), ("b", 30), ("c", 15), ("d", 5)], "s string, n int")
    assert series.items_to_reach(df, "n", ["s"], 80.0).first().items == 3


# --- regression ---------------------------------------------------------------------------

def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3)) * [1, 100, 0.01]
    y = 3 + x @ [2.0, -0.5, 40.0] + rng.normal(size=400)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y})).repartition(5)
    fit = regression.ols(df, ["a", "b", "c"], "y")
    X = np.column_stack([np.ones(400), x])
    beta, sse = np.linalg.lstsq(X, y, rcond=None)[:2]
    s2 = sse[0] / 396
    se = np.sqrt(np.diag(np.linalg.inv(X.T @ X)) * s2)
    assert fit.coef == pytest.approx(beta, rel=1e-8) and fit.stderr == pytest.approx(se, rel=1e-7)
    assert fit.r2 == pytest.approx(1 - sse[0] / ((y - y.mean()) ** 2).sum()) and fit.n == 400 and fit.rank == 4
    sub = regression.nested(df, {"all": ["a", "b", "c"], "one": ["a"]}, "y")
    assert sub["one"].params()["a"] == pytest.approx(np.polyfit(x[:, 0], y, 1)[0])
    parab = regression.polyfit2(df, "a", "y")
    assert parab.coef[::-1] == pytest.approx(np.polyfit(x[:, 0], y, 2), rel=1e-7)


def test_collinear_design_has_the_pseudo_inverse_solution(spark):
    rows = [(float(s), float(u), float(s + u), 10.0 + 4 * s + 6 * u + (i % 2)) for i, (s, u) in enumerate([(1, 0), (0, 1), (0, 0), (0, 0)] * 20)]
    df = spark.createDataFrame(rows, "sat double, sun double, weekend double, y double")
    fit = regression.ols(df, ["sat", "sun", "weekend"], "y")
    assert fit.rank == 3
    X = np.array([[1, r[0], r[1], r[2]] for r in rows])
    y = np.array([r[3] for r in rows])
    assert X @ fit.coef == pytest.approx(X @ np.linalg.pinv(X) @ y)


def test_models_per_group_and_nulls(spark):
    rows = [("a", float(i), 2.0 * i + 1) for i in range(20)] + [("b", float(i), -1.0 * i) for i in range(20)] + [("a", None, 5.0), ("c", 1.0, 1.0)]
    got = {(r.g, r.term): r for r in regression.ols_by(spark.createDataFrame(rows, "g string, x double, y double"), ["x"], "y", ["g"], 10).collect()}
    assert got[("a", "x")].coef == pytest.approx(2.0) and got[("b", "x")].coef == pytest.approx(-1.0) and got[("a", "x")].n == 20
    assert ("c", "x") not in got


def test_p_values():
    # Textbook critical values.
    for t, df, p in ((2.228, 10, 0.05), (2.576, 10_000, 0.01), (63.657, 1, 0.01)):
        assert regression.t_two_sided(t, df) == pytest.approx(p, rel=2e-3)


# --- enrichment, cohorts, reconciliation -----------------------------------------------------

def test_trip_weighted_means_survive_the_hourly_aggregate(spark):
    rows = [(datetime(2024, 1, 1, h) + timedelta(seconds=i), "member", "classic_bike") for h, n in ((0, 3), (1, 1), (2, 2)) for i in range(n)]
    t = spark.createDataFrame(rows, "started_at timestamp, member_casual string, rideable_type string")
    w = spark.createDataFrame([(datetime(2024, 1, 1, 0), 10.0, 1.0), (datetime(2024, 1, 1, 1), 20.0, 0.0)],
                              "datetime timestamp, temperature_2m double, precipitation double")
    d = enrich.daily_weather(enrich.with_weather(enrich.hourly_counts(t), w)).first()
    assert d.trips == 6 and d.temp_c == pytest.approx((3 * 10 + 20) / 4) and d.hourly_temp_c == pytest.approx(15.0)
    assert (d.trip_weighted_precip_mm, d.hourly_precip_mm, d.trip_weighted_rainy_hours, d.hourly_rainy_hours) == (3.0, 1.0, 3, 1)


def test_difference_in_differences(spark):
    rows = [("t", "b")] * 100 + [("t", "a")] * 150 + [("c", "b")] * 50 + [("c", "a")] * 55
    df = spark.createDataFrame(rows, "g string, p string")
    r = cohorts.did(df, F.col("g") == "t", F.col("g") == "c", F.col("p") == "b", F.col("p") == "a").first()
    assert (r.treated_change_pct, r.control_change_pct, r.did_pp) == pytest.approx((50.0, 10.0, 40.0))


def test_reconcile_flags_large_differences(spark):
    a = spark.createDataFrame([("x", 100), ("x", 5), ("y", 50)], "op string, n int")
    c = spark.createDataFrame([("x", 100), ("y", 80), ("gone", 10), ("zero", 0)], "op string, total int")
    got = {r.op: (r.actual, r.status) for r in reconcile.reconcile(a, c, "op", "n", "total").collect()}
    assert got == {"x": (105, "passed"), "y": (50, "warning"), "gone": (0, "warning")}


# --- sheets, names, schedules -------------------------------------------------------------------

def cells(spark, sheet, grid):
    return spark.createDataFrame([("f", sheet, i, j, str(v)) for i, row in enumerate(grid) for j, v in enumerate(row) if v is not None],
                                 "file string, sheet string, row int, col int, value string")


def test_sheets_of_both_layouts(spark):
    modern = [[None, None, "Pier 11", None, "Weekday", "Total"], ["Day", "Date", "Hoboken", "Edgewater", None, "Total"],
              ["(MLK Day) Monday", "2024-01-15 00:00:00", "1,200", None, "9", "1200"], ["Tuesday", "2024-01-16", "n/a", "7", None, "7"],
              ["Weekday Total", "2024-01-31", "5", "5", None, "5"], [None, None, "5"]]
    legacy = [[None, None, "Pier 79", None, "WFC"], [None], ["Day", "Date", "Paulus Hook", "Lincoln Harbor", "Hoboken"], [None], [None],
              ["Friday", "1/4/2013", "10", "20.9", "30"]]
    df = cells(spark, "m", modern).unionByName(cells(spark, "l", legacy))
    got = {(r.sheet, str(r.date), r.day_of_week, r.holiday, r.destination, r.origin, r.ridership)
           for r in reshape.sheet_records(df).collect()}
    assert got == {
        ("m", "2024-01-15", "Monday", "MLK Day", "Pier 11", "Hoboken", 1200),
        ("m", "2024-01-15", "Monday", "MLK Day", "Pier 11", "Edgewater", 0),
        ("m", "2024-01-16", "Tuesday", None, "Pier 11", "Hoboken", 0),
        ("m", "2024-01-16", "Tuesday", None, "Pier 11", "Edgewater", 7),
        ("l", "2013-01-04", "Friday", None, "Pier 79", "Paulus Hook", 10),
        ("l", "2013-01-04", "Friday", None, "Pier 79", "Lincoln Harbor", 20),
        ("l", "2013-01-04", "Friday", None, "WFC", "Hoboken", 30)}


def test_loose_names(spark):
    names = spark.createDataFrame([("East 34th Street",), ("Wall St/Pier 11",), ("DUMBO",), ("Red Hook",)], "name string")
    known = spark.createDataFrame([("Wall St",), ("East 34th Street Ferry",), ("Hook and Ladder",), ("Astoria",)], "known string")
    got = {r.name: r.match for r in reshape.match_names(names, known).collect()}
    assert got == {"East 34th Street": "East 34th Street Ferry", "Wall St/Pier 11": "Wall St", "DUMBO": None, "Red Hook": "Hook and Ladder"}


def test_wide_months(spark):
    df = spark.createDataFrame([(1, "A", 1.0, None, 3.0, 9.0)], "`RegionID` int, `RegionName` string, `2015-01-31` double, `2015-02-28` double, `2016-01-31` double, `2009-12-31` double")
    got = sorted((r.month, r.year, r.value) for r in reshape.unpivot_months(df, ["RegionID"], first_year=2010, last_year=2025).collect())
    assert got == [("2015-01-31", 2015, 1.0), ("2016-01-31", 2016, 3.0)]


def test_service_frequency_counts_late_hours_as_night(spark):
    stops = spark.createDataFrame([("S", "Main - Queens", 0.0, 0.0, "1", None), ("S1", "Main", 0.0, 0.0, "0", "S"), ("P", "Lone", 0.0, 0.0, None, None)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double, location_type string, parent_station string")
    routes = spark.createDataFrame([("r", "7", "Flushing", "1", "c", "t"), ("bus", "B1", "x", "3", "c", "t")],
                                   "route_id string, route_short_name string, route_long_name string, route_type string, route_color string, route_text_color string")
    t = spark.createDataFrame([("t1", "r", "wk"), ("t2", "bus", "wk")], "trip_id string, route_id string, service_id string")
    st = spark.createDataFrame([("t1", "S1", a) for a in ("7:00:00", "08:30:00", "25:00:00")] + [("t1", "P", "12:00:00"), ("t2", "S1", "8:00:00")],
                               "trip_id string, stop_id string, arrival_time string")
    cal = spark.createDataFrame([("wk", 1, 0, 0)], "service_id string, monday int, saturday int, sunday int")
    got = {(r.station_id, r.day_type, r.time_period): (r.trips_in_period, r.trains_per_hour) for r in transit.service_frequency(st, t, routes, stops, cal).collect()}
    assert got == {("S", "Weekday", "AM Peak"): (2, 0.7), ("S", "Weekday", "Night"): (1, 0.1), ("P", "Weekday", "Midday"): (1, 0.2)}
    assert {(r.station_id, r.borough) for r in transit.stations(stops).collect()} == {("S", "Queens"), ("P", None)}
    assert transit.service_frequency(st, t, routes, stops).count() == 3
