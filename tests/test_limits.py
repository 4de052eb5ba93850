"""Data beyond former limits: late years, many columns, large counts, NULL groups, collinear designs."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pedalmill.functions import geo, parse, text
from pedalmill.operators import flows, quantiles, regression, reshape, series, spatial


def test_scenarios_are_open_in_time(spark):
    t = spark.createDataFrame([(datetime(y, 6, 1, 12), 600, "casual", "electric_bike") for y in (1999, 2025, 2026, 2040)],
                              "started_at timestamp, duration_sec int, member_casual string, rideable_type string")
    count = lambda cfg: t.filter(flows.scenario_predicate(cfg)).count()
    assert count(flows.SCENARIOS["everything"]) == 4
    assert count(flows.SCENARIOS["ebikes_only"]) == 3
    assert count(flows.Scenario(years=(None, 2025))) == 2 and count(flows.Scenario(years=(2026, 2026))) == 1


def test_month_columns_of_any_year(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0)], "RegionID string, `1999-01-31` double, `2026-01-31` double, `2031-12-31` double")
    assert {r.year for r in reshape.unpivot_months(df, ["RegionID"]).collect()} == {1999, 2026, 2031}
    assert {r.year for r in reshape.unpivot_months(df, ["RegionID"], first_year=2000, last_year=2030).collect()} == {2026}


def test_header_far_down_and_right(spark):
    cells = [("f", "s", 20, 0, "Day"), ("f", "s", 20, 1, "Date"), ("f", "s", 20, 30, "Pier 1"), ("f", "s", 18, 29, "East"),
             ("f", "s", 21, 0, "Monday"), ("f", "s", 21, 1, "2031-01-06"), ("f", "s", 21, 30, "3,000,000,000"), ("f", "s", 3, 2, "Title"),
             ("f", "none", 0, 0, "nothing"), ("f", "none", 1, 1, "2031-01-06")]
    df = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string")
    got = reshape.sheet_records(df).collect()
    assert [(r.sheet, str(r.date), r.destination, r.origin, r.ridership) for r in got] == [("s", "2031-01-06", "East", "Pier 1", 3_000_000_000)]
    assert [r.sheet for r in reshape.sheets_without_header(df).collect()] == ["none"]


def test_late_stamps_and_long_durations(spark):
    df = spark.createDataFrame([("203101-trips.csv", "0014-01-01 00:00:00", "2014-01-01 00:00:00"), ("x_204512.csv", "2014-01-01 00:00:00", "2014-01-01 00:01:00")],
                               "n string, a string, b string")
    got = df.select(parse.expected_year_month(F.col("n")).alias("e"),
                    parse.duration_seconds(parse.parse_timestamp(F.col("a")), parse.parse_timestamp(F.col("b"))).alias("d")).collect()
    assert [(tuple(r.e), r.d) for r in got] == [((2031, 1), None), ((2045, 12), 60)]


def test_large_counts(spark):
    df = spark.createDataFrame([("3,000,000,000",), ("7.9",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(text.clean_count(F.col("c"))).collect()] == [3_000_000_000, 7, 0, 0]


def test_null_groups_keep_their_counts(spark):
    df = spark.createDataFrame([(None, 3, 5), ("e", 4, 2)], "bike string, hour int, trips int")
    got = {(r.bike, r.hour): r.trips for r in series.full_grid(df, {"hour": range(24)}, ["trips"], ["bike"]).collect()}
    assert len(got) == 48 and got[(None, 3)] == 5 and got[("e", 4)] == 2 and sum(got.values()) == 7


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_collinear_coefficients_and_errors_equal_the_pseudo_inverse(spark, offset):
    rng = np.random.default_rng(4)
    n = 700
    dow = np.arange(n) % 7
    temp = rng.normal(60, 15, n)
    cols = {"is_weekend": (dow >= 5).astype(float), **{f"dow_{d}": (dow == d).astype(float) for d in range(7) if d != 2}, "temp": temp, "temp_sq": temp ** 2}
    y = offset + 30 + 0.4 * temp - 5 * cols["is_weekend"] + rng.normal(size=n)
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values(), y)], ", ".join(f"{c} double" for c in [*cols, "y"]))
    fit = regression.ols(df, list(cols), "y")
    x = np.column_stack([np.ones(n), *cols.values()])
    inverse = np.linalg.pinv(x)
    coef = inverse @ y
    sse = float(((y - x @ coef) ** 2).sum())
    errors = np.sqrt(np.diag(inverse @ inverse.T) * sse / (n - np.linalg.matrix_rank(x)))
    assert fit.rank == np.linalg.matrix_rank(x) == len(cols)
    assert fit.coef == pytest.approx(coef, rel=1e-5, abs=1e-6 * (1 + offset * 1e-3))
    assert fit.stderr == pytest.approx(errors, rel=2e-3 if offset else 1e-6)


def test_neighbours_across_the_antimeridian(spark):
    rng = np.random.default_rng(7)
    pts = [(float(la), float(lo)) for la, lo in zip(rng.uniform(-89.9, 89.9, 60), rng.choice([-1, 1], 60) * (180 - rng.exponential(0.5, 60)))]
    pts += [(10.0, 179.9999), (10.0, -179.9999), (0.0, 180.0), (0.0, -180.0), (0.0, 0.0)]
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id int, lat double, lon double")
    b = spark.createDataFrame([(i, la + 0.0001, lo) for i, (la, lo) in enumerate(pts)], "id int, lat double, lon double")

    def far(p, q):
        (la, lo), (lb, lp) = p, q
        h = np.sin(np.radians(lb - la) / 2) ** 2 + np.cos(np.radians(la)) * np.cos(np.radians(lb)) * np.sin(np.radians(lp - lo) / 2) ** 2
        return 2 * geo.EARTH_RADIUS_M * np.arcsin(np.sqrt(h))

    others = [(la + 0.0001, lo) for la, lo in pts]
    got = {(r.lat, r.lon): r.nearby for r in spatial.neighbours(a, b, 200_000.0).collect()}
    assert got == {p: n for p in pts if (n := sum(far(p, q) <= 200_000 for q in others))}
    near = {}
    for r in spatial.nearest_k(a, b, 3, "id").collect():
        near.setdefault((r.lat, r.lon), []).append((r["rank"], r.distance))
    for p in pts:
        assert [d for _, d in sorted(near[p])] == pytest.approx(sorted(far(p, q) for q in others)[:3], rel=1e-6, abs=1e-3)


def test_quantiles_with_a_far_outlier(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(5, 2, 4000), [1e12, -1e9, 0.0, 1e-300], rng.normal(2.0 ** 20, 1, 500)])
    df = spark.createDataFrame([("a", float(x)) for x in values] + [("b", 7.0)], "k string, x double")
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], {f"q{p}": ("x", p / 100) for p in (0, 3, 50, 90, 99, 100)}).collect()}
    for p in (0, 3, 50, 90, 99, 100):
        assert got["a"][f"q{p}"] == pytest.approx(np.quantile(values, p / 100), rel=1e-12) and got["b"][f"q{p}"] == 7.0
    scaled = sorted((r.x, r.e) for r in df.filter("k = 'a'").withColumn("e", quantiles.even_scale(F.col("x"))).collect())
    assert [e for _, e in scaled] == sorted(e for _, e in scaled)
    # the narrow values spread over many buckets of the first level, whatever the outlier
    low, high = scaled[0][1], scaled[-1][1]
    buckets = {int((e - low) / (high - low) * quantiles.FANOUT) for x, e in scaled if 1 < x < 9}
    assert len(buckets) > 3


def test_year_effects_are_nan_where_every_day_has_the_same_size(spark, tmp_path):
    import os

    import duckdb

    from pedalmill.catalog import ORACLES, QUERIES
    from tests.oracle_compare import TABLES, compare, connect
    given = "/root/testdata/sf0.001"
    if not os.path.isdir(given):
        pytest.skip("no test tables")
    for t in TABLES:
        if t != "orders":
            os.symlink(f"{given}/{t}.parquet", tmp_path / f"{t}.parquet")
    # three years, every one of the 25 stations in use on every day, one order more on some days
    duckdb.execute(f"""COPY (SELECT (d * 60 + k)::BIGINT AS o_orderkey, k::BIGINT AS o_custkey, CASE WHEN hash(d * 60 + k) % 3 = 0 THEN 'F' ELSE 'O' END AS o_orderstatus,
        100.0::DOUBLE AS o_totalprice, TIMESTAMP '1994-01-01' + to_days((d * 20)::INTEGER) AS o_orderdate, 'x' AS o_orderpriority
        FROM range(54) t(d), range(30) u(k) WHERE k < 25 OR d % 7 > k - 25) TO '{tmp_path}/orders.parquet'""")
    name = "nested_year_effects"
    assert compare(spark, connect(str(tmp_path)), name, QUERIES[name], ORACLES[name], str(tmp_path)) == []
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    assert rows and all(np.isnan(r.effect_b) and np.isnan(r.effect_c) and not np.isnan(r.effect_a) for r in rows)
