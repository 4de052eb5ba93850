from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pedalmill.functions import geo
from pedalmill.operators import pyramid, spatial


def far(lat, lon, lats, lons):
    h = np.sin(np.radians(lats - lat) / 2) ** 2 + np.cos(np.radians(lat)) * np.cos(np.radians(lats)) * np.sin(np.radians(lons - lon) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * np.arctan2(np.sqrt(h), np.sqrt(1 - h))


@pytest.mark.parametrize("lat0, radius", [(40.7, 1500.0), (-75.0, 900.0), (0.0, 60_000.0)])
def test_counts_with_a_dense_spot(spark, lat0, radius):
    rng = np.random.default_rng(3)
    spot = np.column_stack([lat0 + rng.normal(0, 2e-4, 100_000), -74 + rng.normal(0, 2e-4, 100_000)])
    wide = np.column_stack([lat0 + rng.uniform(-0.1, 0.1, 3000), -74 + rng.uniform(-0.1, 0.1, 3000)])
    b = np.concatenate([spot, wide, wide[:500]])
    a = np.concatenate([wide[::60], spot[:20], [[lat0, -74.0], [lat0 + 1.2, -74.0]]])
    db = spark.createDataFrame(__import__("pandas").DataFrame({"id": range(len(b)), "lat": b[:, 0], "lon": b[:, 1]}))
    da = spark.createDataFrame([(float(x), float(y)) for x, y in a], "lat double, lon double")
    got = {(r.lat, r.lon): (r.nearby, r.closest_m) for r in spatial.neighbours(da, db, radius).collect()}
    want = {}
    for lat, lon in {tuple(p) for p in a.tolist()}:
        d = far(lat, lon, b[:, 0], b[:, 1])
        if (d <= radius).any():
            want[lat, lon] = (int((d <= radius).sum()), pytest.approx(d.min(), abs=1e-6))
    assert got == want


def test_cells_of_coarser_levels_are_sums(spark):
    pts = spark.range(2000).select((F.rand(1) * 4 - 2).alias("lat"), (F.rand(2) * 4 - 2).alias("lon"), F.lit(1).alias("n"))
    coarse, *_, finest = pyramid.cell_pyramid(pts, 1.0, 3)
    assert coarse.agg(F.sum("n")).first()[0] == finest.agg(F.sum("n")).first()[0] == 2000
    assert coarse.count() == 16 and {(r.cx, r.cy) for r in coarse.collect()} == {(x, y) for x in range(-2, 2) for y in range(-2, 2)}


def test_finest_cells_hold_k_points():
    from pedalmill.operators import zorder
    rng = np.random.default_rng(5)
    xy = np.concatenate([rng.integers(0, 1 << 10, (300, 2)), rng.integers(500, 520, (300, 2))])

    def code(p):
        return sum(((int(p[0]) >> b & 1) << 2 * b) | ((int(p[1]) >> b & 1) << 2 * b + 1) for b in range(10))
    z = np.array([code(p) for p in xy])
    points = np.sort(z[::2])
    got = zorder.finest_levels(z, points, 3, 10)
    for p, level in zip(z, got):
        want = max(lv for lv in range(11) if (points >> 2 * (10 - lv) == p >> 2 * (10 - lv)).sum() >= 3)
        assert level == want


def test_z_codes_interleave(spark):
    from pedalmill.operators import zorder
    rows = [(-80.3, 179.9), (0.0, 0.0), (40.7, -74.0), (89.9, -180.0)]
    size = 512.0 / 2 ** 23
    got = spark.createDataFrame(rows, "lat double, lon double").select(zorder.z_code(F.col("lat"), F.col("lon"), size)).collect()

    def code(lat, lon):
        y, x = (int(np.floor(v / size)) + zorder.SHIFT for v in (lat, lon))
        return sum(((y >> b & 1) << 2 * b) | ((x >> b & 1) << 2 * b + 1) for b in range(31))
    assert [r[0] for r in got] == [code(*p) for p in rows]
