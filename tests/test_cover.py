from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from pedalmill.operators import cover, spatial

RINGS = "layer string, code string, rings array<array<struct<lon:double,lat:double>>>"


def star(rng, x, y, size, points):
    return [(x + size * rng.uniform(0.4, 1) * math.cos(2 * math.pi * i / points), y + size * rng.uniform(0.4, 1) * math.sin(2 * math.pi * i / points)) for i in range(points)]


def polygons(rng):
    rows = [("big", "b", [star(rng, -74, 40.7, 3.0, 400)]), ("tiny", "t", [star(rng, -74, 40.7, 1e-7, 9)]), ("line", "flat", [[(-74.1, 40.7), (-73.9, 40.7), (-74.0, 40.7)]])]
    rows += [("mid", f"m{i}", [star(rng, rng.uniform(-74.3, -73.7), rng.uniform(40.4, 41), rng.uniform(0.01, 0.2), rng.choice([3, 7, 60]))]) for i in range(25)]
    rows += [("hole", "h", [[(-74.2, 40.5), (-73.8, 40.5), (-73.8, 40.9), (-74.2, 40.9)], star(rng, -74, 40.7, 0.1, 30)])]
    rows += [("parts", "p", [[(-74.5, 40.2), (-74.4, 40.2), (-74.4, 40.3), (-74.5, 40.3), (-74.5, 40.2)]]), ("parts", "p", [[(-74.0, 40.0), (-73.9, 40.0), (-73.9, 40.1)]])]
    return rows


def brute(rows, x, y):
    """Crossing parity over all rings of all parts, with the arithmetic of the operator."""
    found = []
    for key in {(layer, code) for layer, code, _ in rows}:
        odd = on = False
        for ring in [r for layer, code, rs in rows if (layer, code) == key for r in rs]:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
                if (x1, y1) == (x2, y2):
                    continue
                if y1 != y2 and min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) / (y2 - y1) * (x2 - x1) > x:
                    odd = not odd
                on |= (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
        if odd and not on:
            found.append(key)
    return sorted(found)


def test_cover_equals_brute_force(spark):
    rng = random.Random(4)
    rows = polygons(rng)
    points = {(rng.uniform(-74.6, -73.4), rng.uniform(39.9, 41.2)) for _ in range(1500)} | {(-74 + rng.uniform(-2e-7, 2e-7), 40.7 + rng.uniform(-2e-7, 2e-7)) for _ in range(50)}
    points |= {p for _, _, rs in rows for r in rs for p in r} | {(-74.2, 40.7), (-74.0, 40.5), (-74.0, 40.7), (-74.25, 40.5), (180.0, 90.0), (0.0, 0.0)}
    df = spark.createDataFrame([(layer, code, [[{"lon": x, "lat": y} for x, y in r] for r in rs]) for layer, code, rs in rows], RINGS)
    made = cover.polygon_cover(df, ["layer", "code"])
    pts = spark.createDataFrame(sorted(points), "lon double, lat double").repartition(4)
    got = {}
    for r in cover.positions_in_cover(pts, made, ["layer", "code"]).collect():
        got.setdefault((r.lon, r.lat), []).append((r.layer, r.code))
    assert {p: sorted(k) for p, k in got.items()} == {p: b for p in points if (b := brute(rows, *p))}
    # inside cells answer most positions of a large polygon, and cells do not overlap
    kinds = made.filter("layer = 'big'").select("level", "cx", "cy", F.col("x1").isNull().alias("sure")).distinct()
    assert kinds.filter("sure").count() > 30 and kinds.groupBy("level", "cx", "cy").count().filter("count > 1").isEmpty()


def test_empty_sides(spark):
    none = spark.createDataFrame([], RINGS)
    made = cover.polygon_cover(none, ["layer", "code"])
    pts = spark.createDataFrame([(1.0, 2.0)], "lon double, lat double")
    assert made.isEmpty() and cover.positions_in_cover(pts, made, ["layer", "code"]).isEmpty()
    square = spark.createDataFrame([("l", "c", [[{"lon": x, "lat": y} for x, y in ((0.0, 0.0), (2.0, 0.0), (2.0, 3.0), (0.0, 3.0))]])], RINGS)
    assert [tuple(r) for r in spatial.points_in_polygons(pts, square.drop("layer")).collect()] == [(2.0, 1.0, "c")]
    assert cover.positions_in_cover(pts.limit(0), cover.polygon_cover(square, ["layer", "code"]), ["layer", "code"]).isEmpty()


def test_half_open_gives_positions_of_a_common_edge_to_one_polygon(spark):
    side = [("l", f"{x}{y}", [[(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0)]]) for x in (0.0, 1.0) for y in (0.0, 1.0)]
    slanted = [("s", "west", [[(0.0, 0.0), (0.75, 0.0), (1.25, 2.0), (0.0, 2.0)]]), ("s", "east", [[(0.75, 0.0), (2.0, 0.0), (2.0, 2.0), (1.25, 2.0)]])]
    rows = side + slanted
    df = spark.createDataFrame([(layer, code, [[{"lon": x, "lat": y} for x, y in r] for r in rs]) for layer, code, rs in rows], RINGS)
    made = cover.polygon_cover(df, ["layer", "code"])
    points = [(i / 8, j / 8) for i in range(17) for j in range(17)]
    pts = spark.createDataFrame(points, "lon double, lat double")

    def parity(x, y):
        found = []
        for layer, code, (ring,) in rows:
            crossed = [1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1])
                       if y1 != y2 and min(y1, y2) <= y < max(y1, y2) and x1 + (y - y1) / (y2 - y1) * (x2 - x1) > x]
            found += [(layer, code)] * (len(crossed) % 2)
        return sorted(found)

    got = {}
    for r in cover.positions_in_cover(pts, made, ["layer", "code"], half_open=True).collect():
        got.setdefault((r.lon, r.lat), []).append((r.layer, r.code))
    assert {p: sorted(k) for p, k in got.items()} == {p: f for p in points if (f := parity(*p))}
    assert all(len(got[p]) == 2 for p in points if p[0] < 2 and p[1] < 2)  # one of each layer, on edges too
