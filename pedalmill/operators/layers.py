"""Checks on boundary layers given as polygons (layer, code, name, rings)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import count_if
from .spatial import part_area

# City bounding box (lat_min, lat_max, lon_min, lon_max) and expected counts.
CITY_BOX = (40.4774, 40.9176, -74.2591, -73.7004)
EXPECTED_COUNTS = {"boroughs": (5, 5), "nta": (185, 245), "puma": (50, 60), "census_tracts": (2100, 2500)}
SLIVER_DEG2 = 0.00001


def _features(polygons: DataFrame) -> DataFrame:
    """One row per feature with its box, area and missing parts; geometry is read within the row."""
    points = F.flatten("rings")
    lon, lat = F.transform(points, lambda p: p["lon"]), F.transform(points, lambda p: p["lat"])
    empty = F.col("rings").isNull() | (F.size("rings") == 0)
    attributes = [c for c in polygons.columns if c not in ("layer", "rings")]
    missing = sum((F.col(c).isNull().cast("int") for c in attributes), F.lit(0))
    return polygons.groupBy("layer", "code").agg(
        F.max(empty).alias("empty"), F.max(missing).alias("missing"), F.sum(part_area()).alias("area"),
        F.min(F.array_min(lon)).alias("min_lon"), F.min(F.array_min(lat)).alias("min_lat"),
        F.max(F.array_max(lon)).alias("max_lon"), F.max(F.array_max(lat)).alias("max_lat"))


def layer_checks(polygons: DataFrame, box: Sequence[float] = CITY_BOX,
                 expected: dict[str, tuple[int, int]] | None = None,
                 sliver: float = SLIVER_DEG2) -> DataFrame:
    """PASS / WARN / FAIL per layer for geometry, bounds, count, attributes and slivers."""
    expected = EXPECTED_COUNTS if expected is None else expected
    lat_min, lat_max, lon_min, lon_max = box
    out = _features(polygons).groupBy("layer").agg(
        F.count(F.lit(1)).alias("features"), count_if(F.col("empty")).alias("null_geometries"),
        F.sum("missing").alias("null_attributes"), count_if(F.col("area") < sliver).alias("slivers"),
        F.min("min_lon").alias("min_lon"), F.min("min_lat").alias("min_lat"),
        F.max("max_lon").alias("max_lon"), F.max("max_lat").alias("max_lat"))
    inside = ((F.col("min_lat") >= lat_min) & (F.col("max_lat") <= lat_max)
              & (F.col("min_lon") >= lon_min) & (F.col("max_lon") <= lon_max))
    apart = ((F.col("max_lat") < lat_min) | (F.col("min_lat") > lat_max)
             | (F.col("max_lon") < lon_min) | (F.col("min_lon") > lon_max))
    count_status = F.lit("SKIP")
    for layer, (lo, hi) in expected.items():
        count_status = F.when(F.col("layer") == layer, F.when(
            F.col("features").between(lo, hi), "PASS").otherwise("WARN")).otherwise(count_status)
    return out.withColumns({
        "geometry_check": F.when(F.col("null_geometries") > 0, "FAIL").otherwise("PASS"),
        "bounds_check": F.when(inside, "PASS").when(apart, "FAIL").otherwise("WARN"),
        "count_check": count_status,
        "attribute_check": F.when(F.col("null_attributes") > 0, "WARN").otherwise("PASS"),
        "sliver_check": F.when(F.col("slivers") > 0, "WARN").otherwise("PASS")})
