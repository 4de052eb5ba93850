"""Spatial joins on grid cells: radius, box, k nearest, point in polygon, areas.

Spark has no spatial index, so nearness becomes equality of cell keys: one side
is repeated for every cell its search area touches, the other side carries the
one cell it lies in. Equal coordinates are collapsed before any pairing and
spread out again afterwards, so a spot that holds a third of all rows takes part
once. Distances in metres reach across the antimeridian: a search area that crosses it
is looked up on both sides. Longitudes are expected within -180 and 180.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..session import durable
from . import pyramid, zorder
from .cover import polygon_cover, positions_in_cover


def distinct_points(df: DataFrame, lat: str = "lat", lon: str = "lon",
                    *aggs: Column) -> DataFrame:
    """Each position once with the number of rows there."""
    return (df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
            .groupBy(F.col(lat).alias("lat"), F.col(lon).alias("lon"))
            .agg(F.count(F.lit(1)).alias("n"), *aggs))


def _seen_from(a: DataFrame, lon_reach: Column, wrap: bool) -> DataFrame:
    """``a`` with the longitude ``__lon`` to search around and the half width ``__reach_lon``.

    A row whose range passes the antimeridian is repeated one turn away. Half widths end at
    half a turn, so the ranges of a row do not overlap.
    """
    if not wrap:
        return a.withColumn("__reach_lon", lon_reach).withColumn("__lon", F.col("a_lon"))
    out = a.withColumn("__reach_lon", F.least(lon_reach, F.lit(180.0)))
    lo, hi = F.col("a_lon") - F.col("__reach_lon"), F.col("a_lon") + F.col("__reach_lon")
    turns = F.array_compact(F.array(F.lit(0.0), F.when(lo < -180, F.lit(360.0)), F.when(hi > 180, F.lit(-360.0))))
    return out.withColumn("__turn", F.explode(turns)).withColumn("__lon", F.col("a_lon") + F.col("__turn")).drop("__turn")


def _in_lon_range(wrap: bool) -> Column:
    """Whether b lies in the searched range, which of several copies of ``a`` is true for one."""
    if not wrap:
        return F.lit(True)
    off = F.col("b_lon") - F.col("__lon")
    return (off > -F.col("__reach_lon")) & (off <= F.col("__reach_lon"))


def _pairs_in_reach(a: DataFrame, b: DataFrame, lat_reach: Column, lon_reach: Column,
                    size: float, wrap: bool) -> DataFrame:
    """All (a, b) whose cells can be within reach. ``a`` is repeated per touched cell.

    ``a`` has a_lat/a_lon, ``b`` has b_lat/b_lon; reaches are columns of ``a`` in degrees.
    """
    left = (_seen_from(a, lon_reach, wrap)
            .withColumn("__cy", F.explode(geo.cells_covering(
                F.col("a_lat") - lat_reach, F.col("a_lat") + lat_reach, size)))
            .withColumn("__cx", F.explode(geo.cells_covering(
                F.col("__lon") - F.col("__reach_lon"), F.col("__lon") + F.col("__reach_lon"), size))))
    right = (b.withColumn("__cy", geo.cell(F.col("b_lat"), size))
             .withColumn("__cx", geo.cell(F.col("b_lon"), size)))
    return left.join(right, ["__cx", "__cy"]).filter(_in_lon_range(wrap)).drop("__cx", "__cy", "__lon", "__reach_lon")


def position_pairs_within(a: DataFrame, b: DataFrame, radius_m: float) -> DataFrame:
    """Distinct positions of ``a`` and ``b`` at most ``radius_m`` apart.

    Result: a_lat, a_lon, a_n, b_lat, b_lon, b_n, distance_m, where the ``n`` are
    the rows at each position. Sums over ``a_n * b_n`` count row pairs without
    producing them.
    """
    pa = distinct_points(a).toDF("a_lat", "a_lon", "a_n")
    pb = distinct_points(b).toDF("b_lat", "b_lon", "b_n")
    reach = math.degrees(radius_m / geo.EARTH_RADIUS_M) * (1 + 1e-9)
    near = _pairs_in_reach(pa, pb, F.lit(reach), geo.lon_reach_deg(F.col("a_lat"), F.lit(reach)), reach, wrap=True)
    d = geo.haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    return near.withColumn("distance_m", d).filter(F.col("distance_m") <= radius_m)


def pairs_within(a: DataFrame, b: DataFrame, radius_m: float) -> DataFrame:
    """Every row pair at most ``radius_m`` apart. The result is all pairs, so use it
    between small reference tables; :func:`neighbours` gives the per-row summary."""
    near = position_pairs_within(a, b, radius_m).drop("a_n", "b_n")
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in a.columns])
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    return near.join(left, ["a_lat", "a_lon"]).join(right, ["b_lat", "b_lon"])


def neighbours(a: DataFrame, b: DataFrame, radius_m: float) -> DataFrame:
    """Per position of ``a`` (lat, lon): rows of ``b`` within the radius, and the nearest distance.

    Rows are counted by cells of a pyramid (see ``pyramid``), so the work grows with the rim of dense spots. Discs around a
    pole, which span all longitudes, are compared pair by pair; few positions have one.
    """
    pa = distinct_points(a).select(F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"))
    pb = distinct_points(b)
    reach = math.degrees(radius_m / geo.EARTH_RADIUS_M) * (1 + pyramid.SLACK)
    seen = durable(_seen_from(pa, geo.lon_reach_deg(F.col("a_lat"), F.lit(reach)), wrap=True))
    narrow = F.col("__reach_lon") < 90
    counted = pyramid.counts_within(seen.filter(narrow), pb, radius_m)
    polar = seen.filter(~narrow).select(F.col("a_lat").alias("lat"), F.col("a_lon").alias("lon")).distinct()
    if not polar.isEmpty():
        around = position_pairs_within(polar, b, radius_m).groupBy("a_lat", "a_lon").agg(F.sum("b_n").alias("nearby"))
        counted = counted.unionByName(around)
    counted = durable(counted).withColumnsRenamed({"a_lat": "lat", "a_lon": "lon"})
    spots = pb.select("lat", "lon", F.monotonically_increasing_id().alias("spot"))
    closest = nearest_k(counted, spots, 1, "spot").select("lat", "lon", F.col("distance").alias("closest_m"))
    return counted.join(closest, ["lat", "lon"])


def rows_in_box(a: DataFrame, b: DataFrame, half_deg: float) -> DataFrame:
    """Pairs of ``a`` places and distinct ``b`` positions closer than ``half_deg`` on both axes.

    ``a`` is a short list of places with a ``place`` column.
    """
    pa = a.select("place", F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"))
    pb = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])
    near = _pairs_in_reach(pa, pb, F.lit(half_deg), F.lit(half_deg), half_deg, wrap=False)
    return near.filter((F.abs(F.col("a_lat") - F.col("b_lat")) < half_deg)
                       & (F.abs(F.col("a_lon") - F.col("b_lon")) < half_deg))


def _levels(max_deg: float | None) -> list[float]:
    """Cell sizes from coarse to fine, halving each time."""
    top, count = (max_deg, 12) if max_deg else (512.0, 24)
    return [top / 2 ** i for i in range(count)]


def nearest_k(a: DataFrame, b: DataFrame, k: int, b_id: str, max_deg: float | None = None,
              metric: str = "haversine", round_to: int | None = None) -> DataFrame:
    """The ``k`` nearest ``b`` rows of every distinct ``a`` position, exactly.

    ``metric`` is ``haversine`` (metres) or ``degrees`` (planar). With ``max_deg``
    only neighbours strictly closer than that many degrees count (``degrees``
    metric). Ties go to the smaller ``b_id``. Result: lat, lon, rank, distance,
    and the columns of ``b``, prefixed ``b_``.

    How the search stays small where points are dense: for each ``a`` position
    a fine grid level is found whose own cell already holds ``k`` points (see ``zorder``).
    Those ``k`` are at most one cell diagonal away, so nothing beyond the
    diagonal can belong to the answer, and only cells within it are searched.
    """
    if max_deg is not None and metric != "degrees":
        raise ValueError("max_deg is in degrees and needs metric='degrees'")
    sizes = _levels(max_deg)
    pa = distinct_points(a).select(F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"))
    # More than k rows on one spot can never all be among the k nearest.
    same_spot = Window.partitionBy("lat", "lon").orderBy(b_id)
    kept = (b.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .withColumn("__r", F.row_number().over(same_spot)).filter(F.col("__r") <= k).drop("__r"))
    pb = kept.select(*[F.col(c).alias(f"b_{c}") for c in kept.columns])
    bid = f"b_{b_id}"

    located = zorder.with_levels(pa, pb.select("b_lat", "b_lon"), k, sizes[-1], len(sizes) - 1)

    # Cell diagonal at the chosen level; without a full cell the whole search range.
    # Sizes halve exactly, so top / 2^level is the same double as the list entry.
    widest = F.lit(max_deg if max_deg else 720.0)
    diag = F.lit(sizes[0]) / F.pow(F.lit(2.0), F.col("level")) * math.sqrt(2.0) * (1 + 1e-9)
    reach = F.when(F.col("level").isNull(), widest).otherwise(F.least(diag, widest))
    # Search cells one step larger than the cell counted, so few cells are touched.
    search = F.greatest(F.coalesce(F.col("level"), F.lit(0)) - 1, F.lit(0))
    located = durable(located.withColumn("__reach", reach).withColumn("__lv", search))
    lon_reach = (F.col("__reach") if metric == "degrees"
                 else F.when(F.col("__reach") >= 90, F.lit(360.0)).otherwise(
                     geo.lon_reach_deg(F.col("a_lat"), F.col("__reach"))))
    step = F.lit(sizes[0]) / F.pow(F.lit(2.0), F.col("__lv"))
    wrap = metric == "haversine"
    left = (_seen_from(located, lon_reach, wrap)
            .withColumn("__cy", F.explode(geo.cells_covering(
                F.col("a_lat") - F.col("__reach"), F.col("a_lat") + F.col("__reach"), step)))
            .withColumn("__cx", F.explode(geo.cells_covering(
                F.col("__lon") - F.col("__reach_lon"), F.col("__lon") + F.col("__reach_lon"), step))))
    # Points stand in the cells of the levels that some position searches, and of no others.
    used = sorted(r["__lv"] for r in located.select("__lv").distinct().toLocalIterator())
    at = F.explode(F.array(*[F.struct(F.lit(lv).alias("__lv"), geo.cell(F.col("b_lat"), sizes[lv]).alias("__cy"),
                                      geo.cell(F.col("b_lon"), sizes[lv]).alias("__cx")) for lv in used or [0]]))
    right = pb.withColumn("g", at).select("*", "g.*").drop("g")
    pairs = left.join(right, ["__lv", "__cx", "__cy"]).filter(_in_lon_range(wrap))
    dlat, dlon = F.col("b_lat") - F.col("a_lat"), F.col("b_lon") - F.col("a_lon")
    if metric == "degrees":
        dist = F.sqrt(dlat * dlat + dlon * dlon)
    else:
        dist = geo.haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    if round_to is not None:
        dist = F.round(dist, round_to)
    pairs = pairs.withColumn("distance", dist)
    if max_deg is not None:
        pairs = pairs.filter(F.col("distance") < max_deg)
    order = Window.partitionBy("a_lat", "a_lon").orderBy("distance", bid)
    return (pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select(F.col("a_lat").alias("lat"), F.col("a_lon").alias("lon"), "rank", "distance",
                    *[c for c in pb.columns]))


# --- polygons -----------------------------------------------------------------

def points_in_polygons(df: DataFrame, polygons: DataFrame, how: str = "left",
                       lat: str = "lat", lon: str = "lon", code: str = "code", half_open: bool = False) -> DataFrame:
    """Rows with the code of the polygon around them (``left`` keeps unmatched rows).

    The test runs on distinct positions; rows get the answer by equi join. ``half_open``: see ``positions_in_cover``.
    """
    pts = distinct_points(df, lat, lon).select("lat", "lon")
    inside = positions_in_cover(pts, polygon_cover(polygons, [code]), [code], half_open).withColumnsRenamed({"lat": lat, "lon": lon})
    # About as many positions as rows in general, so no broadcast; both sides are
    # shuffled by position and a hot position is split by adaptive execution.
    return df.join(inside, [lat, lon], how)


def _ring_area(ring: Column) -> Column:
    """Shoelace area of one ring; pairing each point with the next closes an open ring."""
    after = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, after, lambda p, q: p["lon"] * q["lat"] - q["lon"] * p["lat"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)) / 2


def part_area(rings: str = "rings") -> Column:
    """Square degrees of one polygon part: first ring less its holes, within the row."""
    areas = F.transform(F.col(rings), _ring_area)
    return F.get(areas, F.lit(0)) * 2 - F.aggregate(areas, F.lit(0.0), lambda total, x: total + x)


def polygon_area(polygons: DataFrame, code: str = "code", rings: str = "rings") -> DataFrame:
    """Area in square degrees per code, summed over its parts."""
    return polygons.groupBy(code).agg(F.sum(part_area(rings)).alias("area_deg2"))


def station_density(stations: DataFrame, polygons: DataFrame, sq_km_per_deg2: float = 12_100.0,
                    code: str = "code", half_open: bool = False) -> DataFrame:
    """Stations per area and per square kilometre; areas without stations have 0."""
    pts = distinct_points(stations)
    inside = positions_in_cover(pts, polygon_cover(polygons, [code]), [code], half_open)
    count = inside.join(pts, ["lat", "lon"]).groupBy(code).agg(F.sum("n").alias("station_count"))
    return (polygon_area(polygons, code).join(count, code, "left")
            .withColumn("station_count", F.coalesce("station_count", F.lit(0)).cast("long"))
            .withColumn("area_sq_km", F.col("area_deg2") * sq_km_per_deg2)
            .withColumn("stations_per_sq_km", F.col("station_count") / F.col("area_sq_km"))
            .drop("area_deg2"))


def area_lookup(stations: DataFrame, layers: dict[str, DataFrame], source_order: Sequence[str], half_open: bool = False) -> DataFrame:
    """One row per station id with the area code of every layer, all layers in one join.

    ``stations``: station_id, lat, lon, source. When an id occurs in several
    sources the first of ``source_order`` wins. Of several areas of a layer the smallest code counts.
    """
    priority = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in source_order]),
                                           F.col("source")), F.lit(0))
    rank = F.when(priority == 0, F.lit(len(source_order) + 1)).otherwise(priority)
    names = [c for c in stations.columns if c != "station_id"]
    best = (stations.groupBy("station_id")
            .agg(F.min_by(F.struct(*names), F.struct(rank, F.col("lat"), F.col("lon"))).alias("s"))
            .select("station_id", "s.*"))
    pts = distinct_points(best).select("lat", "lon")
    polygons = reduce(DataFrame.unionByName, [p.select(F.lit(n).alias("__layer"), "code", "rings") for n, p in layers.items()])
    inside = positions_in_cover(pts, polygon_cover(polygons, ["__layer", "code"]), ["__layer", "code"], half_open)
    codes = inside.groupBy("lat", "lon").agg(*[F.min(F.when(F.col("__layer") == n, F.col("code"))).alias(f"{n}_code") for n in layers])
    return best.join(codes, ["lat", "lon"], "left")


# --- area vintages ------------------------------------------------------------

def transfer(values: DataFrame, crosswalk: DataFrame, old: str, new: str, value: str,
             pct_col: str) -> DataFrame:
    """Spread values of old areas over new areas by overlap percent."""
    weighted = F.sum(F.col(value) * F.col(pct_col) / 100.0).alias(value)
    return values.groupBy(old).agg(F.sum(value).alias(value)).join(crosswalk, old).groupBy(new).agg(weighted)


def dominant_area(crosswalk: DataFrame, old: str, new: str, pct_col: str) -> DataFrame:
    """The new area with the largest overlap per old area."""
    pick = F.min_by(F.struct(new, pct_col), F.struct((-F.col(pct_col)).alias("p"), F.col(new).alias("n")))
    return crosswalk.groupBy(old).agg(pick.alias("__p")).select(old, f"__p.{new}", f"__p.{pct_col}")


def stable_areas(crosswalk: DataFrame, pct_col: str, above: float = 95.0) -> DataFrame:
    return crosswalk.filter(F.col(pct_col) > above)


def unchanged_areas(crosswalk: DataFrame, old: str, new: str) -> DataFrame:
    return crosswalk.filter(F.col(old) == F.col(new))
