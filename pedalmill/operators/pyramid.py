"""Counts within a radius over a pyramid of grid cells.

The finest cells are counted once, coarser ones are sums of four. A search disc goes down the pyramid: cells wholly inside
add their count, cells wholly outside are left out, and only cells on the rim are looked at one level finer. Positions are
compared with the disc only in rim cells of the finest level, so a dense spot costs its rim and not its square.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import durable

#: Cells of the finest level are the reach divided by 2^FINEST wide.
FINEST = 4
#: Bounds on distances leave so much room for rounding.
SLACK = 1e-9


def cell_pyramid(points: DataFrame, width: float, finest: int = FINEST) -> list[DataFrame]:
    """``cx``, ``cy``, ``n`` of the cells that hold rows, from cells of ``width`` degrees to those 2^finest times finer.

    ``points`` has lat, lon and the number of rows ``n``.
    """
    size = width / 2 ** finest
    cells = durable(points.groupBy(geo.cell(F.col("lon"), size).alias("cx"), geo.cell(F.col("lat"), size).alias("cy")).agg(F.sum("n").alias("n")))
    levels = [cells]
    for _ in range(finest):
        cells = cells.groupBy(F.floor(F.col("cx") / 2).alias("cx"), F.floor(F.col("cy") / 2).alias("cy")).agg(F.sum("n").alias("n"))
        levels.append(cells)
    return levels[::-1]


def _farthest(width: float) -> Column:
    """Distance to the farthest point of a cell: one of its corners."""
    corners = [geo.haversine_m(F.col("a_lat"), F.col("__lon"), (F.col("cy") + dy) * width, (F.col("cx") + dx) * width) for dx in (0, 1) for dy in (0, 1)]
    return F.greatest(*corners)


def _apart(width: float) -> Column:
    """A lower bound on the distance to any point of a cell: to its band of latitudes, and to its nearest meridian."""
    south, west = F.col("cy") * width, F.col("cx") * width
    off_lat = F.greatest(south - F.col("a_lat"), F.col("a_lat") - south - width, F.lit(0.0))
    off_lon = F.greatest(west - F.col("__lon"), F.col("__lon") - west - width, F.lit(0.0))
    meridian = F.when(off_lon < 90, F.asin(F.cos(F.radians("a_lat")) * F.sin(F.radians(off_lon)))).otherwise(0.0)
    return F.greatest(F.radians(off_lat), meridian) * geo.EARTH_RADIUS_M


def counts_within(a: DataFrame, b: DataFrame, radius_m: float, finest: int = FINEST) -> DataFrame:
    """``a_lat``, ``a_lon`` and ``nearby``: rows of ``b`` within ``radius_m`` of each position of ``a`` that has any.

    ``a`` has a_lat and a_lon, each position once and with ``__lon``, the longitude to search around, a turn away where a disc
    crosses the antimeridian, and its half width ``__reach_lon``. ``b`` has each position once: lat, lon, ``n``.
    Discs must be narrower than half a turn.
    """
    reach = math.degrees(radius_m / geo.EARTH_RADIUS_M) * (1 + SLACK)
    levels = cell_pyramid(b, reach, finest)
    left = (a.withColumn("cy", F.explode(geo.cells_covering(F.col("a_lat") - reach, F.col("a_lat") + reach, reach)))
            .withColumn("cx", F.explode(geo.cells_covering(F.col("__lon") - F.col("__reach_lon"), F.col("__lon") + F.col("__reach_lon"), reach))))
    left = left.select("a_lat", "a_lon", "__lon", "cx", "cy")
    found = []
    for level, cells in enumerate(levels):
        width = reach / 2 ** level
        met = left.join(cells, ["cx", "cy"]).filter(_apart(width) <= radius_m * (1 + SLACK))
        met = durable(met.withColumn("inside", _farthest(width) <= radius_m * (1 - SLACK)))
        found.append(met.filter("inside").groupBy("a_lat", "a_lon").agg(F.sum("n").alias("n")))
        left = met.filter("NOT inside").drop("n", "inside")
        if level < finest:
            children = F.explode(F.array(*[F.struct((F.col("cx") * 2 + dx).alias("cx"), (F.col("cy") * 2 + dy).alias("cy")) for dx in (0, 1) for dy in (0, 1)]))
            left = left.withColumn("c", children).select("a_lat", "a_lon", "__lon", "c.*")
    size = reach / 2 ** finest
    points = b.select(F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), "n", geo.cell(F.col("lon"), size).alias("cx"), geo.cell(F.col("lat"), size).alias("cy"))
    rim = left.join(points, ["cx", "cy"]).filter(geo.haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")) <= radius_m)
    out = rim.groupBy("a_lat", "a_lon").agg(F.sum("n").alias("n"))
    for part in found:
        out = out.unionByName(part)
    return out.groupBy("a_lat", "a_lon").agg(F.sum("n").alias("nearby"))
