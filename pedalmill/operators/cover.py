"""Adaptive covers of polygons by grid cells, for point-in-polygon joins by equality.

Cells are those of a quadtree: at level l they are 512 / 2^l degrees wide. Each polygon is cut at a level that suits its extent,
cells with many of its edges are cut further, and three kinds of cells remain: outside (left out), inside, and cells that
an edge touches. A point in an inside cell is answered by the cell key alone. For a touched cell the cover holds the edges
that matter to its points: those at its latitudes that reach east of its west side. Polygons of any number of layers share one
cover, and so one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable, fits_broadcast

#: Width of a cell of level 0 in degrees; a power of two, so that all widths are exact.
TOP = 512.0
#: A polygon is at most 2^FIRST + 1 cells wide and high at first; a cut cell has 4^STEP children.
FIRST, STEP, STEPS = 3, 2, 3
#: A cell that more edges touch is cut, down to the finest level.
MAX_EDGES, FINEST = 6, 34


def polygon_edges(polygons: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """Edges of all rings, holes included: the keys and x1, y1, x2, y2.

    ``rings`` is array<array<struct<lon, lat>>>: the outer ring, then holes. A polygon may have several rows, one
    per part. An open ring is closed. Rings are exploded, so one large polygon does not travel as one value.
    """
    ring = polygons.select(*keys, F.explode(rings).alias("ring"))
    points = F.when(F.element_at("ring", 1) == F.element_at("ring", -1), F.col("ring")).otherwise(
        F.concat("ring", F.slice("ring", 1, 1)))
    pairs = F.arrays_zip(F.slice(F.col("p"), F.lit(1), F.size("p") - 1).alias("f"),
                         F.slice(F.col("p"), F.lit(2), F.size("p") - 1).alias("t"))
    return (ring.filter(F.size("ring") > 2).select(*keys, points.alias("p"))
            .select(*keys, F.explode(pairs).alias("e"))
            .select(*keys, F.col("e.f.lon").alias("x1"), F.col("e.f.lat").alias("y1"),
                    F.col("e.t.lon").alias("x2"), F.col("e.t.lat").alias("y2")))


def _width(level: Column) -> Column:
    return F.lit(TOP) / F.pow(F.lit(2.0), level)


def cell_of(x: Column, level: Column) -> Column:
    return F.floor(x / _width(level))


def crosses_east(lat: Column, lon: Column) -> Column:
    """Whether the ray from a position to the east crosses the edge."""
    t = (lat - F.col("y1")) / (F.col("y2") - F.col("y1"))
    straddles = (lat >= F.least("y1", "y2")) & (lat < F.greatest("y1", "y2"))
    return F.coalesce(F.when(F.col("y1") != F.col("y2"), straddles & (F.col("x1") + t * (F.col("x2") - F.col("x1")) > lon)), F.lit(False))


def on_edge(lat: Column, lon: Column) -> Column:
    cross = ((F.col("x2") - F.col("x1")) * (lat - F.col("y1")) - (F.col("y2") - F.col("y1")) * (lon - F.col("x1")))
    return ((cross == 0) & lat.between(F.least("y1", "y2"), F.greatest("y1", "y2"))
            & lon.between(F.least("x1", "x2"), F.greatest("x1", "x2")))


def _touches() -> Column:
    """Whether the edge may touch the closed cell; never false for one that does.

    Boxes must overlap and the corners of the cell must not all lie on one side of the edge's line. The cell is widened a
    little against rounding.
    """
    w = _width(F.col("level"))
    pad = w * 1e-9
    west, south = F.col("cx") * w - pad, F.col("cy") * w - pad
    east, north = (F.col("cx") + 1) * w + pad, (F.col("cy") + 1) * w + pad
    boxes = ((F.greatest("x1", "x2") >= west) & (F.least("x1", "x2") <= east)
             & (F.greatest("y1", "y2") >= south) & (F.least("y1", "y2") <= north))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    sides = [dx * (y - F.col("y1")) - dy * (x - F.col("x1")) for x in (west, east) for y in (south, north)]
    slack = (F.abs(dx) + F.abs(dy)) * w * 1e-9
    return boxes & (F.least(*sides) <= slack) & (F.greatest(*sides) >= -slack)


def _placed(edges: DataFrame, south: Column, north: Column, west: Column, east: Column) -> DataFrame:
    """``edges`` with ``level`` in all cells of a range that they matter to: those at their latitudes west of their east end."""
    level = F.col("level")
    rows = edges.withColumn("cy", F.explode(F.sequence(F.greatest(cell_of(F.least("y1", "y2"), level), south),
                                                       F.least(cell_of(F.greatest("y1", "y2"), level), north))))
    return rows.withColumn("cx", F.explode(F.sequence(west, F.least(cell_of(F.greatest("x1", "x2"), level), east))))


def polygon_cover(polygons: DataFrame, keys: list[str], rings: str = "rings") -> DataFrame:
    """``keys``, ``level``, ``cx``, ``cy`` and x1, y1, x2, y2 (NULL for inside cells, else a row per edge that matters)."""
    edges = polygon_edges(polygons, keys, rings)
    box = edges.groupBy(*keys).agg(F.min(F.least("x1", "x2")).alias("west"), F.max(F.greatest("x1", "x2")).alias("east"),
                                   F.min(F.least("y1", "y2")).alias("south"), F.max(F.greatest("y1", "y2")).alias("north"))
    extent = F.greatest(F.col("east") - F.col("west"), F.col("north") - F.col("south"))
    level = F.when(extent > 0, F.least(F.floor(F.log2(F.lit(TOP) / extent)) + FIRST, F.lit(FINEST))).otherwise(F.lit(FINEST)).cast("int")
    boxed = edges.join(box.withColumn("level", level), keys)
    lv = F.col("level")
    rows = _placed(boxed, cell_of(F.col("south"), lv), cell_of(F.col("north"), lv), cell_of(F.col("west"), lv), cell_of(F.col("east"), lv))
    cell, edge = [*keys, "level", "cx", "cy"], ["x1", "y1", "x2", "y2"]
    rows, done = rows.select(*cell, *edge), []
    for step in range(STEPS):
        w = _width(lv)
        middle = crosses_east((F.col("cy") + 0.5) * w, (F.col("cx") + 0.5) * w)
        rows = durable(rows)
        kinds = durable(rows.groupBy(*cell).agg(F.count(F.when(_touches(), 1)).alias("touching"), F.count(F.when(middle, 1)).alias("east")))
        done.append(kinds.filter("touching = 0 AND east % 2 = 1").select(*cell, *[F.lit(None).cast("double").alias(c) for c in edge]))
        crowded = (F.col("touching") > MAX_EDGES) & (lv + STEP <= FINEST) & F.lit(step + 1 < STEPS)
        done.append(rows.join(kinds.filter((F.col("touching") > 0) & ~crowded).select(*cell), cell, "left_semi"))
        if step + 1 == STEPS:
            break
        cut = kinds.filter(crowded).select(*cell)
        if cut.isEmpty():
            break
        parents = rows.join(cut, cell, "left_semi").withColumnsRenamed({"cx": "px", "cy": "py"}).withColumn("level", lv + STEP)
        n = 2 ** STEP
        rows = _placed(parents.filter(cell_of(F.greatest("x1", "x2"), lv) >= F.col("px") * n), F.col("py") * n, F.col("py") * n + (n - 1),
                       F.col("px") * n, F.col("px") * n + (n - 1)).select(*cell, *edge)
    cover = done[0]
    for part in done[1:]:
        cover = cover.unionByName(part)
    return durable(cover)


def positions_in_cover(points: DataFrame, cover: DataFrame, keys: list[str], half_open: bool = False) -> DataFrame:
    """``lat``, ``lon`` and the keys of the polygons around them, by one join for all polygons.

    ``points`` are distinct positions. A position lies in one cell of each level in use (a level per factor of two
    between the sizes of polygons). Positions on an edge are not inside, unless ``half_open``: then the crossings of the ray to
    the east decide alone, so of two polygons with a common edge one has the positions on it.
    """
    levels = [r["level"] for r in cover.select("level").distinct().toLocalIterator()]
    if not levels:
        return points.select("lat", "lon").limit(0).join(cover.select(*keys).limit(0), F.lit(True))
    cells = F.explode(F.array(*[F.struct(F.lit(lv).alias("level"), cell_of(F.col("lon"), F.lit(lv)).alias("cx"), cell_of(F.col("lat"), F.lit(lv)).alias("cy"))
                                for lv in sorted(levels)]))
    placed = points.select("lat", "lon", cells.alias("c")).select("lat", "lon", "c.*")
    hit = placed.join(F.broadcast(cover) if fits_broadcast(cover) else cover, ["level", "cx", "cy"])
    sure = hit.filter(F.col("x1").isNull()).select("lat", "lon", *keys)
    lat, lon = F.col("lat"), F.col("lon")
    on = F.lit(False) if half_open else on_edge(lat, lon)
    tested = hit.filter(F.col("x1").isNotNull()).withColumns({"__crosses": crosses_east(lat, lon), "__on": on})
    tested = (tested.filter(F.col("__crosses") | F.col("__on")).groupBy("lat", "lon", *keys)
              .agg(F.count(F.when(F.col("__crosses"), 1)).alias("__c"), F.max("__on").alias("__on"))
              .filter((F.col("__c") % 2 == 1) & ~F.col("__on")))
    return sure.unionByName(tested.select("lat", "lon", *keys))
