"""The finest grid cell around a position that holds k points, from one sort in Z-order.

Cells of all levels are intervals of the Z-order curve. Positions and points are sorted along it once, and
the k points before and after a position tell how fine a cell around it can be: one that holds the position and k points
in a row. Points of a neighbouring partition or batch are not looked at beyond the last k; that can only give a coarser cell,
never one with fewer points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import ship_package

#: Added to cell indexes, which may be negative; a power of two beyond all of them.
SHIFT = 1 << 30


def _spread(index: Column) -> Column:
    """A cell index with a zero bit between all of its bits."""
    x = index + F.lit(SHIFT)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x.bitwiseOR(F.shiftleft(x, shift))).bitwiseAND(F.lit(mask))
    return x


def z_code(lat: Column, lon: Column, size: float) -> Column:
    """Place of a position's cell on the Z-order curve."""
    return _spread(geo.cell(lat, size)).bitwiseOR(F.shiftleft(_spread(geo.cell(lon, size)), 1))


def _bit_length(x: np.ndarray) -> np.ndarray:
    high, low = (x >> 32).astype(np.float64), (x & 0xFFFFFFFF).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp(low)[1])


def finest_levels(z: np.ndarray, points: np.ndarray, k: int, finest: int) -> np.ndarray:
    """Finest level at which the cell around each ``z`` holds k of the sorted ``points``; -1 if none does."""
    best = np.full(len(z), -1, np.int64)
    at = np.searchsorted(points, z)
    for ahead in range(k + 1):
        first, last = at - k + ahead, at + ahead - 1
        fits = (first >= 0) & (last < len(points))
        low, high = np.minimum(z[fits], points[first[fits]]), np.maximum(z[fits], points[last[fits]])
        best[fits] = np.maximum(best[fits], finest - (_bit_length(low ^ high) + 1) // 2)
    return np.maximum(best, -1)


def _leveler(k: int, finest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = np.array([], np.int64)
        for batch in batches:
            z = batch.column("z").to_numpy()
            point = batch.column("point").to_numpy(zero_copy_only=False)
            points = np.concatenate([carried, z[point]])
            levels = finest_levels(z[~point], points, k, finest)
            carried = points[-k:]
            asked = batch.filter(pa.array(~point))
            yield pa.RecordBatch.from_arrays([asked.column("a_lat"), asked.column("a_lon"), pa.array(levels, mask=levels < 0)], ["a_lat", "a_lon", "level"])
    return run


def with_levels(a: DataFrame, b: DataFrame, k: int, size: float, finest: int) -> DataFrame:
    """``a`` (a_lat, a_lon) with a fine ``level`` whose cell around the position holds k rows of ``b`` (b_lat, b_lon).

    Level ``finest`` has cells of ``size`` degrees, each level above twice that. NULL where even level 0 is not proven to do.
    """
    ship_package(a.sparkSession)
    asked = a.select(z_code(F.col("a_lat"), F.col("a_lon"), size).alias("z"), F.lit(False).alias("point"), "a_lat", "a_lon")
    points = b.select(z_code(F.col("b_lat"), F.col("b_lon"), size).alias("z"), F.lit(True).alias("point"),
                      F.lit(None).cast("double").alias("a_lat"), F.lit(None).cast("double").alias("a_lon"))
    ordered = asked.unionByName(points).repartitionByRange("z").sortWithinPartitions("z")
    return ordered.mapInArrow(_leveler(k, finest), "a_lat double, a_lon double, level long")
