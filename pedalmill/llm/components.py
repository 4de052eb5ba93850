"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _towards_least(links: DataFrame) -> DataFrame:
    """``links`` (u, v): each u's neighbours v with the least of u and its neighbours, ``m``.

    Least values are aggregated before they are joined back, so a hub costs no task of its own.
    """
    least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return links.join(least, "u")


def _is_star_forest(links: DataFrame) -> bool:
    """Whether every u has one v and no v is a u: then v is the least of its component already."""
    ends = links.select(F.col("u").alias("end"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("v").alias("end"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counts = ends.groupBy("end").agg(F.sum("up").alias("ups"), F.max("down").alias("down"))
    return counts.filter("ups > 1 OR (ups = 1 AND down = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``class`` and ``label`` (the least class of its component) of every end of ``edges`` (a, b).

    Large-star steps hang larger neighbours below the least one, small-star steps hang the smaller ones;
    a logarithmic number of rounds leaves one star per component. Each round is written to the shared
    folder, which cuts lineage.
    """
    stars = common.stored(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    while not _is_star_forest(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        down = _towards_least(large)
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(down.select("u", F.col("m").alias("v")))
        stars = common.stored(small.filter("u != v").distinct(), "stars")
    return stars.select(F.col("u").alias("class"), F.col("v").alias("label")).unionByName(
        stars.select(F.col("v").alias("class"), F.col("v").alias("label")).distinct())
