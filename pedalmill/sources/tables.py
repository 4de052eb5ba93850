"""Positional permit files and boundary features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# 0-based positions of the fields used.
STATE_FIELDS = {"state_fips": 1, "state_name": 4}
STATE_UNITS = {"units_1": 6, "units_2": 9, "units_3_4": 12, "units_5plus": 15}
STATE_MIN_FIELDS = 16
PLACE_FIELDS = {"state_fips": 1, "place_id": 2}
PLACE_UNITS = {"units_1": 18, "units_2": 21, "units_3_4": 24, "units_5plus": 27}
PLACE_MIN_FIELDS = 30


def read_lines(spark: SparkSession, path: str, skip: int = 3) -> DataFrame:
    """Text lines less the first ``skip`` of each file, with the file name.

    Only the block that starts a file can hold its first lines; numbering is per
    block, so no group is larger than one input block.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_path").alias("__path"), F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__id"))
    number = F.row_number().over(Window.partitionBy("__path", "__start").orderBy("__id"))
    return (lines.withColumn("__n", number).filter((F.col("__start") > 0) | (F.col("__n") > skip))
            .select("file", "line"))


def _units(parts: Column, position: int) -> Column:
    """Blank means 0; text that is no whole number gives NULL."""
    cell = F.trim(F.get(parts, position))
    return F.when(cell == "", F.lit(0).cast("bigint")).when(cell.rlike(r"^[+-]?\d+$"), cell.try_cast("bigint"))


def permits(lines: DataFrame, fields: dict[str, int], units: dict[str, int], min_fields: int,
            line: str = "line") -> DataFrame:
    """Permit rows from positional lines; short lines and lines with bad numbers are dropped."""
    keep = [c for c in lines.columns if c != line]
    split = lines.withColumn("__p", F.split(F.trim(line), ",")).filter(F.size("__p") >= min_fields)
    rows = split.select(
        *keep, *[F.trim(F.get(F.col("__p"), i)).alias(n) for n, i in fields.items()],
        *[_units(F.col("__p"), i).alias(n) for n, i in units.items()]).dropna(subset=list(units))
    if "file" in keep:
        rows = rows.withColumn("year", F.regexp_extract("file", r"(\d{4})", 1).try_cast("int"))
    return structure_groups(rows)


def structure_groups(rows: DataFrame) -> DataFrame:
    """Total, single-family, small and large multi-family units."""
    return rows.withColumns({
        "total_units": F.col("units_1") + F.col("units_2") + F.col("units_3_4") + F.col("units_5plus"),
        "single_family": F.col("units_1"), "small_multi": F.col("units_2") + F.col("units_3_4"),
        "large_multi": F.col("units_5plus")})


# --- boundaries -----------------------------------------------------------------

# Borough number to name, and names the same attribute goes by.
BOROUGH_CODES = {"1": "Manhattan", "2": "Bronx", "3": "Brooklyn", "4": "Queens", "5": "Staten Island"}
ATTRIBUTE_NAMES = {
    "borough_name": ["boro_name", "BoroName", "boroname"],
    "borough_code": ["boro_code", "BoroCode", "borocode", "BOROCODE"],
    "nta_code": ["nta2020", "NTA2020", "NTACode"],
    "nta_name": ["ntaname", "NTAName"],
    "tract_code": ["CT", "CT2010"],
    "tract_geoid": ["BOROCT", "BoroCT2010"],
}
FEATURE_SCHEMA = """features array<struct<properties: map<string, string>,
    geometry: struct<type: string, coordinates: string>>>"""


def explode_features(collection: DataFrame, layer: str, code: str, name: str) -> DataFrame:
    """Feature collections to (layer, code, name, rings, properties), one row per polygon part.

    A multi-polygon gives several rows with one code, so outer rings and holes
    stay apart.
    """
    f = collection.select(F.explode("features").alias("f")).select("f.properties", "f.geometry")
    many = F.from_json("geometry.coordinates", "array<array<array<array<double>>>>")
    single = F.array(F.from_json("geometry.coordinates", "array<array<array<double>>>"))
    parts = f.select("properties", F.explode_outer(
        F.when(F.col("geometry.type") == "MultiPolygon", many).otherwise(single)).alias("part"))
    points = F.transform("part", lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))))
    return parts.select(F.lit(layer).alias("layer"), attribute(code).alias("code"), attribute(name).alias("name"),
                        points.alias("rings"), "properties")


def attribute(wanted: str, properties: str = "properties") -> Column:
    """A property under its standard name or any of the names it is known by."""
    names = [wanted, *ATTRIBUTE_NAMES.get(wanted, [])]
    return F.coalesce(*[F.try_element_at(F.col(properties), F.lit(n)) for n in names])


def standard_attributes(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Known attributes as columns under their standard names; borough numbers become names."""
    cols = {k: attribute(k) for k in keep}
    if "borough_name" in cols:
        decode = F.create_map(*[F.lit(x) for kv in BOROUGH_CODES.items() for x in kv])
        cols["borough_name"] = F.coalesce(cols["borough_name"],
                                          F.try_element_at(decode, attribute("borough_code")))
    return df.select(*[c for c in df.columns if c != "properties"], *[v.alias(k) for k, v in cols.items()])


def rename_present(df: DataFrame, names: dict[str, Sequence[str]], drop: Sequence[str] = ()) -> DataFrame:
    """Rename the first present candidate to each standard name; drop what is listed."""
    out = df
    for new, olds in names.items():
        if new in out.columns:
            continue
        for old in olds:
            if old in out.columns:
                out = out.withColumnRenamed(old, new)
                break
    return out.drop(*[c for c in drop if c in out.columns])


def read_boundaries(spark: SparkSession, path: str, layer: str, code: str, name: str) -> DataFrame:
    raw = spark.read.schema(FEATURE_SCHEMA).option("multiLine", True).json(path)
    return explode_features(raw, layer, code, name)
