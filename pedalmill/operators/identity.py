"""Station identity: legacy extraction, matching, resolution, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from ..functions.dates import half_open_band
from ..functions.numeric import count_if
from ..session import durable, lookup_join
from .quantiles import exact_quantiles
from .spatial import nearest_k

#: Search radius in metres, and how many nearest stations are scored.
MATCH_RADIUS_M = 150.0
CANDIDATES = 5
#: Metres per degree used to turn the radius into degrees.
RADIUS_M_PER_DEGREE = 85_000.0

CROSSWALK_COLUMNS = ["legacy_id", "legacy_name", "legacy_lat", "legacy_lon", "trip_count", "modern_id",
                     "modern_name", "match_score", "match_confidence", "match_distance_m"]


def legacy_stations(obs: DataFrame, system: str = "nyc", min_trips: int = 10) -> DataFrame:
    """One row per legacy id: usual name, median position, trips.

    ``obs``: station_id, name, lat, lon, one row per trip end.
    """
    sid = text.strip_float_suffix(F.col("station_id"))
    wanted = (text.is_legacy_numeric_id(F.col("station_id")) if system == "jc"
              else text.is_legacy_short_id(F.col("station_id")))
    # Trips are read once: everything below comes from counts per (id, name, position).
    seen = durable(obs.withColumn("station_id", sid)
                   .filter(geo.in_box(F.col("lat"), F.col("lon"), system) & wanted)
                   .groupBy("station_id", "name", "lat", "lon").agg(F.count(F.lit(1)).alias("n")))
    names = seen.groupBy("station_id", "name").agg(F.sum("n").alias("n"))
    usual = F.min(F.when(F.col("name").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("name").alias("v"))))
    per = (names.groupBy("station_id").agg(F.sum("n").alias("trip_count"), usual.alias("u"))
           .filter(F.col("trip_count") >= min_trips))
    middle = exact_quantiles(seen, ["station_id"], {"legacy_lat": ("lat", 0.5), "legacy_lon": ("lon", 0.5)}, weight="n")
    return per.join(middle, "station_id").select(
        F.col("station_id").alias("legacy_id"), F.col("u.v").alias("legacy_name"), "legacy_lat", "legacy_lon",
        "trip_count")


def match_score(name_score: Column, distance_m: Column, radius_m: float = MATCH_RADIUS_M) -> Column:
    """Seven parts name, three parts nearness, 0..100."""
    return name_score * 0.7 + (1 - distance_m / radius_m) * 100 * 0.3


def match_confidence(distance_m: Column, name_score: Column, radius_m: float = MATCH_RADIUS_M,
                     min_name: float = 60) -> Column:
    """Confidence tier, NULL when the pair is no match."""
    return (F.when(distance_m < 20, "high")
            .when((distance_m < 50) & (name_score >= 50),
                  F.when(name_score >= 70, "high").otherwise("medium"))
            .when((distance_m < radius_m) & (name_score >= min_name),
                  F.when(name_score >= 80, "medium").otherwise("low")))


def crosswalk_candidates(legacy: DataFrame, modern: DataFrame, radius_m: float = MATCH_RADIUS_M,
                         k: int = CANDIDATES) -> DataFrame:
    """Scored candidates: up to ``k`` nearest by degrees, then within the radius in metres.

    ``modern``: station_id, name, lat, lon.
    """
    places = legacy.select("legacy_id", "legacy_name", F.col("legacy_lat").alias("lat"),
                           F.col("legacy_lon").alias("lon"))
    near = nearest_k(places, modern.select("station_id", "name", "lat", "lon"), k, "station_id",
                     max_deg=radius_m / RADIUS_M_PER_DEGREE, metric="degrees")
    d = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("b_lat"), F.col("b_lon"))
    near = near.withColumn("distance_m", d).filter(F.col("distance_m") <= radius_m)
    pairs = places.join(near, ["lat", "lon"])
    name = text.token_sort_ratio(F.col("legacy_name"), F.col("b_name"))
    return (pairs.withColumn("name_score", F.coalesce(name, F.lit(0.0)))
            .withColumn("score", match_score(F.col("name_score"), F.col("distance_m"), radius_m))
            .select("legacy_id", F.col("b_station_id").alias("modern_id"), F.col("b_name").alias("modern_name"),
                    "distance_m", "name_score", "score"))


def build_crosswalk(legacy: DataFrame, modern: DataFrame, radius_m: float = MATCH_RADIUS_M) -> DataFrame:
    """Best match per legacy station; stations without a match stay as ghosts.

    The best candidate is chosen by score alone (ties: nearer, then id). Only then
    is it tested against the tiers: a failed best candidate makes a ghost even if
    another candidate would pass.
    """
    scored = crosswalk_candidates(legacy, modern, radius_m).filter(F.col("score") > 0)
    order = F.struct((-F.col("score")).alias("s"), F.col("distance_m").alias("d"), F.col("modern_id").alias("i"))
    best = (scored.groupBy("legacy_id")
            .agg(F.min_by(F.struct("modern_id", "modern_name", "distance_m", "name_score", "score"),
                          order).alias("m"))
            .select("legacy_id", "m.*"))
    distance = F.round("distance_m", 1)
    best = (best.withColumn("match_confidence", match_confidence(distance, F.col("name_score"), radius_m))
            .filter(F.col("match_confidence").isNotNull())
            .withColumn("match_score", F.round("score", 1)).withColumn("match_distance_m", distance)
            .select("legacy_id", "modern_id", "modern_name", "match_score", "match_confidence",
                    "match_distance_m"))
    return (legacy.join(best, "legacy_id", "left")
            .fillna({"modern_id": "", "modern_name": "", "match_score": 0.0, "match_confidence": "none",
                     "match_distance_m": 0.0})
            .select(*CROSSWALK_COLUMNS))


def crosswalk_summary(crosswalk: DataFrame) -> DataFrame:
    matched = F.col("modern_id") != ""
    tier = F.col("match_confidence")
    return crosswalk.agg(
        F.count(F.lit(1)).alias("legacy_stations"), count_if(matched).alias("matched"),
        (count_if(matched) * 100.0 / F.count(F.lit(1))).alias("match_rate"),
        count_if(tier == "high").alias("high"), count_if(tier == "medium").alias("medium"),
        count_if(tier == "low").alias("low"), count_if(~matched).alias("ghosts"))


def apply_overrides(crosswalk: DataFrame, overrides: DataFrame) -> DataFrame:
    """Override rows replace crosswalk rows of the same legacy id; new ids are added.

    An anti join, so a NULL id among the overrides drops nothing.
    """
    kept = crosswalk.join(overrides.select("legacy_id"), "legacy_id", "left_anti")
    return kept.unionByName(overrides.select(*crosswalk.columns))


def station_map(crosswalk: DataFrame, current: DataFrame) -> DataFrame:
    """Everything needed to resolve a raw id, one row per raw id.

    raw_id, current station columns (by id), and crosswalk columns with the
    current station behind the modern id. Joining this once per trip end replaces
    three lookups per end.
    """
    cur = current.select(F.col("station_id"), F.col("name"), F.col("lat"), F.col("lon")) \
        .dropDuplicates(["station_id"])
    cw = crosswalk.dropDuplicates(["legacy_id"]).select(
        F.col("legacy_id"), "legacy_name", "legacy_lat", "legacy_lon",
        F.nullif(F.col("modern_id"), F.lit("")).alias("modern_id"), "modern_name")
    target = cur.select(F.col("station_id").alias("modern_id"), F.col("name").alias("t_name"),
                        F.col("lat").alias("t_lat"), F.col("lon").alias("t_lon"))
    cw = cw.join(target, "modern_id", "left")
    direct = cur.select(F.col("station_id").alias("raw_id"), F.col("name").alias("c_name"),
                        F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"),
                        F.lit(True).alias("is_current"))
    via = cw.select(F.col("legacy_id").alias("raw_id"), "legacy_name", "legacy_lat", "legacy_lon",
                    "modern_id", "modern_name", "t_name", "t_lat", "t_lon", F.lit(True).alias("is_legacy"))
    return direct.join(via, "raw_id", "full")


def resolve_end(trips: DataFrame, smap: DataFrame, end: str) -> DataFrame:
    """Add canonical id, name, position and match type for one end (``start`` or ``end``).

    Needs ``<end>_station_id_raw``, ``<end>_station_name_raw``, ``<end>_lat_raw`` and
    ``<end>_lon_raw``. Modern ids resolve directly, legacy ids through the
    crosswalk, ghosts keep their own id.
    """
    raw = f"{end}_station_id_raw"
    side = smap.withColumnRenamed("raw_id", raw)
    joined = lookup_join(trips, side, raw, "left")
    modern = text.id_class(F.col(raw)) == "modern"
    mapped = F.col("modern_id").isNotNull()

    def pick(direct: str, target: str, mapped_to: str, ghost: str, own: str) -> Column:
        return (F.when(modern, F.coalesce(F.col(direct), F.col(own)))
                .when(mapped, F.coalesce(F.col(target), F.col(mapped_to)))
                .otherwise(F.coalesce(F.col(ghost), F.col(own))))

    kind = (F.when(modern & F.coalesce(F.col("is_current"), F.lit(False)), "direct")
            .when(mapped, "crosswalk")
            .when(F.col("is_legacy"), "ghost").otherwise("unmatched"))
    out = joined.withColumns({
        f"{end}_station_id": F.when(modern, F.col(raw)).when(mapped, F.col("modern_id")).otherwise(F.col(raw)),
        f"{end}_station_name": pick("c_name", "t_name", "modern_name", "legacy_name", f"{end}_station_name_raw"),
        f"{end}_lat": pick("c_lat", "t_lat", "legacy_lat", "legacy_lat", f"{end}_lat_raw"),
        f"{end}_lon": pick("c_lon", "t_lon", "legacy_lon", "legacy_lon", f"{end}_lon_raw"),
        f"{end}_match_type": kind})
    return out.drop(*[c for c in smap.columns if c != "raw_id"])


def resolve_stations(trips: DataFrame, smap: DataFrame) -> DataFrame:
    return resolve_end(resolve_end(trips, smap, "start"), smap, "end")


# --- observations, profiles, reports ------------------------------------------

def observations(ends: DataFrame, years: Sequence[int] | None = None, box: str = "nyc",
                 drop_test: bool = True) -> DataFrame:
    """Distinct (id, name, position to 6 places) of legacy stations with trip counts.

    ``ends``: station_id, name, lat, lon, source_file, file_year. Years are
    filtered before grouping, so a station seen in several years is not lost to
    the first one.
    """
    rows = (ends.withColumn("station_id", text.strip_float_suffix(F.col("station_id")))
            .withColumn("lat", F.round("lat", 6)).withColumn("lon", F.round("lon", 6))
            .filter(geo.in_box(F.col("lat"), F.col("lon"), box) & F.col("name").isNotNull()
                    & text.is_legacy_short_id(F.col("station_id"), 20)))
    if years is not None:
        rows = rows.filter(F.col("file_year").isin(*years))
    if drop_test:
        rows = rows.filter(~text.is_test_station(F.col("name")))
    return rows.groupBy("station_id", "name", "lat", "lon").agg(
        F.count(F.lit(1)).alias("trip_count"), F.min("source_file").alias("sample_file"),
        F.min("file_year").alias("source_year"))


def match_class(distance_m: Column, similarity: Column) -> Column:
    near, alike = distance_m < 20, similarity >= 60
    return (F.when(near & alike, "both").when(near, "coordinate").when(alike, "name").otherwise("weak"))


def ghost_class(nearest_m: Column, similarity: Column) -> Column:
    return (F.when(nearest_m > 200, "removed")
            .when((nearest_m > 50) & (similarity < 40), "moved_renamed").otherwise("unclear"))


def mapping_report(obs: DataFrame, crosswalk: DataFrame, current: DataFrame) -> DataFrame:
    """Every observation with how it matched, or why it did not."""
    cur = current.select(F.col("station_id").alias("canonical_id"), F.col("name").alias("canonical_name"),
                         F.col("lat").alias("canonical_lat"), F.col("lon").alias("canonical_lon"))
    cw = crosswalk.select(F.col("legacy_id").alias("station_id"),
                          F.nullif(F.col("modern_id"), F.lit("")).alias("canonical_id"))
    known = lookup_join(lookup_join(obs, cw, "station_id"), cur, "canonical_id")
    matched = known.filter(F.col("canonical_id").isNotNull())
    drift = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("canonical_lat"), F.col("canonical_lon"))
    matched = (matched.withColumn("__d", drift)
               .withColumn("name_similarity_pct", text.token_sort_ratio(F.col("name"), F.col("canonical_name")))
               .withColumn("status", F.lit("matched"))
               .withColumn("match_type", F.when(F.col("canonical_name").isNull(), "orphan").otherwise(
                   match_class(F.col("__d"), F.col("name_similarity_pct"))))
               .withColumn("coord_distance_m", F.round("__d", 1)).drop("__d"))
    ghosts = known.filter(F.col("canonical_id").isNull()).drop(
        "canonical_id", "canonical_name", "canonical_lat", "canonical_lon")
    near = nearest_k(ghosts, current.select("station_id", "name", "lat", "lon"), 1, "station_id",
                     metric="haversine", round_to=1)
    near = near.select("lat", "lon", F.col("b_station_id").alias("nearest_station_id"),
                       F.col("b_name").alias("nearest_station"), F.col("distance").alias("nearest_distance_m"))
    ghosts = (ghosts.join(near, ["lat", "lon"], "left")
              .withColumn("name_similarity_pct", text.token_sort_ratio(F.col("name"), F.col("nearest_station")))
              .withColumn("status", F.lit("ghost"))
              .withColumn("ghost_type", ghost_class(F.col("nearest_distance_m"), F.col("name_similarity_pct"))))
    return matched.unionByName(ghosts, allowMissingColumns=True)


def report_totals(report: DataFrame) -> DataFrame:
    """Observations and trips per status and class."""
    kind = F.coalesce(F.col("match_type"), F.col("ghost_type"))
    return report.groupBy("status", kind.alias("match_class")).agg(
        F.count(F.lit(1)).alias("observations"), F.sum("trip_count").alias("trips"))


# Bucket bounds of the report, drift in metres and similarity in percent.
DRIFT_BUCKETS = [(0, 10, "<10m"), (10, 50, "10-50m"), (50, 100, "50-100m"), (100, float("inf"), ">100m")]
SIMILARITY_BUCKETS = [(0, 50, "<50%"), (50, 80, "50-80%"), (80, float("inf"), ">80%")]


def report_distribution(report: DataFrame) -> DataFrame:
    """Mean, median, maximum and bucket shares of drift and name similarity of matched
    observations. Zero values do not enter, as in the published report."""
    measures = F.explode(F.array(
        F.struct(F.lit("drift").alias("measure"), F.col("coord_distance_m").alias("x")),
        F.struct(F.lit("similarity").alias("measure"), F.col("name_similarity_pct").alias("x")))).alias("m")
    values = report.filter(F.col("status") == "matched").select(measures).select("m.*").filter(F.col("x") > 0)
    drift, alike = (half_open_band(F.col("x"), b) for b in (DRIFT_BUCKETS, SIMILARITY_BUCKETS))
    # Written once: names were compared in Python, and five aggregates follow.
    counts = durable(values.groupBy("measure", "x").agg(F.count(F.lit(1)).alias("n")))
    totals = counts.groupBy("measure").agg(
        F.sum("n").alias("observations"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"), F.max("x").alias("max"))
    middle = exact_quantiles(counts, ["measure"], {"median": ("x", 0.5)}, weight="n")
    buckets = counts.groupBy("measure", F.when(F.col("measure") == "drift", drift).otherwise(alike).alias("bucket")).agg(
        F.sum("n").alias("n"))
    return (buckets.join(totals, "measure").join(middle, "measure")
            .select("measure", "bucket", (F.col("n") * 100.0 / F.col("observations")).alias("pct"),
                    "observations", "mean", "median", "max"))


def report_leaders(report: DataFrame, n: int = 10) -> DataFrame:
    """Ghosts and renamed stations (matched by place only) with the most trips."""
    from .series import top_per_group

    kind = F.when(F.col("status") == "ghost", "ghost").when(F.col("match_type") == "coordinate", "renamed")
    rows = report.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    return top_per_group(rows, ["kind"], [F.desc("trip_count"), "station_id", "name", "lat", "lon"], n)


def station_profiles(obs: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """Names, positions, spread and years per station id.

    Counted per (id, name) and per (id, position) first. The name list of the
    result is complete by definition; the position list is the top five.
    """
    from .series import top_per_group

    coord = F.concat(F.format_string("%.5f", "lat"), F.lit(","), F.format_string("%.5f", "lon"))
    names = obs.groupBy("station_id", "name").agg(F.sum("trip_count").alias("n"))
    coords = (obs.groupBy("station_id", coord.alias("coord"), F.round("lat", 5).alias("la"),
                          F.round("lon", 5).alias("lo")).agg(F.sum("trip_count").alias("n")))

    def listed(key: str) -> Column:
        entry = F.struct((-F.col("n")).alias("neg"), F.col(key).alias("k"))
        return F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.concat(
            x["k"], F.lit(" ("), F.format_number(-x["neg"], 0), F.lit(")"))), " | ")

    first = F.struct((-F.col("n")).alias("neg"), F.col("name").alias("k"))
    by_name = names.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("name_variant_count"), F.min(first).alias("__f"),
        F.sum("n").alias("total_trips"), listed("name").alias("all_names"))
    by_name = (by_name.withColumn("primary_name", F.col("__f.k"))
               .withColumn("primary_name_trips", -F.col("__f.neg")).drop("__f"))
    first_c = F.struct((-F.col("n")).alias("neg"), F.col("coord").alias("k"))
    spread = F.greatest((F.max("la") - F.min("la")) * 111_320.0, (F.max("lo") - F.min("lo")) * RADIUS_M_PER_DEGREE)
    by_coord = coords.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("coord_variant_count"), F.min(first_c).alias("__f"),
        F.round(spread, 1).alias("coord_spread_m"))
    by_coord = by_coord.withColumn("primary_coord", F.col("__f.k")).drop("__f")
    top5 = (top_per_group(coords, ["station_id"], [F.desc("n"), "coord"], 5)
            .groupBy("station_id").agg(listed("coord").alias("all_coords")))
    years = (obs.select("station_id", "source_year").distinct().groupBy("station_id")
             .agg(F.array_join(F.array_sort(F.collect_list(F.col("source_year").cast("string"))), ",")
                  .alias("years_observed")))
    out = by_name.join(by_coord, "station_id").join(top5, "station_id").join(years, "station_id", "left")
    if crosswalk is None:
        return out
    cw = crosswalk.select(F.col("legacy_id").alias("station_id"),
                          F.nullif(F.col("modern_id"), F.lit("")).alias("canonical_id"),
                          F.col("modern_name").alias("canonical_name"), "match_confidence", "match_distance_m",
                          F.col("legacy_name").alias("crosswalk_name"))
    return lookup_join(out, cw, "station_id").withColumn(
        "status", F.when(F.col("canonical_id").isNotNull(), "matched").otherwise("ghost"))


def validate_mapping(trips: DataFrame, crosswalk: DataFrame, threshold_m: float = 200.0,
                     outlier_pct: float = 5.0) -> DataFrame:
    """Distance between the position used and the legacy position, per mapping.

    A trip matches a crosswalk row through the modern id, or, as a ghost, through
    its legacy id. The OR is split into two equi joins. Trips are counted per
    distinct (station, position) first, so joins and quantiles see few rows.
    """
    used = (trips.filter(F.col("start_match_type").isin("crosswalk", "ghost"))
            .groupBy("start_station_id", "start_station_name", "start_lat", "start_lon", "start_match_type")
            .agg(F.count(F.lit(1)).alias("n")))
    cw = crosswalk.select("legacy_id", "legacy_name", "legacy_lat", "legacy_lon",
                          F.nullif(F.col("modern_id"), F.lit("")).alias("modern_id"))
    by_modern = used.join(cw, used.start_station_id == cw.modern_id)
    by_legacy = used.join(cw, (used.start_station_id == cw.legacy_id)
                          & (used.start_match_type == "ghost")
                          & ~F.coalesce(used.start_station_id == cw.modern_id, F.lit(False)))
    joined = by_modern.unionByName(by_legacy)
    d = geo.flat_distance_m(F.col("start_lat"), F.col("start_lon"), F.col("legacy_lat"), F.col("legacy_lon"))
    # Both positions are keys, so a group has one distance and its quantiles are cheap.
    keys = ["legacy_id", "legacy_name", "legacy_lat", "legacy_lon", "start_station_id", "start_station_name",
            "start_lat", "start_lon", "start_match_type"]
    per = joined.withColumn("distance_m", d)
    over = F.sum(F.when(F.col("distance_m") > threshold_m, F.col("n")).otherwise(0))
    stats = per.groupBy(*keys).agg(
        F.sum("n").alias("trip_count"),
        F.percentile("distance_m", F.lit(0.5), F.col("n")).alias("median_distance_m"),
        (F.sum(F.col("distance_m") * F.col("n")) / F.sum("n")).alias("avg_distance_m"),
        F.max("distance_m").alias("max_distance_m"),
        F.percentile("distance_m", F.lit(0.95), F.col("n")).alias("p95_distance_m"),
        (over * 100.0 / F.sum("n")).alias("pct_over_threshold"))
    verdict = (F.when(F.col("median_distance_m") > threshold_m, "suspicious")
               .when(F.col("pct_over_threshold") > outlier_pct, "bad_data").otherwise("good"))
    return stats.withColumn("verdict", verdict)
