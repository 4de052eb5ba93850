"""Files, manifests, feeds, positional lines, boundary features and incremental ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import parse
from ..session import shared_dir
from ..sources import feeds, manifest, tables
from . import views as v
from .registry import query, r, table


@query("S4", "S24", sql="SELECT 'events.parquet' AS file_name, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events")
def rows_per_file(spark, sf):
    """Row counts by source file name."""
    return table(spark, sf, "events").groupBy(F.col("_metadata.file_name").alias("file_name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"))


def _file_names(spark, sf):
    """File names derived from orders: named stamps, plain stamps, split parts, odd names."""
    o = table(spark, sf, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    moved = F.add_months(d, 19 * 12)
    stamp = F.date_format(moved, "yyyyMM")
    name = (F.when(k % 5 == 0, F.concat(stamp, F.lit("-bikeshare-tripdata.csv")))
            .when(k % 5 == 1, F.concat(F.lit("2014-bikeshare-tripdata_"), stamp, F.lit("-bikeshare-tripdata_1.csv")))
            .when(k % 5 == 2, F.concat(F.lit("JC-"), stamp, F.lit("_2.csv")))
            .when(k % 5 == 3, F.concat(F.lit("x209913"), (k % 7).cast("string"), F.lit(".csv"))).otherwise("readme.csv"))
    return o.select("o_orderkey", name.alias("file_name"))


_NAMES = """nm AS (SELECT o_orderkey, strftime(o_orderdate + INTERVAL 19 YEAR, '%Y%m') AS s, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate + INTERVAL 19 YEAR, '%Y%m') || '-bikeshare-tripdata.csv'
   WHEN 1 THEN '2014-bikeshare-tripdata_' || strftime(o_orderdate + INTERVAL 19 YEAR, '%Y%m') || '-bikeshare-tripdata_1.csv' WHEN 2 THEN 'JC-' || strftime(o_orderdate + INTERVAL 19 YEAR, '%Y%m') || '_2.csv'
   WHEN 3 THEN 'x209913' || CAST(o_orderkey % 7 AS VARCHAR) || '.csv' ELSE 'readme.csv' END AS file_name FROM orders),
 ex AS (SELECT *, CASE WHEN o_orderkey % 5 < 3 THEN CAST(left(s, 4) AS BIGINT) ELSE -1 END AS year, CASE WHEN o_orderkey % 5 < 3 THEN CAST(right(s, 2) AS BIGINT) ELSE -1 END AS month FROM nm)"""


@query("S6", "S22", sql=f"""WITH {_NAMES} SELECT year, month, count(*) AS n FROM ex GROUP BY ALL""")
def expected_months(spark, sf):
    """The month each file name promises, -1 where it names none."""
    f = _file_names(spark, sf).withColumn("e", parse.expected_year_month(F.col("file_name")))
    return f.groupBy(F.coalesce("e.year", F.lit(-1)).alias("year"), F.coalesce("e.month", F.lit(-1)).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("S22", "S23", "S21", sql=f"""WITH {_NAMES}, f AS (SELECT DISTINCT file_name, year, month FROM ex), w AS (SELECT DISTINCT year, month FROM f WHERE month > 0 AND NOT regexp_matches(file_name, '_[0-9]\\.csv$'))
SELECT file_name FROM f WHERE NOT (regexp_matches(file_name, '_[0-9]\\.csv$') AND month > 0 AND EXISTS (SELECT 1 FROM w WHERE w.year = f.year AND w.month = f.month)) AND year IN (2016, 2018)
 AND NOT (month = 3 AND file_name LIKE '%-bikeshare%')""")
def files_to_read(spark, sf):
    """Superseded split files dropped, years selected by parsed year, finished files skipped."""
    f = _file_names(spark, sf).select("file_name").distinct().withColumn("expected", parse.expected_year_month(F.col("file_name")))
    files = manifest.of_years(manifest.without_superseded(f), [2016, 2018])
    done = f.filter((F.col("expected.month") == 3) & F.col("file_name").contains("-bikeshare")).select("file_name")
    return manifest.pending(files, done).select("file_name")


@query("S5", sql="""SELECT CASE event_id % 4 WHEN 0 THEN 'modern' WHEN 1 THEN 'legacy' WHEN 2 THEN 'legacy_titlecase' ELSE 'unknown' END AS family, count(*) AS files FROM events GROUP BY 1""")
def header_families(spark, sf):
    k = F.col("event_id") % 4
    header = (F.when(k == 0, F.concat(F.lit("Ride_ID,x"), k.cast("string"))).when(k == 1, "tripduration,starttime")
              .when(k == 2, "Trip Duration,Start Time").otherwise(F.col("event_type")))
    return table(spark, sf, "events").groupBy(manifest.schema_family(header).alias("family")).agg(F.count(F.lit(1)).alias("files"))


@query("S24", sql="""WITH h AS (SELECT md5(text) AS m, min((lpad(CAST(doc_id AS VARCHAR), 12, '0'), source || '.csv')) AS f FROM documents GROUP BY 1),
 u AS (SELECT m, f[1] AS path, f[2] AS file_name FROM h), w AS (SELECT *, min(path) OVER (PARTITION BY file_name) AS first_path FROM u)
SELECT path, CASE WHEN path = first_path THEN file_name ELSE replace(file_name, '.csv', '') || '_' || m || '.csv' END AS stored_name FROM w""")
def unique_files(spark, sf):
    """One file per content; equal names with other content get distinct names. Documents play files."""
    d = table(spark, sf, "documents").select(F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"),
                                             F.concat("source", F.lit(".csv")).alias("file_name"), F.md5("text").alias("md5"))
    return manifest.without_duplicates(d).select("path", "stored_name")


@query("S11", sql=f"""SELECT CAST(s_suppkey AS VARCHAR) AS station_id, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'short ' || CAST(s_suppkey AS VARCHAR) END AS short_name, s_name AS name, round({v.sql_lat('s_suppkey')}, 6) AS lat,
 (CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE s_nationkey END)::BIGINT AS capacity, '' AS region_id FROM supplier""")
def station_feed(spark, sf):
    """Nested station feed to rows with defaults for missing fields."""
    k = F.col("s_suppkey")
    one = F.struct(k.cast("string").alias("station_id"), F.when(k % 3 != 0, F.concat(F.lit("short "), k.cast("string"))).alias("short_name"),
                   F.col("s_name").alias("name"), v.lat_of(k).alias("lat"), v.lon_of(k).alias("lon"),
                   F.when(k % 4 != 0, F.col("s_nationkey")).alias("capacity"), F.lit(None).cast("string").alias("region_id"))
    text = F.to_json(F.struct(F.struct(F.array(one).alias("stations")).alias("data")))
    feed = table(spark, sf, "supplier").select(F.from_json(text, feeds.STATION_FEED_SCHEMA).alias("j")).select("j.*")
    return feeds.explode_stations(feed).select("station_id", "short_name", "name", r("lat").alias("lat"), "capacity", "region_id")


@query("S12", "S13", sql="""WITH x AS (SELECT date_trunc('hour', ts) AS h, min(value) AS a, max(value) AS b FROM events GROUP BY 1)
SELECT strftime(h, '%Y-%m-%d %H:%M') AS datetime, a AS temperature_2m, b AS precipitation FROM x""")
def weather_arrays(spark, sf):
    """Parallel arrays to hourly rows; overlapping chunks are combined to unique hours."""
    x = table(spark, sf, "events").groupBy(F.date_trunc("hour", "ts").alias("h")).agg(F.min("value").alias("a"), F.max("value").alias("b"))

    def arrays(c):
        # The second element repeats the hour, as overlapping chunks do.
        return F.array(c, c)

    fields = {"time": F.date_format("h", "yyyy-MM-dd'T'HH:mm"), **{m: F.col("a") for m in feeds.HOURLY_MEASURES}, "precipitation": F.col("b"),
              "weather_code": F.lit(3)}
    raw = x.select(F.struct(*[arrays(c).alias(n) for n, c in fields.items()]).alias("hourly"))
    out = feeds.combine_chunks([feeds.explode_hourly(raw), feeds.explode_hourly(raw)], ["datetime"], sort=False)
    return out.select(F.date_format("datetime", "yyyy-MM-dd HH:mm").alias("datetime"), "temperature_2m", "precipitation")


@query("S12", "P31", sql="""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events)
SELECT strftime(date, '%Y-%m-%d') AS date, round((10 * 60 + day(date)) / 60.0::DOUBLE, 6) AS daylight_hours FROM d""")
def daylight(spark, sf):
    d = table(spark, sf, "events").select(F.to_date("ts").alias("date")).distinct()
    day = F.dayofmonth("date")
    raw = d.select(F.struct(F.array(F.date_format("date", "yyyy-MM-dd")).alias("time"),
                            F.array(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T07:00"))).alias("sunrise"),
                            F.array(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T17:"), F.lpad(day.cast("string"), 2, "0"))).alias("sunset")).alias("daily"))
    return feeds.explode_daily(raw).select("date", r("daylight_hours").alias("daylight_hours"))


@query("S17", "P44", "P50", sql="""WITH x AS (SELECT *, o_orderkey % 97 AS a, o_orderkey % 13 AS b, o_custkey % 7 AS c, o_custkey % 5 AS d FROM orders WHERE o_orderkey % 11 <> 4 AND o_orderkey % 17 <> 5)
SELECT year(o_orderdate) AS year, '0' || CAST(o_custkey % 9 AS VARCHAR) AS state_fips, count(*) AS lines, CAST(sum(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE a END) AS BIGINT) AS single_family, CAST(sum(b + c) AS BIGINT) AS small_multi,
  CAST(sum(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE a END + b + c + d) AS BIGINT) AS total_units FROM x GROUP BY ALL""")
def positional_permits(spark, sf):
    """Positional lines: short lines and bad numbers are dropped, blanks are zero."""
    o = table(spark, sf, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    cells = [F.lit("x")] * 17
    cells[1] = F.concat(F.lit(" 0"), (c % 9).cast("string"))
    cells[4] = F.lit("State ")
    cells[6] = F.when(k % 3 == 0, " ").otherwise((k % 97).cast("string"))
    cells[9] = F.concat(F.lit(" "), (k % 13).cast("string"))
    cells[12] = F.when(k % 17 == 5, "12a").otherwise((c % 7).cast("string"))
    cells[15] = (c % 5).cast("string")
    line = F.when(k % 11 == 4, "too,short").otherwise(F.concat_ws(",", *cells))
    raw = o.select(F.concat(F.lit("st"), F.year("o_orderdate").cast("string"), F.lit("a.txt")).alias("file"), line.alias("line"))
    p = tables.permits(raw, tables.STATE_FIELDS, tables.STATE_UNITS, tables.STATE_MIN_FIELDS)
    return p.groupBy("year", "state_fips").agg(F.count(F.lit(1)).alias("lines"), F.sum("single_family").alias("single_family"),
                                               F.sum("small_multi").alias("small_multi"), F.sum("total_units").alias("total_units"))


@query("S20", sql="""SELECT n_name AS code, CASE n_nationkey % 5 + 1 WHEN 1 THEN 'Manhattan' WHEN 2 THEN 'Bronx' WHEN 3 THEN 'Brooklyn' WHEN 4 THEN 'Queens' ELSE 'Staten Island' END AS borough_name,
 CAST(n_nationkey % 5 + 1 AS VARCHAR) AS borough_code, (CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END)::BIGINT AS n_rings FROM nation""")
def boundary_features(spark, sf):
    """Feature collections to rows: attributes under any of their names, polygon and multi-polygon."""
    k = F.col("n_nationkey")
    ring = F.lit("[[0,0],[1,0],[1,1],[0,0]]")
    geometry = F.struct(F.when(k % 2 == 0, "MultiPolygon").otherwise("Polygon").alias("type"),
                        F.when(k % 2 == 0, F.concat(F.lit("[["), ring, F.lit("],["), ring, F.lit("]]"))).otherwise(
                            F.concat(F.lit("["), ring, F.lit("]"))).alias("coordinates"))
    props = F.create_map(F.when(k % 3 == 0, "NTA2020").otherwise("ntaname"), F.col("n_name"), F.lit("BoroCode"), (k % 5 + 1).cast("string"))
    raw = table(spark, sf, "nation").select(F.array(F.struct(props.alias("properties"), geometry.alias("geometry"))).alias("features"))
    f = tables.explode_features(raw, "nta", "nta_code", "nta_name")
    out = tables.standard_attributes(f.withColumn("code", F.coalesce("code", "name")), ["borough_name", "borough_code"])
    return out.groupBy("code", "borough_name", "borough_code").agg(F.sum(F.size("rings")).alias("n_rings"))


@query("S7", "S8", sql="""SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, count(*) AS trips FROM orders WHERE year(o_orderdate) IN (1996, 1999) GROUP BY ALL""")
def partitioned_rewrite(spark, sf):
    """Trips written by system, year and month and read back with partition pruning."""
    from ..sources.sinks import write_trips
    from ..sources.trips import read_processed
    root = f"{shared_dir(spark)}/trips-{uuid.uuid4().hex}"
    write_trips(v.order_trips(spark, sf).drop("o_custkey", "o_totalprice"), root)
    back = read_processed(spark, root, "nyc", [1996, 1999])
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("trips"))


@query("S21", "S8", sql="""SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS date, event_type, count(*) AS n FROM events GROUP BY ALL""")
def incremental_ingest(spark, sf):
    """A file-source stream run to the end twice: the second run finds nothing new."""
    from ..streaming.ingest import ingest_new
    base = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        ingest_new(stream, lambda b: b.select("event_type", F.to_date("ts").alias("date")), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("date", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("S1", "S2", "S3", "S5", "S9", "S10", "A10", sql=f"""WITH {v.TRIPS}, x AS (SELECT *, CASE WHEN ride_id % 2 = 0 THEN 'modern' ELSE 'legacy' END AS fam, ride_id % 31 = 0 AS gone FROM trips)
SELECT fam AS family, count(*) AS rows_in, count(*) FILTER (WHERE NOT gone AND duration_sec BETWEEN 90 AND 14400) AS rows_out, count(*) FILTER (WHERE gone) AS missing_station,
  count(*) FILTER (WHERE NOT gone AND duration_sec < 90) AS first_duration_too_short, count(*) FILTER (WHERE NOT gone AND duration_sec > 14400) AS first_duration_too_long FROM x GROUP BY 1""")
def raw_files_accounting(spark, sf):
    """Trips written as raw CSV files of two eras, read back by header family, judged, logged as JSON."""
    from ..operators import quality
    from ..sources import sinks, trips as trip_source
    base = f"{shared_dir(spark)}/raw-{uuid.uuid4().hex}"
    t = v.trips(spark, sf)
    k = F.col("ride_id")
    sid = F.when(k % 31 != 0, F.col("start_station_id").cast("string"))
    start = F.date_format("started_at", "yyyy-MM-dd HH:mm:ss")
    end = F.date_format(F.date_trunc("second", "started_at") + F.make_dt_interval(secs=F.col("duration_sec")), "yyyy-MM-dd HH:mm:ss")
    common = {"start": start, "end": end, "start_id": sid, "end_id": F.col("end_station_id").cast("string"), "start_name": F.lit('A "x", B'),
              "end_name": F.lit("C"), **{c: F.col(c).cast("string") for c in ("start_lat", "start_lon", "end_lat", "end_lon")}}
    cells = {"modern": {**common, "ride_id": k.cast("string"), "rideable_type": F.col("rideable_type"), "rider": F.col("member_casual")},
             "legacy": {**common, "seconds": F.col("duration_sec").cast("string"), "bike": k.cast("string"), "rider": F.col("member_casual"),
                        "birth": F.lit("1980"), "gender": F.lit("1")}}
    for family, rest in (("modern", 0), ("legacy", 1)):
        names = trip_source.COLUMN_NAMES[family]
        sinks.write_csv(t.filter(k % 2 == rest).select(*[cells[family][c].alias(n) for c, n in names.items()]), f"{base}/files/{family}")
    projected = trip_source.read_files(spark, manifest.trip_files(spark, f"{base}/files"))
    judged = projected.withColumn("family", F.when(F.col("bike_id").isNull(), "modern").otherwise("legacy"))
    sinks.write_log(quality.filter_accounting(judged, quality.quality_reasons(), ["family"]), f"{base}/log", "check")
    return spark.read.json(f"{base}/log").select("family", "rows_in", "rows_out", "missing_station", "first_duration_too_short", "first_duration_too_long")


_ETL_RAW = f"""{v.TRIPS}, raw_trips AS (SELECT CAST(ride_id AS VARCHAR) AS ride, ['modern', 'legacy', 'titlecase'][ride_id % 3 + 1] AS family, duration_sec, member_casual,
    date_trunc('second', started_at) + CASE WHEN ride_id % 41 = 0 THEN INTERVAL 40 DAY ELSE INTERVAL 0 DAY END AS started_at,
    CASE WHEN ride_id % 31 <> 0 THEN CASE WHEN ride_id % 3 = 0 THEN 'M-' ELSE '' END || CAST(start_station_id AS VARCHAR) END AS start_station_id_raw,
    CASE WHEN ride_id % 3 = 0 THEN 'M-' ELSE '' END || CAST(end_station_id AS VARCHAR) AS end_station_id_raw,
    CASE WHEN ride_id % 7 = 0 THEN 'Demo, yard' ELSE 'raw ' || CAST(start_station_id AS VARCHAR) END AS start_station_name_raw, 'raw ' || CAST(end_station_id AS VARCHAR) AS end_station_name_raw,
    start_lat AS start_lat_raw, start_lon AS start_lon_raw, end_lat AS end_lat_raw, end_lon AS end_lon_raw FROM trips),
  {v.CROSSWALK}, {v.CURRENT}, ws AS ({v.resolved_sql('start', 'raw_trips')}), resolved AS ({v.resolved_sql('end', 'ws')}),
  judged AS (SELECT *, CASE WHEN start_station_id_raw IS NULL THEN 'missing_station' WHEN duration_sec < 90 THEN 'duration_too_short' WHEN duration_sec > 14400 THEN 'duration_too_long'
    WHEN month(started_at) <> 1 THEN 'wrong_month' WHEN start_station_name ILIKE '%demo%' THEN 'test_station' END AS reason FROM resolved)"""


def _named_files(spark, folder: str, name: str) -> None:
    """Give the part files of a folder names like those of raw files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path):
        part = status.getPath().getName()
        if part.endswith(".csv"):
            fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path, f"202401-{name}-{part.split('-')[1]}-tripdata.csv"))


def _raw_cells():
    """Text of the raw cells of a trip, and per family the forms of station ids and riders."""
    k = F.col("ride_id")
    start = F.date_trunc("second", "started_at") + F.when(k % 41 == 0, F.make_dt_interval(days=F.lit(40))).otherwise(F.make_dt_interval(days=F.lit(0)))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    sid, eid = F.col("start_station_id").cast("string"), F.col("end_station_id").cast("string")
    text = {"ride_id": k.cast("string"), "bike": k.cast("string"), "rideable_type": F.col("rideable_type"), "seconds": F.col("duration_sec").cast("string"),
            "start": stamp(start), "end": stamp(start + F.make_dt_interval(secs=F.col("duration_sec"))), "birth": F.lit("1980.0"), "gender": F.lit("1"),
            "start_name": F.when(k % 7 == 0, "Demo, yard").otherwise(F.concat(F.lit("raw "), sid)), "end_name": F.concat(F.lit("raw "), eid),
            **{c: F.col(c).cast("string") for c in ("start_lat", "start_lon", "end_lat", "end_lon")}}
    forms = {"modern": (lambda c: F.concat(F.lit("M-"), c), F.col("member_casual")), "legacy": (lambda c: c, F.when(F.col("member_casual") == "member", "Subscriber").otherwise("Customer"))}
    forms["titlecase"] = (lambda c: F.concat(c, F.lit(".0")), forms["legacy"][1])
    return text, forms


def _etl_result(spark, sf):
    """Files of three families from the trips; the ETL runs twice, and once more by force for one family."""
    from ..plans import trip_etl
    from ..sources import sinks, trips as trip_source
    base = f"{shared_dir(spark)}/etl-{uuid.uuid4().hex}"
    t, k, (text, forms) = v.trips(spark, sf), F.col("ride_id"), _raw_cells()
    sid, eid = F.col("start_station_id").cast("string"), F.col("end_station_id").cast("string")
    for n, (name, (form, rider)) in enumerate(forms.items()):
        cells = {**text, "start_id": F.when(k % 31 != 0, form(sid)), "end_id": form(eid), "rider": rider}
        names = trip_source.COLUMN_NAMES["legacy_titlecase" if name == "titlecase" else name]
        sinks.write_csv(t.filter(k % 3 == n).select(*[cells[c].alias(x) for c, x in names.items()]), f"{base}/files/{name}")
        _named_files(spark, f"{base}/files/{name}", name)
    args = (f"{base}/trips", v.crosswalk(spark, sf), v.current_stations(spark, sf))
    for _ in range(2):
        trip_etl.run(spark, f"{base}/files", *args)
    return trip_etl.run(spark, f"{base}/files/legacy", *args, force=True)


def _family():
    return F.split("source_file", "-")[1].alias("family")


@query("S1", "S2", "S3", "S8", "S21", "J1", "F2", "F3", sql=f"""WITH {_ETL_RAW} SELECT family, ride, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, CAST(duration_sec AS BIGINT) AS duration_sec, member_casual, start_station_id, start_station_name,
 round(start_lat, 6) AS start_lat, start_match_type, end_station_id, end_station_name, end_match_type FROM judged WHERE reason IS NULL""")
def trip_etl_end_to_end(spark, sf):
    """Raw files of three families to canonical trips, with files skipped, forced and replaced on the way."""
    t = _etl_result(spark, sf).trips
    return t.select(_family(), F.coalesce("bike_id", "ride_id").alias("ride"), F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"), "duration_sec", "member_casual",
                    "start_station_id", "start_station_name", r("start_lat").alias("start_lat"), "start_match_type", "end_station_id", "end_station_name", "end_match_type")


_ETL_REASONS = ("missing_station", "duration_too_short", "duration_too_long", "wrong_month", "test_station")


@query("A10", "S21", "F1", sql=f"""WITH {_ETL_RAW} SELECT family, count(*) AS rows_in, count(*) FILTER (WHERE reason IS NULL) AS rows_out, """
       + ", ".join(f"count(*) FILTER (WHERE reason = '{n}') AS first_{n}" for n in _ETL_REASONS) + " FROM judged GROUP BY 1")
def trip_etl_accounting(spark, sf):
    """What the ETL kept and dropped, per family, from the written rows."""
    acc = _etl_result(spark, sf).accounting()
    return acc.groupBy(_family()).agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_out", *(f"first_{n}" for n in _ETL_REASONS))])


def _grown_file_result(spark, sf):
    """Two folders with files of the same names, one of an unknown header; the files of the first folder grow between two runs."""
    from ..plans import trip_etl
    from ..sources import sinks, trips as trip_source
    base = f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}"
    t, k, (text, forms) = v.trips(spark, sf), F.col("ride_id"), _raw_cells()
    form, rider = forms["modern"]
    cells = {**text, "start_id": F.when(k % 31 != 0, form(F.col("start_station_id").cast("string"))), "end_id": form(F.col("end_station_id").cast("string")), "rider": rider,
             "start_name": F.when(k % 13 == 0, F.concat(F.lit('Pier "7",\n'), text["start_name"])).otherwise(text["start_name"])}
    rows = t.select(k.alias("__k"), *[cells[c].alias(x) for c, x in trip_source.MODERN.items()])

    def put(folder: str, part, columns=()) -> None:
        chosen = rows.filter(part).drop("__k")
        sinks.write_csv(chosen.select(*columns) if columns else chosen, f"{base}/{folder}")
        _named_files(spark, f"{base}/{folder}", "modern")

    def run():
        return trip_etl.run(spark, f"{base}/files", f"{base}/trips", v.crosswalk(spark, sf), v.current_stations(spark, sf))

    put("files/near", F.col("__k") % 4 == 0)
    put("files/far", F.col("__k") % 4 == 1)
    put("files/odd", F.col("__k") % 4 == 3, ["started_at", "ended_at"])
    run()
    put("files/near", F.col("__k") % 4 != 1)  # replaces the folder's files
    return run()


@query("S1", "S3", "S5", "S9", "S21", "A10", sql=f"""WITH {v.TRIPS}
SELECT 'near' AS folder, 'processed' AS status, count(*)::BIGINT AS rows_in, count(*) FILTER (WHERE ride_id % 31 = 0)::BIGINT AS missing_station, count(*) FILTER (WHERE duration_sec < 90)::BIGINT AS duration_too_short FROM trips WHERE ride_id % 4 <> 1
UNION ALL SELECT 'far', 'processed', count(*), count(*) FILTER (WHERE ride_id % 31 = 0), count(*) FILTER (WHERE duration_sec < 90) FROM trips WHERE ride_id % 4 = 1
UNION ALL SELECT 'odd', 'unknown_header', 0, 0, 0""")
def trip_etl_versions(spark, sf):
    """Grown files replace their rows, equal names in two folders stay apart, files of an unknown header are accounted for."""
    acc = _grown_file_result(spark, sf).accounting()
    folder = F.element_at(F.split("source_path", "/"), -2).alias("folder")
    return acc.groupBy(folder, "status").agg(*[F.sum(c).cast("long").alias(c) for c in ("rows_in", "missing_station", "duration_too_short")])


@query("S1", "S3", sql="""WITH x AS (SELECT o_orderkey, o_orderkey % 7 AS bucket, CASE o_orderkey % 5 WHEN 0 THEN 'plain' WHEN 1 THEN 'one, two' WHEN 2 THEN 'said "' || o_orderkey || '",' || chr(10) || 'then left'
    WHEN 3 THEN chr(10) || chr(10) || '"' ELSE '"",' || chr(10) || '"' || o_custkey || '"' || chr(10) END AS note FROM orders)
SELECT bucket, count(*) AS records, sum(length(note))::BIGINT AS characters, sum(o_orderkey)::BIGINT AS keys, max(note) AS last_note FROM x GROUP BY 1""")
def quoted_records(spark, sf):
    """CSV records with commas, doubled quotes and line breaks inside cells, from files cut into many splits."""
    from ..sources import records, sinks
    folder = f"{shared_dir(spark)}/quoted-{uuid.uuid4().hex}"
    o, key = table(spark, sf, "orders"), F.col("o_orderkey")
    note = (F.when(key % 5 == 0, "plain").when(key % 5 == 1, "one, two").when(key % 5 == 2, F.concat(F.lit('said "'), key.cast("string"), F.lit('",\nthen left')))
            .when(key % 5 == 3, '\n\n"').otherwise(F.concat(F.lit('"",\n"'), F.col("o_custkey").cast("string"), F.lit('"\n'))))
    sinks.write_csv(o.select(key.cast("string").alias("key"), note.alias("note"), (key % 7).cast("string").alias("bucket")), folder)
    paths = [r.path for r in manifest.list_files(spark, folder).select("path").toLocalIterator()]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = records.read_records(spark, paths)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    cells = F.from_csv("record", "key string, note string, bucket string", {"escape": '"'})
    rows = found.select(cells.alias("c")).select("c.*").filter("key != 'key'")
    return rows.groupBy(F.col("bucket").cast("long").alias("bucket")).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length("note")).alias("characters"), F.sum(F.col("key").cast("long")).alias("keys"), F.max("note").alias("last_note"))


@query("S17", "P44", sql="""WITH x AS (SELECT l_orderkey % 16 AS part, l_linenumber AS n, count(*) AS c, sum(l_orderkey)::BIGINT AS k FROM lineitem GROUP BY ALL)
SELECT part::BIGINT AS part, sum(c)::BIGINT AS lines, sum(k)::BIGINT AS keys FROM x GROUP BY 1""")
def lines_after_headings(spark, sf):
    """Text files whose first three lines are headings, read without them, however the files are split."""
    folder = f"{shared_dir(spark)}/headed-{uuid.uuid4().hex}"
    li = table(spark, sf, "lineitem").withColumn("part", F.col("l_orderkey") % 16)
    line = F.concat_ws(",", F.col("part").cast("string"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    heads = spark.range(16).select(F.col("id").alias("part"), F.explode(F.array(*[F.lit(x) for x in ("0,Survey", "0,Date", "")])).alias("value"), F.lit(0).alias("first"))
    body = li.select("part", line.alias("value"), F.lit(1).alias("first"))
    rows = heads.unionByName(body).repartition(16, "part").sortWithinPartitions("part", "first")
    rows.select("part", "value").write.partitionBy("part").text(folder)
    p = F.split("line", ",")
    found = tables.read_lines(spark, f"{folder}/*", 3).select(p[0].cast("long").alias("part"), p[1].cast("long").alias("key"))
    return found.groupBy("part").agg(F.count(F.lit(1)).alias("lines"), F.sum("key").alias("keys"))


@query("S19", "A48", sql="""SELECT (n_regionkey + 1)::VARCHAR AS line_name, count(*)::BIGINT AS stops, sum(o)::BIGINT AS calls, min('0' || n_nationkey) AS first_stop FROM nation
JOIN (SELECT o_custkey % 25 AS n_nationkey, count(*) AS o FROM orders GROUP BY 1) USING (n_nationkey) GROUP BY n_regionkey""")
def schedule_files(spark, sf):
    """Schedule CSV files written from the tables and read as text columns: ids keep their zeros, missing columns are NULL."""
    from ..sources import sinks
    base = f"{shared_dir(spark)}/schedule-{uuid.uuid4().hex}"
    n, o = table(spark, sf, "nation"), table(spark, sf, "orders")
    stop, line = F.concat(F.lit("0"), F.col("n_nationkey").cast("string")), (F.col("n_regionkey") + 1).cast("string")
    sinks.write_csv(n.select(stop.alias("stop_id"), F.col("n_name").alias("stop_name"), F.lit("40.7").alias("stop_lat")), f"{base}/stops.txt")
    sinks.write_csv(n.select(line.alias("route_id"), line.alias("route_short_name"), F.lit("1").alias("route_type")).distinct(), f"{base}/routes.txt")
    key = F.col("o_custkey") % 25
    trips = o.join(n, key == F.col("n_nationkey")).select(F.col("o_orderkey").cast("string").alias("trip_id"), line.alias("route_id"), stop.alias("stop_id"), F.lit("wk").alias("service_id"))
    sinks.write_csv(trips.select("trip_id", "route_id", "service_id"), f"{base}/trips.txt")
    sinks.write_csv(trips.select("trip_id", "stop_id", F.lit("25:01:00").alias("arrival_time")), f"{base}/stop_times.txt")
    sinks.write_csv(spark.range(1).select(F.lit("wk").alias("service_id"), F.lit("1").alias("monday")), f"{base}/calendar.txt")
    g = feeds.read_gtfs(spark, base)
    calls = g["stop_times"].join(g["trips"], "trip_id").join(g["routes"], "route_id").filter(F.col("route_type") == "1")
    return calls.groupBy(F.col("route_short_name").alias("line_name")).agg(
        F.countDistinct("stop_id").alias("stops"), F.count(F.lit(1)).alias("calls"), F.min("stop_id").alias("first_stop"))


@query("S22", sql=f"""WITH {_NAMES} SELECT DISTINCT file_name FROM nm ORDER BY file_name LIMIT 7""")
def first_file_names(spark, sf):
    """The first files by name, as a run with a limit takes them."""
    return manifest.first_files(_file_names(spark, sf).select("file_name").distinct(), 7)


@query("S24", sql="""WITH f AS (SELECT k, CASE WHEN k % 4 = 3 THEN k - 1 ELSE k END AS content FROM (SELECT DISTINCT o_orderkey % 12 AS k FROM orders))
SELECT count(DISTINCT content)::BIGINT AS files, (SELECT count(*) FROM f)::BIGINT AS found, sum(CASE WHEN k = content THEN 1 ELSE 0 END)::BIGINT AS names FROM f""")
def hashed_files(spark, sf):
    """A manifest by content: files of equal bytes count once, whatever their names and folders."""
    folder = f"{shared_dir(spark)}/hashed-{uuid.uuid4().hex}"
    k = F.col("o_orderkey") % 12
    o = table(spark, sf, "orders").select(k.alias("k"), "o_orderkey")
    copies = o.withColumn("part", F.explode(F.when(F.col("k") % 4 == 2, F.array(F.col("k"), F.col("k") + 1)).when(F.col("k") % 4 == 3, F.array().cast("array<bigint>")).otherwise(F.array("k"))))
    copies.repartition(12, "part").sortWithinPartitions("part", "o_orderkey").select("part", F.col("o_orderkey").cast("string").alias("value")).write.partitionBy("part").text(folder)
    files = manifest.content_hashes(spark, folder, "*.txt")
    kept = manifest.without_duplicates(files)
    return kept.agg(F.count(F.lit(1)).alias("files"), F.lit(files.count()).cast("long").alias("found"), F.countDistinct("path").alias("names"))
