"""Readers, manifests, sinks, the ETL and incremental ingest on files written by the tests."""

from __future__ import annotations

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from pedalmill.operators import quality
from pedalmill.operators.layers import layer_checks
from pedalmill.operators.spatial import polygon_area
from pedalmill.plans import crosswalk as crosswalk_plan
from pedalmill.plans import trip_etl
from pedalmill.sources import feeds, ledger, manifest, sinks, tables, trips
from pedalmill.streaming.ingest import ingest_folder, ingest_new, raw_stream

MODERN = "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
LEGACY = ('tripduration,starttime,stoptime,start station id,start station name,start station latitude,start station longitude,'
          'end station id,end station name,end station latitude,end station longitude,bikeid,usertype,birth year,gender')
TITLE = ('Trip Duration,Start Time,Stop Time,Start Station ID,Start Station Name,Start Station Latitude,Start Station Longitude,'
         'End Station ID,End Station Name,End Station Latitude,End Station Longitude,Bike ID,User Type,Birth Year,Gender')


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture
def raw(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    write(d / "202401-bikeshare-tripdata.csv", MODERN,
          "A,electric_bike,2024-01-01 13:00:04.563,2024-01-01 13:04:04.652,3 St,m-1,Carroll,4225.14,40.67,-73.98,40.68,-73.99,casual",
          "B,classic_bike,2024-01-02 10:00:00.000,2024-01-02 10:01:29.000,3 St,m-1,Carroll,4225.14,40.67,-73.98,40.68,-73.99,member",
          "C,classic_bike,2024-02-01 10:00:00.000,2024-02-01 10:30:00.000,3 St,m-1,Carroll,4225.14,40.67,-73.98,NULL,-73.99,member",
          "D,classic_bike,2024-01-03 10:00:00.000,2024-01-03 10:30:00.000,Warehouse 3,4225.15,Carroll,,40.67,-73.98,40.1,-73.99,member",
          "E,classic_bike,2024-01-03 10:00:00.000,2024-01-03 10:30:00.000,Warehouse 3,77,Carroll,4225.14,40.67,-73.98,40.1,-73.99,member",
          "F,classic_bike,2024-01-03 10:00:00.000,2024-01-03 10:30:00.000,A,77,Carroll,4225.14,40.67,-73.98,40.1,-73.99,member,extra,cells",
          "G,classic_bike,soon,2024-01-03 10:30:00.000,A,77,Carroll,4225.14,40.67,-73.98,40.1,-73.99,member")
    write(d / "201409-bikeshare-tripdata.csv", LEGACY,
          '471,9/1/2014 00:00:25,9/1/2014 00:08:16,519.0,Old Pl,40.75,-73.97,263,"Elizabeth, Hester",40.71,-73.99,16379,Subscriber,1986,1',
          "14401,9/2/2014 00:00:25,9/2/2014 04:08:16,519,Old Pl,40.75,-73.97,263,E,40.71,-73.99,16379,Customer,,0",
          "100,9/3/2014 0:05,9/3/2014 0:07,600,Unknown,40.75,-73.97,519,E,40.71,-73.99,16380,Customer,1890,0")
    write(d / "201409-bikeshare-tripdata_1.csv", LEGACY,
          "471,9/1/2014 00:00:25,9/1/2014 00:08:16,519.0,Old Pl,40.75,-73.97,263,E,40.71,-73.99,16379,Subscriber,1986,1")
    write(d / "201610-bikeshare-tripdata.csv", TITLE,
          "200,2016-10-01 00:00:07,2016-10-01 00:03:27,519,Old Pl,40.75,-73.97,263,E,40.71,-73.99,1,Subscriber,1969.0,2")
    write(d / "notes.csv", "a,b", "1,2")
    return d


@pytest.fixture
def reference(spark):
    cw = spark.createDataFrame([("519", "Old Place", 40.75, -73.97, 9, "m-9", "New Place", 95.0, "high", 3.0),
                                ("263", "Ghost Ln", 40.71, -73.99, 9, "", "", 0.0, "none", 0.0)],
                               "legacy_id string, legacy_name string, legacy_lat double, legacy_lon double, trip_count long, modern_id string, "
                               "modern_name string, match_score double, match_confidence string, match_distance_m double")
    cur = spark.createDataFrame([("m-1", "", "3 St & 3 Ave", 40.675, -73.9877, 10, ""), ("m-9", "", "New Place N", 40.751, -73.971, 10, "")],
                                "station_id string, short_name string, name string, lat double, lon double, capacity int, region_id string")
    return cw, cur


def test_manifest(spark, raw):
    files = manifest.trip_files(spark, str(raw))
    got = {r.file_name: (r.family, r.expected.year, r.expected.month) for r in files.collect()}
    assert got == {"202401-bikeshare-tripdata.csv": ("modern", 2024, 1), "201409-bikeshare-tripdata.csv": ("legacy", 2014, 9),
                   "201409-bikeshare-tripdata_1.csv": ("legacy", 2014, 9), "201610-bikeshare-tripdata.csv": ("legacy_titlecase", 2016, 10),
                   "notes.csv": ("unknown", None, None)}
    kept = {r.file_name for r in manifest.without_superseded(files).collect()}
    assert kept == set(got) - {"201409-bikeshare-tripdata_1.csv"}
    assert {r.file_name for r in manifest.of_years(files, [2016]).collect()} == {"201610-bikeshare-tripdata.csv"}
    done = files.filter("file_name like '2014%'")
    assert {r.file_name for r in manifest.pending(files, done).collect()} == {"202401-bikeshare-tripdata.csv", "201610-bikeshare-tripdata.csv", "notes.csv"}
    assert manifest.pending(files, done, force=True).count() == 5
    assert {r.file_name: r.approx_rows for r in manifest.row_counts(spark, str(raw)).collect()}["202401-bikeshare-tripdata.csv"] == 7
    assert [r.file_name for r in manifest.first_files(files, 2).collect()] == ["201409-bikeshare-tripdata.csv", "201409-bikeshare-tripdata_1.csv"]


def test_content_hashes(spark, raw, tmp_path):
    shutil.copy(raw / "notes.csv", raw / "notes_copy.csv")
    other = raw / "sub"
    other.mkdir()
    write(other / "notes.csv", "a,b", "3,4")
    kept = manifest.without_duplicates(manifest.content_hashes(spark, str(raw))).collect()
    assert len(kept) == 6
    names = sorted(r.stored_name for r in kept if r.stored_name.startswith("notes"))
    assert len(names) == 2 and names[0] == "notes.csv" and names[1].startswith("notes_")


def test_etl_end_to_end(spark, raw, reference, tmp_path):
    cw, cur = reference
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    result = trip_etl.run(spark, str(raw), out, cw, cur, log=log, run_id="r1")
    assert result.trips.columns == trip_etl.CANONICAL and len(trip_etl.CANONICAL) == 27
    back = trips.read_processed(spark, out, "nyc", [2014, 2016, 2024])
    rows = {(r.source_file[:4], r.ride_id if r.source_file.startswith("2024") else r.duration_sec): r for r in back.collect()}
    assert set(rows) == {("2024", "A"), ("2014", 471), ("2014", 100), ("2016", 200)}
    a = rows[("2024", "A")]
    assert (a.duration_sec, a.start_station_name, a.start_match_type, a.end_station_id, a.end_match_type) == (240, "3 St & 3 Ave", "direct", "4225.14", "unmatched")
    b = rows[("2014", 471)]
    assert (b.start_station_id, b.start_station_name, b.start_lat, b.start_match_type) == ("m-9", "New Place N", 40.751, "crosswalk")
    assert (b.end_station_id, b.end_station_name, b.end_match_type) == ("263", "Ghost Ln", "ghost")
    assert (b.member_casual, b.birth_year_valid, b.age_at_trip, b.gender_valid, b.start_lat_raw) == ("member", True, 28, True, 40.75)
    assert (rows[("2014", 100)].birth_year_valid, rows[("2014", 100)].age_at_trip) == (False, None)
    assert (rows[("2016", 200)].birth_year, rows[("2016", 200)].age_at_trip) == (1969, 47)
    acc = {r.source_file: r.asDict() for r in result.accounting().collect()}
    for r in acc.values():
        assert r["rows_in"] == r["rows_out"] + sum(n for k, n in r.items() if k.startswith("first_"))
    m = acc["202401-bikeshare-tripdata.csv"]
    assert (m["rows_in"], m["rows_out"], m["malformed_row"], m["first_duration_too_short"], m["first_wrong_month"], m["first_missing_station"],
            m["first_test_station"], m["first_invalid_timestamp"]) == (7, 1, 1, 1, 1, 1, 1, 1)
    assert "201409-bikeshare-tripdata_1.csv" not in acc
    assert (acc["notes.csv"]["status"], acc["notes.csv"]["rows_in"]) == ("unknown_header", 0)
    logged = spark.read.json(log)
    assert logged.filter("run = 'r1'").count() == len(acc)
    match = {r.source_file: r for r in result.matches().collect()}
    assert match["201409-bikeshare-tripdata.csv"].crosswalk == 1 and match["201409-bikeshare-tripdata.csv"].unmatched == 1
    # Forcing one month again replaces that month only.
    assert {r.drop_reason for r in result.judged.filter("status = 'dropped'").collect()} >= {"malformed_row", "wrong_month", "test_station"}
    trip_etl.run(spark, str(raw), out, cw, cur, years=[2024], force=True)
    assert spark.read.parquet(out).count() == sum(r["rows_in"] for r in acc.values())
    assert trips.read_processed(spark, out).count() == 4


def test_crosswalk_from_files(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    line = "471,9/1/2014 00:00:25,9/1/2014 00:08:16,{id},{name},{lat},-73.97,263,E,40.71,-73.99,16379,Subscriber,1986,1"
    rows = [line.format(id="519.0" if i % 2 else "519", name="Old Pl" if i else "Typo", lat=40.75 + i * 1e-5) for i in range(11)]
    rows += [line.format(id="600", name="Rare", lat=40.7)] * 9
    write(d / "201409-bikeshare-tripdata.csv", LEGACY, *rows)
    cur = spark.createDataFrame([("m-9", "Old Place", 40.7501, -73.97)], "station_id string, name string, lat double, lon double")
    got = crosswalk_plan.from_files(spark, str(d), cur, out=str(tmp_path / "cw")).collect()
    assert len(got) == 1
    assert (got[0].legacy_id, got[0].legacy_name, got[0].trip_count, got[0].modern_id, got[0].match_confidence) == ("519", "Old Pl", 11, "m-9", "high")
    assert got[0].legacy_lat == pytest.approx(40.75005)
    back = spark.read.option("header", True).csv(str(tmp_path / "cw"))
    assert back.columns[0] == "legacy_id" and back.count() == 1


def test_incremental_ingest_reads_each_file_once(spark, raw, tmp_path):
    src = tmp_path / "legacy"
    src.mkdir()
    shutil.copy(raw / "201409-bikeshare-tripdata.csv", src / "201409-bikeshare-tripdata.csv")
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def good(batch):
        return batch.filter(quality.first_reason(quality.quality_reasons(month_check=True)).isNull()).select("ride_id", "source_file")

    def run():
        ingest_new(raw_stream(spark, str(src), "legacy"), good, out, check).awaitTermination()
        return sorted(r.source_file for r in spark.read.parquet(out).collect())

    assert run() == ["201409-bikeshare-tripdata.csv"] * 2
    assert run() == ["201409-bikeshare-tripdata.csv"] * 2
    shutil.copy(raw / "201409-bikeshare-tripdata_1.csv", src / "201409-bikeshare-tripdata_1.csv")
    assert run() == ["201409-bikeshare-tripdata.csv"] * 2 + ["201409-bikeshare-tripdata_1.csv"]


def test_feeds(spark, tmp_path):
    (tmp_path / "stations.json").write_text(json.dumps({"data": {"stations": [
        {"station_id": "1", "name": "A", "lat": 1.0, "lon": 2.0, "capacity": 5, "extra": 1}, {"station_id": "2", "name": "B", "lat": 1, "lon": 2}]}}))
    got = {r.station_id: (r.short_name, r.capacity, r.region_id) for r in feeds.read_stations(spark, str(tmp_path / "stations.json")).collect()}
    assert got == {"1": ("", 5, ""), "2": ("", 0, "")}
    w = tmp_path / "weather"
    w.mkdir()
    for name, hours in (("a", ["2024-01-01T00:00", "2024-01-01T01:00"]), ("b", ["2024-01-01T01:00", "2024-01-01T02:00"])):
        (w / f"{name}.json").write_text(json.dumps({"hourly": {"time": hours, "weather_code": [1, 2], **{m: [0.5, 1.5] for m in feeds.HOURLY_MEASURES}}}))
    hourly = feeds.read_hourly_weather(spark, str(w)).collect()
    assert [r.datetime.hour for r in hourly] == [0, 1, 2]
    (tmp_path / "sun.json").write_text(json.dumps({"daily": {"time": ["2024-06-01"], "sunrise": ["2024-06-01T05:30"], "sunset": ["2024-06-01T20:15"]}}))
    assert feeds.read_daily_sun(spark, str(tmp_path / "sun.json")).first().daylight_hours == 14.75
    h = spark.createDataFrame([("2024-07-04", "Independence Day (Observed)")], "date string, name string")
    assert tuple(feeds.clean_holidays(h).first())[1:] == ("Independence Day", "observed")
    ferry = spark.createDataFrame([("2024-01-01", "ER", "NB", "Pier 11", "8", "12.0", "WD"), ("2024-01-01", "ER", "NB", "Pier 11", None, "x", "WD")],
                                  "date string, route string, direction string, stop string, hour string, boardings string, typeday string")
    assert sorted((r.hour, r.boardings) for r in feeds.clean_ferry(ferry).collect()) == [(-1, 0), (8, 12)]
    ops = spark.createDataFrame([(" NYWW (Port Imperial FC)",), ("Mystery",)], "operator string")
    assert [r.operator for r in feeds.normalise_operator(ops).collect()] == ["NY Waterway", "Mystery"]


def test_gtfs_keeps_text_ids(spark, tmp_path):
    write(tmp_path / "stops.txt", "stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station", "007,A,40.1,-73.9,1,", "007N,A,40.1,-73.9,,007")
    write(tmp_path / "routes.txt", "route_id,route_short_name,route_long_name,route_type,route_color,route_text_color", "1,1,Bway,1,EE352E,")
    write(tmp_path / "trips.txt", "route_id,trip_id,service_id,shape_id", "1,t1,wk,x")
    write(tmp_path / "stop_times.txt", "trip_id,arrival_time,stop_id", "t1,25:01:00,007N")
    write(tmp_path / "calendar.txt", "service_id,monday,saturday,sunday", "wk,1,0,0")
    g = feeds.read_gtfs(spark, str(tmp_path))
    assert {r.stop_id for r in g["stops"].collect()} == {"007", "007N"} and g["calendar"].first().monday == 1
    assert tuple(g["stop_times"].first()) == ("t1", "007N", "25:01:00")


def test_positional_permits(spark, tmp_path):
    def line(*units, n=17):
        cells = ["x"] * n
        cells[1], cells[4] = " 34 ", "New Jersey"
        for p, u in zip((6, 9, 12, 15), units):
            cells[p] = u
        return ",".join(cells)

    write(tmp_path / "st2010a.txt", "Survey,a", "Date,b", "", line("10", " 2", "", "5"), line("1", "x", "1", "1"), "short,line")
    write(tmp_path / "st2011a.txt", "Survey,a", "Date,b", "", line("1", "1", "1", "1"))
    p = tables.permits(tables.read_lines(spark, str(tmp_path)), tables.STATE_FIELDS, tables.STATE_UNITS, tables.STATE_MIN_FIELDS)
    got = sorted((r.year, r.state_fips, r.state_name, r.total_units, r.small_multi) for r in p.collect())
    assert got == [(2010, "34", "New Jersey", 17, 2), (2011, "34", "New Jersey", 4, 2)]


def test_boundaries(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    (tmp_path / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"BoroCode": 3, "NTA2020": "BK01", "NTAName": "X"}, "geometry": {"type": "Polygon", "coordinates": [ring]}},
        {"type": "Feature", "properties": {"boroname": "Queens", "NTA2020": "QN01"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]}))
    b = tables.read_boundaries(spark, str(tmp_path / "b.geojson"), "nta", "nta_code", "nta_name")
    got = sorted((r.code, r.name or "", len(r.rings), r.borough_name) for r in tables.standard_attributes(b, ["borough_name"]).collect())
    assert got == [("BK01", "X", 1, "Brooklyn"), ("QN01", "", 1, "Queens"), ("QN01", "", 1, "Queens")]
    assert {r.code: r.area_deg2 for r in polygon_area(b).collect()} == {"BK01": 0.5, "QN01": 1.0}
    assert layer_checks(b).first().features == 2
    df = spark.createDataFrame([(1, 2)], "BoroCT2020 int, Shape__Area int")
    assert tables.rename_present(df, {"ct": ["nope", "BoroCT2020"]}, ["Shape__Area", "OBJECTID"]).columns == ["ct"]


def test_written_trips_are_partitioned(spark, tmp_path):
    df = spark.range(10).select(F.timestamp_seconds(F.col("id") * 86400 * 40).alias("started_at"))
    sinks.write_trips(df, str(tmp_path / "t"))
    assert os.path.isdir(tmp_path / "t" / "system=nyc" / "year=1970" / "month=1")
    sinks.write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 10


def part(i, seconds=600, start="2024-01-01 10:00:00.000"):
    end = f"2024-01-01 10:{seconds // 60:02d}:{seconds % 60:02d}.000"
    return f"{i},classic_bike,{start},{end},3 St,m-1,Carroll,4225.14,40.67,-73.98,40.68,-73.99,member"


def test_etl_runs_again_without_doubling(spark, reference, tmp_path):
    cw, cur = reference
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write(raw / "202401-bikeshare-tripdata_1.csv", MODERN, part("A"), part("B", 30))
    write(raw / "202401-bikeshare-tripdata_2.csv", MODERN, part("C"))

    def run(**options):
        acc = trip_etl.run(spark, str(raw), out, cw, cur, **options).accounting().collect()
        return ({r.source_file[-5]: (r.rows_in, r.rows_out) for r in acc}, sorted(r.ride_id for r in trips.read_processed(spark, out).collect()))

    first = ({"1": (2, 1), "2": (1, 1)}, ["A", "C"])
    assert run() == first and run() == first  # finished files are skipped
    write(raw / "202402-bikeshare-tripdata.csv", MODERN, part("D", start="2024-02-01 10:00:00.000").replace("2024-01-01", "2024-02-01"))
    assert run() == ({"1": (2, 1), "2": (1, 1), "a": (1, 1)}, ["A", "C", "D"])
    # a forced run replaces the file's kept and dropped rows and leaves other parts of the month alone
    (raw / "202402-bikeshare-tripdata.csv").unlink()
    (raw / "202401-bikeshare-tripdata_2.csv").rename(tmp_path / "aside.csv")
    write(raw / "202401-bikeshare-tripdata_1.csv", MODERN, part("E"))
    assert run(force=True) == ({"1": (1, 1), "2": (1, 1), "a": (1, 1)}, ["C", "D", "E"])


def test_etl_by_file_version(spark, reference, tmp_path):
    cw, cur = reference
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    (raw / "b").mkdir(parents=True)
    name = "202401-bikeshare-tripdata.csv"
    write(raw / name, MODERN, part("A"), part("B", 30))
    write(raw / "b" / name, MODERN, part("C"))
    write(raw / "202403-odd.csv", "what,ever", "1,2")

    def run(folder=raw, **options):
        acc = trip_etl.run(spark, str(folder), out, cw, cur, **options).accounting().collect()
        got = sorted((r.source_path.removeprefix(f"file:{raw}/"), r.status, r.rows_in, r.rows_out) for r in acc)
        return got, sorted(r.ride_id for r in trips.read_processed(spark, out).collect())

    odd, second = ("202403-odd.csv", "unknown_header", 0, 0), ("b/" + name, "processed", 1, 1)
    assert run() == ([(name, "processed", 2, 1), odd, second], ["A", "C"])
    # a grown file replaces its own rows; the other one of its name stays
    write(raw / name, MODERN, part("A"), part("B", 30), part("D"))
    assert run() == ([(name, "processed", 3, 2), odd, second], ["A", "C", "D"])
    # the same bytes at another time are not read again, nor is anything when a part of the folder is given
    book = ledger.Ledger(spark, out)
    before = {r.path: r.part for r in book.state().collect()}
    os.utime(raw / name, (1e9, 1e9))
    assert run() == run(raw / "b") == ([(name, "processed", 3, 2), odd, second], ["A", "C", "D"])
    assert {r.path: r.part for r in book.state().collect()} == before
    # a file whose header becomes known is read
    write(raw / "202403-odd.csv", MODERN, part("E", start="2024-03-01 10:00:00.000").replace("2024-01-01", "2024-03-01"))
    assert run()[1] == ["A", "C", "D", "E"]
    assert not os.path.exists(f"{out}/_finished") and len(os.listdir(f"{out}/system=nyc/year=2024")) == 2
    assert spark.read.parquet(out).count() == 5


def test_unsplit_file_takes_the_place_of_its_parts(spark, reference, tmp_path):
    cw, cur = reference
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write(raw / "202401-bikeshare-tripdata_1.csv", MODERN, part("A"))
    trip_etl.run(spark, str(raw), out, cw, cur)
    write(raw / "202401-bikeshare-tripdata.csv", MODERN, part("A"), part("B"))
    trip_etl.run(spark, str(raw), out, cw, cur)
    assert sorted(r.ride_id for r in trips.read_processed(spark, out).collect()) == ["A", "B"]
    (raw / "202401-bikeshare-tripdata.csv").rename(tmp_path / "aside.csv")
    trip_etl.run(spark, str(raw), out, cw, cur)  # the part is back, the file that is gone keeps its rows
    assert sorted(r.ride_id for r in trips.read_processed(spark, out).collect()) == ["A", "A", "B"]


def test_rows_of_a_lost_commit_are_invisible(spark, reference, tmp_path, monkeypatch):
    cw, cur = reference
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write(raw / "202401-a.csv", MODERN, part("A"))
    trip_etl.run(spark, str(raw), out, cw, cur)
    write(raw / "202401-b.csv", MODERN, part("B"))
    monkeypatch.setattr(ledger.Ledger, "last", lambda self: 0)  # another writer took number 1
    with pytest.raises(ledger.CommitConflict):
        trip_etl.run(spark, str(raw), out, cw, cur)
    assert [r.ride_id for r in trips.read_processed(spark, out).collect()] == ["A"]
    monkeypatch.undo()
    trip_etl.run(spark, str(raw), out, cw, cur)
    assert sorted(r.ride_id for r in trips.read_processed(spark, out).collect()) == ["A", "B"]


def test_ledger_checkpoints(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "COMPACT_EVERY", 3)
    book = ledger.Ledger(spark, str(tmp_path))
    row = "'nyc' system, 'p{0}' path, 'f' file_name, {1}L length, current_timestamp() modified, 'x' md5, 'modern' family, 'processed' status, 'q' part, 'r' run_id"
    for i in range(1, 6):
        book.commit(spark.sql("SELECT " + row.format(i % 2, i)), i)
    assert sorted(n for n in os.listdir(tmp_path / "_ledger") if n.startswith("check")) == ["checkpoint-000000000003"]
    assert {(r.path, r.length) for r in book.state("nyc").collect()} == {("p0", 4), ("p1", 5)}
    assert book.entries().count() == 4 and book.last() == 5


def test_quoted_line_breaks_in_trip_files(spark, tmp_path):
    broken = part("X").replace("3 St,", '"3 St, ""near""\nthe park",')
    write(tmp_path / "202401-q.csv", MODERN, part("A"), broken.replace("\\n", "\n"), part("B"))
    got = {r.ride_id: r for r in trips.read_files(spark, manifest.trip_files(spark, str(tmp_path))).collect()}
    assert set(got) == {"A", "X", "B"} and got["X"].start_station_name_raw == '3 St, "near"\nthe park'
    assert all(r[trips.CORRUPT] is None for r in got.values())


def test_many_headers_and_column_orders(spark, tmp_path):
    names = MODERN.split(",")
    cells = dict(zip(names, part("X").split(",")))
    for i in range(230):
        order = names[i % 13:] + names[:i % 13]
        line = ",".join(f'"r{i}, x"' if n == "ride_id" else cells[n] for n in order)
        write(tmp_path / f"202401-{i}.csv", ",".join([*order, f"extra{i}"]), line + ",", line)
    got = trips.read_files(spark, manifest.trip_files(spark, str(tmp_path))).collect()
    assert len(got) == 460 and {r.ride_id for r in got} == {f"r{i}, x" for i in range(230)}
    assert {(r.rideable_type, r.duration_sec, r.start_station_id_raw, r.end_lon_raw) for r in got} == {("classic_bike", 600, "m-1", -73.99)}
    assert sum(r[trips.CORRUPT] is not None for r in got) == 230


def test_stream_reads_by_header(spark, raw, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    names = MODERN.split(",")
    swapped = [names[1], names[0], *names[2:]]
    write(src / "202401-a.csv", ",".join(swapped), "classic_bike,R1," + part("x").split(",", 2)[2])
    shutil.copy(raw / "201409-bikeshare-tripdata.csv", src / "201409-bikeshare-tripdata.csv")
    shutil.copy(raw / "notes.csv", src / "notes.csv")
    out = str(tmp_path / "out")
    for _ in range(2):
        ingest_folder(spark, str(src), lambda b: b.select("ride_id", "rideable_type", "duration_sec"), out, str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == 4 and {(r.ride_id, r.rideable_type) for r in got if r.rideable_type} == {("R1", "classic_bike")}
    # the reader for one fixed order refuses another one
    only = tmp_path / "only"
    only.mkdir()
    shutil.copy(src / "202401-a.csv", only / "a.csv")
    with pytest.raises(Exception):
        ingest_new(raw_stream(spark, str(only), "modern"), lambda b: b, str(tmp_path / "o2"), str(tmp_path / "c2")).awaitTermination()
