from __future__ import annotations

import hashlib
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quartermet.layout import Layout
from quartermet.model import CURATED_TABLES, PRODUCT_SCHEMAS, product_schema
from quartermet.operators import cleaning, quality
from quartermet.plans import jobs
from quartermet.sinks import tables
from quartermet.sources import archives, listing, observations, staged, stations
from quartermet.streaming import runs
from tests.util import one

AIR = "STATIONS_ID;MESS_DATUM;QN_9;TT_TU;RF_TU;eor\n"


def write(path, text, encoding="ISO-8859-1"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def air_lines(station, hours, qn=5, day="20230101"):
    return "".join(f"{station:>5};{day}{h:02d};   {qn};  {h}.5;  80.0;eor\n" for h in hours)


def test_one_file(spark, tmp_path):
    write(tmp_path / "a.txt", AIR + air_lines(433, range(3)))
    df = observations.read_observations(spark, str(tmp_path / "a.txt"), "air_temperature")
    rows = df.orderBy("MESS_DATUM").collect()
    assert [r.TT_TU for r in rows] == [0.5, 1.5, 2.5]
    assert rows[0].timestamp == datetime(2023, 1, 1, 0) and rows[0].STATIONS_ID == 433
    assert rows[0]._source_file.endswith("a.txt")


def test_tree_of_files_and_path_columns(spark, tmp_path):
    zone = Layout(str(tmp_path))
    for s in (1, 2):
        file = f"station_{s:05d}/2023/produkt_{s}.txt"
        write(tmp_path / "raw/dwd/air_temperature" / file, AIR + air_lines(s, range(2)))
        write(tmp_path / "raw/dwd/air_temperature" / f"station_{s:05d}/2023/readme.md", "x")
    df = observations.read_observations(spark, zone.raw("air_temperature"), "air_temperature")
    assert df.count() == 4
    objects = observations.list_objects(spark, zone.raw("air_temperature"), "*.txt")
    got = {tuple(r) for r in objects.select("path_variable", "path_station", "path_year").collect()}
    assert got == {("air_temperature", "00001", "2023"), ("air_temperature", "00002", "2023")}
    lacking = {r[0] for r in quality.missing_products(objects).collect()}
    assert lacking == {"precipitation", "wind", "pressure", "moisture"}


def test_bad_cells_become_null(spark, tmp_path):
    write(tmp_path / "a.txt", AIR + "433;2023010100;x;1.0;eor\n433;20230101;5;2.0;3.0;eor\n\n")
    df = observations.read_observations(spark, str(tmp_path), "air_temperature")
    rows = {r.MESS_DATUM: r for r in df.collect()}
    assert rows["2023010100"].QN_9 is None and rows["20230101"].timestamp is None


@pytest.mark.parametrize("product", sorted(PRODUCT_SCHEMAS))
def test_every_product_has_a_schema(spark, tmp_path, product):
    names = product_schema(product).names
    write(tmp_path / "f.txt", ";".join(names) + "\n" + "7;2023010105;5;" + ";".join("1" * (len(names) - 3)) + "\n")
    r = one(observations.read_observations(spark, str(tmp_path), product))
    assert r["timestamp"] == datetime(2023, 1, 1, 5) and r[names[3]] == 1
    with pytest.raises(ValueError):
        observations.read_observations(spark, str(tmp_path), "snow")


def test_archives_skip_metadata_members(spark, tmp_path):
    folder = tmp_path / "z"
    folder.mkdir()
    for s in (1, 2):
        with zipfile.ZipFile(folder / f"s{s}.zip", "w") as z:
            z.writestr("Metadaten.txt", "Stations_id;x\n1;2\n")
            z.writestr("produkt.txt", AIR + air_lines(s, range(24)))
    df = archives.read_archives(spark, str(folder), "air_temperature")
    assert df.count() == 48
    assert df.where("timestamp IS NULL").count() == 0
    assert df.select("_source_file").distinct().count() == 2


def test_archive_batches_keep_all_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "LINES_PER_BATCH", 7)
    content = tmp_path / "a.zip"
    with zipfile.ZipFile(content, "w") as z:
        z.writestr("p.txt", AIR + air_lines(1, range(24)))
    got = [line for _, lines in archives._member_lines(content.read_bytes()) for line in lines]
    assert len(got) == 24 and got[0].strip().startswith("1;2023010100")


def test_checksums(spark, tmp_path):
    for name, data in (("a.zip", b"one"), ("b.zip", b"two"), ("c.zip", b"three"), ("d.zip", b"four")):
        (tmp_path / name).write_bytes(data)
    write(tmp_path / "a.zip.sha256", hashlib.sha256(b"one").hexdigest() + "  a.zip\n")
    write(tmp_path / "b.zip.sha256", hashlib.sha256(b"other").hexdigest() + "  b.zip\n")
    write(tmp_path / "c.zip.md5", hashlib.md5(b"three").hexdigest().upper())
    files = archives.read_files(spark, str(tmp_path))
    sides = archives.read_files(spark, str(tmp_path), "*.{sha256,md5}")
    bad = archives.checksum_mismatches(files, sides).collect()
    assert [r.path.rsplit("/", 1)[1] for r in bad] == ["b.zip"]


def test_listing(spark):
    html = "\n".join([
        '<a href="../">../</a>',
        '<a href="stundenwerte_TU_00433_20230101_20231231_hist.zip">x</a>',
        '<a href="stundenwerte_RR_01766_19950901_20231231_hist.zip">x</a>  <a href="y.zip">',
        '<a href="stundenwerte_TU_00433_20230101_20231231_hist.txt">x</a>',
        '<a href="TU_Stundenwerte_Beschreibung_Stationen.txt">x</a>',
        '<a href="stundenwerte_XX_00001_20230101_20231231_hist.zip">x</a>',
    ])
    df = listing.parse_listing(spark.createDataFrame([(html,), ("",)], "html string"))
    got = {(r.variable, r.station_id, r.year) for r in df.collect()}
    assert got == {("air_temperature", "00433", "2023"), ("precipitation", "01766", "1995")}
    assert listing.restrict_stations(df, ["00433"]).count() == 1
    loaded = df.where("variable = 'precipitation'").select("object_path")
    assert listing.skip_loaded(df, loaded).count() == 1
    states = {r.variable: r.status for r in listing.with_status(df, loaded).collect()}
    assert states == {"air_temperature": "processed", "precipitation": "skipped"}


def test_station_list(spark, tmp_path):
    write(
        tmp_path / "stations.txt",
        "Stations_id;von_datum;bis_datum;Stationshoehe;geoBreite;geoLaenge;Stationsname;Bundesland\n"
        "00433;19470101;99999999;553;50.7983;6.0244;Aachen-Orsbach;Nordrhein-Westfalen\n"
        "00044;20070401;20191231;44;52.9336;8.2370;Großenkneten;Niedersachsen\n",
    )
    df = stations.read_station_list(spark, str(tmp_path / "stations.txt"))
    a, b = df.orderBy(F.desc("station_id")).collect()
    assert (a.station_id, a.start_date, a.end_date, a.is_active) == (433, date(1947, 1, 1), None, True)
    assert (b.station_name, b.end_date, b.is_active) == ("Großenkneten", date(2019, 12, 31), False)
    df.write.parquet(str(tmp_path / "p"))
    assert stations.load_stations(spark, str(tmp_path / "p")).columns == [
        "station_id", "station_name", "latitude", "longitude", "elevation_m"
    ]


# -------------------------------------------------------------------- sinks

def staged_air(spark, tmp_path, days=("20230101", "20230401")):
    text = AIR + "".join(air_lines(s, range(24), day=d) for s in (1, 2) for d in days)
    write(tmp_path / "in" / "a.txt", text)
    raw = observations.read_observations(spark, str(tmp_path / "in"), "air_temperature")
    return cleaning.clean(raw, "air_temperature")


def test_staged_table_is_idempotent_and_prunes(spark, tmp_path):
    rows, zone = staged_air(spark, tmp_path), Layout(str(tmp_path))
    path = zone.staged("air_temperature")
    for _ in range(2):
        stats = tables.write_staged(rows, path, "v1")
        assert stats["rows_written"] == 96
    assert staged.load_staged(spark, zone, "air_temperature").count() == 96
    quarter = staged.load_staged(spark, zone, "air_temperature", 2023, 2, "v1")
    assert quarter.count() == 48
    plan = quarter._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "quarter" in plan.split("PartitionFilters")[1][:300]
    m = one(tables.table_statistics(spark.read.parquet(path)))
    assert (m["total_rows"], m["distinct_stations"], m["files"]) == (96, 2, 2)
    assert m["max_timestamp"] == datetime(2023, 4, 1, 23)


def test_write_modes(spark, tmp_path):
    rows, path = staged_air(spark, tmp_path), str(tmp_path / "t")
    tables.write_staged(rows, path, "v1")
    tables.write_staged(rows, path, "v1", mode="append")
    assert spark.read.parquet(path).count() == 192
    first = rows.where("quarter = 1")
    tables.write_staged(first, path, "v1")  # only its own quarter is replaced
    assert spark.read.parquet(path).groupBy("quarter").count().orderBy("quarter").collect() == [(1, 48), (2, 96)]
    tables.write_staged(first, path, "v1", mode="replace")
    assert spark.read.parquet(path).count() == 48
    with pytest.raises(Exception):
        tables.write_staged(rows, path, "v1", mode="error")
    with pytest.raises(ValueError):
        tables.write_staged(rows, path, "v1", mode="other")
    with pytest.raises(ValueError):
        tables.write_staged(rows, path, "v1", partition_by=("absent",))
    tables.write_by_station(rows, str(tmp_path / "s"), "v1")
    assert (tmp_path / "s" / "STATIONS_ID=1" / "year=2023").is_dir()


def test_version_column_is_kept(spark, tmp_path):
    rows = staged_air(spark, tmp_path).withColumn("dataset_version", F.lit("mine"))
    tables.write_staged(rows, str(tmp_path / "t"), "other")
    assert spark.read.parquet(str(tmp_path / "t")).select("dataset_version").distinct().collect() == [("mine",)]


def feature_rows(spark, values):
    return spark.createDataFrame(
        [(s, y, q, f"{y}Q{q}_v1", v) for s, y, q, v in values],
        "station_id int, year int, quarter int, dataset_version string, v int",
    )


def contents(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("station_id", "year", "quarter", "v").collect())


def test_upsert_and_delete(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = feature_rows(spark, [(1, 2023, 1, 1), (2, 2023, 1, 1), (1, 2023, 2, 1), (1, 2023, 3, 1)])
    for _ in range(2):
        tables.upsert_features(rows, path)
    assert len(contents(spark, path)) == 4
    # The second quarter is redone, the third comes out empty, the first is untouched.
    targets = [("2023Q2_v1", 2023, 2), ("2023Q3_v1", 2023, 3), ("2023Q4_v1", 2023, 4)]
    tables.upsert_features(feature_rows(spark, [(1, 2023, 2, 9)]), path, targets)
    assert contents(spark, path) == [(1, 2023, 1, 1), (1, 2023, 2, 9), (2, 2023, 1, 1)]
    tables.delete_features(spark, path, ("2023Q1_v1", 2023, 1), station_id=1)
    assert contents(spark, path) == [(1, 2023, 2, 9), (2, 2023, 1, 1)]
    tables.delete_features(spark, path, ("2023Q1_v1", 2023, 1), station_id=2)
    assert contents(spark, path) == [(1, 2023, 2, 9)]
    tables.delete_features(spark, path, ("2023Q2_v1", 2023, 2))
    assert not (tmp_path / "f" / "dataset_version=2023Q2_v1" / "year=2023" / "quarter=2").exists()
    with pytest.raises(ValueError):
        tables.delete_features(spark, path, ("../x", 2023, 2))


# --------------------------------------------------------------------- jobs

def raw_zone(tmp_path):
    for s in (1, 2):
        text = AIR + "".join(air_lines(s, range(24), day=d) for d in ("20230101", "20230102", "20230401"))
        write(tmp_path / f"raw/dwd/air_temperature/station_{s:05d}/2023/p.txt", text)
    return Layout(str(tmp_path))


def test_stage_then_curate(spark, tmp_path):
    zone = raw_zone(tmp_path)
    done = jobs.stage(spark, zone, "air_temperature", version="2023_staged_v1")
    assert done["status"] == "success"
    assert (done["metrics"]["rows_written"], done["metrics"]["rows_rejected"]) == ("144", "0")
    known = spark.createDataFrame(
        [(1, "One", 50.0, 6.0, 553)],
        "station_id int, station_name string, latitude double, longitude double, elevation_m int",
    )
    for _ in range(2):  # the second run replaces the first
        jobs.curate(spark, zone, "air_temperature", known, version="v7")
    out = spark.read.parquet(zone.curated("temperature"))
    assert out.count() == 4
    assert {c.name for c in CURATED_TABLES["temperature"]} < set(out.columns)
    r = out.where("station_id = 1 AND quarter = 1").first()
    assert (float(r.mean_temp_c), r.station_name, r.dataset_version) == (12.0, "One", "v7")
    assert r.quarter_end == datetime(2023, 3, 31, 23, 59, 59)
    assert out.where("station_id = 2").first().station_name is None
    # One quarter only.
    jobs.curate(spark, zone, "air_temperature", known, year=2023, quarter=2, version="v8")
    assert spark.read.parquet(zone.curated("temperature")).count() == 6
    log = spark.read.parquet(zone.log("runs"))
    assert log.where("status = 'success'").count() == 4
    edges = spark.read.parquet(zone.log("lineage")).distinct().collect()
    assert ("curated_temperature_features:v7", "staged_temperature:2023_staged_v1", "aggregation") in edges
    versions = spark.read.parquet(zone.log("versions"))
    assert versions.where("status = 'available' AND version = 'v8'").first().record_count == 2


def test_failures_are_recorded_and_do_not_stop_a_batch(spark, tmp_path):
    zone = raw_zone(tmp_path)
    done = jobs.stage_products(spark, zone, ["air_temperature", "wind"])
    assert done["air_temperature"]["status"] == "success" and done["wind"]["status"] == "failed"
    log = spark.read.parquet(zone.log("runs"))
    assert log.where("status = 'failed' AND error IS NOT NULL").count() == 1
    write(tmp_path / "raw/dwd/wind/station_00001/2023/p.txt", "STATIONS_ID;MESS_DATUM;QN_3;F;D\n" + "1;bad;5;1;1\n" * 3)
    with pytest.raises(quality.QualityError):
        jobs.stage(spark, zone, "wind")
    with pytest.raises(ValueError):
        jobs.curate(spark, zone, "cloud_cover", None)


def test_incremental_load_reads_new_files_once(spark, tmp_path):
    zone = Layout(str(tmp_path))
    raw = tmp_path / "raw/dwd/air_temperature"
    args = (spark, zone.raw("air_temperature"), "air_temperature", zone.staged("air_temperature"), zone.log("load"))
    write(raw / "a.txt", AIR + air_lines(1, range(24)))
    assert runs.load_new_files(*args) == 24
    assert runs.load_new_files(*args) == 0
    write(raw / "station_00002/2023/b.txt", AIR + air_lines(2, range(12)))
    assert runs.load_new_files(*args) == 12
    assert staged.load_staged(spark, zone, "air_temperature", 2023, 1).count() == 36


def test_incremental_load_and_staging_share_a_table(spark, tmp_path):
    zone = Layout(str(tmp_path))
    raw = tmp_path / "raw/dwd/air_temperature"
    args = (spark, zone.raw("air_temperature"), "air_temperature", zone.staged("air_temperature"), zone.log("load"))
    write(raw / "a.txt", AIR + air_lines(1, range(24)) + "1;bad;5;1;1\n" * 3)
    assert runs.load_new_files(*args) == 24  # the three lines are left out
    jobs.stage(spark, zone, "air_temperature")
    write(raw / "b.txt", AIR + air_lines(2, range(12)))
    assert runs.load_new_files(*args) == 12
    rows = staged.load_staged(spark, zone, "air_temperature")
    assert (rows.count(), rows.where("dataset_version IS NULL").count()) == (36, 0)
    jobs.stage(spark, zone, "air_temperature")
    assert staged.load_staged(spark, zone, "air_temperature").count() == 36
    write(raw / "c.txt", AIR + air_lines(3, range(2)) + "1;bad;5;1;1\n" * 9)
    with pytest.raises(Exception, match="did not parse"):
        runs.load_new_files(*args)
    assert staged.load_staged(spark, zone, "air_temperature").count() == 36


def test_a_failing_run_leaves_staged_rows(spark, tmp_path):
    zone = Layout(str(tmp_path))
    raw = tmp_path / "raw/dwd/air_temperature"
    write(raw / "a.txt", AIR + air_lines(1, range(24)))
    jobs.stage(spark, zone, "air_temperature", version="v1")
    write(raw / "b.txt", AIR + "1;bad;5;1;1\n" * 22)
    with pytest.raises(quality.QualityError):
        jobs.stage(spark, zone, "air_temperature", version="v1")
    assert staged.load_staged(spark, zone, "air_temperature").count() == 24


def test_errors_are_recorded_whole(spark, tmp_path):
    zone = Layout(str(tmp_path))

    def fail():
        raise ValueError("x" * 5000)

    with pytest.raises(ValueError):
        jobs._recorded(spark, zone, "stage", "wind", None, fail)
    assert len(spark.read.parquet(zone.log("runs")).first().error) == 5000


def test_curated_names_want_one_staged_version_and_true_lineage(spark, tmp_path):
    zone = raw_zone(tmp_path)
    known = spark.createDataFrame([], "station_id int, station_name string, latitude double, longitude double, elevation_m int")
    for version in ("s_v1", "s_v2"):
        jobs.stage(spark, zone, "air_temperature", version=version)
    with pytest.raises(ValueError, match="several staged versions"):
        jobs.curate(spark, zone, "air_temperature", known, version="v1")
    for _ in range(2):
        jobs.curate(spark, zone, "air_temperature", known, staged_version="s_v1", version="c_v1")
    jobs.curate(spark, zone, "air_temperature", known, staged_version="s_v2", version="c_v2")
    edges = {(r.child_id, r.parent_id) for r in spark.read.parquet(zone.log("lineage")).collect()}
    child = "curated_temperature_features:c_v"
    assert edges == {(f"{child}{i}", f"staged_temperature:s_v{i}") for i in (1, 2)}
    assert spark.read.parquet(zone.log("lineage")).count() == 2
    events = spark.read.parquet(zone.log("versions")).groupBy("version").count().collect()
    assert {r.version: r["count"] for r in events} == {"c_v1": 4, "c_v2": 2}  # two quarters in each run


def test_layout_rejects_unknown_names():
    zone = Layout("/x")
    for call in (zone.raw, zone.staged, zone.curated):
        with pytest.raises(ValueError):
            call("nothing")


def test_upsert_of_nothing_empties_its_targets(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = feature_rows(spark, [(1, 2023, 1, 1), (1, 2023, 2, 1)])
    tables.upsert_features(rows, path)
    tables.upsert_features(rows.where("false"), path, [("2023Q1_v1", 2023, 1)])
    assert contents(spark, path) == [(1, 2023, 2, 1)]
    tables.upsert_features(rows.where("v > 5"), path, [("2023Q2_v1", 2023, 2)])
    left = list((tmp_path / "f").glob("dataset_version=*/year=*/quarter=*"))
    assert left == []
