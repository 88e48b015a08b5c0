"""Archives in one pass, columns by name, versions of a table, presence of columns."""

from __future__ import annotations

import hashlib
import io
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermet.layout import Layout
from quartermet.operators import enrich, quality
from quartermet.plans import jobs
from quartermet.sinks.files import write_files
from quartermet.sinks.tables import read_log, upsert_features
from quartermet.sources import archives, observations, staged

HEAD = "STATIONS_ID;MESS_DATUM;QN_9;TT_TU;RF_TU;eor"


def zipped(*lines: str) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("Metadaten.txt", "x")
        z.writestr("produkt.txt", "\n".join([HEAD, *lines, ""]))
    return buffer.getvalue()


def test_archives_unpack_once(spark, tmp_path):
    good, other = zipped("1;2023010100;9;1.0;2.0;eor"), zipped("2;2023010100;9;1.0;2.0;eor")
    cut = good[:-30]  # without its directory
    content = {"a/good.zip": good, "a/other.zip": other, "cut.zip": cut, "none.zip": zipped()}
    sides = {
        "a/good.zip.sha256": hashlib.sha256(good).hexdigest().encode() + b"  good.zip",
        "a/other.zip.sha256": b"0" * 64,
        "cut.zip.md5": hashlib.md5(cut).hexdigest().encode(),
    }
    files = spark.createDataFrame(list({**content, **sides}.items()), "path string, content binary")
    wrote = write_files(files.repartition(3), f"file:{tmp_path}/files")
    assert wrote == {"files": 7, "bytes": sum(map(len, [*content.values(), *sides.values()]))}
    assert write_files(files, f"{tmp_path}/files") == wrote  # again, as a repeated task does
    assert len([p for p in (tmp_path / "files").rglob("*") if p.is_file()]) == 7

    archives.unpack_archives(archives.read_files(spark, f"{tmp_path}/files"), f"{tmp_path}/unpacked")
    unpacked = spark.read.schema(archives.UNPACKED).parquet(f"{tmp_path}/unpacked")
    name = F.substring_index("path", "/", -1).alias("name")
    digests = {r["name"]: r for r in archives.unpacked_digests(unpacked).select(name, "*").collect()}
    assert {n: r.sha256 for n, r in digests.items()} == {
        p.split("/")[-1]: hashlib.sha256(c).hexdigest() for p, c in content.items()
    }
    assert [n for n, r in digests.items() if r.problem] == ["cut.zip"]
    told = archives.read_files(spark, f"{tmp_path}/files", "*.{sha256,md5}")
    differing = archives.differing(archives.unpacked_digests(unpacked), told)
    assert [r["name"] for r in differing.select(name).collect()] == ["other.zip"]
    whole = sorted(r["value"] for r in archives.unpacked_lines(unpacked).collect())
    assert whole == ["1;2023010100;9;1.0;2.0;eor", "2;2023010100;9;1.0;2.0;eor"]
    checked = [r["value"] for r in archives.unpacked_lines(unpacked, told).collect()]
    assert checked == ["1;2023010100;9;1.0;2.0;eor"]


def test_files_stay_below_their_folder(spark, tmp_path):
    files = spark.createDataFrame([("../out.txt", b"x")], "path string, content binary")
    with pytest.raises(PySparkException, match="is not below the folder"):
        write_files(files, str(tmp_path / "files"))
    empty = spark.createDataFrame([], "path string, content binary")
    assert write_files(empty, str(tmp_path / "files")) == {"files": 0, "bytes": 0}


MOISTURE = [
    ("own", "STATIONS_ID;MESS_DATUM;QN_4;RF_TU;TF_TU;eor"),
    ("own", "00001;2023010100;9; 80.0 ;1.5;eor"),
    ("other", " STATIONS_ID; MESS_DATUM;QN_8;TD;RF_TU;eor"),
    ("other", "2;2023010101;7;-1.5;70;eor"),
    ("other", ""),
    ("other", "x;bad;;;71"),
    ("short", "STATIONS_ID;MESS_DATUM;RF_TU"),
    ("short", "3;2023010102;60;9"),
    ("bare", "4;2023010103;5;50;2.5;eor"),
]


def test_columns_by_name(spark):
    lines = spark.createDataFrame(MOISTURE, "file string, value string")
    rows = observations.parse_named_lines(lines, "moisture", {"TD": "TF_TU"}).collect()
    got = sorted((r.file, r.STATIONS_ID, r.QN_4, r.RF_TU, r.TF_TU, r.timestamp is None) for r in rows if r.STATIONS_ID)
    assert got == [
        ("bare", 4, 5, 50.0, 2.5, False), ("other", 2, 7, 70.0, -1.5, False),
        ("own", 1, 9, 80.0, 1.5, False), ("short", 3, None, 60.0, None, False),
    ]
    broken = [r for r in rows if r.STATIONS_ID is None]
    assert [(r.RF_TU, r.timestamp) for r in broken] == [(71.0, None)]
    found = observations.header_mismatches(lines, "moisture").collect()
    assert sorted((r.file, r.position, r.expected, r.found) for r in found if r.file == "other") == [
        ("other", 3, "QN_4", "QN_8"), ("other", 4, "RF_TU", "TD"), ("other", 5, "TF_TU", "RF_TU"),
    ]
    assert sorted((r.position, r.expected, r.found) for r in found if r.file == "short") == [
        (3, "QN_4", "RF_TU"), (4, "RF_TU", None), (5, "TF_TU", None),
    ]
    assert {r.file for r in found} == {"other", "short"}


def test_staging_by_name(spark, tmp_path):
    zone = Layout(str(tmp_path))
    folder = tmp_path / "raw/dwd/moisture/station_00002/2023"
    folder.mkdir(parents=True)
    folder.joinpath("produkt.txt").write_text(
        "STATIONS_ID;MESS_DATUM;QN_8;TD;RF_TU;eor\n" + "".join(f"2;20230101{h:02d};7;-1.5;{60 + h};eor\n" for h in range(24))
    )
    jobs.stage(spark, zone, "moisture", version="2023Q1_staged_v1", by_name=True, aliases={"TD": "TF_TU"})
    rows = staged.load_staged(spark, zone, "moisture", 2023, 1).orderBy("timestamp").collect()
    assert [(r.QN_4, r.RF_TU, r.TF_TU) for r in rows] == [(7, 60.0 + h, -1.5) for h in range(24)]
    assert all(r._source_file.endswith("station_00002/2023/produkt.txt") for r in rows)
    with pytest.raises(ValueError, match="by position"):
        jobs.stage(spark, zone, "moisture", archives=True, by_name=True)


def test_two_headers_in_a_file_are_an_error(spark):
    lines = spark.createDataFrame([*MOISTURE, ("own", "STATIONS_ID;MESS_DATUM;QN_4;TF_TU;RF_TU;eor")], "file string, value string")
    with pytest.raises(PySparkException, match="several headers in own"):
        observations.parse_named_lines(lines, "moisture").collect()
    with pytest.raises(ValueError, match="no columns"):
        observations.parse_named_lines(lines, "moisture", {"TD": "TT_TU"})
    # A header that is repeated is none too many.
    again = spark.createDataFrame([MOISTURE[0], *MOISTURE[:2]], "file string, value string")
    assert observations.parse_named_lines(again, "moisture").count() == 1


def test_versions_of_a_table(spark, tmp_path):
    key = "station_id int, dataset_version string, year int, quarter int"
    old = spark.createDataFrame([(1, "v1", 1999, 1, 5, 1.5)], f"{key}, hours int, mean float")
    new = spark.createDataFrame([(1, "v1", 2000, 1, 2**40, 0.25, "N")], f"{key}, hours long, mean double, side string")
    path = str(tmp_path / "t")
    assert read_log(spark, path) is None
    upsert_features(old, path)
    upsert_features(new, path)
    schema = enrich.wider_schema(old.schema, new.schema)
    assert [f.dataType.typeName() for f in schema.fields[-3:]] == ["long", "double", "string"]
    rows = {r.year: r for r in staged.load_versions(spark, path, schema).collect()}
    assert (rows[1999].hours, rows[1999].mean, rows[1999].side) == (5, 1.5, None)
    assert (rows[2000].hours, rows[2000].mean, rows[2000].side) == (2**40, 0.25, "N")
    assert staged.load_versions(spark, path, schema, year=1999).count() == 1
    assert enrich.wider_schema(new.schema, old.schema)["hours"].dataType == T.LongType()
    with pytest.raises(ValueError, match="'hours' is string in one version and long in another"):
        enrich.wider_schema(T.StructType().add("hours", "string"), new.schema)


def test_column_presence(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int")
    got = [tuple(r) for r in quality.column_presence(df, ("a", "b", "c")).collect()]
    assert got == [("a", True, 2), ("b", True, 0), ("c", False, 0)]
    assert [tuple(r) for r in quality.column_presence(df.where("a > 5"), ("a", "c")).collect()] == [("a", True, 0), ("c", False, 0)]
