"""Tables of many small partitions, written and read by tasks."""

from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from quartermet.model import STATION
from quartermet.plans import queries_catalog
from quartermet.sinks import partitions, tables

from .util import one

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp_ntz"


def observed(spark, rows=600):
    """Stations and years of several rows, some NULL, and a column of each type."""
    return spark.range(rows).selectExpr(
        f"CAST(nullif(id % 5, 4) AS INT) AS {STATION}", "CAST(nullif(1998 + id % 3, 2000) AS INT) AS year",
        "TIMESTAMP_NTZ'1998-01-01' + make_dt_interval(CAST(id AS INT)) AS timestamp",
        "TIMESTAMP'1960-01-01 00:00:00.000001' + make_dt_interval(CAST(id AS INT)) AS made", "nullif(id % 7, 0) / 2 AS v",
        "CAST(id AS DECIMAL(20, 3)) AS price", "CAST(id % 100 AS TINYINT) AS small", "DATE'0900-01-01' + CAST(id AS INT) AS day",
        "concat('é', id) AS name", "CAST('x' AS BINARY) AS raw", "id % 2 = 0 AS good", "'v1' AS dataset_version",
    )


def listed(df):
    return sorted((tuple(r.asDict().items()) for r in df.collect()), key=repr)


def files(folder):
    return sorted(os.path.relpath(f"{d}/{n}", folder) for d, _, names in os.walk(folder) for n in names if n != "_SUCCESS")


@pytest.fixture
def no_spark_writer(monkeypatch):
    """Spark's writer, and its reader, which lists every folder on the driver, are not to be used."""
    from pyspark.sql import DataFrameReader, DataFrameWriter

    def refused(*_, **__):
        raise AssertionError("a table of many small partitions went through Spark's writer or reader")

    def stop():
        monkeypatch.setattr(DataFrameWriter, "parquet", refused)

        def parquet(self, path, was=DataFrameReader.parquet):
            return refused() if os.path.isdir(f"{path}/{STATION}=1") or "/staged/" in path else was(self, path)

        monkeypatch.setattr(DataFrameReader, "parquet", parquet)

    return stop


def test_statistics_need_no_listing_by_the_driver(spark, tmp_path, no_spark_writer):
    lines = spark.range(600).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "nullif(id % 5, 4) AS l_suppkey", "CAST(1 + id % 7 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "(id % 11) / 100D AS l_discount",
        "TIMESTAMP_NTZ'1998-01-01' + make_dt_interval(CAST(id AS INT)) AS l_shipdate",
    )
    spark.createDataFrame(lines.collect(), LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    no_spark_writer()
    got = one(queries_catalog.staged_statistics(spark, str(tmp_path)))
    hour = F.expr("l_shipdate + make_dt_interval(0, CAST(l_linenumber - 1 + 7 * (l_orderkey % 3) AS INT))")
    want = one(lines.select("l_suppkey", hour.alias("t")).distinct().agg(
        F.count("*").alias("total_rows"), F.min("t").alias("min_timestamp"), F.max("t").alias("max_timestamp"),
        F.countDistinct("l_suppkey").alias("distinct_stations"),
    ))
    assert got == want and got["distinct_stations"] == 4


def test_statistics_of_no_rows(spark, tmp_path):
    spark.createDataFrame([], LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = one(queries_catalog.staged_statistics(spark, str(tmp_path)))
    assert got == {"total_rows": 0, "min_timestamp": None, "max_timestamp": None, "distinct_stations": 0}


def test_tables_are_those_of_sparks_writer(spark, tmp_path, monkeypatch):
    rows, path, plain = observed(spark), str(tmp_path / "t"), str(tmp_path / "plain")
    stats = tables.write_by_station(rows, path, mode="append", parallel_commit=True)
    tables.write_by_station(rows, plain)
    assert stats == {"path": path, "partition_by": [STATION, "year"], "mode": "append", "rows_written": 600}
    assert {os.path.dirname(f) for f in files(path)} == {os.path.dirname(f) for f in files(plain) if f.endswith(".parquet")}
    assert len(files(path)) == 15 and os.path.exists(f"{path}/_SUCCESS")
    back, other = spark.read.parquet(path), spark.read.parquet(plain)
    assert back.schema == other.schema and listed(back) == listed(other)
    # The same rows by tasks, from either writer, whole or in part.
    for folder in (path, plain):
        own = tables.read_by_station(spark, folder, rows.schema, 3)
        assert own.columns == [*rows.columns, "_file"] and own.schema["timestamp"] == rows.schema["timestamp"]
        assert listed(own.drop("_file")) == listed(rows)
        some = tables.read_by_station(spark, folder, rows.schema, 3, (STATION, "timestamp"))
        summed = one(tables.table_statistics(some, "_file", len(rows.columns)))
        assert summed == one(tables.table_statistics(spark.read.parquet(folder)))
        assert listed(tables.read_by_station(spark, folder, rows.schema, 3, (STATION,)).drop("_file")) == listed(rows.select(STATION))
    monkeypatch.setattr(tables, "within_reach", lambda *_: False)
    assert listed(tables.read_by_station(spark, path, rows.schema, 3).drop("_file")) == listed(rows)


def test_rows_are_added(spark, tmp_path):
    rows, path = observed(spark, 20), str(tmp_path / "t")
    tables.write_by_station(rows, path, mode="append", parallel_commit=True)
    tables.write_by_station(rows.drop("v"), path, mode="append", parallel_commit=True)
    (tmp_path / "t" / f"{STATION}=1" / "year=1998" / "_half").write_text("a task that failed")
    own = tables.read_by_station(spark, path, rows.schema, 2).drop("_file")
    assert listed(own) == sorted(listed(rows) + listed(rows.withColumn("v", F.lit(None))), key=repr)
    (tmp_path / "t" / "loose.parquet").write_text("")
    with pytest.raises(Exception, match="loose"):
        tables.read_by_station(spark, path, rows.schema, 2).count()


def test_rows_of_a_station_are_not_shuffled_again(spark, tmp_path):
    rows, path = observed(spark), str(tmp_path / "t")
    noted = rows.repartition(3, STATION).withMetadata("v", {"unit": "K"})
    tables.write_by_station(noted, path, mode="append", parallel_commit=True, rebalance=False)
    assert len(files(path)) == 15
    back = spark.read.parquet(path)
    assert back.schema["v"].metadata == {"unit": "K"} and listed(back.select(*rows.columns)) == listed(rows)


def test_files_are_bounded(spark, tmp_path, monkeypatch):
    rows = spark.range(45_000, numPartitions=3).selectExpr("CAST(id % 2 AS INT) AS STATIONS_ID", "2023 AS year", "id AS v", "'v1' AS dataset_version")
    path = str(tmp_path / "t")
    tables.write_by_station(rows, path, mode="append", parallel_commit=True, target_file_mb=1)
    back = spark.read.parquet(path)
    sizes = [r["count"] for r in back.groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) == 1024 * 1024 // tables.ROW_BYTES and sum(sizes) == 45_000 and len(sizes) >= 6
    assert back.agg(F.sum("v"), F.countDistinct("v")).first() == (45_000 * 44_999 // 2, 45_000)
    own = tables.read_by_station(spark, path, rows.schema, 2, ("v",))
    assert own.agg(F.sum("v"), F.countDistinct("v"), F.countDistinct("_file")).first() == (45_000 * 44_999 // 2, 45_000, len(sizes))


def test_folders_are_sparks(spark, tmp_path):
    keys = [None, "", "a/b=c%20", "%41", "ä b", "\\ \"[x]^{y}'\t", "1"]
    rows = spark.createDataFrame(
        [(k, datetime.date(1999, 1, 1 + n % 2), n) for n, k in enumerate(keys * 4)], "k string, d date, n int"
    )
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    tables.write_partitioned(rows, path, ("k", "d"), mode="append", parallel_commit=True)
    rows.write.partitionBy("k", "d").parquet(plain)
    folders = [{os.path.dirname(f) for f in files(p) if f.endswith(".parquet")} for p in (path, plain)]
    assert folders[0] == folders[1]
    want = listed(rows.withColumn("k", F.nullif("k", F.lit(""))))
    assert listed(partitions.read_partitions(spark, path, rows.schema, ("k", "d"), 2).drop("_file")) == want
    assert listed(spark.read.schema(rows.schema).parquet(path)) == listed(spark.read.schema(rows.schema).parquet(plain))


def test_other_types_and_stores_are_left_to_spark(spark, tmp_path):
    rows = observed(spark, 20).withColumn("list", F.array("v"))
    path = str(tmp_path / "t")
    assert not partitions.within_reach(path, rows.schema, tables.BY_STATION)
    assert not partitions.within_reach("viewfs://store/t", rows.drop("list").schema, tables.BY_STATION)
    assert not partitions.within_reach(path, rows.select(STATION, "year").schema, tables.BY_STATION)
    tables.write_by_station(rows, path, mode="append", parallel_commit=True)
    own = tables.read_by_station(spark, path, rows.schema, 2)
    assert listed(own.drop("_file")) == listed(rows)
