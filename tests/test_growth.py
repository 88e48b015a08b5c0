"""Plans whose figures must not grow faster than their input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quartermet.model import GROUP
from quartermet.operators import catalog, cleaning
from quartermet.plans import views
from quartermet.sinks import tables
from quartermet.sinks.files import read_listed, write_files
from quartermet.sources import observations

LINES = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp_ntz"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tiny(spark, tmp_path):
    rows = spark.range(600).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "nullif(id % 5, 4) AS l_suppkey", "CAST(1 + id % 7 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "(id % 11) / 100D AS l_discount",
        "TIMESTAMP_NTZ'1998-01-01' + make_dt_interval(CAST(id % 200 AS INT)) AS l_shipdate",
    )
    spark.createDataFrame(rows.collect(), LINES).write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_hours_are_shuffled_once(spark, tiny):
    rows = views.staged(spark, tiny, "moisture")
    made = rows.groupBy(*GROUP).agg(F.max("RF_TU"))
    assert plan(made).count("Exchange ") == 1
    assert made.count() == rows.select(*GROUP).distinct().count() == 15


def test_tasks_grow_with_the_table(spark, tiny, monkeypatch):
    assert views.tasks_for(spark, tiny, "lineitem") == 1
    monkeypatch.setattr(views, "_TASKS", {})
    monkeypatch.setattr(views, "TASK_BYTES", 256)
    assert views.tasks_for(spark, tiny, "lineitem") > 10


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([("1;2023010100;9;1.0;2.0;eor",), ("x;2023010101;2;1.0;2.0;eor",), ("2;20230101;3",)], "value string")
    rows = observations.parse_lines(lines, "air_temperature")
    _, rejected = cleaning.split_rejects(rows)
    assert plan(rejected).count("from_csv") == 1
    assert sorted((r.STATIONS_ID is None, r.QN_9) for r in rejected.collect()) == [(False, 3), (True, 2)]


def test_files_are_found_by_their_list(spark, tmp_path):
    made = [(f"a/{i}.zip", bytes([i])) for i in range(5)] + [("a/0.zip.sha256", b"x"), ("b/9.zip", b"")]
    files = spark.createDataFrame(made, "path string, content binary")
    assert write_files(files, str(tmp_path / "files"), str(tmp_path / "listed")) == {"files": 7, "bytes": 6}
    listed = spark.read.parquet(str(tmp_path / "listed"))
    back = read_listed(listed, str(tmp_path / "files"), ".zip")
    want = sorted((f"{tmp_path}/files/{p}", c) for p, c in made if p.endswith(".zip"))
    assert sorted((r.path, bytes(r.content)) for r in back.collect()) == want
    assert read_listed(listed, str(tmp_path / "files")).count() == 7


def test_tasks_commit_their_own_files(spark, tmp_path):
    rows = spark.range(6).selectExpr("CAST(id % 3 AS INT) AS STATIONS_ID", "2023 AS year", "id AS v", "'v1' AS dataset_version")
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        tables.write_by_station(rows, path, parallel_commit=True)
    tables.write_by_station(rows, path, mode="append", parallel_commit=True)
    assert (tmp_path / "t" / "STATIONS_ID=2" / "year=2023").is_dir()
    assert spark.read.parquet(path).count() == 6


def test_schema_requests_are_dealt_over_growing_tasks(spark, tiny, monkeypatch):
    lines = spark.read.parquet(f"{tiny}/lineitem.parquet").withColumns({"l_returnflag": F.lit("N"), "l_linestatus": F.lit("O")})
    path = f"{tiny}/more"
    lines.write.parquet(f"{path}/lineitem.parquet")
    spark.range(600).selectExpr(
        "id AS o_orderkey", "id % 40 AS o_custkey", "'x' AS o_orderpriority", "'O' AS o_orderstatus",
        "TIMESTAMP_NTZ'1998-01-01' AS o_orderdate",
    ).write.parquet(f"{path}/orders.parquet")
    monkeypatch.setattr(views, "_TASKS", {})
    monkeypatch.setattr(views, "TASK_BYTES", 1024)
    tasks = views.tasks_for(spark, path, "lineitem")
    requests = views.schema_requests(spark, path)
    assert tasks > 3 and plan(requests).count(f", {tasks}), REPARTITION_BY_NUM") == 2

    def rows(registry):
        return sorted((r.schema_name, r.version, r.schema_hash) for r in registry.collect())

    assert rows(catalog.register_schemas(None, requests, tasks)) == rows(catalog.register_schemas(None, requests))
