"""Properties that must hold at any size: plans, skew, feature relations."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quartermet.layout import Layout
from quartermet.operators import features as f
from quartermet.operators import serving
from quartermet.plans import views
from quartermet.sinks import tables
from quartermet.sources.staged import load_staged
from tests.conftest import SF_SMALL
from tests.util import one, staged

WRITING = ("stream_", "incremental_", "upsert", "staged_", "raw_to_", "text_file_", "schema_")
LAZY = sorted(n for n in entry.queries() if not n.startswith(WRITING))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_join_without_a_key(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_SMALL))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_features_read_few_columns_and_push_filters(spark, tmp_path):
    zone = Layout(str(tmp_path))
    tables.write_staged(views.cleaned(spark, SF_SMALL, "wind"), zone.staged("wind"), "v1")
    rows = load_staged(spark, zone, "wind", 1998, 2, "v1").where("STATIONS_ID = 7")
    plan = plan_of(f.wind(rows))
    assert plan.count("FileScan") == 1
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in schema.split(",")} == {"STATIONS_ID", "F", "D", "quality_acceptable"}
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "EqualTo(STATIONS_ID,7)" in pushed and "quality_acceptable" in pushed
    partitions = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(c in partitions for c in ("dataset_version", "year", "quarter"))


def test_pages_read_the_partitions_they_need(spark):
    queries = entry.queries()
    for name in ("feature_page", "feature_page_after", "station_series_after"):
        plan = plan_of(queries[name](spark, SF_SMALL))
        partitions = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "year" in partitions and plan.count("FileScan") == 1, name
    assert "EqualTo(station_id,7)" in plan_of(queries["station_series"](spark, SF_SMALL))


def test_pages_follow_each_other(spark, curated):
    rows, seen, after = curated["wind"].select("year", "quarter", "station_id", "dataset_version"), [], None
    while got := serving.feature_page(rows, 70, after=after).collect():
        seen += got
        after = tuple(got[-1])
    want = rows.orderBy(F.desc("year"), F.desc("quarter"), "station_id", "dataset_version").collect()
    assert seen == want and len(seen) > 140


def test_unused_branch_is_not_planned(spark):
    counted = views.product_features(spark, SF_SMALL, "air_temperature").groupBy("year").count()
    assert "Join" not in plan_of(counted)


def test_shared_rows_are_exchanged_once(spark):
    df = views.product_features(spark, SF_SMALL, "air_temperature")
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_one_station_holding_most_rows(spark):
    """A station with a very often repeated hour: right result, small windows."""
    heavy = spark.range(30_000).select(
        F.lit(1).alias("STATIONS_ID"),
        F.lit(datetime(2023, 1, 1, 5)).cast("timestamp_ntz").alias("timestamp"),
        F.lit(1.0).alias("R1"),
        F.lit(True).alias("quality_acceptable"),
        F.lit("v1").alias("dataset_version"),
        F.lit(2023).alias("year"),
        F.lit(1).alias("quarter"),
        F.lit(False).alias("has_outlier"),
    )
    rest = staged(spark, "R1 double", [(1, h, float(h % 2), True) for h in range(20)])
    r = one(f.precipitation(rest.unionByName(heavy)))
    assert r["max_wet_spell_hours"] == 30_001 and r["count_observations"] == 30_020


@pytest.fixture(scope="module")
def curated(spark):
    return views.curated(spark, SF_SMALL)


def test_order_of_statistics(spark, curated):
    for table, low, points in (
        ("temperature", "temp_{}_c", ("min", "q25", "median", "q75", "max")),
        ("pressure", "pressure_{}_pa", ("min", "q25", "median", "q75", "max")),
        ("humidity", "humidity_{}_pct", ("min", "q25", "median", "q75", "max")),
        ("wind", "wind_speed_{}_mps", ("min", "median", "q75", "q95", "max")),
        ("precipitation", "precip_{}_mm", ("median", "q75", "q95", "max")),
    ):
        names = [low.format(p) for p in points]
        wrong = [F.col(a) > F.col(b) for a, b in zip(names, names[1:])]
        for w in wrong:
            assert curated[table].where(w).count() == 0, table


def test_feature_relations(spark, curated):
    t, p, w = curated["temperature"], curated["precipitation"], curated["wind"]
    assert t.where("heating_degree_days < 0 OR cooling_degree_days < 0").count() == 0
    hours = "count_observations + count_missing"
    assert p.where(f"coalesce(max_wet_spell_hours, 0) > wet_hours OR max_dry_spell_hours > {hours}").count() == 0
    assert p.where("wet_hours + dry_hours <> count_observations").count() == 0
    assert w.where("prevailing_direction < 0 OR prevailing_direction >= 360").count() == 0
    for table in curated.values():
        assert table.where("missingness_ratio < 0 OR missingness_ratio > 1").count() == 0
        keys = table.groupBy("station_id", "year", "quarter", "dataset_version").count()
        assert keys.where("count > 1").count() == 0
