from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quartermet.operators import enrich, quality, runs, serving
from tests.util import one

NAMES = serving.PRODUCTS


def keys(spark, rows, version="v1"):
    return spark.createDataFrame(
        [(s, y, q, version) for s, y, q in rows],
        "station_id int, year int, quarter int, dataset_version string",
    )


def tables(spark, **rows):
    base = [(s, 2023, q) for s in (1, 2) for q in (1, 2)]
    return {n: keys(spark, rows.get(n, base)) for n in NAMES}


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_counts_and_coverage(spark):
    t = tables(spark, wind=[(1, 2023, 1), (1, 2023, 2), (2, 2023, 2)])
    assert values(quality.short_quarters(t, 2)) == [("wind", 2023, 1, 1)]
    assert values(quality.thin_coverage(t, 2)) == [("wind", 2023, 1, 1)]
    with pytest.raises(quality.QualityError):
        quality.require(quality.short_quarters(t, 2), "rows")
    quality.require(quality.short_quarters(t, 1), "rows")


def test_gaps(spark):
    rows = keys(spark, [(1, 2021, 4), (1, 2023, 1)]).withColumn("product", F.lit("wind"))
    got = values(quality.missing_quarters(rows, "product"))
    expected = [(y, q) for y in (2021, 2022, 2023) for q in (1, 2, 3, 4)]
    expected = [p for p in expected if p not in ((2021, 4), (2023, 1))]
    assert got == [("wind", y, q) for y, q in expected]
    assert quality.missing_quarters(rows.where("false"), "product").collect() == []


def test_completeness_matrix(spark):
    t = tables(spark, wind=[(1, 2023, 1)])
    got = quality.completeness_matrix(t, quality.year_range(spark, 2023, 2023)).orderBy("quarter").collect()
    assert [(r.quarter, r.temperature, r.wind) for r in got] == [
        (2, "OK", "MISSING"), (3, "MISSING", "MISSING"), (4, "MISSING", "MISSING"),
    ]


def test_alignment(spark):
    a = keys(spark, [(s, 2023, 1) for s in range(12)] + [(1, 2023, 2)] + [(s, 2023, 4) for s in range(11)])
    b = keys(spark, [(1, 2023, 1), (1, 2023, 3)])
    got = {r.quarter: (r.left_count, r.right_count, r.status) for r in quality.alignment(a, b).collect()}
    assert got == {1: (12, 1, "MISMATCH"), 2: (1, 0, "OK"), 3: (0, 1, "OK"), 4: (11, 0, "MISMATCH")}


def temperature(spark, **changes):
    row = dict(
        station_id=1, year=2023, quarter=1, dataset_version="v1", temp_mean_c=5.0, temp_min_c=-3.0,
        temp_max_c=9.0, temp_range_c=12.0, heating_degree_days=1.0, cooling_degree_days=0.0,
        frost_hours=3, hours_below_0c=3, missingness_ratio=0.1, count_observations=10, count_missing=1,
    )
    row.update(changes)
    types = {str: "string", int: "int", float: "double"}
    ddl = ", ".join(f"{k} {types.get(type(v), 'double')}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], ddl)


@pytest.mark.parametrize(
    "changes", [{"temp_mean_c": 10.0}, {"temp_min_c": 6.0}, {"temp_range_c": 15.0}, {"frost_hours": 4}]
)
def test_consistency_violations(spark, changes):
    good = quality.violations(quality.temperature_consistency(temperature(spark)))
    assert good.count() == 0
    assert quality.violations(quality.temperature_consistency(temperature(spark, **changes))).count() == 1


def test_ranges(spark):
    bad = temperature(spark, temp_max_c=51.0, heating_degree_days=-1.0)
    found = quality.out_of_range({"temperature": bad}).select("feature", "value")
    assert values(found) == [("heating_degree_days", -1.0), ("temp_max_c", 51.0)]
    r = one(quality.range_counts(bad, "temperature"))
    assert (r["total"], r["temp_max_c_valid"], r["temp_min_c_valid"]) == (1, 0, 1)


def test_contract_alerts(spark):
    rows = enrich.with_quarter_bounds(temperature(spark, missingness_ratio=0.3))
    assert [tuple(r)[-2:] for r in quality.contract_alerts(rows, ("temp_mean_c",)).collect()] == [("missingness", "warn")]
    rows = enrich.with_quarter_bounds(temperature(spark, temp_mean_c=None))
    rows = rows.withColumn("quarter_end", F.lit(datetime(2023, 3, 30)).cast("timestamp_ntz"))
    rules = {r.rule for r in quality.contract_alerts(rows, ("temp_mean_c",)).collect()}
    assert rules == {"empty_statistic", "quarter_bounds"}


def stations(spark):
    return spark.createDataFrame(
        [
            (433, "A", 50.0, 6.0, 5, "X", date(2023, 1, 1), None, True),
            (44, "B", 51.0, 7.0, 6, "Y", date(2000, 1, 1), date(2023, 6, 30), True),
            (9, "C", 52.0, 8.0, 7, "Y", date(2000, 1, 1), date(2010, 1, 1), False),
        ],
        "station_id int, station_name string, latitude double, longitude double, elevation_m int, "
        "state string, start_date date, end_date date, is_active boolean",
    )


def test_station_checks(spark):
    f = keys(spark, [(433, 2022, 4), (433, 2023, 1), (44, 2023, 2), (44, 2023, 3), (777, 2023, 1), (777, 2023, 2)])
    assert values(quality.unknown_stations(f, stations(spark))) == [(777,)]
    assert one(quality.orphan_count(f, stations(spark), "station_id"))["orphaned_rows"] == 2
    out = quality.outside_active_dates(f, stations(spark)).select("station_id", "year", "quarter")
    assert values(out) == [(44, 2023, 3), (433, 2022, 4)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, "only")], "k int, t int, v string")
    assert values(quality.duplicate_keys(df, "k")) == [(1, 2)]
    assert values(quality.keep_newest(df, ("k",), ("t",))) == [(1, 2, "new"), (2, 1, "only")]


def test_raw_format(spark):
    lines = spark.createDataFrame(
        [
            ("a", "STATIONS_ID;MESS_DATUM;QN_9;TT_TU;RF_TU"), ("a", "00433;2023010100;3;-2.4;87"), ("a", ""),
            ("a", "433;2023010100;3"), ("b", "x;2023010100;3;1;1"), ("b", "433;20230101;3;1;1"),
        ],
        "file string, value string",
    )
    got = quality.raw_format(lines, "air_temperature").select("file", "reason")
    assert values(got) == [("a", "fields"), ("b", "station"), ("b", "time")]
    assert values(quality.files_without_header(lines)) == [("b",)]


def test_other_checks(spark):
    df = spark.createDataFrame([(1, 1.005), (2, None)], "k int, v double")
    assert values(quality.not_null_rejects(df, "k", "v")) == [(2, None)]
    assert quality.missing_columns(df, ("k", "w")) == ["w"]
    r = one(quality.type_change(df, "v", "decimal(5,2)"))
    assert (r["total"], r["old_count"], r["new_count"], r["mismatches"]) == (2, 1, 1, 1)
    f = keys(spark, [(1, 2023, 1)], "v9")
    log = spark.createDataFrame([("v1",)], "version string")
    assert values(quality.unknown_versions(f, log)) == [("v9",)]


def test_check_log(spark):
    found = keys(spark, [(1, 2023, 1)])
    old = quality.check_records(found, "a", "completeness", "fail", F.lit(datetime(2023, 1, 1)))
    new = quality.check_records(found, "b", "accuracy", "warn", F.lit(datetime(2023, 2, 1)))
    log = old.unionByName(new)
    assert [r.check_name for r in quality.check_log(log).collect()] == ["b", "a"]
    assert [r.check_name for r in quality.check_log(log, status="failed").collect()] == ["a"]
    recent = quality.check_log(log, since=F.lit(datetime(2023, 1, 15)))
    assert [r.status for r in recent.collect()] == ["warning"]


# ------------------------------------------------------------------ serving

def test_feature_page(spark):
    f = keys(spark, [(s, y, q) for s in (1, 2) for y in (2022, 2023) for q in (1, 2)])
    rows = [tuple(r)[:3] for r in serving.feature_page(f, 3, 1).collect()]
    assert rows == [(2, 2023, 2), (1, 2023, 1), (2, 2023, 1)]
    assert serving.feature_page(f, station_id=1, min_year=2023).count() == 2
    assert serving.feature_page(f, max_year=2022, quarter=2).count() == 2
    assert [tuple(r)[1:3] for r in serving.station_series(f, 1).collect()] == [
        (2022, 1), (2022, 2), (2023, 1), (2023, 2)
    ]


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 1001}, {"offset": -1}, {"quarter": 5}, {"year": 20}])
def test_page_arguments(spark, bad):
    with pytest.raises(ValueError):
        serving.feature_page(keys(spark, []), **bad)


def test_station_reads(spark):
    s = stations(spark)
    assert [r.station_id for r in serving.station_page(s).collect()] == [9, 44, 433]
    assert [r.station_id for r in serving.station_page(s, is_active=True, state="Y").collect()] == [44]
    assert serving.station(s, 433).first().station_name == "A"
    assert serving.station(s, 1).count() == 0
    assert one(serving.station_total(s))["station_count"] == 3
    t = {n: keys(spark, [(433, 2023, 1)]) for n in NAMES[:2]}
    got = {r.station_id: (r.temperature, r.total_records) for r in serving.station_summary(s, t).collect()}
    assert got == {433: (1, 2), 44: (0, 0), 9: (0, 0)}


def test_summaries(spark):
    t = tables(spark)
    assert one(serving.feature_stats(t["wind"], "wind")) == {
        "product": "wind", "total_records": 4, "station_count": 2,
        "min_year": 2023, "max_year": 2023, "min_quarter": 1, "max_quarter": 2,
    }
    assert {r.name: r.record_count for r in serving.available_products(t).collect()} == dict.fromkeys(NAMES, 4)
    mixed = keys(spark, [(1, 2022, 4), (1, 2023, 1)])
    assert values(serving.freshness({"wind": mixed})) == [("wind", 2023, 1)]
    assert one(serving.table_sizes(t)) == dict.fromkeys(NAMES, 4)
    with pytest.raises(ValueError):
        serving.product_table(t, "snow")


def test_contract_layout(spark):
    row = temperature(spark).withColumns(
        {
            "temp_median_c": F.lit(4.444), "temp_stddev_c": F.lit(None).cast("double"),
            "temp_q25_c": F.lit(1.0), "temp_q75_c": F.lit(2.0), "freeze_thaw_cycles": F.lit(2),
        }
    )
    out = enrich.to_contract(enrich.enrich(row.withColumn("station_id", F.lit(433)), stations(spark)), "temperature")
    assert out.columns[:5] == ["station_id", "station_name", "latitude", "longitude", "elevation_m"]
    r = out.first()
    assert str(r.median_temp_c) == "4.44" and str(r.missingness_ratio) == "0.1000" and r.stddev_temp_c is None
    response = enrich.to_response(out, "temperature")
    assert dict(response.dtypes)["median_temp_c"] == "double" and "computed_at" in response.columns
    with pytest.raises(ValueError):
        enrich.to_contract(row, "snow")


def test_contract_pressure_in_hpa(spark):
    names = [c.feature for c in enrich.CURATED_TABLES["pressure"]]
    row = spark.createDataFrame([(433, 2023, 1, "v1", *[101300.0] * len(names))],
        "station_id int, year int, quarter int, dataset_version string, " + ", ".join(f"{n} double" for n in names))
    row = row.withColumns({n: F.lit(0.1) for n in names if n == "missingness_ratio"})
    row = row.withColumns({"pressure_range_pa": F.lit(12345.0), "pressure_stddev_pa": F.lit(512.0)})
    r = enrich.to_contract(enrich.enrich(row, stations(spark)), "pressure").first()
    assert (str(r.mean_pressure_hpa), str(r.pressure_range_hpa)) == ("1013.00", "123.45")


# --------------------------------------------------------------------- runs

def test_work_list(spark):
    items = runs.work_list(spark, 2022, 2023, quarters=[1, 2], products=["wind", "pressure"])
    assert items.count() == 8
    done = items.where("year = 2022")
    assert runs.work_list(spark, 2022, 2023, quarters=[1, 2], products=["wind", "pressure"], done=done).count() == 4
    forced = runs.work_list(spark, 2022, 2023, quarters=[1, 2], products=["wind"], done=done, force=True)
    assert forced.count() == 4 and forced.first().force is True


def test_run_log(spark):
    log = runs.run_record(spark, run_id="a", status="success").unionByName(
        runs.run_record(spark, run_id="b", status="failed", error="x")
    )
    r = one(runs.batch_summary(log))
    assert (r["total"], r["successful"], r["failed"], r["success_share"]) == (2, 1, 1, 0.5)
    with pytest.raises(ValueError):
        runs.run_record(spark, other=1)


def test_ingestion_statistics(spark):
    files = spark.createDataFrame(
        [("processed", 10), ("processed", 5), ("skipped", 7), ("failed", 0)], "status string, size_bytes int"
    )
    r = one(runs.ingestion_statistics(files))
    assert r["processed"] + r["skipped"] + r["failed"] == r["total_files"] == 4
    assert r["total_bytes"] == 15
