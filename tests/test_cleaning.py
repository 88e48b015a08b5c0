from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quartermet.functions import columns as c
from quartermet.model import CONTRACT, PRODUCT_SCHEMAS
from quartermet.operators import cleaning
from quartermet.sources.observations import with_time
from tests.util import one


def air(spark, rows):
    return with_time(spark.createDataFrame(rows, PRODUCT_SCHEMAS["air_temperature"]))


ROWS = [
    (433, "2023010100", 5, 2.5, 80.0),
    (433, "2023010101", 5, -999.0, 81.0),
    (433, "2023010102", 3, 3.0, 82.0),
    (433, "2023010103", None, 3.5, -999.0),
]


def test_sentinel_becomes_null(spark):
    rows = cleaning.clean(air(spark, ROWS), "air_temperature")
    assert rows.where("TT_TU IS NULL").count() == 1
    assert rows.where("RF_TU IS NULL").count() == 1


def test_sentinel_in_integer_measures(spark):
    rows = [(1, "2023010100", -999, -999.0, -999)]
    df = with_time(spark.createDataFrame(rows, PRODUCT_SCHEMAS["wind"]))
    r = one(cleaning.clean(df, "wind"))
    assert r["D"] is None and r["F"] is None and r["QN_3"] is None
    assert r["quality_acceptable"] is False


def test_quality_flag(spark):
    flags = [r.quality_acceptable for r in cleaning.clean(air(spark, ROWS), "air_temperature").collect()]
    assert flags == [True, True, False, False]
    low = [(1, f"20230101{h:02d}", 4, 1.0, 1.0) for h in range(4)]
    assert cleaning.clean(air(spark, low), "air_temperature").where("quality_acceptable").count() == 0


def test_no_quality_column_leaves_rows_alone(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert cleaning.flag_quality(df).columns == ["x"]


def test_outliers_and_null_is_none(spark):
    rows = [
        (1, "2023010100", 5, 100.0, 50.0),
        (1, "2023010101", 5, -70.0, None),
        (1, "2023010102", 5, 10.0, None),
        (1, "2023010103", 5, 55.0, 50.0),
    ]
    df = air(spark, rows)
    got = [r.has_outlier for r in cleaning.clean(df, "air_temperature").collect()]
    assert got == [True, True, False, False]
    strict = [r.has_outlier for r in cleaning.clean(df, "air_temperature", CONTRACT).collect()]
    assert strict == [True, True, False, True]


def test_products_without_rules_have_no_outliers(spark):
    rows = [(1, "2023010100", 5, 99.0, "P")]
    df = with_time(spark.createDataFrame(rows, PRODUCT_SCHEMAS["cloud_cover"]))
    assert one(cleaning.clean(df, "cloud_cover"))["has_outlier"] is False


def test_units_and_time_parts(spark):
    rows = [(1, "2024022923", 5, 1013.25, None)]
    r = one(cleaning.clean(with_time(spark.createDataFrame(rows, PRODUCT_SCHEMAS["pressure"])), "pressure"))
    assert r["P_pa"] == 101325.0 and r["P0_pa"] is None
    assert (r["year"], r["quarter"], r["month"], r["day"], r["hour"]) == (2024, 1, 2, 29, 23)
    assert r["product_type"] == "pressure"


def test_unparsable_time_is_rejected(spark):
    rows = [(1, t, 5, 1.0, 1.0) for t in ("2023010100", "2023013200", "20230101", "x", "202301010")]
    good, bad = cleaning.split_rejects(air(spark, rows))
    assert (good.count(), bad.count()) == (1, 4)


def test_metrics(spark):
    df = cleaning.clean(air(spark, ROWS), "air_temperature")
    m = one(cleaning.cleaning_metrics(df, "air_temperature"))
    assert (m["total_rows"], m["rows_acceptable_quality"], m["missing_TT_TU"]) == (4, 2, 1)
    assert m["missing_ratio_TT_TU"] == 0.25
    empty = one(cleaning.cleaning_metrics(df.where("false"), "air_temperature"))
    assert empty["total_rows"] == 0 and empty["missing_ratio_TT_TU"] == 0
    p = one(cleaning.parse_metrics(air(spark, ROWS), "air_temperature"))
    assert (p["total_rows"], p["distinct_stations"], p["nulls_QN_9"]) == (4, 1, 1)
    assert p["min_timestamp"] == datetime(2023, 1, 1)


def test_observed_metrics_come_from_the_write(spark, tmp_path):
    df = cleaning.clean(air(spark, ROWS), "air_temperature")
    rows, seen = cleaning.observed_metrics(df, "air_temperature")
    rows.write.parquet(str(tmp_path / "out"))
    assert seen()["total_rows"] == 4


def test_unknown_product(spark):
    with pytest.raises(ValueError):
        cleaning.clean(air(spark, ROWS), "snow")


@pytest.mark.parametrize(
    ("year", "quarter", "start", "end", "hours"),
    [
        (2024, 1, datetime(2024, 1, 1), datetime(2024, 3, 31, 23, 59, 59), 2184),
        (2023, 1, datetime(2023, 1, 1), datetime(2023, 3, 31, 23, 59, 59), 2160),
        (2023, 2, datetime(2023, 4, 1), datetime(2023, 6, 30, 23, 59, 59), 2184),
        (2023, 4, datetime(2023, 10, 1), datetime(2023, 12, 31, 23, 59, 59), 2208),
    ],
)
def test_quarter_bounds(spark, year, quarter, start, end, hours):
    df = spark.createDataFrame([(year, quarter)], "year int, quarter int")
    r = df.select(
        c.quarter_start("year", "quarter"), c.quarter_end("year", "quarter"), c.quarter_hours("year", "quarter")
    ).first()
    assert tuple(r) == (start, end, hours)


def test_names(spark):
    df = spark.createDataFrame(
        [(7, 2023, 1, "stundenwerte_TU_00007_20230101_20231231_hist.zip")],
        "station int, year int, quarter int, file string",
    )
    r = df.select(
        c.station_code("station"),
        c.version_name("year", "quarter"),
        c.version_name("year", "quarter", "raw"),
        c.version_name("year", "quarter", "staged", 2),
        c.period_year("file"),
        c.period_year(F.lit("short.zip")),
        c.object_path(F.lit("wind"), "station", "year", "file"),
    ).first()
    assert tuple(r) == (
        "00007", "2023Q1_v1", "2023Q1_raw_v1", "2023Q1_staged_v2", "2023", "unknown",
        "raw/dwd/wind/station_00007/2023/stundenwerte_TU_00007_20230101_20231231_hist.zip",
    )


def test_ratio_of_nothing_is_null(spark):
    df = spark.createDataFrame([(0, 0)], "a int, b int")
    assert df.select(c.ratio("a", "b")).first()[0] is None
