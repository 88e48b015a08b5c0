from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quartermet.streaming import requests as log
from quartermet.streaming import runs

START = datetime(2024, 1, 1)
DDL = "ts timestamp_ntz, method string, endpoint string, status int, duration_s double, caller long"


def requests(spark, rows):
    """Rows: (seconds after the start, status, duration), on one endpoint."""
    data = [(START + timedelta(seconds=s), "GET", "/features/x", st, d, 1) for s, st, d in rows]
    return spark.createDataFrame(data, DDL)


def points(df):
    return sorted((r.at - START).total_seconds() for r in df.collect())


def test_rates_and_latency(spark):
    df = requests(spark, [(0, 200, 0.1), (299, 500, 0.3), (300, 404, 0.2)])
    rows = log.request_rate(df).orderBy("window_start").collect()
    assert [(r.requests, round(r.per_second * 300)) for r in rows] == [(2, 2), (1, 1)]
    assert log.error_rate(df).count() == 2
    first = log.latency(df).orderBy("window_start").first()
    assert (first.p50_s, first.p99_s, first.mean_s) == (0.1, 0.3, pytest.approx(0.2))
    assert [r.success_pct for r in log.success_share(df).orderBy("window_start").collect()] == [50.0, 0.0]
    assert log.hourly_requests(df).first().requests == 3


def test_sliding_windows_count_a_request_in_each(spark):
    df = requests(spark, [(30, 200, 0.1)])
    assert log.request_rate(df, "5 minutes", "1 minute").count() == 5


def test_histogram_is_cumulative(spark):
    df = requests(spark, [(0, 200, 0.005), (1, 200, 0.3), (2, 200, 99.0)])
    got = {r.le: r.requests for r in log.latency_histogram(df).collect()}
    assert (got["0.005"], got["0.25"], got["0.5"], got["10.0"], got["+Inf"]) == (1, 1, 2, 2, 3)
    assert len(got) == 15


def test_staleness(spark):
    df = requests(spark, [(0, 200, 0.1), (100, 500, 0.1)])
    r = log.last_success(df, F.lit(START + timedelta(days=2)).cast("timestamp_ntz")).first()
    assert (r.age_s, r.is_stale) == (2 * 86400, True)
    never = log.last_success(df.where("status = 500"), F.lit(START).cast("timestamp_ntz")).first()
    assert never.last_success is None and never.is_stale is True


def test_top_reports(spark):
    df = requests(spark, [(i, 200, i / 10) for i in range(10)])
    assert log.slowest_endpoints(df).first().latency_s == 0.9
    assert log.top_callers(df).first().requests == 10
    assert log.weekly_usage(df).first().requests == 10


def brute_force_held(breached, step, hold):
    return sorted(t for t in breached if all(t - k in breached for k in range(0, hold + 1, step)))


def test_held_points(spark):
    seconds = {0, 60, 120, 240, 300, 360, 420, 480, 900}
    at = spark.createDataFrame([(START + timedelta(seconds=s),) for s in seconds], "at timestamp_ntz")
    assert points(log.held(at, 60, 180)) == brute_force_held(seconds, 60, 180) == [420, 480]
    with pytest.raises(ValueError):
        log.held(at, 60, 90)


def test_error_alert_fires_after_the_holding_time(spark):
    df = requests(spark, [(60 * m + 1, 500 if m >= 10 else 200, 0.1) for m in range(30)])
    got = points(log.error_ratio_alert(df))
    # First grid point with an error in its window is minute 11; five minutes on it fires.
    assert got[0] == 16 * 60


def test_latency_and_failure_alerts(spark):
    df = requests(spark, [(60 * m + 1, 500, 3.0) for m in range(40)])
    assert points(log.latency_alert(df))[0] == 11 * 60
    assert points(log.failing_share_alert(df))[0] == 11 * 60
    assert log.latency_alert(df, above_s=5.0).count() == 0


def test_low_traffic_counts_empty_windows(spark):
    busy = [(10 * i, 200, 0.1) for i in range(60)]  # ten minutes
    df = requests(spark, [*busy, (7200, 200, 0.1)])
    got = points(log.low_traffic_alert(df))
    brute = {
        t for t in range(0, 7201, 60)
        if sum(t - 300 <= s < t for s, *_ in [*busy, (7200, 0, 0)]) < 3
    }
    assert got == brute_force_held(brute, 60, 900)


def test_no_success(spark):
    df = requests(spark, [(0, 200, 0.1), (86_400, 500, 0.1)])
    got = points(log.no_success_alert(df))
    assert got[0] == 6 * 3600 + 300 + 1800 and got[-1] == 86_400


def test_stream_equals_batch_over_several_runs(spark, tmp_path):
    rows = [(60 * i, 200 if i % 3 else 500, i / 100) for i in range(200)]
    source, folder = tmp_path / "in", tmp_path / "s"
    for part in (rows[:120], rows[120:]):  # the first run ends within a window
        requests(spark, part).coalesce(1).write.mode("append").parquet(str(source))
        stream = runs.with_event_time(runs.stream_table(spark, str(source), DDL), "1 day")
        runs.run_windows(log.latency(stream, "1 hour"), str(folder / "out"), str(folder / "cp"))
    got = runs.read_windows(spark, str(folder / "out"), ["window_start", "window_end", "endpoint"])
    want = log.latency(requests(spark, rows), "1 hour")

    def comparable(df):
        return sorted(
            (str(r.window_start), r.p50_s, r.p95_s, round(r.mean_s, 9), r.requests) for r in df.collect()
        )

    assert comparable(got) == comparable(want)
