"""Panes, alerts by timers, late rows, files set apart."""

from __future__ import annotations

import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quartermet.layout import Layout
from quartermet.sources import staged
from quartermet.streaming import requests as log
from quartermet.streaming import runs

START = datetime(2024, 1, 1)
DDL = "ts timestamp_ntz, method string, endpoint string, status int, duration_s double, caller long"


def requests(spark, rows):
    """Rows: (seconds after the start, endpoint, status, duration)."""
    data = [(START + timedelta(seconds=s), "GET", e, st, d, 1) for s, e, st, d in rows]
    return spark.createDataFrame(data, DDL)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_alerts_count_each_request_once(spark):
    df = requests(spark, [(k * 7, "/x", 200 if k % 3 else 500, k / 100) for k in range(200)])
    for made in (
        log.error_ratio_alert(df), log.latency_alert(df), log.failing_share_alert(df), log.low_traffic_alert(df),
        log.no_success_alert(df, 1800, 300, 600), log.failure_rate_alert(df, "%"), log.few_queries_alert(df, "%"),
    ):
        assert "Expand" not in plan(made)
    with pytest.raises(ValueError):
        log.error_ratio_alert(df, width="90 seconds")


def test_a_percentile_is_above_a_limit_if_few_values_are_not(spark):
    values = [(k, "/x", 200, float(k % 100)) for k in range(0, 240, 3)] + [(5, "/y", 200, None)]
    df = requests(spark, values)
    for above in (0.0, 50.0, 90.0, 95.0, 96.0, 99.0):
        got = sorted(r.at for r in log.latency_alert(df, above, "2 minutes", 60, 0).collect())
        want = []
        for end in range(60, 420, 60):
            inside = sorted(v for s, e, _, v in values if e == "/x" and end - 120 <= s < end)
            if inside and inside[-(-95 * len(inside) // 100) - 1] > above:
                want.append(START + timedelta(seconds=end))
        assert got == want


def test_failing_and_quiet_endpoints(spark):
    busy = [(s, "/a/stations", 500, 0.1) for s in range(0, 3600, 5)]
    fired = log.failure_rate_alert(requests(spark, busy), hold_s=900).collect()
    # The rate passes 0.1 a second once 61 requests are in the window.
    assert min(r.at for r in fired) == START + timedelta(minutes=6 + 15)
    few = [(s, "/a/stations", 200, 0.1) for s in range(0, 4 * 3600, 1200)] + [(s, "/b", 200, 0.1) for s in range(0, 4 * 3600, 60)]
    assert log.few_queries_alert(requests(spark, few), below=10).count() == 4 * 60 - 120
    assert log.few_queries_alert(requests(spark, few), below=1).count() == 0


def stream_of(spark, folder, lots, alert, lateness):
    """Each lot is a file and a run of the stream."""
    for lot in lots:
        requests(spark, lot).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        found = runs.run_alerts(spark, runs.stream_table(spark, f"{folder}/in", DDL), alert, folder, lateness)
    return sorted((r.endpoint, r.last_success, r.at) for r in found.collect())


def test_staleness_is_held_on_a_stream_as_on_a_table(spark, tmp_path):
    minute = 60
    lots = [
        [(0, "/a", 200, 0.1), (5 * minute, "/a", 500, 0.1), (0, "/b", 200, 0.1), (10 * minute, "/c", 404, 0.1)],
        [(40 * minute, "/a", 200, 0.1), (100 * minute, "/d", 201, 0.1)],
        # Late, but within the watermark: closes a gap of /b that has not fired yet, and comes twice.
        [(95 * minute, "/b", 200, 0.1), (95 * minute, "/b", 200, 0.1), (300 * minute, "/e", 200, 0.1)],
        [(310 * minute, "/e", 200, 0.1)],
    ]
    every = [r for lot in lots for r in lot]
    as_of = F.lit(START + timedelta(minutes=300)).cast("timestamp_ntz")
    want = sorted((r.endpoint, r.last_success, r.at) for r in log.stale_alert(requests(spark, every), as_of, 4800, 1200).collect())
    assert [(e, (t - START).seconds // 60) for e, t, _ in want] == [("/a", 40), ("/b", 95), ("/d", 100)]
    got = stream_of(spark, str(tmp_path), lots, lambda df: log.stale_alerts(df, 4800, 1200), "10 minutes")
    assert got == want


def test_late_rows_are_counted_and_refused(spark, tmp_path):
    folder = str(tmp_path)
    key = ("window_start", "window_end", "method", "endpoint")

    def lot(rows):
        requests(spark, rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        return runs.with_event_time(runs.stream_table(spark, f"{folder}/in", DDL), "1 hour")

    metric = log.request_rate(lot([(7200, "/a", 200, 0.1), (20_000, "/a", 200, 0.1)]))
    assert runs.run_windows(metric, f"{folder}/out", f"{folder}/state") == {"rows_read": 2, "rows_late": 0}
    metric = log.request_rate(lot([(0, "/a", 200, 0.1), (16_500, "/a", 200, 0.1)]))  # one late, one just in time
    with pytest.raises(runs.LateRows):
        runs.run_windows(metric, f"{folder}/out", f"{folder}/state")
    assert runs.read_windows(spark, f"{folder}/out", key).agg(F.sum("requests")).first()[0] == 3
    metric = log.request_rate(lot([(60, "/a", 200, 0.1)]))
    assert runs.run_windows(metric, f"{folder}/out", f"{folder}/state", allow_late=True) == {"rows_read": 1, "rows_late": 1}

    # Folding changes no result, whether or not it was interrupted before, and later batches win.
    def result():
        return sorted(tuple(r) for r in runs.read_windows(spark, f"{folder}/out", key).collect())

    def stored(kind):
        return sorted(p.name for p in tmp_path.joinpath("out", kind).glob("batch=*"))

    want = result()
    shutil.copytree(tmp_path / "out", tmp_path / "copy")
    batches = stored(".")
    assert runs.fold_windows(spark, f"{folder}/out", key) == len(batches) > 1
    assert result() == want and stored(".") == [] and stored("folded") == batches[-1:]
    shutil.copytree(tmp_path / "copy" / batches[0], tmp_path / "out" / batches[0])  # as if it had not been removed
    assert result() == want
    assert runs.fold_windows(spark, f"{folder}/out", key) == 1 and result() == want and stored(".") == []
    assert runs.fold_windows(spark, f"{folder}/out", key) == 0
    metric = log.request_rate(lot([(21_000, "/a", 200, 0.1), (16_600, "/a", 200, 0.1)]))
    runs.run_windows(metric, f"{folder}/out", f"{folder}/state", allow_late=True)
    more = result()
    assert more != want and sum(r[4] for r in more) == sum(r[4] for r in want) + 2
    assert runs.fold_windows(spark, f"{folder}/out", key) >= 1 and result() == more and len(stored("folded")) == 1
    with pytest.raises(ValueError, match="no windows"):
        runs.read_windows(spark, f"{folder}/none", key)


AIR = "STATIONS_ID;MESS_DATUM;QN_9;TT_TU;RF_TU\n"


def lines(station, hours):
    return "".join(f"{station};20230101{h:02d};5;1.0;80.0\n" for h in hours)


def test_a_bad_file_is_set_apart(spark, tmp_path):
    zone = Layout(str(tmp_path))
    product = "air_temperature"
    raw = tmp_path / "raw/dwd" / product
    raw.mkdir(parents=True)
    apart = zone.log("set_apart")

    def load():
        return runs.load_new_files(
            spark, zone.raw(product), product, zone.staged(product), zone.log("load"), set_apart=apart
        )

    (raw / "a.txt").write_text(AIR + lines(1, range(24)))
    assert load() == 24
    (raw / "b.txt").write_text(AIR + "1;bad;5;1;1\n" * 10)
    (raw / "c.txt").write_text(AIR + lines(3, range(8)) + "1;bad;5;1;1\n")  # few enough
    assert load() == 8
    (raw / "d.txt").write_text(AIR + lines(4, range(12)) + lines(4, range(3)))  # hours given twice
    load()
    assert load() == 0
    assert staged.load_staged(spark, zone, product).count() == 24 + 8 + 12
    (bad,) = runs.files_set_apart(spark, apart).collect()
    assert bad.file.endswith("b.txt") and (bad.rows_read, bad.rows_rejected) == (10, 10)
