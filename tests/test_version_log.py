"""Version queries read the whole event log."""

from __future__ import annotations

from datetime import datetime

from quartermet.plans import queries_catalog, views


def test_versions_are_folded_from_all_events(spark, monkeypatch):
    day = [datetime(1998, 6, 1 + k) for k in range(4)]
    rows = [
        (1, "a", "v1", day[1], 0, "pending"), (2, "a", "v2", day[2], 0, "pending"), (2, "b", None, day[3], 1, None),
        (3, None, None, day[3], 0, "pending"), (3, "a", "v3", day[0], 1, "available"), (4, "a", "v4", day[3], 1, None),
    ]
    log = spark.createDataFrame(
        rows, "version_id long, dataset_name string, version string, at timestamp_ntz, step long, status string"
    )
    log = log.selectExpr("*", "CAST(NULL AS bigint) AS record_count", "step AS total_size_bytes")
    monkeypatch.setattr(views, "version_events", lambda spark, sf_dir: log)
    latest = {r.dataset_name: r.version for r in queries_catalog.version_latest(spark, "").collect()}
    assert latest == {"a": "v3", "b": "v2"}
    assert [r.version_id for r in queries_catalog.version_recent(spark, "").collect()] == [3, 2, 1]
