from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

STAGED = (
    "STATIONS_ID int, timestamp timestamp_ntz, {measures}, quality_acceptable boolean, "
    "dataset_version string"
)


def staged(spark, measures: str, rows, start=datetime(2023, 1, 1), version="v1"):
    """Staged rows: each entry is (station, hour offset or time, values..., acceptable)."""
    made = []
    for station, hour, *values, good in rows:
        when = hour if isinstance(hour, datetime) else start + timedelta(hours=hour)
        made.append((station, when, *values, good, version))
    df = spark.createDataFrame(made, STAGED.format(measures=measures))
    t = F.col("timestamp")
    return df.withColumns({"year": F.year(t), "quarter": F.quarter(t), "has_outlier": F.lit(False)})


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()
