"""Work lists and run records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ratio
from ..model import CURATED_NAMES
from .catalog import fold_versions

ALL_QUARTERS = (1, 2, 3, 4)


def work_list(
    spark: SparkSession,
    first_year: int,
    last_year: int,
    *,
    quarters: Sequence[int] = ALL_QUARTERS,
    products: Sequence[str] = tuple(CURATED_NAMES),
    done: DataFrame | None = None,
    force: bool = False,
) -> DataFrame:
    """Year x quarter x product to process; what is done is left out unless forced."""
    items = (
        spark.range(first_year, last_year + 1)
        .select(F.col("id").cast("int").alias("year"), F.explode(F.lit(list(quarters))).alias("quarter"))
        .select("*", F.explode(F.lit(list(products))).alias("product"), F.lit(force).alias("force"))
    )
    if done is None or force:
        return items
    return items.join(done.select("year", "quarter", "product").distinct(), ["year", "quarter", "product"], "left_anti")


def ingestion_statistics(files: DataFrame, *by: str) -> DataFrame:
    """Counts of a manifest with status processed, skipped or failed, and bytes loaded."""
    def having(status: str):
        return F.count_if(F.col("status") == status).alias(status)

    loaded = F.when(F.col("status") == "processed", F.col("size_bytes")).otherwise(0)
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_files"),
        having("processed"),
        having("skipped"),
        having("failed"),
        F.sum(loaded).cast("bigint").alias("total_bytes"),
    )


def fold_runs(events: DataFrame) -> DataFrame:
    """Current state of ingestion runs from their events (run_id, at, step, and
    the values an event sets, such as variable, status, station_count, error)."""
    return fold_versions(events, ["run_id"], states=())


def run_quality(features: DataFrame, *by: str) -> DataFrame:
    """Mean missingness and station count of computed features."""
    return features.groupBy(*by).agg(
        F.avg("missingness_ratio").alias("avg_missingness_ratio"),
        F.countDistinct("station_id").alias("total_stations"),
        F.count(F.lit(1)).alias("feature_count"),
    )


def batch_summary(runs: DataFrame) -> DataFrame:
    """All, successful and failed runs of a run log."""
    ok = F.count_if(F.col("status") == "success")
    return runs.agg(
        F.count(F.lit(1)).alias("total"),
        ok.alias("successful"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        ratio(ok, F.count(F.lit(1))).alias("success_share"),
    )


RUN_RECORD = (
    "run_id string, job string, product_type string, dataset_version string, status string, "
    "started_at timestamp, ended_at timestamp, elapsed_seconds double, "
    "metrics map<string,string>, error string"
)


def run_record(spark: SparkSession, **values: object) -> DataFrame:
    """One row of the run log; absent values are NULL."""
    names = [f.split(" ")[0] for f in RUN_RECORD.split(", ")]
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"unknown run fields {sorted(unknown)}")
    return spark.createDataFrame([tuple(values.get(n) for n in names)], RUN_RECORD)
