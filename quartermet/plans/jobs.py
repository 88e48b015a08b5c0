"""Whole jobs: raw to staged, staged to curated, over all stations and quarters.

A job reads its input once per branch of its plan (staging once more, to judge
it before writing), writes once and takes its counts from that write.  Every run is recorded, failed ones too; a curating run
also appends version events and lineage edges, so the catalogue follows from
the work done.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..layout import Layout
from ..model import CURATED_NAMES, PIPELINE, Profile, product_schema
from ..operators.catalog import add_lineage
from ..operators.cleaning import add_version, clean, observed_metrics, split_rejects
from ..operators.enrich import enrich, to_contract
from ..operators.features import features
from ..operators.quality import require_parsed
from ..operators.runs import run_record
from ..sinks.tables import append_log, read_log, upsert_features, write_staged
from ..sources.archives import read_archives
from ..sources.observations import read_named, read_observations
from ..sources.staged import load_features, load_staged

MAX_PARSE_ERRORS = 0.30


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _recorded(
    spark: SparkSession, layout: Layout, job: str, product: str, version: str | None,
    work: Callable[[], dict[str, object]],
) -> dict[str, object]:
    """Run the work and append its record, whatever comes of it."""
    started = _now()
    base = {
        "run_id": uuid.uuid4().hex, "job": job, "product_type": product,
        "dataset_version": version, "started_at": started,
    }

    def log(status: str, **more: object) -> dict[str, object]:
        ended = _now()
        record = {
            **base, "status": status, "ended_at": ended,
            "elapsed_seconds": round((ended - started).total_seconds(), 2), **more,
        }
        append_log(run_record(spark, **record), layout.log("runs"))
        return record

    try:
        metrics = work()
    except Exception as error:
        log("failed", error=str(error))
        raise
    return log("success", metrics={k: str(v) for k, v in metrics.items()})


# ------------------------------------------------------------------ staging

def stage(
    spark: SparkSession,
    layout: Layout,
    product: str,
    *,
    profile: Profile = PIPELINE,
    version: str | None = None,
    archives: bool = False,
    pattern: str = "*.txt",
    mode: str = "overwrite",
    by_name: bool = False,
    aliases: dict[str, str] | None = None,
) -> dict[str, object]:
    """Raw files of a product to its staged table.

    Columns are taken by position, or with ``by_name`` by the names in each file's
    header (``aliases`` names those that are called otherwise there).

    Rows without station or time are left out and counted; too large a share of
    them fails the run before anything is written.
    """
    product_schema(product)
    if archives and by_name:
        raise ValueError("columns of archives are taken by position")

    def work() -> dict[str, object]:
        if archives:
            raw = read_archives(spark, layout.raw(product), product)
        elif by_name:
            raw = read_named(spark, layout.raw(product), product, pattern, aliases)
        else:
            raw = read_observations(spark, layout.raw(product), product, pattern)
        # Exact counts from a pass of their own: the decision comes before the write.
        parsed = require_parsed(raw, MAX_PARSE_ERRORS)
        rows = clean(split_rejects(raw)[0], product, profile)
        rows, cleaned = observed_metrics(rows, product)
        wrote = write_staged(rows, layout.staged(product), version, mode=mode)
        return {**parsed, **cleaned(), "rows_written": wrote["rows_written"]}

    return _recorded(spark, layout, "stage", product, version, work)


# ----------------------------------------------------------------- curating

def curate(
    spark: SparkSession,
    layout: Layout,
    product: str,
    stations: DataFrame,
    *,
    profile: Profile = PIPELINE,
    year: int | None = None,
    quarter: int | None = None,
    staged_version: str | None = None,
    version: str | Column | None = None,
    mode: str = "overwrite",
    **options: bool,
) -> dict[str, object]:
    """Staged rows to the curated features of a product.

    All quarters in one run, or one of them.  ``version`` names the curated
    rows; by default they keep the version of their staged rows.  A name wants
    one staged version in each quarter: name it in ``staged_version`` if there
    are several.
    """
    if product not in CURATED_NAMES:
        raise ValueError(f"no features for product {product!r}")
    table = CURATED_NAMES[product]

    def work() -> dict[str, object]:
        rows = load_staged(spark, layout, product, year, quarter, staged_version)
        staged_names = F.col("dataset_version").alias("staged_version")
        sources = rows.select("year", "quarter", staged_names).distinct()
        if version is None:
            sources = sources.withColumn("dataset_version", F.col("staged_version"))
        else:
            _one_staged_version(sources)
            sources = add_version(sources, version)
        made = features(rows, product, profile, **options)
        if version is not None:
            made = add_version(made.drop("dataset_version"), version)
        out = to_contract(enrich(made, stations), table)
        targets = []
        if isinstance(version, str) and year is not None and quarter is not None:
            targets = [(version, year, quarter)]
        wrote = upsert_features(out, layout.curated(table), targets, mode)
        _catalogue(spark, layout, table, sources)
        return wrote

    label = version if isinstance(version, str) else staged_version
    return _recorded(spark, layout, "curate", product, label, work)


def _one_staged_version(sources: DataFrame) -> None:
    """Raise if rows of several staged versions would get one name."""
    several = sources.groupBy("year", "quarter").count().where("count > 1").orderBy("year", "quarter")
    if found := several.take(3):
        quarters = ", ".join(f"{r['year']}Q{r['quarter']}" for r in found)
        raise ValueError(f"several staged versions in {quarters}: name one in staged_version")


def _catalogue(spark: SparkSession, layout: Layout, table: str, sources: DataFrame) -> None:
    """Version events and lineage edges of the quarters just written.

    ``sources`` has the run's own quarters with their staged and curated
    versions; versions that the run never touched stay as they are.
    """
    dataset = f"curated_{table}_features"
    own = ["dataset_version", "year", "quarter"]
    done = (
        load_features(spark, layout, table)
        .join(sources.select(*own).distinct(), own, "left_semi")
        .groupBy(*own)
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.avg("missingness_ratio").cast("double").alias("avg_missingness_ratio"),
        )
    )
    edges = done.join(sources, own).select(
        F.concat_ws(":", F.lit(dataset), "dataset_version").alias("child_id"),
        F.concat_ws(":", F.lit(f"staged_{table}"), "staged_version").alias("parent_id"),
        F.lit("aggregation").alias("transformation_type"),
    )
    known = read_log(spark, layout.log("lineage"))
    append_log(add_lineage(known, edges), layout.log("lineage"))
    events = done.select(
        F.concat_ws(":", F.lit(dataset), "dataset_version").alias("version_id"),
        F.lit(dataset).alias("dataset_name"),
        F.col("dataset_version").alias("version"),
        F.current_timestamp().alias("at"),
        F.lit(1).cast("bigint").alias("step"),
        F.lit("available").alias("status"),
        "record_count",
        F.to_json(F.struct("avg_missingness_ratio", "record_count")).alias("quality_metrics"),
        F.to_json(F.struct("year", "quarter")).alias("metadata"),
    )
    append_log(events, layout.log("versions"))


# ------------------------------------------------------------------- batches

def run_all(jobs: Iterable[tuple[str, Callable[[], dict[str, object]]]]) -> dict[str, dict[str, object]]:
    """Run named jobs one after another; a failed one does not stop the rest."""
    results: dict[str, dict[str, object]] = {}
    for name, job in jobs:
        try:
            results[name] = job()
        except Exception as error:
            results[name] = {"status": "failed", "error": str(error)}
    return results


def stage_products(
    spark: SparkSession, layout: Layout, products: Iterable[str], **options
) -> dict[str, dict[str, object]]:
    return run_all((p, lambda p=p: stage(spark, layout, p, **options)) for p in products)


def curate_products(
    spark: SparkSession, layout: Layout, stations: DataFrame,
    products: Iterable[str] = tuple(CURATED_NAMES), **options,
) -> dict[str, dict[str, object]]:
    return run_all((p, lambda p=p: curate(spark, layout, p, stations, **options)) for p in products)
