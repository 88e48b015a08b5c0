"""Directory listings to a manifest of raw files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import object_path, period_year
from ..model import PRODUCT_PREFIXES


def parse_listing(pages: DataFrame, html: str = "html") -> DataFrame:
    """Archive files named in listing pages: variable, station, year, object path.

    A line counts if it holds a product prefix and a quoted ``.zip`` name; the
    file name is its first link, the station the third token of that name.
    """
    lines = pages.select(F.explode(F.split(html, "\n")).alias("line")).where(
        F.col("line").contains('.zip"')
    )
    variable = F.coalesce(
        *[F.when(F.col("line").contains(p), F.lit(v)) for v, p in PRODUCT_PREFIXES.items()]
    )
    name = F.regexp_extract("line", 'href="([^"]*)"', 1)
    token = F.get(F.split("filename", "_"), F.lit(2))
    found = lines.select(variable.alias("variable"), name.alias("filename")).where(
        F.col("variable").isNotNull() & F.col("filename").endswith(".zip")
    )
    return (
        found.select("variable", token.alias("station_id"), "filename", period_year("filename").alias("year"))
        .where(F.col("station_id").isNotNull())
        .withColumn("object_path", object_path("variable", "station_id", "year", "filename"))
    )


def restrict_stations(manifest: DataFrame, stations: Sequence[str] | DataFrame) -> DataFrame:
    """Files of the given stations: a short list, or a table of any size."""
    if isinstance(stations, DataFrame):
        return manifest.join(stations.select("station_id").distinct(), "station_id", "left_semi")
    return manifest.where(F.col("station_id").isin(list(stations)))


def skip_loaded(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files whose object path is not there yet."""
    return manifest.join(loaded.select("object_path"), "object_path", "left_anti")


def with_status(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Every file as processed (to load) or skipped (already there)."""
    there = loaded.select("object_path").distinct().withColumn("_there", F.lit(True))
    return manifest.join(there, "object_path", "left").select(
        *manifest.columns, F.when(F.col("_there"), "skipped").otherwise("processed").alias("status")
    )
