"""Staged and curated tables, pruned to the partitions asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..layout import Layout


def _pruned(df: DataFrame, **wanted: object) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def load_staged(
    spark: SparkSession,
    layout: Layout,
    product: str,
    year: int | None = None,
    quarter: int | None = None,
    version: str | None = None,
) -> DataFrame:
    """Staged hourly rows of a product; all quarters unless told otherwise."""
    df = spark.read.parquet(layout.staged(product))
    return _pruned(df, dataset_version=version, year=year, quarter=quarter)


def load_features(
    spark: SparkSession,
    layout: Layout,
    table: str,
    year: int | None = None,
    quarter: int | None = None,
    version: str | None = None,
) -> DataFrame:
    df = spark.read.parquet(layout.curated(table))
    return _pruned(df, dataset_version=version, year=year, quarter=quarter)


def load_versions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    year: int | None = None,
    quarter: int | None = None,
    version: str | None = None,
) -> DataFrame:
    """A table whose partitions were written with different schemas, under one that holds them all.

    ``enrich.wider_schema`` makes it.  A column that a file lacks is NULL there,
    narrower types are widened by the scan, and no footer is read to plan it.
    """
    df = spark.read.schema(schema).parquet(path)
    return _pruned(df, dataset_version=version, year=year, quarter=quarter)
