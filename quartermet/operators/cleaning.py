"""From parsed rows to staged rows: sentinels, flags, units, time parts.

Every step is a projection, so the whole chain is one narrow stage that Spark
fuses with the scan; no step counts or collects.  Counts come from
``cleaning_metrics`` (one aggregate) or from ``observed_metrics`` (inside the
write).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.counted import counted
from ..functions.columns import outside, version_name, without_sentinel
from ..model import PIPELINE, PRODUCT_SCHEMAS, STATION, Profile, measure_columns


def null_sentinels(df: DataFrame, product: str) -> DataFrame:
    """-999 becomes NULL in every measure and in the quality flag."""
    wanted = set(measure_columns(product))
    return df.withColumns(
        {
            c: without_sentinel(c)
            for c in df.columns
            if c in wanted or c.startswith("QN_")
        }
    )


def flag_quality(df: DataFrame, profile: Profile = PIPELINE) -> DataFrame:
    """Add quality_acceptable from the first quality column, if there is one."""
    flags = [c for c in df.columns if c.startswith("QN_")]
    if not flags:
        return df
    good = F.coalesce(F.col(flags[0]) >= profile.quality_min, F.lit(False))
    return df.withColumn("quality_acceptable", good)


def to_si(df: DataFrame) -> DataFrame:
    """Pressure columns in Pa beside those in hPa."""
    return df.withColumns({f"{c}_pa": F.col(c) * 100 for c in ("P", "P0") if c in df.columns})


def add_time_parts(df: DataFrame) -> DataFrame:
    t = F.col("timestamp")
    return df.withColumns(
        {
            "year": F.year(t),
            "quarter": F.quarter(t),
            "month": F.month(t),
            "day": F.dayofmonth(t),
            "hour": F.hour(t),
        }
    )


def outlier_rules(columns: list[str], product: str, profile: Profile = PIPELINE) -> dict[str, Column]:
    """Out-of-range condition of each rule whose column is present."""
    rules = profile.valid.get(product, {})
    return {c: outside(c, low, high) for c, (low, high) in rules.items() if c in columns}


def flag_outliers(df: DataFrame, product: str, profile: Profile = PIPELINE) -> DataFrame:
    """Add has_outlier: any rule broken; false for products without rules."""
    rules = outlier_rules(df.columns, product, profile).values()
    return df.withColumn("has_outlier", reduce(Column.__or__, rules, F.lit(False)))


def add_processing_metadata(df: DataFrame, product: str) -> DataFrame:
    return df.withColumns({"cleaned_at": F.current_timestamp(), "product_type": F.lit(product)})


def add_version(df: DataFrame, version: str | Column | None = None) -> DataFrame:
    """Add dataset_version if absent; by default one staged version per quarter."""
    if "dataset_version" in df.columns:
        return df
    if version is None:
        version = version_name("year", "quarter", "staged")
    return df.withColumn("dataset_version", F.lit(version) if isinstance(version, str) else version)


def clean(df: DataFrame, product: str, profile: Profile = PIPELINE) -> DataFrame:
    """The whole cleaning chain for one product."""
    if product not in PRODUCT_SCHEMAS:
        raise ValueError(f"unknown product {product!r}")
    df = df.transform(null_sentinels, product).transform(flag_quality, profile)
    if product == "pressure":
        df = df.transform(to_si)
    return (
        df.transform(add_time_parts)
        .transform(flag_outliers, product, profile)
        .transform(add_processing_metadata, product)
    )


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with station and time, and rows lacking one of them."""
    keyed = F.col(STATION).isNotNull() & F.col("timestamp").isNotNull()
    return df.where(keyed), df.where(~keyed)


# --------------------------------------------------------------- metrics

def parse_metric_columns(df: DataFrame, product: str) -> list[Column]:
    """Rows, NULLs per nullable column, distinct stations, time range."""
    nullable = [f.name for f in PRODUCT_SCHEMAS[product].fields if f.nullable]
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in nullable if c in df.columns],
        F.countDistinct(STATION).alias("distinct_stations"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
    ]


def parse_metrics(df: DataFrame, product: str) -> DataFrame:
    """One row; one scan for all metrics."""
    return df.agg(*parse_metric_columns(df, product))


def cleaning_metric_columns(df: DataFrame, product: str) -> list[Column]:
    rows = F.count(F.lit(1))
    out = [
        rows.alias("total_rows"),
        F.count_if("has_outlier").alias("rows_with_outliers"),
        F.count_if("quality_acceptable").alias("rows_acceptable_quality"),
    ]
    for c in measure_columns(product):
        if c in df.columns:
            missing = F.count_if(F.col(c).isNull())
            out += [
                missing.alias(f"missing_{c}"),
                F.round(F.coalesce(F.try_divide(missing, rows), F.lit(0.0)), 4).alias(
                    f"missing_ratio_{c}"
                ),
            ]
    return out


def cleaning_metrics(df: DataFrame, product: str) -> DataFrame:
    """Outlier, quality and missing counts of a cleaned table, in one row."""
    return df.agg(*cleaning_metric_columns(df, product))


def quality_share(df: DataFrame, *by: str) -> DataFrame:
    """Share of acceptable rows, overall or per group."""
    good = F.col("quality_acceptable").cast("int")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(good).cast("bigint").alias("acceptable_rows"),
        F.avg(good).alias("acceptable_share"),
    )


def observed_metrics(
    df: DataFrame, product: str
) -> tuple[DataFrame, Callable[[], dict[str, object]]]:
    """Attach the cleaning metrics to whatever action runs next on the table."""
    return counted(df, *cleaning_metric_columns(df, product))
