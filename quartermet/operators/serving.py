"""Reads behind the service: filtered pages, time series, counts, reports.

Pages sort on a total order and take offset and limit, which Spark plans as a
distributed top-k; totals are a separate aggregate, so a page never waits for a
full count.  A page can also start behind the last row of the one before it
(``after``): then nothing is skipped over, and on a table partitioned by quarter
the quarters before it are not read at all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import percent
from .quality import PERIOD, tagged

PRODUCTS = ("temperature", "precipitation", "wind", "pressure", "humidity")


def _check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= 1000:
        raise ValueError(f"limit must be between 1 and 1000, got {limit}")
    if offset < 0:
        raise ValueError(f"offset must not be negative, got {offset}")


def page(df: DataFrame, order: list[Column | str], limit: int = 50, offset: int = 0) -> DataFrame:
    _check_page(limit, offset)
    return df.orderBy(*order).offset(offset).limit(limit)


def total(df: DataFrame) -> DataFrame:
    """Row count of a filtered read, before paging."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def product_table(tables: dict[str, DataFrame], product: str) -> DataFrame:
    if product not in tables:
        raise ValueError(f"invalid product {product!r}, expected one of {', '.join(tables)}")
    return tables[product]


# -------------------------------------------------------------- features

def filter_features(
    df: DataFrame,
    *,
    station_id: int | None = None,
    year: int | None = None,
    quarter: int | None = None,
    min_year: int | None = None,
    max_year: int | None = None,
) -> DataFrame:
    """Conjunction of the filters given; bounds on the year are inclusive."""
    if quarter is not None and quarter not in (1, 2, 3, 4):
        raise ValueError(f"quarter must be between 1 and 4, got {quarter}")
    for y in (year, min_year, max_year):
        if y is not None and not 1900 <= y <= 2100:
            raise ValueError(f"year must be between 1900 and 2100, got {y}")
    tests = []
    for name, value in (("station_id", station_id), ("year", year), ("quarter", quarter)):
        if value is not None:
            tests.append(F.col(name) == value)
    if min_year is not None:
        tests.append(F.col("year") >= min_year)
    if max_year is not None:
        tests.append(F.col("year") <= max_year)
    return df.where(reduce(Column.__and__, tests)) if tests else df


#: Key of the last row of a page: year, quarter, station_id, dataset_version.
Cursor = tuple[int, int, int, str]


def _behind(cursor: Cursor, newest_first: bool) -> Column:
    """Rows that come behind a row in the order of a page, with the partitions told first."""
    year, quarter, station, version = cursor
    y, q, s, v = F.col("year"), F.col("quarter"), F.col("station_id"), F.col("dataset_version")
    within = (s > station) | ((s == station) & (v > version))
    if newest_first:
        return (y <= year) & ((y < year) | (q < quarter) | ((q == quarter) & within))
    return (y >= year) & ((y > year) | (q > quarter) | ((q == quarter) & within))


def feature_page(
    df: DataFrame, limit: int = 50, offset: int = 0, after: Cursor | None = None, **filters: int
) -> DataFrame:
    """Newest quarter first, stations ascending within it; ``after`` is the key of the row before the page."""
    order = [F.desc("year"), F.desc("quarter"), "station_id", "dataset_version"]
    rows = filter_features(df, **filters)
    return page(rows.where(_behind(after, True)) if after else rows, order, limit, offset)


def station_series(
    df: DataFrame, station_id: int, limit: int = 50, offset: int = 0, after: Cursor | None = None
) -> DataFrame:
    """All quarters of one station in time order; ``after`` as for ``feature_page``."""
    rows = filter_features(df, station_id=station_id)
    rows = rows.where(_behind(after, False)) if after else rows
    return page(rows, ["year", "quarter", "dataset_version"], limit, offset)


def feature_stats(df: DataFrame, product: str) -> DataFrame:
    return df.agg(
        F.lit(product).alias("product"),
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("station_id").alias("station_count"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
        F.min("quarter").alias("min_quarter"),
        F.max("quarter").alias("max_quarter"),
    )


def available_products(tables: dict[str, DataFrame]) -> DataFrame:
    """Each product with its record and station count."""
    return (
        tagged(tables, "station_id")
        .groupBy(F.col("product").alias("name"))
        .agg(F.count(F.lit(1)).alias("record_count"), F.countDistinct("station_id").alias("station_count"))
        .withColumn("table", F.concat(F.lit("quarterly_"), "name", F.lit("_features")))
    )


def product_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, stations, years and year range per product."""
    return tagged(tables, "station_id", "year").groupBy("product").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("station_id").alias("unique_stations"),
        F.countDistinct("year").alias("unique_years"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )


def quarter_row_counts(tables: dict[str, DataFrame], year: int, quarter: int) -> DataFrame:
    """Rows of one quarter per product."""
    rows = filter_features(tagged(tables, *PERIOD), year=year, quarter=quarter)
    return rows.groupBy("product").agg(F.count(F.lit(1)).alias("rows"))


def counts_by_quarter(df: DataFrame, newest: int | None = None) -> DataFrame:
    """Rows per quarter, newest first; optionally only the newest few."""
    rows = df.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("row_count"))
    rows = rows.orderBy(F.desc("year"), F.desc("quarter"))
    return rows.limit(newest) if newest else rows


def table_sizes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row holding the row count of every table."""
    return tagged(tables).groupBy().pivot("product", list(tables)).count()


def freshness(tables: dict[str, DataFrame]) -> DataFrame:
    """Latest quarter present per product."""
    number = F.col("year") * 4 + F.col("quarter") - 1  # quarters in one running number
    latest = tagged(tables, *PERIOD).groupBy("product").agg(F.max(number).alias("latest"))
    return latest.select(
        "product",
        F.floor(F.col("latest") / 4).cast("int").alias("latest_year"),
        (F.col("latest") % 4 + 1).alias("latest_quarter"),
    )


def latest_per_station(df: DataFrame, k: int = 20) -> DataFrame:
    """The k stations with the newest data."""
    rows = df.groupBy("station_id").agg(F.max("quarter_end").alias("latest_data"))
    return rows.orderBy(F.desc("latest_data"), "station_id").limit(k)


def value_summary(df: DataFrame, column: str) -> DataFrame:
    """Range, mean and NULL share of one feature."""
    c = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(c.isNull()).alias("nulls"),
        percent(F.count_if(c.isNull()), F.count(F.lit(1))).alias("null_pct"),
        F.min(c).alias("min_value"),
        F.max(c).alias("max_value"),
        F.avg(c).alias("avg_value"),
    )


def missingness_report(df: DataFrame, above: float = 0.2) -> DataFrame:
    """Station-quarters missing too much, worst first."""
    rows = df.where(F.col("missingness_ratio") > above)
    return rows.select("station_id", "year", "quarter", "missingness_ratio").orderBy(
        F.desc("missingness_ratio"), "station_id", "year", "quarter"
    )


# -------------------------------------------------------------- stations

def filter_stations(
    df: DataFrame, *, is_active: bool | None = None, state: str | None = None
) -> DataFrame:
    if is_active is not None:
        df = df.where(F.col("is_active") == is_active)
    return df.where(F.col("state") == state) if state else df


def station_page(
    df: DataFrame,
    limit: int = 50,
    offset: int = 0,
    *,
    is_active: bool | None = None,
    state: str | None = None,
) -> DataFrame:
    return page(filter_stations(df, is_active=is_active, state=state), ["station_id"], limit, offset)


def station(df: DataFrame, station_id: int) -> DataFrame:
    """One station, or no row."""
    return df.where(F.col("station_id") == station_id)


def station_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("station_id").alias("station_count"))


def station_summary(stations: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Every station with its rows per product and in all."""
    names = list(tables)
    counts = tagged(tables, "station_id").groupBy("station_id").pivot("product", names).count()
    zero = [F.coalesce(F.col(n), F.lit(0).cast("bigint")).alias(n) for n in names]
    kept = [c for c in stations.columns]
    out = stations.join(counts, "station_id", "left").select(*kept, *zero)
    return out.withColumn("total_records", reduce(Column.__add__, [F.col(n) for n in names]))


def derive_stations(df: DataFrame) -> DataFrame:
    """Station table from feature rows: distinct attributes, first and last day."""
    first = F.make_date("year", F.col("quarter") * 3 - 2, F.lit(1))
    last = F.last_day(F.make_date("year", F.col("quarter") * 3, F.lit(1)))
    attributes = ["station_id", "station_name", "latitude", "longitude", "elevation_m"]
    return df.groupBy(*attributes).agg(
        F.min(first).alias("start_date"), F.max(last).alias("end_date"), F.lit(True).alias("is_active")
    )
