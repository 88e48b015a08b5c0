"""The station table: from its list file, from parquet, from a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the station list file, in file order.
STATION_LIST = (
    "Stations_id int, von_datum string, bis_datum string, Stationshoehe int, geoBreite double, "
    "geoLaenge double, Stationsname string, Bundesland string"
)
OPEN_END = "99999999"
DATE_FORMAT = "yyyyMMdd"


def station_columns(rows: DataFrame) -> DataFrame:
    """List-file columns to the station table; an open end means active."""
    day = F.lit(DATE_FORMAT)
    end = F.when(F.col("bis_datum") != OPEN_END, F.col("bis_datum"))
    return rows.select(
        F.col("Stations_id").alias("station_id"),
        F.col("Stationsname").alias("station_name"),
        F.col("geoBreite").alias("latitude"),
        F.col("geoLaenge").alias("longitude"),
        F.col("Stationshoehe").alias("elevation_m"),
        F.col("Bundesland").alias("state"),
        F.try_to_date("von_datum", DATE_FORMAT).alias("start_date"),
        F.try_to_date(end, DATE_FORMAT).alias("end_date"),
        F.coalesce(F.col("bis_datum") == OPEN_END, F.lit(False)).alias("is_active"),
    )


def read_station_list(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    rows = (
        spark.read.options(
            sep=";", header="true", encoding=encoding, mode="PERMISSIVE",
            ignoreLeadingWhiteSpace="true", ignoreTrailingWhiteSpace="true",
        )
        .schema(STATION_LIST)
        .csv(path)
    )
    return station_columns(rows)


def parse_station_lines(lines: DataFrame) -> DataFrame:
    """The same from text lines (column value), header lines skipped."""
    body = lines.where(F.col("value").rlike(r"^\s*\d"))
    options = {"sep": ";", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    row = F.from_csv("value", STATION_LIST, options)
    return station_columns(body.select(row.alias("r")).select("r.*"))


def load_stations(spark: SparkSession, path: str | None = None, **jdbc: str) -> DataFrame:
    """Station attributes for the feature join, from parquet or a JDBC table.

    JDBC needs ``url`` and ``dbtable`` and a driver on the class path.
    """
    if path is not None:
        df = spark.read.parquet(path)
    else:
        df = spark.read.format("jdbc").options(**jdbc).load()
    return df.select("station_id", "station_name", "latitude", "longitude", "elevation_m")
