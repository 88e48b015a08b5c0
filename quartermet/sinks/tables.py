"""Partitioned parquet tables that can be rewritten by quarter.

Tables are partitioned by version, year and quarter, the columns every read
filters on.  Rows are rebalanced by those columns before the write: Spark then
makes files near its advisory size, merging small quarters and splitting a
quarter that holds much of the data.  Files are sorted by station, so a read of
one station skips row groups.  A run replaces the quarters it computes
and no others (dynamic partition overwrite), so running it twice gives the same
table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.counted import counted
from ..model import STATION
from ..operators.cleaning import add_version
from ..session import shared_folder
from .partitions import read_partitions, within_reach, write_partitions

PARTITIONS = ("dataset_version", "year", "quarter")
BY_STATION = (STATION, "year")
ROW_BYTES = 100  # estimate for a staged row, as for the raw text it comes from
MODES = ("overwrite", "append", "error", "replace")


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = PARTITIONS,
    mode: str = "overwrite",
    target_file_mb: int = 128,
    also: tuple[Column, ...] = (),
    parallel_commit: bool = False,
    rebalance: bool = True,
) -> dict[str, object]:
    """Write and return statistics, which are taken during the write.

    ``table_statistics`` reads a table back for exact ones.

    ``overwrite`` replaces the partitions present in the rows, ``replace`` the
    whole table.  ``also`` adds further aggregates to the statistics.

    ``parallel_commit`` has tasks move their files to their places as they end,
    instead of the driver all of them one after the other; it is for new tables
    of many small partitions, as a run that fails leaves files.  Such rows are
    appended by ``write_partitions`` where Arrow knows the store and the types.

    ``rebalance=False`` is for rows that come with each partition in one task, of
    even size, as hours shuffled by station do: they are not shuffled again.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    absent = [c for c in partition_by if c not in df.columns]
    if absent:
        raise ValueError(f"partition columns {absent} are not in the table")
    inner = [c for c in ("station_id", STATION, "timestamp") if c in df.columns and c not in partition_by]
    rows, wrote = counted(df, F.count(F.lit(1)).alias("rows_written"), *also)
    if rebalance:
        rows = rows.hint("rebalance", *partition_by)
    rows = rows.sortWithinPartitions(*partition_by, *inner)
    rows_per_file = target_file_mb * 1024 * 1024 // ROW_BYTES
    if parallel_commit and mode == "append" and within_reach(path, df.schema, partition_by):
        write_partitions(rows, path, partition_by, rows_per_file)
        return {"path": path, "partition_by": list(partition_by), "mode": mode, **wrote()}
    writer = rows.write.partitionBy(*partition_by).option("compression", "snappy")
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    if parallel_commit:
        if mode == "overwrite":
            raise ValueError("partitions are replaced by the driver: parallel_commit needs another mode")
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
    elif mode == "replace":
        writer = writer.option("partitionOverwriteMode", "static").mode("overwrite")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)
    return {"path": path, "partition_by": list(partition_by), "mode": mode, **wrote()}


def write_staged(df: DataFrame, path: str, version: str | None = None, **options) -> dict[str, object]:
    """Staged rows; the version column is added if it is absent."""
    return write_partitioned(add_version(df, version), path, **options)


def merge_staged(df: DataFrame, path: str) -> None:
    """Staged rows added to the quarters present in them; rows of the same station, time and version are replaced.

    Of equal ones among the new rows one stays.

    Doing it twice is doing it once, so a batch that is repeated after a failure
    does no harm.  The quarters are rewritten by way of the shared folder.
    """
    spark = df.sparkSession
    key = ["dataset_version", STATION, "timestamp"]
    work = shared_folder(spark, "merge")
    df.dropDuplicates(key).write.parquet(f"{work}/new")
    new = spark.read.parquet(f"{work}/new")
    have = read_log(spark, path)
    if have is None:
        write_partitioned(new, path)
        return
    kept = have.join(new.select(*PARTITIONS).distinct(), list(PARTITIONS), "left_semi")
    kept = kept.join(new.select(*key), key, "left_anti")
    kept.write.parquet(f"{work}/kept")
    write_partitioned(spark.read.parquet(f"{work}/kept").unionByName(new, allowMissingColumns=True), path)


def write_by_station(df: DataFrame, path: str, version: str | None = None, **options) -> dict[str, object]:
    """Staged rows laid out by station and year."""
    return write_staged(df, path, version, partition_by=BY_STATION, **options)


def read_by_station(
    spark: SparkSession, path: str, schema: T.StructType, tasks: int, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a table laid out by station and year, and the file of each as ``_file``.

    It has a folder for each station and year: tasks list them and open their files, where Arrow knows the store.
    """
    if within_reach(path, schema, BY_STATION):
        return read_partitions(spark, path, schema, BY_STATION, tasks, columns)
    stored = spark.read.schema(schema).parquet(path)
    return stored.select(*columns or schema.names, F.col("_metadata.file_path").alias("_file"))


def table_statistics(df: DataFrame, file: str = "_metadata.file_path", fields: int | None = None) -> DataFrame:
    """Read-back check of a written table: one row, one scan.

    Rows are first summed up by file and station, so that the distinct counts
    work on few of them.  ``file`` names the file of a row, ``fields`` is the
    number of the table's columns if not all of them were read.
    """
    station = next((c for c in (STATION, "station_id") if c in df.columns), None)
    timed = "timestamp" in df.columns
    own = [F.count(F.lit(1)).alias("n")]
    if timed:
        own += [F.min("timestamp").alias("low"), F.max("timestamp").alias("high")]
    keys = [F.col(file).alias("_file")] + ([F.col(station).alias("_station")] if station else [])
    summed = df.groupBy(*keys).agg(*own)
    parts = [F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.lit(fields or len(df.columns)).alias("schema_fields")]
    parts.append(F.countDistinct("_file").alias("files"))
    if timed:
        parts += [F.min("low").alias("min_timestamp"), F.max("high").alias("max_timestamp")]
    if station:
        parts.append(F.countDistinct("_station").alias("distinct_stations"))
    return summed.agg(*parts)


# ----------------------------------------------------------------- features

Target = tuple[str, int, int]  # version, year, quarter


def _partition_path(path: str, target: Target) -> str:
    version, year, quarter = target
    if not re.fullmatch(r"[\w.\-]+", version):
        raise ValueError(f"version {version!r} may hold letters, digits, '_', '.' and '-' only")
    return f"{path}/dataset_version={version}/year={int(year)}/quarter={int(quarter)}"


def remove(spark: SparkSession, folder: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _matches(target: Target):
    version, year, quarter = target
    return (
        (F.col("dataset_version") == version) & (F.col("year") == year) & (F.col("quarter") == quarter)
    )


def upsert_features(
    df: DataFrame, path: str, targets: Iterable[Target] = (), mode: str = "overwrite"
) -> dict[str, object]:
    """Replace the quarters present in the rows.

    ``targets`` names the quarters the run was asked for: one for which no row
    came out is emptied too, so that no old result survives it.
    """
    targets = list(targets)
    per_target = [F.count_if(_matches(t)).alias(f"target_{i}") for i, t in enumerate(targets)]
    wrote = write_partitioned(df, path, PARTITIONS, mode, also=tuple(per_target))
    for i, target in enumerate(targets):
        if wrote.pop(f"target_{i}") == 0 and mode == "overwrite":
            remove(df.sparkSession, _partition_path(path, target))
    return wrote


def delete_features(
    spark: SparkSession, path: str, target: Target, station_id: int | None = None
) -> None:
    """Delete a quarter of a version, or one station of it."""
    if station_id is None:
        remove(spark, _partition_path(path, target))
        return
    quarter = spark.read.parquet(path).where(_matches(target))
    rest = quarter.where(F.col("station_id") != station_id)
    if rest.isEmpty():
        remove(spark, _partition_path(path, target))
    else:
        write_partitioned(rest, path, PARTITIONS)


def append_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    """Append to a database table; needs a JDBC driver on the class path."""
    df.write.jdbc(url, table, mode="append", properties=properties)


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to an event log."""
    df.write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str, **options: str) -> DataFrame | None:
    """A stored table, None where nothing was written yet; other errors are errors."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as error:
        # Only a table that is not there, or holds no file, is a first run's.
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
