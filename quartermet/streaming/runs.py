"""Running streams over what has arrived, and reading their results.

Streams run with ``availableNow``: everything present is processed, then the
query stops; the checkpoint remembers it.  Windowed results are written per
micro-batch (update mode: only windows that changed), each batch into its own
folder, so a batch that is repeated after a failure replaces itself.  A reader
takes the newest row of each window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import add_version, clean, split_rejects
from ..operators.quality import bad_files, require_parsed
from ..sinks.tables import merge_staged, read_log, remove
from ..sources.observations import stream_observations


def stream_table(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """Parquet files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)
    )


def with_event_time(df: DataFrame, lateness: str) -> DataFrame:
    """ts as a TIMESTAMP (watermarks want one) with a watermark; the session must run in UTC."""
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)


class LateRows(RuntimeError):
    """A stream dropped rows behind its watermark."""


@contextmanager
def _all_progress(spark: SparkSession) -> Iterator[None]:
    """Keep the progress of every batch of a run, not of the last hundred."""
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def run_windows(stream: DataFrame, path: str, checkpoint: str, allow_late: bool = False) -> dict[str, int]:
    """Run a windowed aggregate over all available input; returns rows_read and rows_late.

    Rows behind the watermark are dropped by Spark, which counts them (as groups,
    where a task has aggregated them before).  Unless they are allowed, a run that
    dropped any raises ``LateRows`` once its results are written.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with _all_progress(stream.sparkSession):
        query = (
            stream.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
        )
        query.awaitTermination()
        progress = query.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    if late and not allow_late:
        raise LateRows(f"{late} rows came after their windows were closed")
    return {"rows_read": sum(p["numInputRows"] for p in progress), "rows_late": late}


def _stored_windows(spark: SparkSession, path: str) -> list[DataFrame]:
    """What batches wrote, and what was folded before, each row with the number of its batch."""
    batches = read_log(spark, f"{path}/batch=*", basePath=path)
    folded = read_log(spark, f"{path}/folded")
    return [df for df in (batches, folded) if df is not None]


def _newest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in (*key, "batch")]
    best = F.max_by(F.struct(*rest), "batch").alias("_row")
    return rows.groupBy(*key).agg(best).select(*key, "_row.*")


def read_windows(spark: SparkSession, path: str, key: Sequence[str]) -> DataFrame:
    """Newest row of every window written by ``run_windows``."""
    stored = _stored_windows(spark, path)
    if not stored:
        raise ValueError(f"no windows were written to {path}")
    return _newest(reduce(DataFrame.unionByName, stored), key)


def fold_windows(spark: SparkSession, path: str, key: Sequence[str]) -> int:
    """Put the batches written so far into one table and remove them; returns how many.

    Without it every read goes through all batches there ever were.  To be
    called between runs.  A window's folded row counts as written by the newest
    batch folded, so one that is interrupted changes no result, and the next
    call removes what it left.
    """
    if read_log(spark, f"{path}/batch=*", basePath=path) is None:
        return 0
    # One number for each batch since the last call, told by its files: a batch may hold no row.
    files = spark.read.format("binaryFile").load(f"{path}/batch=*")
    number = F.regexp_extract("path", r"/batch=([0-9]+)/[^/]*$", 1).cast("int")
    numbers = [r["batch"] for r in files.select(number.alias("batch")).distinct().collect()]
    before = read_log(spark, f"{path}/folded")
    held = [r["batch"] for r in before.select("batch").distinct().collect()] if before is not None else []
    newest = max([*numbers, *held], default=0)
    if newest not in held:
        made = read_windows(spark, path, key).withColumn("batch", F.lit(newest))
        # The new folder appears by one rename; what it replaces goes after.
        writer = made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(f"{path}/folded")
    for n in numbers:
        remove(spark, f"{path}/batch={n}")
    for n in held:
        if n != newest:
            remove(spark, f"{path}/folded/batch={n}")
    return len(numbers)


def load_new_files(
    spark: SparkSession,
    folder: str,
    product: str,
    staged: str,
    checkpoint: str,
    pattern: str = "*.txt",
    max_rejects: float = 0.30,
    set_apart: str | None = None,
) -> int:
    """Clean and stage the raw files not seen by an earlier run; returns the rows staged.

    Rows without station or time are left out.  A file with too large a share of
    them is not staged: with ``set_apart`` it is listed there (file, rows_read,
    rows_rejected, batch) and the load goes on; without, the batch fails before it
    writes, and so does every later run, until the file is mended.  Rows are merged
    into the table that ``jobs.stage`` writes, so both can load the same folder, and
    a batch that is repeated replaces itself.
    """
    staged_rows = 0

    def write(batch: DataFrame, number: int) -> None:
        nonlocal staged_rows
        if set_apart is not None:
            bad = bad_files(batch, max_rejects).withColumnRenamed("_source_file", "file")
            # A folder for each batch: one that is repeated replaces its list.
            bad.write.mode("overwrite").parquet(f"{set_apart}/batch={number}")
            listed = spark.read.parquet(f"{set_apart}/batch={number}").select(F.col("file").alias("_source_file"))
            batch = batch.join(listed, "_source_file", "left_anti")
        seen = require_parsed(batch, max_rejects)
        if seen["rows_read"]:
            merge_staged(add_version(clean(split_rejects(batch)[0], product)), staged)
        staged_rows += seen["rows_read"] - seen["rows_rejected"]

    query = (
        stream_observations(spark, folder, product, pattern)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()
    return staged_rows


def files_set_apart(spark: SparkSession, set_apart: str) -> DataFrame:
    """The files that loads have set apart: file, rows_read, rows_rejected, batch."""
    return spark.read.option("basePath", set_apart).parquet(f"{set_apart}/batch=*")


def stream_metric(
    spark: SparkSession,
    stream: DataFrame,
    metric: Callable[[DataFrame], DataFrame],
    key: Sequence[str],
    folder: str,
    lateness: str = "1 hour",
    allow_late: bool = False,
) -> DataFrame:
    """A request metric computed by a stream, as a table; late rows raise unless they are allowed."""
    run_windows(metric(with_event_time(stream, lateness)), f"{folder}/out", f"{folder}/checkpoint", allow_late)
    return read_windows(spark, f"{folder}/out", key)


def run_alerts(
    spark: SparkSession, stream: DataFrame, alert: Callable[[DataFrame], DataFrame], folder: str, lateness: str = "1 hour"
) -> DataFrame:
    """Alerts that a stateful stream has fired, as a table; each is written once."""
    run_windows(alert(with_event_time(stream, lateness)), f"{folder}/out", f"{folder}/checkpoint", allow_late=True)
    return spark.read.option("basePath", f"{folder}/out").parquet(f"{folder}/out/batch=*").drop("batch")
