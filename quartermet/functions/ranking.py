"""Numbering rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

#: A row's place within its task fills the low bits of Spark's increasing ids.
ROW_BITS = 33


def numbered(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, total: str | None = None,
    many_groups: bool = False, tasks: int | None = None,
) -> DataFrame:
    """``df`` with ``name``: 1, 2, … by ``order`` (NULL first) within each group of ``by``, and the group's ``total``.

    A window over a group would sort it in one task.  Here rows are dealt by
    ranges of group and order, so a large group takes several tasks, sorted and
    written with their places; then each range starts behind the ranges before
    it.  Only counts of rows for each range and group are ever ordered in one
    place.  Rows that tie in ``order`` are numbered in any order; many of them
    fill one range, so add a column that tells them apart.  NULLs of ``by`` form a group.

    ``many_groups``: groups grow with the rows.  Their starts are then joined by
    shuffle: Spark would broadcast them for the size of the compressed file below.
    ``tasks``: how many ranges the rows are dealt by, instead of Spark's setting.
    """
    spark, keys = df.sparkSession, [*by, *order]
    place = F.monotonically_increasing_id().alias("_place")
    ranged = df.repartitionByRange(*([tasks] if tasks else []), *keys) if keys else df
    path = shared_folder(spark, "numbered")
    ranged.sortWithinPartitions(*keys).select("*", place).write.parquet(path)
    rows = spark.read.parquet(path).select(
        *df.columns,
        F.shiftright("_place", ROW_BITS).alias("_range"),
        F.col("_place").bitwiseAND((1 << ROW_BITS) - 1).alias("_row"),
    )
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    starts = starts.select(
        *(F.col(c).alias(f"_by_{c}") for c in by),
        F.col("_range").alias("_of"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"),
    )
    same: list[Column] = [F.col("_range") == F.col("_of"), *(F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by)]
    starts = starts.hint("merge") if many_groups else starts
    joined = rows.join(starts, reduce(lambda a, b: a & b, same))
    made = [(F.col("_shift") + F.col("_row")).alias(name), *([F.col("_total").alias(total)] if total else [])]
    return joined.select(*df.columns, *made)


