"""Longest wet and dry spells: runs of equal state in time order.

Rows are never sorted as they come.  They are first reduced by an aggregate
that combines in the map tasks, in one of two ways:

* counts, for any input: rows per (group, hour, state).  An hour given twice
  counts twice; where an hour is both, its dry rows precede its wet rows.  Runs
  are then cut with a window over one station-quarter, which after the
  reduction holds at most a wet and a dry row per hour, no more than 2 x 2,208
  rows, however many raw rows the station has.
* masks, for input with one row per station and hour: one row per day holding a
  bit per wet hour and a bit per dry hour.  A twenty-fourth of the rows reaches
  the shuffle, nothing is sorted, and the longest runs are read off the days of
  a quarter laid end to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import GROUP


def _hour_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP, "timestamp", "is_wet").agg(F.count(F.lit(1)).alias("n"))


def _day_masks(rows: DataFrame) -> DataFrame:
    bit = F.expr("shiftleft(1, hour(timestamp))")
    return rows.groupBy(*GROUP, F.to_date("timestamp").alias("date")).agg(
        F.bit_or(F.when(F.col("is_wet"), bit).otherwise(0)).alias("wet"),
        F.bit_or(F.when(~F.col("is_wet"), bit).otherwise(0)).alias("dry"),
    )


def _day_text(day: Column, absent: str) -> Column:
    """The hours of a day in order: 1 wet, 0 dry, ``absent`` for a missing one."""

    def state(hour: Column) -> Column:
        return (
            F.when(F.getbit(day["wet"], hour) == 1, "1")
            .when(F.getbit(day["dry"], hour) == 1, "0")
            .otherwise(absent)
        )

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(23)), state), "")


def _longest_run(text: Column, state: str) -> Column:
    runs = F.transform(F.split(text, f"[^{state}]+"), F.length)
    return F.nullif(F.array_max(runs), F.lit(0)).cast("bigint")


def _longest_from_masks(rows: DataFrame, break_on_gap: bool) -> DataFrame:
    """Longest runs read off one text per group, an hour a character.

    A group collects its days, 92 at most.
    """
    days = F.array_sort(F.collect_list(F.struct("date", "wet", "dry"))).alias("days")
    groups = _day_masks(rows).groupBy(*GROUP).agg(days)

    def text(day: Column, i: Column) -> Column:
        if not break_on_gap:
            return _day_text(day, "")
        before = F.get("days", i - 1)["date"]
        skipped = F.when(F.datediff(day["date"], before) > 1, "-").otherwise("")
        return F.concat(skipped, _day_text(day, "-"))

    hours = groups.select(*GROUP, F.array_join(F.transform("days", text), "").alias("hours"))
    return hours.select(
        *GROUP,
        _longest_run(F.col("hours"), "1").alias("max_wet_spell_hours"),
        _longest_run(F.col("hours"), "0").alias("max_dry_spell_hours"),
    )


def spells(rows: DataFrame, *, break_on_gap: bool = False) -> DataFrame:
    """All runs: group, is_wet, length, first and last hour.

    ``break_on_gap`` ends a run at an absent hour; by default runs go over the
    rows there are, absent hours not counting either way.
    """
    hours = _hour_counts(rows)
    ordered = Window.partitionBy(*GROUP).orderBy("timestamp", "is_wet")
    before = F.lag("is_wet").over(ordered)
    starts = before.isNull() | (before != F.col("is_wet"))
    if break_on_gap:
        gap = F.expr("INTERVAL 1 HOUR")
        starts = starts | (F.lag("timestamp").over(ordered) < F.col("timestamp") - gap)
    numbered = hours.withColumn("_starts", F.coalesce(starts, F.lit(True)).cast("int")).withColumn(
        "_run",
        F.sum("_starts").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    return numbered.groupBy(*GROUP, "_run", "is_wet").agg(
        F.sum("n").alias("length"),
        F.min("timestamp").alias("first_hour"),
        F.max("timestamp").alias("last_hour"),
    )


def longest_spells(
    rows: DataFrame, *, break_on_gap: bool = False, one_row_per_hour: bool = False
) -> DataFrame:
    """Longest wet and longest dry run per group, NULL where there is none."""
    if one_row_per_hour:
        return _longest_from_masks(rows, break_on_gap)
    wet = F.col("is_wet")
    return (
        spells(rows, break_on_gap=break_on_gap)
        .groupBy(*GROUP)
        .agg(
            F.max(F.when(wet, F.col("length"))).alias("max_wet_spell_hours"),
            F.max(F.when(~wet, F.col("length"))).alias("max_dry_spell_hours"),
        )
    )
