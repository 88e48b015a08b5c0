"""Aggregates taken while a table is being written."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


def counted(df: DataFrame, *columns: Column) -> tuple[DataFrame, Callable[[], dict[str, object]]]:
    """The table with aggregates attached to its next action, and how to get them.

    They are counted as tasks finish: after a lost executor, rows of a repeated
    task may be counted twice.
    """
    seen = Observation()

    def get() -> dict[str, object]:
        try:
            return seen.get
        except Py4JJavaError:
            # Where nothing came out, adaptive execution drops the empty rest of
            # the plan and the counters in it: count directly.
            return df.agg(*columns).first().asDict()

    return df.observe(seen, *columns), get
