"""Orderings packed into one number.

Aggregates stay hash-based if their buffers have a fixed width: numbers do,
structs and texts do not, and Spark would sort all rows on both sides of a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col

DECIMAL = "decimal(38,0)"
#: Room below the time for a long and its sign.
ROOM = 10**19


def packed(at: Column | str, step: Column | str) -> Column:
    """Time (to the microsecond) and a number of at most 18 digits as one number in the same order.

    NULL times come before all others, NULL steps before all of their time.
    """
    micros = F.coalesce(F.unix_micros(col(at).cast("timestamp")), F.lit(-(10**18)))
    number = F.coalesce(col(step).cast("long"), F.lit(-(10**18)))
    high = micros.cast("decimal(18,0)") * F.lit(str(ROOM)).cast("decimal(20,0)")
    return (high + number.cast("decimal(19,0)")).cast(DECIMAL)
