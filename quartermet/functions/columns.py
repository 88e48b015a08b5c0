"""Column helpers shared by the operators; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import RAW_ROOT, SENTINEL


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time

def observed_at(text: Column | str) -> Column:
    """Hour text (yyyyMMddHH) to a zone-less UTC timestamp, NULL when it is none."""
    c = col(text)
    hour = F.when(c.rlike(r"^\d{10}$"), c)

    def part(start: int, length: int) -> Column:
        return F.substring(hour, start, length).cast("int")

    # Made from its parts, not through a zoned timestamp: no hour is skipped or
    # doubled, whatever the session's time zone.
    return F.try_make_timestamp_ntz(
        part(1, 4), part(5, 2), part(7, 2), part(9, 2), F.lit(0), F.lit(0).cast("decimal(16,6)")
    )


def quarter_start(year: Column | str, quarter: Column | str) -> Column:
    first = F.make_date(col(year), (col(quarter) - 1) * 3 + 1, F.lit(1))
    return first.cast("timestamp_ntz")


def quarter_end(year: Column | str, quarter: Column | str) -> Column:
    """Last second of the quarter."""
    last = F.last_day(F.make_date(col(year), col(quarter) * 3, F.lit(1)))
    return last.cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def quarter_hours(year: Column | str, quarter: Column | str) -> Column:
    """Number of hours in the quarter, leap years included."""
    first = F.make_date(col(year), (col(quarter) - 1) * 3 + 1, F.lit(1))
    return (F.datediff(F.add_months(first, 3), first) * 24).cast("int")


# ------------------------------------------------------------- numbers

def without_sentinel(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(SENTINEL))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole, NULL for an empty whole."""
    return F.try_divide(col(part), col(whole))


def percent(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    return F.round(F.try_divide(col(part) * F.lit(100.0), col(whole)), digits)


def outside(c: Column | str, low: float, high: float) -> Column:
    """True outside the inclusive range; a NULL is not outside."""
    return F.coalesce(~col(c).between(low, high), F.lit(False))


def compass_sector(degrees: Column | str, sectors: int = 16) -> Column:
    """Index of the compass sector whose centre is nearest, 0 = north."""
    width = 360.0 / sectors
    return F.pmod(F.floor((col(degrees) + width / 2) / width), F.lit(sectors)).cast("int")


def settled(c: Column | str, type_: str) -> Column:
    """Double to decimal, rounded half up from the sixth digit on.

    Sums arrive in any order, so a double may lie one bit beside a rounding
    tie; going through six digits gives every run the same decimal.
    """
    return F.round(col(c), 6).cast("decimal(18,6)").cast(type_)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if f.dataType.typeName() in ("double", "float")
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --------------------------------------------------------------- names

def station_code(station: Column | str) -> Column:
    """Station number as five digits."""
    text = col(station).cast("string")
    return F.when(F.length(text) >= 5, text).otherwise(F.lpad(text, 5, "0"))


def object_path(variable: Column | str, station: Column | str, year: Column | str, file: Column | str) -> Column:
    """Place of a raw file: root/variable/station_NNNNN/year/file."""
    return F.concat_ws(
        "/",
        F.lit(RAW_ROOT),
        col(variable),
        F.concat(F.lit("station_"), station_code(station)),
        col(year).cast("string"),
        col(file),
    )


def path_columns(df: DataFrame, path: Column | str) -> DataFrame:
    """Add variable, station, year and file name read from an object path."""
    pattern = r"([^/]+)/station_(\d+)/([^/]+)/([^/]+)$"
    parts = ("path_variable", "path_station", "path_year", "path_file")
    found = [F.regexp_extract(col(path), pattern, i + 1) for i in range(4)]
    return df.withColumns(
        {name: F.when(c != "", c) for name, c in zip(parts, found, strict=True)}
    )


def version_name(year: Column | str, quarter: Column | str, stage: str = "curated", number: int = 1) -> Column:
    """Version names: 2023Q1_raw_v1, 2023Q1_staged_v1 and, curated, 2023Q1_v1."""
    middle = {"raw": "_raw_v", "staged": "_staged_v", "curated": "_v"}[stage]
    return F.concat(
        col(year).cast("string"), F.lit("Q"), col(quarter).cast("string"), F.lit(f"{middle}{number}")
    )


def period_year(file: Column | str) -> Column:
    """First year covered by a raw file, from the fourth token of its name."""
    token = F.get(F.split(col(file), "_"), F.lit(3))
    return F.coalesce(F.substring(token, 1, 4), F.lit("unknown"))


# ---------------------------------------------------------------- maps

def canonical_json(fields: Column | str) -> Column:
    """JSON of a map with its keys sorted."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col(fields)))))


def content_hash(fields: Column | str) -> Column:
    return F.sha2(canonical_json(fields), 256)
