"""Station attributes, quarter bounds and the curated and response layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import quarter_end, quarter_start, settled
from ..model import CURATED_TABLES, STATION_COLUMNS

STATION_ATTRIBUTES = ("station_name", "latitude", "longitude", "elevation_m")


def with_stations(features: DataFrame, stations: DataFrame) -> DataFrame:
    """Left join of the station table; an unknown station keeps NULL attributes.

    No broadcast hint: the station table grows with the data, so Spark decides
    by its measured size, and shuffles both sides by station beyond the limit.
    """
    picked = stations.select("station_id", *STATION_ATTRIBUTES)
    return features.join(picked, "station_id", "left")


def with_quarter_bounds(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "quarter_start": quarter_start("year", "quarter"),
            "quarter_end": quarter_end("year", "quarter"),
        }
    )


def with_computed_at(df: DataFrame) -> DataFrame:
    return df.withColumn("computed_at", F.current_timestamp())


def enrich(features: DataFrame, stations: DataFrame) -> DataFrame:
    """Feature rows as they are curated: stations, bounds, computation time."""
    return features.transform(with_stations, stations).transform(with_quarter_bounds).transform(
        with_computed_at
    )


def to_contract(df: DataFrame, table: str, with_time: bool = True) -> DataFrame:
    """Curated table layout: contract names, order, hPa and decimal types."""
    if table not in CURATED_TABLES:
        raise ValueError(f"unknown curated table {table!r}, expected one of {sorted(CURATED_TABLES)}")

    def measure(c):
        source = F.col(c.feature) / c.divide_by if c.divide_by != 1 else F.col(c.feature)
        if c.type.startswith("decimal"):
            return settled(source, c.type).alias(c.name)
        return F.round(source).cast(c.type).alias(c.name)  # sector centres end in .5

    station = [
        (settled(c, t) if t.startswith("decimal") else F.col(c).cast(t)).alias(c)
        for c, t in STATION_COLUMNS.items()
    ]
    times = ["quarter_start", "quarter_end", "dataset_version"]
    if with_time:
        times.append("computed_at")
    return df.select(
        *station, "year", "quarter", *times, *[measure(c) for c in CURATED_TABLES[table]]
    )


def to_response(df: DataFrame, table: str) -> DataFrame:
    """The columns a read of one product returns, from the curated layout.

    Twelve common columns less the surrogate number (the key columns identify a
    row), then the measures as doubles and counts; wind direction as text.
    """
    measures = []
    for c in CURATED_TABLES[table]:
        made = F.col(c.name)
        if c.name == "prevailing_direction":
            made = made.cast("string")
        elif c.type.startswith("decimal"):
            made = made.cast("double")
        measures.append(made.alias(c.name))
    common = [*STATION_COLUMNS, "year", "quarter", "quarter_start", "quarter_end", "dataset_version"]
    if "computed_at" in df.columns:
        common.append("computed_at")
    position = ("latitude", "longitude")
    head = [F.col(c).cast("double").alias(c) if c in position else F.col(c) for c in common]
    return df.select(*head, *measures)


def fill_missing(df: DataFrame, defaults: dict[str, float | int | str]) -> DataFrame:
    """Replace NULLs before a column becomes mandatory."""
    return df.fillna(defaults)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, columns by name; a column one side lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


# Types in the order in which each holds every value of those before it.
_WIDENING = (
    ("byte", "short", "integer", "long"),
    ("byte", "short", "integer", "double"),
    ("float", "double"),
    ("date", "timestamp_ntz"),
)


def wider_schema(*versions: T.StructType) -> T.StructType:
    """One schema that holds the rows of all versions of a table.

    Columns come in the order of their first version and may be NULL; a column
    of two types gets the one that holds the values of both, and is an error if
    neither does.
    """
    fields: dict[str, T.DataType] = {}
    for f in (f for version in versions for f in version.fields):
        have = fields.setdefault(f.name, f.dataType)
        if have == f.dataType:
            continue
        pair = (have.typeName(), f.dataType.typeName())
        line = next((w for w in _WIDENING if set(pair) <= set(w)), None)
        if line is None:
            raise ValueError(f"column {f.name!r} is {pair[0]} in one version and {pair[1]} in another")
        fields[f.name] = max((have, f.dataType), key=lambda t: line.index(t.typeName()))
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])
