"""Data-quality checks: each takes tables and returns rows of findings.

Checks over the five feature tables work on one tagged union, so one grouping
serves all products.  A check that fails a run and one that warns differ only
in their ``severity``; raising is left to ``require``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import observed_at, percent, quarter_end, quarter_hours, quarter_start, ratio
from ..model import CRITICAL_COLUMNS, KEY, STATION, measure_columns

PERIOD = ("year", "quarter")


class QualityError(ValueError):
    """A check that must pass has findings."""


def require(findings: DataFrame, check: str, shown: int = 10) -> None:
    """Raise if a check has findings; only the first few are fetched."""
    first = findings.limit(shown).collect()
    if first:
        raise QualityError(f"{check}: " + "; ".join(str(r.asDict()) for r in first))


def tagged(tables: dict[str, DataFrame], *columns: str) -> DataFrame:
    """Rows of all feature tables with their product; only the columns asked for."""
    parts = [t.select(F.lit(name).alias("product"), *columns) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def newest(findings: DataFrame, k: int, *by: str) -> DataFrame:
    """The k newest quarters among the findings of each group."""
    order = [F.desc("year"), F.desc("quarter")]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return findings.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


# ------------------------------------------------- counts per quarter

def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return tagged(tables, *PERIOD).groupBy("product", *PERIOD).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def short_quarters(tables: dict[str, DataFrame], min_rows: int = 100) -> DataFrame:
    """Quarters with too few rows."""
    return row_counts(tables).where(F.col("row_count") < min_rows)


def station_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return tagged(tables, "station_id", *PERIOD).groupBy("product", *PERIOD).agg(
        F.countDistinct("station_id").alias("station_count")
    )


def thin_coverage(tables: dict[str, DataFrame], min_stations: int = 50) -> DataFrame:
    """Quarters with too few stations."""
    return station_counts(tables).where(F.col("station_count") < min_stations)


def null_shares(
    tables: dict[str, DataFrame], critical: dict[str, tuple[str, ...]] = CRITICAL_COLUMNS
) -> DataFrame:
    """NULL percentage per product, critical column and quarter: one pass per table."""
    parts = []
    for name, t in tables.items():
        shares = t.groupBy(*PERIOD).agg(
            *[percent(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(c) for c in critical[name]]
        )
        long = shares.unpivot(list(PERIOD), list(critical[name]), "column_name", "null_pct")
        parts.append(long.select(F.lit(name).alias("product"), "*"))
    return reduce(DataFrame.unionByName, parts)


def null_excess(
    tables: dict[str, DataFrame],
    max_pct: float = 15.0,
    critical: dict[str, tuple[str, ...]] = CRITICAL_COLUMNS,
) -> DataFrame:
    """Columns and quarters with too large a NULL share."""
    return null_shares(tables, critical).where(F.col("null_pct") > max_pct)


def null_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows and NULLs of each column, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_null") for c in columns],
    )


def not_null_rejects(df: DataFrame, *columns: str) -> DataFrame:
    """Rows lacking a mandatory column."""
    return df.where(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def require_parsed(raw: DataFrame, max_share: float) -> dict[str, int]:
    """Count rows and those without station or time; too large a share of them raises."""
    keyless = F.col(STATION).isNull() | F.col("timestamp").isNull()
    rows, bad = raw.agg(F.count(F.lit(1)), F.count_if(keyless)).first()
    if bad > max_share * max(rows, 1):
        raise QualityError(f"{bad} of {rows} rows did not parse")
    return {"rows_read": rows, "rows_rejected": bad}


def bad_files(raw: DataFrame, max_share: float) -> DataFrame:
    """Files (column _source_file) with too large a share of rows without station or time, and their counts."""
    keyless = F.col(STATION).isNull() | F.col("timestamp").isNull()
    counts = raw.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(keyless).alias("rows_rejected")
    )
    return counts.where(F.col("rows_rejected") > max_share * F.col("rows_read"))


# ------------------------------------------------------------ continuity

def year_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    """All quarters of a range of years."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return years.select("year", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("quarter"))


def missing_quarters(rows: DataFrame, *by: str) -> DataFrame:
    """Quarters absent between the first and last year of each group.

    One aggregate: a group keeps the set of its quarters as running numbers
    (four per year covered, so it stays small), and the numbers missing from
    the sequence are unfolded.
    """
    number = F.col("year") * 4 + F.col("quarter") - 1
    have = rows.groupBy(*by).agg(
        F.collect_set(number).alias("_have"),
        F.min("year").alias("_first"),
        F.max("year").alias("_last"),
    )
    every = F.sequence(F.col("_first") * 4, F.col("_last") * 4 + 3)
    absent = have.where(F.col("_first").isNotNull()).select(
        *by, F.explode(F.array_except(every, "_have")).alias("_n")
    )
    return absent.select(
        *by, F.floor(F.col("_n") / 4).cast("int").alias("year"), (F.col("_n") % 4 + 1).alias("quarter")
    )


def completeness_matrix(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Expected quarters that some product lacks, OK or MISSING per product."""
    names = list(tables)
    have = tagged(tables, *PERIOD).groupBy(*PERIOD).pivot("product", names).count()
    wide = expected.join(have, list(PERIOD), "left")
    lacking = reduce(Column.__or__, [F.col(n).isNull() for n in names])
    return wide.where(lacking).select(
        *PERIOD, *[F.when(F.col(n).isNull(), "MISSING").otherwise("OK").alias(n) for n in names]
    )


def alignment(left: DataFrame, right: DataFrame, tolerance: int = 10) -> DataFrame:
    """Quarter counts of two products side by side; a quarter that one lacks counts as 0 there."""
    a = left.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("left_count"))
    b = right.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("right_count"))
    apart = F.abs(F.col("left_count") - F.col("right_count")) > tolerance
    # Also where one side has nothing: that is what the check is for.
    return a.join(b, list(PERIOD), "full").fillna(0, ["left_count", "right_count"]).withColumn(
        "status", F.when(apart, "MISMATCH").otherwise("OK")
    )


# ---------------------------------------------------------- row checks

def temperature_consistency(df: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Temperature rows with their order and range rules, as boolean columns."""
    lo, mid, hi = F.col("temp_min_c"), F.col("temp_mean_c"), F.col("temp_max_c")
    # A mean of equal values may lie a rounding error beside them.
    slack = 1e-9
    return df.select(
        *KEY,
        (hi >= mid - slack).alias("max_gte_mean"),
        (mid >= lo - slack).alias("mean_gte_min"),
        (F.abs(hi - lo - F.col("temp_range_c")) <= tolerance).alias("range_matches"),
        (F.col("frost_hours") <= F.col("hours_below_0c")).alias("frost_lte_below_zero"),
    )


def violations(flags: DataFrame, *kept: str) -> DataFrame:
    """Rows where some rule column is false."""
    rules = [c for c, t in flags.dtypes if t == "boolean" and c not in kept]
    return flags.where(reduce(Column.__or__, [~F.col(c) for c in rules]))


# Inclusive valid ranges per feature.
FEATURE_RANGES: dict[str, dict[str, tuple[float | None, float | None]]] = {
    "temperature": {
        "temp_mean_c": (-50, 50), "temp_min_c": (-50, 50), "temp_max_c": (-50, 50),
        "heating_degree_days": (0, None), "cooling_degree_days": (0, None),
        "frost_hours": (0, 2208), "missingness_ratio": (0, 1),
    },
    "precipitation": {"precip_total_mm": (0, None), "precip_max_mm": (0, None)},
    "wind": {"wind_speed_mean_mps": (0, None), "wind_speed_min_mps": (0, None)},
    "pressure": {
        "pressure_mean_pa": (90000, 110000), "pressure_min_pa": (90000, 110000),
        "pressure_max_pa": (90000, 110000),
    },
    "humidity": {
        "humidity_mean_pct": (0, 100), "humidity_min_pct": (0, 100), "humidity_max_pct": (0, 100),
    },
}


def _inside(c: str, low: float | None, high: float | None) -> Column:
    tests = []
    if low is not None:
        tests.append(F.col(c) >= low)
    if high is not None:
        tests.append(F.col(c) <= high)
    return reduce(Column.__and__, tests)


def range_counts(df: DataFrame, table: str) -> DataFrame:
    """Rows in all, and rows with a valid value per ranged feature: one row."""
    rules = FEATURE_RANGES[table]
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(_inside(c, lo, hi)).alias(f"{c}_valid") for c, (lo, hi) in rules.items()],
    )


def out_of_range(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per feature value outside its range."""
    parts = []
    for name, t in tables.items():
        rules = FEATURE_RANGES[name]
        found = F.filter(
            F.array(
                *[
                    F.when(
                        ~_inside(c, lo, hi),
                        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")),
                    )
                    for c, (lo, hi) in rules.items()
                ]
            ),
            lambda x: x.isNotNull(),
        )
        parts.append(t.select(F.lit(name).alias("product"), *KEY, F.inline(found)))
    return reduce(DataFrame.unionByName, parts)


def hour_coverage(df: DataFrame) -> DataFrame:
    """Rows seen against the hours of the quarter."""
    seen = F.col("count_observations") + F.col("count_missing")
    return df.select(
        *KEY,
        seen.alias("hours_seen"),
        quarter_hours("year", "quarter").alias("hours_expected"),
        ratio(seen, quarter_hours("year", "quarter")).alias("coverage"),
    )


def contract_alerts(df: DataFrame, statistics: tuple[str, ...], max_missing: float = 0.20) -> DataFrame:
    """Alert rows: too much missing (warn), empty statistic or wrong bounds (fail)."""
    empty = reduce(Column.__or__, [F.col(c).isNull() for c in statistics])
    bounds = (F.col("quarter_start") != quarter_start("year", "quarter")) | (
        F.col("quarter_end") != quarter_end("year", "quarter")
    )

    def alert(condition: Column, rule: str, severity: str) -> Column:
        return F.when(
            condition, F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"))
        )

    found = F.array(
        alert(F.col("missingness_ratio") > max_missing, "missingness", "warn"),
        alert((F.col("count_observations") > 0) & empty, "empty_statistic", "fail"),
        alert(bounds, "quarter_bounds", "fail"),
    )
    return df.select(*KEY, F.inline(F.filter(found, lambda x: x.isNotNull())))


# ---------------------------------------------------------- raw checks

def raw_format(lines: DataFrame, product: str) -> DataFrame:
    """Lines of raw files (columns file, value) that break the format, with the reason.

    The first line of a file is its header, recognised by its first column name.
    """
    text = F.trim("value")
    parts = F.split(text, ";")
    reason = (
        F.when(F.size(parts) < 5, "fields")
        .when(~F.trim(F.get(parts, F.lit(0))).rlike(r"^\d+$"), "station")
        .when(~F.trim(F.get(parts, F.lit(1))).rlike(r"^\d{10}$"), "time")
    )
    body = lines.where((text != "") & ~text.startswith(STATION))
    return body.select("*", reason.alias("reason")).where(F.col("reason").isNotNull())


def files_without_header(lines: DataFrame) -> DataFrame:
    """Files in which no line starts with the header's first column name."""
    found = F.max(F.trim("value").startswith(STATION))
    return lines.groupBy("file").agg(found.alias("_found")).where(~F.col("_found")).select("file")


def parse_error_share(parsed: DataFrame, max_share: float = 0.30) -> DataFrame:
    """Share of rows whose station or time did not parse; one row with status."""
    bad = F.count_if(F.col(STATION).isNull() | F.col("timestamp").isNull())
    return parsed.agg(F.count(F.lit(1)).alias("total_rows"), bad.alias("error_rows")).select(
        "*",
        ratio("error_rows", "total_rows").alias("error_share"),
        F.when(ratio("error_rows", "total_rows") > max_share, "fail").otherwise("pass").alias("status"),
    )


def text_error_share(lines: DataFrame, max_share: float = 0.30) -> DataFrame:
    """The same on text lines, before they are parsed."""
    parts = F.split("value", ";")
    rows = lines.select(
        F.get(parts, F.lit(0)).try_cast("int").alias(STATION),
        observed_at(F.get(parts, F.lit(1))).alias("timestamp"),
    )
    return parse_error_share(rows, max_share)


def missing_by_month(cleaned: DataFrame, product: str, max_share: float = 0.20) -> DataFrame:
    """Station-months in which a measure lacks too many values."""
    measures = [c for c in measure_columns(product) if c in cleaned.columns]
    shares = cleaned.groupBy(STATION, "year", "month").agg(
        *[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in measures]
    )
    long = shares.unpivot([STATION, "year", "month"], measures, "column_name", "missing_share")
    return long.where(F.col("missing_share") > max_share)


def unknown_stations(rows: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Distinct stations of a table that the station table lacks."""
    known = stations.select(F.col("station_id").alias(key))
    return rows.select(key).distinct().join(known, key, "left_anti")


def orphan_count(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Number of rows whose key the parent table lacks; rows are counted per key first."""
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(parents.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("orphaned_rows"))


def unknown_versions(features: DataFrame, versions: DataFrame) -> DataFrame:
    """dataset_version values absent from the version log."""
    known = versions.select(F.col("version").alias("dataset_version"))
    return features.select("dataset_version").distinct().join(known, "dataset_version", "left_anti")


def outside_active_dates(features: DataFrame, stations: DataFrame) -> DataFrame:
    """Features before the start or after the end of their station.

    The quarter is taken to run from its first day to day 28 of its last month.
    """
    dates = stations.select("station_id", "start_date", "end_date")
    first = F.make_date("year", (F.col("quarter") - 1) * 3 + 1, F.lit(1))
    last = F.make_date("year", F.col("quarter") * 3, F.lit(28))
    early, late = first < F.col("start_date"), last > F.col("end_date")
    return features.join(dates, "station_id").where(early | late)


def missing_products(objects: DataFrame, expected: tuple[str, ...] | None = None) -> DataFrame:
    """Expected products without a file in the raw zone (column path_variable)."""
    names = expected or ("air_temperature", "precipitation", "wind", "pressure", "moisture")
    have = objects.select("path_variable").distinct()
    want = F.explode(F.array(*[F.lit(n) for n in names])).alias("path_variable")
    wanted = objects.sparkSession.range(1).select(want)
    return wanted.join(have, "path_variable", "left_anti")


def missing_columns(df: DataFrame, required: tuple[str, ...]) -> list[str]:
    """Required columns a table lacks; schema only, no job."""
    return [c for c in required if c not in df.columns]


def column_presence(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Required columns (column_name), whether a table has them, and in how many rows they hold a value; one scan."""
    have = [c for c in required if c in df.columns]
    counts = df.agg(*[F.count(c).alias(c) for c in have], F.count(F.lit(1)).alias("_rows"))

    def row(c: str) -> Column:
        held = F.col(c) if c in have else F.lit(0).cast("bigint")
        return F.struct(F.lit(c).alias("column_name"), F.lit(c in have).alias("present"), held.alias("rows_with_value"))

    return counts.select(F.inline(F.array(*[row(c) for c in required])))


# ---------------------------------------------------------- duplicates

def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*(key or KEY)).agg(F.count(F.lit(1)).alias("copies")).where(
        F.col("copies") > 1
    )


def keep_newest(df: DataFrame, key: tuple[str, ...], newest_by: tuple[str, ...]) -> DataFrame:
    """One row per key, the one greatest in ``newest_by``.

    An aggregate rather than a ranking window: copies are dropped in the map
    tasks, so a key with very many copies never gathers in one place.
    """
    rest = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*newest_by)).alias("_row")
    return df.groupBy(*key).agg(best).select(*key, "_row.*").select(*df.columns)


def type_change(df: DataFrame, column: str, type_: str) -> DataFrame:
    """Effect of casting a column: NULLs before and after, values whose text differs."""
    old, new = F.col(column), F.col(column).try_cast(type_)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(old).alias("old_count"),
        F.count(new).alias("new_count"),
        F.count_if(old.try_cast("decimal(38,10)") != new.try_cast("decimal(38,10)")).alias("mismatches"),
    )


# ------------------------------------------------------------ check log

def check_records(findings: DataFrame, name: str, kind: str, severity: str, at: Column) -> DataFrame:
    """Findings as rows of the check log; the finding itself goes into result."""
    return findings.select(
        F.lit(name).alias("check_name"),
        F.lit(kind).alias("check_type"),
        F.lit({"fail": "failed", "warn": "warning"}[severity]).alias("status"),
        F.to_json(F.struct(*findings.columns)).alias("result"),
        F.lit(None).cast("string").alias("error_message"),
        at.alias("checked_at"),
    )


def check_log(
    log: DataFrame, *, status: str | None = None, since: Column | None = None
) -> DataFrame:
    """The log by status and age, newest first."""
    if status is not None:
        log = log.where(F.col("status") == status)
    if since is not None:
        log = log.where(F.col("checked_at") > since)
    return log.orderBy(F.desc("checked_at"), "check_name", "result")
