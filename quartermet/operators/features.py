"""The quarterly features of the five products.

Each function takes cleaned hourly rows and returns one row per
``station_id, year, quarter, dataset_version``, for all groups at once.

Plan of each: filter and prune at the scan, pre-aggregate in the map tasks,
shuffle one partial row per group and task, finish.  A station that holds much
of the data is therefore cut down before the shuffle, whatever its share.  All
percentiles of a product come from one digest.  Wind needs a single aggregate:
its direction mode is an aggregate like the others, not a second grouping with
a window and a join.  Temperature adds a day-level branch (24 rows become
one) and precipitation its spells; each is joined once on the group key, both
sides one row per group and partitioned alike, and Spark drops the branch where
none of its columns is asked for.  Rows without station or time belong to no
group: staging sets them apart (``cleaning.split_rejects``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import compass_sector, ratio
from ..model import GROUP, PIPELINE, STATION, Profile
from .spells import longest_spells


def _usable(df: DataFrame, exclude_outliers: bool) -> DataFrame:
    """Acceptable rows that belong to a group.

    The key filters are stated here, so that both branches of a product carry
    the same ones and Spark runs what they share once.
    """
    df = df.where("quality_acceptable")
    for key in GROUP:
        df = df.where(F.col(key).isNotNull())
    return df.where(~F.col("has_outlier")) if exclude_outliers else df


def _spread(c: str, prefix: str, unit: str, *names: str) -> list[Column]:
    made = {
        "total": F.sum(c),
        "mean": F.avg(c),
        "min": F.min(c),
        "max": F.max(c),
        "stddev": F.stddev_samp(c),
    }
    return [made[n].alias(f"{prefix}_{n}_{unit}") for n in names]


def _percentiles(c: str, *points: float) -> Column:
    """One digest for all points; unpacked by ``_unpack``."""
    return F.percentile_approx(c, list(points)).alias("_points")


def _unpack(**names: int) -> dict[str, Column]:
    return {name: F.get("_points", F.lit(i)) for name, i in names.items()}


def _counts(c: str) -> list[Column]:
    return [
        F.count(c).alias("count_observations"),
        F.count_if(F.col(c).isNull()).alias("count_missing"),
    ]


def _missingness() -> Column:
    return ratio("count_missing", F.col("count_observations") + F.col("count_missing"))


def _finish(df: DataFrame) -> DataFrame:
    return (
        df.drop("_points")
        .withColumn("missingness_ratio", _missingness())
        .withColumnRenamed(STATION, "station_id")
    )


# ----------------------------------------------------------- temperature

def temperature_days(df: DataFrame) -> DataFrame:
    """One row per group and day: mean, min and max of the hours."""
    return df.groupBy(*GROUP, F.to_date("timestamp").alias("date")).agg(
        F.avg("TT_TU").alias("day_mean"),
        F.min("TT_TU").alias("day_min"),
        F.max("TT_TU").alias("day_max"),
    )


def degree_days(days: DataFrame, profile: Profile = PIPELINE) -> DataFrame:
    """Heating and cooling degree days and freeze-thaw days, in one pass."""
    below = F.lit(profile.degree_day_base_c) - F.col("day_mean")
    zero = F.lit(0.0)
    crossed = (F.col("day_min") < 0) & (F.col("day_max") > 0)
    # A day without any value adds nothing: greatest() skips its NULL.
    return days.groupBy(*GROUP).agg(
        F.sum(F.greatest(below, zero)).alias("heating_degree_days"),
        F.sum(F.greatest(-below, zero)).alias("cooling_degree_days"),
        F.count_if(crossed).alias("freeze_thaw_cycles"),
    )


def temperature(
    df: DataFrame,
    profile: Profile = PIPELINE,
    *,
    exclude_outliers: bool = False,
    extras: bool = False,
) -> DataFrame:
    rows = _usable(df, exclude_outliers)
    t = F.col("TT_TU")
    more = []
    if extras:
        more = [
            F.count_if(t < 0).alias("hours_below_0c"),
            F.count_if(t > profile.warm_c).alias("hours_above_25c"),
            F.var_samp(t).alias("temp_variance"),
        ]
    hourly = rows.groupBy(*GROUP).agg(
        *_spread("TT_TU", "temp", "c", "mean", "min", "max", "stddev"),
        _percentiles("TT_TU", 0.25, 0.5, 0.75),
        F.count_if(t < profile.frost_c).alias("frost_hours"),
        *_counts("TT_TU"),
        *more,
    )
    hourly = hourly.withColumns(_unpack(temp_q25_c=0, temp_median_c=1, temp_q75_c=2))
    out = _finish(hourly.join(degree_days(temperature_days(rows), profile), list(GROUP), "left"))
    if extras:
        out = out.withColumns(
            {
                "temp_range_c": F.col("temp_max_c") - F.col("temp_min_c"),
                "missing_hours_pct": F.col("missingness_ratio") * 100,
            }
        )
    return out


# --------------------------------------------------------- precipitation

def precipitation(
    df: DataFrame,
    profile: Profile = PIPELINE,
    *,
    exclude_outliers: bool = False,
    break_on_gap: bool = False,
    one_row_per_hour: bool = False,
) -> DataFrame:
    """``one_row_per_hour``: the caller knows that (station, hour) is unique."""
    rows = _usable(df, exclude_outliers)
    r = F.col("R1")
    wet = r > profile.wet_mm
    mean = F.avg(F.when(r > 0, r) if profile.rain_mean_of_wet_only else r)
    hourly = rows.groupBy(*GROUP).agg(
        *_spread("R1", "precip", "mm", "total", "max", "stddev"),
        mean.alias("precip_mean_mm"),
        _percentiles("R1", 0.5, 0.75, 0.95),
        F.count_if(wet).alias("wet_hours"),
        F.count_if(r <= profile.wet_mm).alias("dry_hours"),
        F.count_if(r > profile.heavy_mm).alias("heavy_precip_hours"),
        *_counts("R1"),
    )
    hourly = hourly.withColumns(_unpack(precip_median_mm=0, precip_q75_mm=1, precip_q95_mm=2))
    spells = longest_spells(
        rows.select(*GROUP, "timestamp", F.coalesce(wet, F.lit(False)).alias("is_wet")),
        break_on_gap=break_on_gap,
        one_row_per_hour=one_row_per_hour,
    )
    return _finish(hourly.join(spells, list(GROUP), "left"))


# ------------------------------------------------------------------ wind

SECTORS = 16


def wind(
    df: DataFrame, profile: Profile = PIPELINE, *, exclude_outliers: bool = False
) -> DataFrame:
    f, angle = F.col("F"), F.radians(F.col("D").cast("double"))
    rows = _usable(df, exclude_outliers).select(
        *GROUP,
        "F",
        compass_sector("D", SECTORS).alias("_sector"),
        F.sin(angle).alias("_sin"),
        F.cos(angle).alias("_cos"),
    )
    out = rows.groupBy(*GROUP).agg(
        *_spread("F", "wind_speed", "mps", "mean", "min", "max", "stddev"),
        _percentiles("F", 0.5, 0.75, 0.95),
        F.count_if(f > profile.gust_mps).alias("gust_hours"),
        F.count_if(f < profile.calm_mps).alias("calm_hours"),
        *_counts("F"),
        F.stddev_samp("_sin").alias("_sin_sd"),
        F.stddev_samp("_cos").alias("_cos_sd"),
        # The most frequent sector, the lowest on a tie; missing directions are no sector.
        F.mode("_sector", deterministic=True).alias("_sector"),
    )
    out = out.withColumns(
        {
            **_unpack(
                wind_speed_median_mps=0, wind_speed_q75_mps=1, wind_speed_q95_mps=2
            ),
            "prevailing_direction": F.col("_sector") * (360.0 / SECTORS),
            "direction_variability": F.hypot("_sin_sd", "_cos_sd"),
        }
    )
    return _finish(out.drop("_sector", "_sin_sd", "_cos_sd"))


# -------------------------------------------------------------- pressure

def pressure_pa(columns: list[str]) -> Column:
    """Station pressure in Pa: the Pa column, else hPa times 100."""
    choices = []
    if "P_pa" in columns:
        choices.append(F.col("P_pa"))
    if "P" in columns:
        choices.append(F.col("P") * 100)
    if not choices:
        raise ValueError("pressure rows need a column P_pa or P")
    return F.coalesce(*choices)


def pressure(
    df: DataFrame, profile: Profile = PIPELINE, *, exclude_outliers: bool = False
) -> DataFrame:
    rows = _usable(df, exclude_outliers).select(*GROUP, pressure_pa(df.columns).alias("_pa"))
    p = F.col("_pa")
    out = rows.groupBy(*GROUP).agg(
        *_spread("_pa", "pressure", "pa", "mean", "min", "max", "stddev"),
        _percentiles("_pa", 0.25, 0.5, 0.75),
        F.count_if(p > profile.high_pressure_pa).alias("high_pressure_hours"),
        F.count_if(p < profile.low_pressure_pa).alias("low_pressure_hours"),
        *_counts("_pa"),
    )
    return _finish(
        out.withColumns(
            {
                **_unpack(pressure_q25_pa=0, pressure_median_pa=1, pressure_q75_pa=2),
                "pressure_range_pa": F.col("pressure_max_pa") - F.col("pressure_min_pa"),
            }
        )
    )


# -------------------------------------------------------------- humidity

def humidity(
    df: DataFrame, profile: Profile = PIPELINE, *, exclude_outliers: bool = False
) -> DataFrame:
    rows = _usable(df, exclude_outliers)
    h = F.col("RF_TU")
    out = rows.groupBy(*GROUP).agg(
        *_spread("RF_TU", "humidity", "pct", "mean", "min", "max", "stddev"),
        _percentiles("RF_TU", 0.25, 0.5, 0.75),
        F.count_if(h > profile.high_humidity_pct).alias("high_humidity_hours"),
        F.count_if(h < profile.low_humidity_pct).alias("low_humidity_hours"),
        *_counts("RF_TU"),
    )
    return _finish(
        out.withColumns(_unpack(humidity_q25_pct=0, humidity_median_pct=1, humidity_q75_pct=2))
    )


CALCULATORS = {
    "air_temperature": temperature,
    "precipitation": precipitation,
    "wind": wind,
    "pressure": pressure,
    "moisture": humidity,
}


def features(df: DataFrame, product: str, profile: Profile = PIPELINE, **options: bool) -> DataFrame:
    """Features of one product; a product without features is an error."""
    if product not in CALCULATORS:
        raise ValueError(f"no features for product {product!r}, only {sorted(CALCULATORS)}")
    return CALCULATORS[product](df, profile, **options)
