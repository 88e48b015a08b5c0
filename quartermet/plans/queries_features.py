"""Registered queries: cleaning, features, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import quarter_end, quarter_hours, quarter_start, rounded
from ..model import CONTRACT, CURATED_NAMES, CURATED_TABLES, GROUP, PRODUCT_SCHEMAS, STATION
from ..operators import cleaning, enrich
from ..operators import features as feats
from ..operators.spells import spells
from . import views
from .registry import query
from .sql import with_views

G = "station_id, year, quarter, dataset_version"


def _round_sql(columns: list[str], exact: tuple[str, ...] = ()) -> str:
    return ", ".join(c if c in exact else f"round({c}, 6) AS {c}" for c in columns)


# ---------------------------------------------------------------- features

FEATURE_COLUMNS = {name: [c.feature for c in cols] for name, cols in CURATED_TABLES.items()}
EXACT = (
    "count_observations count_missing frost_hours freeze_thaw_cycles wet_hours dry_hours "
    "heavy_precip_hours max_wet_spell_hours max_dry_spell_hours gust_hours calm_hours "
    "high_pressure_hours low_pressure_hours high_humidity_hours low_humidity_hours"
).split()


def features_sql(name: str, view: str | None = None) -> str:
    picked = _round_sql(FEATURE_COLUMNS[name], tuple(EXACT))
    return with_views(view or f"f_{name}") + f"SELECT {G}, {picked} FROM {view or f'f_{name}'}"


def _register_features() -> None:
    for product, name in CURATED_NAMES.items():

        def run(spark, sf_dir, product=product, name=name):
            out = views.product_features(spark, sf_dir, product)
            return rounded(out.select(*G.split(", "), *FEATURE_COLUMNS[name]))

        query(f"{name}_features", features_sql(name))(run)

        contract_view = {"precipitation": "contract_rain_features"}.get(name, f"contract_{name}")
        if name == "temperature":
            continue  # no threshold of this product differs

        def run_contract(spark, sf_dir, product=product, name=name):
            out = views.product_features(spark, sf_dir, product, CONTRACT)
            return rounded(out.select(*G.split(", "), *FEATURE_COLUMNS[name]))

        query(f"{name}_features_contract_profile", features_sql(name, contract_view))(run_contract)


_register_features()


@query(
    "precipitation_features_by_day_masks",
    features_sql("precipitation"),
)
def precipitation_by_day_masks(spark, sf_dir):
    """Spells by day masks: the view has one row per station and hour."""
    out = views.product_features(spark, sf_dir, "precipitation", one_row_per_hour=True)
    return rounded(out.select(*G.split(", "), *FEATURE_COLUMNS["precipitation"]))


@query(
    "temperature_extras",
    with_views("f_temperature")
    + f"""SELECT {G}, round(temp_range_c, 6) AS temp_range_c, hours_below_0c, hours_above_25c,
                 round(temp_variance, 6) AS temp_variance,
                 round(missingness_ratio * 100, 6) AS missing_hours_pct FROM f_temperature""",
)
def temperature_extras(spark, sf_dir):
    out = views.product_features(spark, sf_dir, "air_temperature", extras=True)
    return rounded(
        out.select(
            *G.split(", "),
            "temp_range_c",
            "hours_below_0c",
            "hours_above_25c",
            "temp_variance",
            "missing_hours_pct",
        )
    )


@query(
    "temperature_features_without_outliers",
    with_views("good")
    + f"""SELECT {G},
                 round(avg(tt), 6) AS temp_mean_c, round(max(tt), 6) AS temp_max_c,
                 count(tt) AS count_observations
          FROM good
          WHERE coalesce(tt BETWEEN -60 AND 60, true) AND coalesce(rf BETWEEN 0 AND 100, true)
          GROUP BY {G}""",
)
def temperature_without_outliers(spark, sf_dir):
    out = views.product_features(spark, sf_dir, "air_temperature", exclude_outliers=True)
    return rounded(out.select(*G.split(", "), "temp_mean_c", "temp_max_c", "count_observations"))


@query(
    "degree_days",
    with_views("t_degree")
    + f"""SELECT {G}, round(heating_degree_days, 6) AS heating_degree_days,
                 round(cooling_degree_days, 6) AS cooling_degree_days, freeze_thaw_cycles
          FROM t_degree""",
)
def degree_days(spark, sf_dir):
    rows = views.staged(spark, sf_dir, "air_temperature").where("quality_acceptable")
    out = feats.degree_days(feats.temperature_days(rows))
    return rounded(views.curated_version(out).withColumnRenamed(STATION, "station_id"))


@query(
    "spells",
    with_views("rain_runs")
    + f"SELECT {G}, is_wet, length, first_hour, last_hour FROM rain_runs",
)
def all_spells(spark, sf_dir):
    rows = views.staged(spark, sf_dir, "precipitation").where("quality_acceptable")
    wet = F.coalesce(F.col("R1") > 0, F.lit(False)).alias("is_wet")
    runs = spells(rows.select(*GROUP, "timestamp", wet))
    return views.curated_version(runs).select(
        F.col(STATION).alias("station_id"),
        "year", "quarter", "dataset_version", "is_wet", "length", "first_hour", "last_hour",
    )


@query(
    "spells_broken_by_gaps",
    with_views("good")
    + f"""SELECT {G}, is_wet, count(*) AS length, min(ts) AS first_hour, max(ts) AS last_hour
          FROM (SELECT {G}, is_wet, ts,
                  ts - to_hours(row_number() OVER (PARTITION BY {G}, is_wet ORDER BY ts)) AS run
                FROM (SELECT {G}, ts, coalesce(r1 > 0, false) AS is_wet FROM good))
          GROUP BY {G}, is_wet, run""",
)
def spells_broken_by_gaps(spark, sf_dir):
    rows = views.staged(spark, sf_dir, "precipitation").where("quality_acceptable")
    wet = F.coalesce(F.col("R1") > 0, F.lit(False)).alias("is_wet")
    runs = spells(rows.select(*GROUP, "timestamp", wet), break_on_gap=True)
    return views.curated_version(runs).select(
        F.col(STATION).alias("station_id"),
        "year", "quarter", "dataset_version", "is_wet", "length", "first_hour", "last_hour",
    )


@query(
    "longest_spells_broken_by_gaps",
    with_views("good")
    + f"""SELECT {G}, max(length) FILTER (WHERE is_wet) AS max_wet_spell_hours,
            max(length) FILTER (WHERE NOT is_wet) AS max_dry_spell_hours FROM (
              SELECT {G}, is_wet, count(*) AS length
              FROM (SELECT {G}, is_wet,
                      ts - to_hours(row_number() OVER (PARTITION BY {G}, is_wet ORDER BY ts)) AS run
                    FROM (SELECT {G}, ts, coalesce(r1 > 0, false) AS is_wet FROM good))
              GROUP BY {G}, is_wet, run)
          GROUP BY {G}""",
)
def longest_spells_broken_by_gaps(spark, sf_dir):
    out = views.product_features(
        spark, sf_dir, "precipitation", break_on_gap=True, one_row_per_hour=True
    )
    return out.select(*G.split(", "), "max_wet_spell_hours", "max_dry_spell_hours")


# -------------------------------------------------------------- enrichment

FLAGSHIP_SQL = (
    with_views("f_temperature", "stations")
    + f"""SELECT f.station_id, f.year, f.quarter, f.dataset_version,
                 {_round_sql(FEATURE_COLUMNS["temperature"], tuple(EXACT))},
                 s.station_name, round(s.latitude, 6) AS latitude, round(s.longitude, 6) AS longitude,
                 s.elevation_m,
                 make_date(f.year, (f.quarter - 1) * 3 + 1, 1)::TIMESTAMP AS quarter_start,
                 last_day(make_date(f.year, f.quarter * 3, 1))::TIMESTAMP + INTERVAL '23:59:59'
                   AS quarter_end
          FROM f_temperature f LEFT JOIN stations s ON f.station_id = s.station_id"""
)


@query("features_with_station", FLAGSHIP_SQL)
def features_with_station(spark, sf_dir):
    """Flagship: quarterly temperature features joined to their stations."""
    out = views.product_features(spark, sf_dir, "air_temperature")
    out = out.select(*G.split(", "), *FEATURE_COLUMNS["temperature"])
    out = enrich.with_quarter_bounds(enrich.with_stations(out, views.stations(spark, sf_dir)))
    return rounded(out)


@query(
    "quarter_bounds",
    with_views("hourly")
    + """SELECT DISTINCT year, quarter,
           make_date(year, (quarter - 1) * 3 + 1, 1)::TIMESTAMP AS quarter_start,
           last_day(make_date(year, quarter * 3, 1))::TIMESTAMP + INTERVAL '23:59:59' AS quarter_end,
           (24 * (last_day(make_date(year, quarter * 3, 1)) + 1
                  - make_date(year, (quarter - 1) * 3 + 1, 1)))::INTEGER AS expected_hours
         FROM hourly""",
)
def quarter_bounds(spark, sf_dir):
    t = F.col("timestamp")
    pairs = views.hourly(spark, sf_dir).select(F.year(t).alias("year"), F.quarter(t).alias("quarter"))
    return pairs.distinct().select(
        "year",
        "quarter",
        quarter_start("year", "quarter").alias("quarter_start"),
        quarter_end("year", "quarter").alias("quarter_end"),
        quarter_hours("year", "quarter").alias("expected_hours"),
    )


def contract_sql(name: str) -> str:
    cells = []
    for c in CURATED_TABLES[name]:
        value = f"f.{c.feature} / {c.divide_by}" if c.divide_by != 1 else f"f.{c.feature}"
        if c.type.startswith("decimal"):
            value = f"(round({value}, 6)::DECIMAL(18,6))::{c.type}::DOUBLE"
        else:
            value = f"round({value})::INTEGER"
        cells.append(f"{value} AS {c.name}")
    place = "(round({0}, 6)::DECIMAL(18,6))::DECIMAL(8,5)::DOUBLE AS {0}"
    return (
        with_views(f"f_{name}", "stations")
        + f"""SELECT f.station_id, s.station_name, {place.format('latitude')},
                {place.format('longitude')}, s.elevation_m, f.year, f.quarter,
                make_date(f.year, (f.quarter - 1) * 3 + 1, 1)::TIMESTAMP AS quarter_start,
                last_day(make_date(f.year, f.quarter * 3, 1))::TIMESTAMP + INTERVAL '23:59:59'
                  AS quarter_end,
                f.dataset_version, {", ".join(cells)}
              FROM f_{name} f LEFT JOIN stations s ON f.station_id = s.station_id"""
    )


def _register_contract() -> None:
    for product, name in CURATED_NAMES.items():

        def run(spark, sf_dir, product=product, name=name):
            rows = views.product_features(spark, sf_dir, product)
            rows = enrich.with_quarter_bounds(
                enrich.with_stations(rows, views.stations(spark, sf_dir))
            )
            out = enrich.to_contract(rows, name, with_time=False)
            # Decimals as doubles, so that values compare by number.
            return out.select(
                *[
                    F.col(f.name).cast("double").alias(f.name)
                    if f.dataType.typeName() == "decimal"
                    else F.col(f.name)
                    for f in out.schema.fields
                ]
            )

        query(f"contract_{name}", contract_sql(name))(run)

        def respond(spark, sf_dir, product=product, name=name):
            rows = views.product_features(spark, sf_dir, product)
            rows = enrich.with_quarter_bounds(
                enrich.with_stations(rows, views.stations(spark, sf_dir))
            )
            return enrich.to_response(enrich.to_contract(rows, name, with_time=False), name)

        text = contract_sql(name)
        if name == "wind":
            text = f"SELECT * REPLACE (prevailing_direction::VARCHAR AS prevailing_direction) FROM ({text})"
        query(f"response_{name}", text)(respond)


_register_contract()


# ---------------------------------------------------------------- cleaning

# Measures of each product: view column holding the raw value, valid range.
_SQL_COLUMNS = {
    "TT_TU": "raw_tt", "RF_TU": "raw_rf", "R1": "raw_r1", "RS_IND": "raw_rs", "WRTR": "raw_wr",
    "F": "raw_f", "D": "raw_d", "P": "raw_p", "P0": "raw_p0", "TF_TU": "raw_tf", "V_N": "raw_vn",
    "V_N_I": "raw_vni", "ATMO_STRAHL": "raw_s1", "FD_STRAHL": "raw_s2", "FG_STRAHL": "raw_s3",
}


def _clean_sql(product: str, profile) -> str:
    schema = PRODUCT_SCHEMAS[product]
    cells = []
    for n in schema.names[3:]:
        c = _SQL_COLUMNS[n]
        cells.append(f"{c} AS {n}" if n == "V_N_I" else f"nullif({c}, -999) AS {n}")
    if product == "pressure":
        cells += ["raw_p * 100 AS P_pa", "raw_p0 * 100 AS P0_pa"]
    rules = [
        f"coalesce(nullif({_SQL_COLUMNS[c]}, -999) NOT BETWEEN {low} AND {high}, false)"
        for c, (low, high) in profile.valid.get(product, {}).items()
    ]
    return (
        with_views("hourly")
        + f"""SELECT station_id AS "STATIONS_ID", strftime(ts, '%Y%m%d%H') AS "MESS_DATUM",
               qn AS {schema.names[2]}, {", ".join(cells)}, ts AS "timestamp",
               qn >= {profile.quality_min} AS quality_acceptable, year, quarter,
               month(ts)::INTEGER AS month, day(ts)::INTEGER AS day, hour(ts)::INTEGER AS hour,
               {" OR ".join(rules) or "false"} AS has_outlier, '{product}' AS product_type
             FROM hourly"""
    )


def _register_clean() -> None:
    for product in PRODUCT_SCHEMAS:

        def run(spark, sf_dir, product=product):
            rows = views.parsed(spark, sf_dir, product)
            return cleaning.clean(rows, product).drop("cleaned_at")

        query(f"clean_{product}", _clean_sql(product, cleaning.PIPELINE))(run)


_register_clean()


def _metric_sql(product: str) -> str:
    inner = _clean_sql(product, cleaning.PIPELINE)
    names = [n for n in PRODUCT_SCHEMAS[product].names[3:] if n != "V_N_I"]
    cells = ", ".join(
        f"count(*) FILTER (WHERE {n} IS NULL) AS missing_{n}, "
        f"round(count(*) FILTER (WHERE {n} IS NULL) / count(*)::DOUBLE, 4) AS missing_ratio_{n}"
        for n in names
    )
    return f"""SELECT '{product}' AS product, count(*) AS total_rows,
                 count(*) FILTER (WHERE has_outlier) AS rows_with_outliers,
                 count(*) FILTER (WHERE quality_acceptable) AS rows_acceptable_quality, {cells}
               FROM ({inner})"""


def _register_metrics() -> None:
    for product in ("air_temperature", "wind"):

        def run(spark, sf_dir, product=product):
            rows = cleaning.clean(views.parsed(spark, sf_dir, product), product)
            out = cleaning.cleaning_metrics(rows, product)
            return out.select(F.lit(product).alias("product"), "*")

        query(f"cleaning_metrics_{product}", _metric_sql(product))(run)


_register_metrics()


@query(
    "parse_metrics",
    with_views("hourly")
    + """SELECT count(*) AS total_rows, count(*) FILTER (WHERE qn IS NULL) AS "nulls_QN_3",
           count(*) FILTER (WHERE raw_f IS NULL) AS "nulls_F",
           count(*) FILTER (WHERE raw_d IS NULL) AS "nulls_D",
           count(DISTINCT station_id) AS distinct_stations,
           min(ts) AS min_timestamp, max(ts) AS max_timestamp
         FROM hourly""",
)
def parse_metrics(spark, sf_dir):
    return cleaning.parse_metrics(views.parsed(spark, sf_dir, "wind"), "wind")


@query(
    "quality_share",
    with_views("hourly")
    + """SELECT year, quarter, count(*) AS total_rows,
           count(*) FILTER (WHERE qn >= 5) AS acceptable_rows,
           round(count(*) FILTER (WHERE qn >= 5) / count(*)::DOUBLE, 6) AS acceptable_share
         FROM hourly GROUP BY year, quarter""",
)
def quality_share(spark, sf_dir):
    rows = views.staged(spark, sf_dir, "moisture")
    return rounded(cleaning.quality_share(rows, "year", "quarter"))
