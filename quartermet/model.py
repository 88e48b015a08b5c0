"""Data model: products, keys, thresholds and curated table layouts.

Everything here is plain data.  Raw files are ``;``-separated with a header;
their schemas are declared, never inferred.  Measures are read as ``double``:
32-bit values would not survive arithmetic unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STATION = "STATIONS_ID"
OBSERVED = "MESS_DATUM"
OBSERVED_FORMAT = "yyyyMMddHH"
SENTINEL = -999

#: key of a staged row group and of a curated feature row
GROUP = (STATION, "year", "quarter", "dataset_version")
KEY = ("station_id", "year", "quarter", "dataset_version")


def _product(quality: str, **measures: str) -> T.StructType:
    kinds = {"double": T.DoubleType(), "int": T.IntegerType(), "string": T.StringType()}
    fields = [
        T.StructField(STATION, T.IntegerType(), False),
        T.StructField(OBSERVED, T.StringType(), False),
        T.StructField(quality, T.IntegerType(), True),
    ]
    fields += [T.StructField(n, kinds[k], True) for n, k in measures.items()]
    return T.StructType(fields)


# Column names and order of the raw product files.
PRODUCT_SCHEMAS: dict[str, T.StructType] = {
    "air_temperature": _product("QN_9", TT_TU="double", RF_TU="double"),
    "precipitation": _product("QN_8", R1="double", RS_IND="int", WRTR="int"),
    "wind": _product("QN_3", F="double", D="int"),
    "pressure": _product("QN_8", P="double", P0="double"),
    "moisture": _product("QN_4", RF_TU="double", TF_TU="double"),
    "cloud_cover": _product("QN_8", V_N="double", V_N_I="string"),
    "solar": _product(
        "QN_592", ATMO_STRAHL="double", FD_STRAHL="double", FG_STRAHL="double"
    ),
}

# File-name prefixes of the raw products.
PRODUCT_PREFIXES: dict[str, str] = {
    "air_temperature": "stundenwerte_TU_",
    "precipitation": "stundenwerte_RR_",
    "wind": "stundenwerte_FF_",
    "pressure": "stundenwerte_P0_",
    "moisture": "stundenwerte_TF_",
    "cloud_cover": "stundenwerte_N_",
    "solar": "stundenwerte_ST_",
}

# Fixed value: folder of the raw zone, then variable/station_NNNNN/year/file.
RAW_ROOT = "raw/dwd"

# Staged product -> name used for its curated table and in reads.
CURATED_NAMES: dict[str, str] = {
    "air_temperature": "temperature",
    "precipitation": "precipitation",
    "wind": "wind",
    "pressure": "pressure",
    "moisture": "humidity",
}

# Dataset version states.
VERSION_STATES = ("pending", "processing", "available", "deprecated", "failed")

# The modes of the schema catalogue.
COMPATIBILITY_MODES = ("BACKWARD", "FORWARD", "FULL", "NONE")


def product_schema(product: str) -> T.StructType:
    """Declared schema of a raw product; an unknown product is an error."""
    try:
        return PRODUCT_SCHEMAS[product]
    except KeyError:
        raise ValueError(
            f"unknown product {product!r}, expected one of {sorted(PRODUCT_SCHEMAS)}"
        ) from None


def quality_column(product: str) -> str:
    return product_schema(product).names[2]


def measure_columns(product: str) -> list[str]:
    """Numeric measures, without station, time and quality flag."""
    return [
        f.name
        for f in product_schema(product).fields[3:]
        if not isinstance(f.dataType, T.StringType)
    ]


# Fixed values from here to CONTRACT: limits of the pipeline and of the data contract.
@dataclass(frozen=True)
class Profile:
    """Thresholds of cleaning and features."""

    quality_min: int = 5
    frost_c: float = 0.0
    degree_day_base_c: float = 18.0
    warm_c: float = 25.0
    wet_mm: float = 0.0
    heavy_mm: float = 2.5
    rain_mean_of_wet_only: bool = False
    gust_mps: float = 10.8
    calm_mps: float = 0.3
    high_pressure_pa: float = 102000.0
    low_pressure_pa: float = 99000.0
    high_humidity_pct: float = 80.0
    low_humidity_pct: float = 30.0
    #: inclusive valid range per product and raw column
    valid: dict[str, dict[str, tuple[float, float]]] = field(
        default_factory=lambda: {
            "air_temperature": {"TT_TU": (-60, 60), "RF_TU": (0, 100)},
            "precipitation": {"R1": (0, 200)},
            "wind": {"F": (0, 150), "D": (0, 360)},
            "pressure": {"P": (850, 1100), "P0": (850, 1100)},
            "moisture": {"RF_TU": (0, 100), "TF_TU": (-60, 60)},
        }
    )


#: thresholds the running pipeline uses (default)
PIPELINE = Profile()

#: thresholds written in the data contract
CONTRACT = Profile(
    wet_mm=0.1,
    heavy_mm=10.0,
    rain_mean_of_wet_only=True,
    gust_mps=10.0,
    calm_mps=1.0,
    low_pressure_pa=100000.0,
    low_humidity_pct=40.0,
    valid={
        "air_temperature": {"TT_TU": (-50, 50), "RF_TU": (0, 100)},
        "precipitation": {"R1": (0, 200)},
        "wind": {"F": (0, 50), "D": (0, 360)},
        "pressure": {"P": (900, 1100), "P0": (900, 1100)},
        "moisture": {"RF_TU": (0, 100), "TF_TU": (-50, 50)},
    },
)


@dataclass(frozen=True)
class Column:
    """One measure of a curated table: its feature, its contract name and type."""

    feature: str
    name: str
    type: str
    divide_by: int = 1


_COUNTS = (
    Column("count_observations", "count_observations", "int"),
    Column("count_missing", "count_missing", "int"),
    Column("missingness_ratio", "missingness_ratio", "decimal(5,4)"),
)

# Columns, order and decimal types of the curated tables.
STATION_COLUMNS: dict[str, str] = {
    "station_id": "int",
    "station_name": "string",
    "latitude": "decimal(8,5)",
    "longitude": "decimal(8,5)",
    "elevation_m": "int",
}

CURATED_TABLES: dict[str, tuple[Column, ...]] = {
    "temperature": (
        Column("temp_mean_c", "mean_temp_c", "decimal(5,2)"),
        Column("temp_median_c", "median_temp_c", "decimal(5,2)"),
        Column("temp_min_c", "min_temp_c", "decimal(5,2)"),
        Column("temp_max_c", "max_temp_c", "decimal(5,2)"),
        Column("temp_stddev_c", "stddev_temp_c", "decimal(5,2)"),
        Column("temp_q25_c", "q25_temp_c", "decimal(5,2)"),
        Column("temp_q75_c", "q75_temp_c", "decimal(5,2)"),
        *_COUNTS,
        Column("heating_degree_days", "heating_degree_days", "decimal(8,2)"),
        Column("cooling_degree_days", "cooling_degree_days", "decimal(8,2)"),
        Column("frost_hours", "frost_hours", "int"),
        Column("freeze_thaw_cycles", "freeze_thaw_cycles", "int"),
    ),
    "precipitation": (
        Column("precip_total_mm", "total_precip_mm", "decimal(8,2)"),
        Column("precip_mean_mm", "mean_hourly_precip_mm", "decimal(6,3)"),
        Column("precip_median_mm", "median_precip_mm", "decimal(6,3)"),
        Column("precip_max_mm", "max_hourly_precip_mm", "decimal(6,2)"),
        Column("precip_stddev_mm", "stddev_precip_mm", "decimal(6,3)"),
        Column("precip_q75_mm", "q75_precip_mm", "decimal(6,3)"),
        Column("precip_q95_mm", "q95_precip_mm", "decimal(6,2)"),
        Column("wet_hours", "wet_hours", "int"),
        Column("dry_hours", "dry_hours", "int"),
        Column("max_dry_spell_hours", "max_dry_spell_hours", "int"),
        Column("max_wet_spell_hours", "max_wet_spell_hours", "int"),
        Column("heavy_precip_hours", "heavy_precip_hours", "int"),
        *_COUNTS,
    ),
    "wind": (
        Column("wind_speed_mean_mps", "mean_wind_speed_ms", "decimal(5,2)"),
        Column("wind_speed_median_mps", "median_wind_speed_ms", "decimal(5,2)"),
        Column("wind_speed_min_mps", "min_wind_speed_ms", "decimal(5,2)"),
        Column("wind_speed_max_mps", "max_wind_speed_ms", "decimal(5,2)"),
        Column("wind_speed_stddev_mps", "stddev_wind_speed_ms", "decimal(5,2)"),
        Column("wind_speed_q75_mps", "q75_wind_speed_ms", "decimal(5,2)"),
        Column("wind_speed_q95_mps", "q95_wind_speed_ms", "decimal(5,2)"),
        Column("gust_hours", "gust_hours", "int"),
        Column("calm_hours", "calm_hours", "int"),
        Column("prevailing_direction", "prevailing_direction", "int"),
        Column("direction_variability", "direction_variability", "decimal(5,4)"),
        *_COUNTS,
    ),
    "pressure": (
        Column("pressure_mean_pa", "mean_pressure_hpa", "decimal(6,2)", 100),
        Column("pressure_median_pa", "median_pressure_hpa", "decimal(6,2)", 100),
        Column("pressure_min_pa", "min_pressure_hpa", "decimal(6,2)", 100),
        Column("pressure_max_pa", "max_pressure_hpa", "decimal(6,2)", 100),
        Column("pressure_stddev_pa", "stddev_pressure_hpa", "decimal(5,2)", 100),
        Column("pressure_q25_pa", "q25_pressure_hpa", "decimal(6,2)", 100),
        Column("pressure_q75_pa", "q75_pressure_hpa", "decimal(6,2)", 100),
        Column("pressure_range_pa", "pressure_range_hpa", "decimal(5,2)", 100),
        Column("high_pressure_hours", "high_pressure_hours", "int"),
        Column("low_pressure_hours", "low_pressure_hours", "int"),
        *_COUNTS,
    ),
    "humidity": (
        Column("humidity_mean_pct", "mean_humidity_pct", "decimal(5,2)"),
        Column("humidity_median_pct", "median_humidity_pct", "decimal(5,2)"),
        Column("humidity_min_pct", "min_humidity_pct", "decimal(5,2)"),
        Column("humidity_max_pct", "max_humidity_pct", "decimal(5,2)"),
        Column("humidity_stddev_pct", "stddev_humidity_pct", "decimal(5,2)"),
        Column("humidity_q25_pct", "q25_humidity_pct", "decimal(5,2)"),
        Column("humidity_q75_pct", "q75_humidity_pct", "decimal(5,2)"),
        Column("high_humidity_hours", "high_humidity_hours", "int"),
        Column("low_humidity_hours", "low_humidity_hours", "int"),
        *_COUNTS,
    ),
}

# Columns whose NULL share the quality checks watch, by curated table.
CRITICAL_COLUMNS: dict[str, tuple[str, ...]] = {
    "temperature": ("temp_mean_c", "temp_min_c", "temp_max_c"),
    "precipitation": ("precip_total_mm", "precip_mean_mm"),
    "wind": ("wind_speed_mean_mps", "wind_speed_max_mps"),
    "pressure": ("pressure_mean_pa",),
    "humidity": ("humidity_mean_pct",),
}
