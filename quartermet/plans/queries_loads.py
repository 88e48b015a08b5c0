"""Registered queries: named columns, loads, replaced tables, records of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded, version_name
from ..layout import Layout
from ..model import CURATED_NAMES, PRODUCT_SCHEMAS, STATION
from ..operators import cleaning, enrich, quality, runs
from ..session import shared_folder
from ..sinks import tables
from ..sources import listing, observations, stations
from . import jobs, views
from .registry import query
from .sql import with_views
from .views import curated_table

_G = "station_id, year, quarter, dataset_version"


# ------------------------------------------------------- columns by their names

def _moisture_files(spark, sf_dir):
    """Lines (file, value) of a file per station; those of even stations have other names in another order."""
    schema = PRODUCT_SCHEMAS["moisture"]
    other = [*schema.names[:2], "QN_8", "TD", "RF_TU"]
    rows = views.parsed(spark, sf_dir, "moisture")
    swapped = F.col(STATION) % 2 == 0

    def line(names):
        cells = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
        return F.concat_ws(";", *cells, F.lit("eor"))

    swapped_names = [*schema.names[:3], "TF_TU", "RF_TU"]
    file = F.format_string("station_%05d", STATION).alias("file")
    body = rows.select(file, F.when(swapped, line(swapped_names)).otherwise(line(schema.names)).alias("value"))
    head = F.when(swapped, ";".join([*other, "eor"])).otherwise(views.header_line("moisture"))
    return body.unionByName(rows.select(STATION).distinct().select(file, head.alias("value")))


@query(
    "named_columns",
    with_views("hourly")
    + """SELECT printf('station_%05d', station_id) AS file, station_id AS "STATIONS_ID",
           strftime(ts, '%Y%m%d%H') AS "MESS_DATUM", qn AS "QN_4", raw_rf AS "RF_TU", raw_tf AS "TF_TU",
           ts AS "timestamp" FROM hourly""",
)
def named_columns(spark, sf_dir):
    """Files that name and order their columns differently, read by name."""
    return observations.parse_named_lines(_moisture_files(spark, sf_dir), "moisture", {"TD": "TF_TU"})


@query(
    "header_mismatches",
    with_views("hourly")
    + """SELECT DISTINCT printf('station_%05d', station_id) AS file, position::INTEGER AS position, expected, found
         FROM hourly, (VALUES (3, 'QN_4', 'QN_8'), (4, 'RF_TU', 'TD'), (5, 'TF_TU', 'RF_TU'))
           AS wrong(position, expected, found) WHERE station_id % 2 = 0""",
)
def header_mismatches(spark, sf_dir):
    return observations.header_mismatches(_moisture_files(spark, sf_dir), "moisture")


@query(
    "source_columns",
    with_views("hourly")
    + """SELECT year, count(*) AS total_rows, count(*) AS rows_of_year, 1::BIGINT AS parse_times
         FROM hourly GROUP BY year""",
)
def source_columns(spark, sf_dir):
    """Rows of raw files by the file they came from: each names its own folder, and all one reading."""
    folder = Layout(shared_folder(spark, "raw")).raw("wind")
    rows = views.parsed(spark, sf_dir, "wind").withColumn("part", F.year("timestamp")).drop("timestamp")
    rows.withColumn("eor", F.lit("eor")).write.partitionBy("part").options(sep=";", header="true").csv(folder)
    read = observations.read_observations(spark, folder, "wind", pattern="*.csv")
    named = F.regexp_extract("_source_file", "/part=([0-9]+)/[^/]+$", 1).cast("int")
    below = F.contains(F.col("_source_file"), F.regexp_replace("_source_prefix", "^file:/+", "/"))
    return read.groupBy(F.year("timestamp").alias("year")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(below & (named == F.year("timestamp"))).alias("rows_of_year"),
        F.countDistinct("_parsed_at").alias("parse_times"),
    )


# ------------------------------------------------------------ loads and metrics

@query(
    "station_attributes",
    with_views("stations")
    + """SELECT station_id, station_name, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
           elevation_m FROM stations""",
)
def station_attributes(spark, sf_dir):
    """The stored station table, as the feature join loads it."""
    path = f"{shared_folder(spark, 'stations')}/stations"
    views.stations(spark, sf_dir).write.parquet(path)
    return rounded(stations.load_stations(spark, path))


@query(
    "parse_metrics_damaged",
    with_views("hourly")
    + """SELECT count(*) AS total_rows, count(*) FILTER (WHERE qn = 1) AS "nulls_QN_9",
           count(*) FILTER (WHERE qn = 2) AS "nulls_TT_TU", count(*) FILTER (WHERE qn IN (2, 3)) AS "nulls_RF_TU",
           count(DISTINCT station_id) FILTER (WHERE qn <> 4) AS distinct_stations,
           min(ts) FILTER (WHERE qn <> 5) AS min_timestamp, max(ts) FILTER (WHERE qn <> 5) AS max_timestamp
         FROM hourly""",
)
def parse_metrics_damaged(spark, sf_dir):
    """Metrics of lines whose cells do not parse: each quality flag breaks other cells."""
    cells = F.split("value", ";")
    qn = F.get(cells, F.lit(2))

    def cell(i, *broken):
        return F.when(qn.isin(*broken), "x").otherwise(F.get(cells, F.lit(i)))

    lines = views.raw_lines(spark, sf_dir, "air_temperature")
    made = F.concat_ws(";", cell(0, "4"), cell(1, "5"), cell(2, "1"), cell(3, "2"), cell(4, "2", "3"), F.lit("eor"))
    rows = observations.parse_lines(lines.select(made.alias("value")), "air_temperature")
    return cleaning.parse_metrics(rows, "air_temperature")


@query(
    "ingestion_statistics_failed",
    with_views("manifest")
    + """SELECT variable, count(*) AS total_files, count(*) FILTER (WHERE kind = 0) AS processed,
           count(*) FILTER (WHERE kind = 1) AS skipped, count(*) FILTER (WHERE kind = 2) AS failed,
           coalesce(sum(length(filename)) FILTER (WHERE kind = 0), 0)::BIGINT AS total_bytes
         FROM (SELECT *, CASE WHEN year < '1996' THEN 1 WHEN station_id::INTEGER % 3 = 0 THEN 2 ELSE 0 END AS kind
               FROM manifest) GROUP BY variable""",
)
def ingestion_statistics_failed(spark, sf_dir):
    """A run in which files of every third station fail, unless they were loaded before."""
    found = listing.parse_listing(views.listing_pages(spark, sf_dir))
    files = listing.with_status(found, found.where(F.col("year") < "1996").select("object_path"))
    failed = (F.col("status") != "skipped") & (F.col("station_id").cast("int") % 3 == 0)
    status = F.when(failed, "failed").otherwise(F.col("status"))
    return runs.ingestion_statistics(
        files.withColumns({"status": status, "size_bytes": F.length("filename")}), "variable"
    )


@query(
    "replace_table",
    with_views("f_humidity")
    + f"SELECT {_G}, count_observations + 1000 AS count_observations FROM f_humidity WHERE year >= 2000",
)
def replace_table(spark, sf_dir):
    """A second run in replace mode: nothing of the first one stays, other quarters neither."""
    path = Layout(shared_folder(spark, "curated")).curated("humidity")
    rows = curated_table(spark, sf_dir, "humidity").select(*_G.split(", "), "count_observations")
    tables.upsert_features(rows, path)
    later = rows.where("year >= 2000").withColumn("count_observations", F.col("count_observations") + 1000)
    tables.upsert_features(later, path, mode="replace")
    return spark.read.parquet(path)


@query(
    "computed_at",
    with_views("f_pressure")
    + """SELECT dataset_version, count(*) AS total_rows, count(*) AS stamped, 1::BIGINT AS moments
         FROM f_pressure GROUP BY dataset_version""",
)
def computed_at(spark, sf_dir):
    """Stored feature rows carry the time of their run, one for all of it."""
    path = Layout(shared_folder(spark, "curated")).curated("pressure")
    made = enrich.enrich(curated_table(spark, sf_dir, "pressure"), views.stations(spark, sf_dir))
    tables.upsert_features(made, path)
    now = F.current_timestamp()
    return spark.read.parquet(path).groupBy("dataset_version").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if((F.col("computed_at") <= now) & (F.col("computed_at") > now - F.expr("INTERVAL '1' DAY"))).alias("stamped"),
        F.countDistinct("computed_at").alias("moments"),
    )


# ----------------------------------------------------------------- row checks

@query(
    "dq_violations",
    with_views("f_temperature")
    + f"""SELECT * FROM (
            SELECT {_G}, temp_max_c >= mean - 1e-9 AS max_gte_mean, mean >= temp_min_c - 1e-9 AS mean_gte_min,
              abs(temp_max_c - temp_min_c - temp_range_c - CASE WHEN station_id % 5 = 2 THEN 2 ELSE 0 END) <= 1
                AS range_matches,
              frost_hours <= CASE WHEN station_id % 5 = 3 THEN frost_hours - 1 ELSE hours_below_0c END
                AS frost_lte_below_zero
            FROM (SELECT *, temp_mean_c + CASE station_id % 5 WHEN 0 THEN 200 WHEN 1 THEN -200 ELSE 0 END AS mean
                  FROM f_temperature))
          WHERE NOT (max_gte_mean AND mean_gte_min AND range_matches AND frost_lte_below_zero)""",
)
def dq_violations(spark, sf_dir):
    """Feature rows of which four fifths of the stations break one rule each."""
    rows = views.product_features(spark, sf_dir, "air_temperature", extras=True)
    kind = F.col("station_id") % 5
    damaged = rows.withColumns(
        {
            "temp_mean_c": F.col("temp_mean_c") + F.when(kind == 0, 200).when(kind == 1, -200).otherwise(0),
            "temp_range_c": F.col("temp_range_c") + F.when(kind == 2, 2).otherwise(0),
            "hours_below_0c": F.when(kind == 3, F.col("frost_hours") - 1).otherwise(F.col("hours_below_0c")),
        }
    )
    return quality.violations(quality.temperature_consistency(damaged))


@query(
    "dq_wrong_bounds",
    with_views("f_humidity")
    + f"""SELECT {_G}, 'quarter_bounds' AS rule, 'fail' AS severity FROM f_humidity WHERE station_id % 4 = 1
          UNION ALL
          SELECT {_G}, 'empty_statistic', 'fail' FROM f_humidity
          WHERE count_observations > 0 AND humidity_stddev_pct IS NULL
          UNION ALL
          SELECT {_G}, 'missingness', 'warn' FROM f_humidity WHERE missingness_ratio > 0.2""",
)
def dq_wrong_bounds(spark, sf_dir):
    """Contract alerts where every fourth station's quarters end a day late."""
    rows = enrich.with_quarter_bounds(curated_table(spark, sf_dir, "humidity"))
    late = F.when(F.col("station_id") % 4 == 1, F.date_add("quarter_end", 1)).otherwise(F.col("quarter_end"))
    return quality.contract_alerts(rows.withColumn("quarter_end", late), ("humidity_stddev_pct",))


_REQUIRED = ("station_id", "year", "quarter", "dataset_version", "count_observations", "missingness_ratio", "computed_at")


def _presence_sql():
    def one(name, c):
        held = f"count({c})" if c != "computed_at" else "(0 * count(*))::BIGINT"
        return f"""SELECT '{name}' AS product, '{c}' AS column_name, {c != 'computed_at'} AS present,
                     {held} AS rows_with_value FROM f_{name}"""

    parts = [one(n, c) for n in CURATED_NAMES.values() for c in _REQUIRED]
    return with_views(*[f"f_{n}" for n in CURATED_NAMES.values()]) + " UNION ALL ".join(parts)


@query("dq_required_columns", _presence_sql())
def dq_required_columns(spark, sf_dir):
    """Required columns of the stored feature tables; these have no computation time."""
    parts = [
        quality.column_presence(t, _REQUIRED).select(F.lit(n).alias("product"), "*")
        for n, t in views.curated(spark, sf_dir).items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------- records of runs

def _ran(spark, sf_dir):
    """A zone in which moisture was staged and curated, and a curating run of no known version failed."""
    zone = Layout(shared_folder(spark, "zones"))
    raw = views.parsed(spark, sf_dir, "moisture").drop("timestamp")
    raw.write.options(sep=";", header="true").csv(zone.raw("moisture"))
    where = views.stations(spark, sf_dir)
    jobs.stage(spark, zone, "moisture", version="all_staged_v1", pattern="*.csv")
    named = version_name("year", "quarter")
    work = {
        "curate": lambda: jobs.curate(spark, zone, "moisture", where, staged_version="all_staged_v1", version=named),
        "broken": lambda: jobs.curate(spark, zone, "pressure", where),  # never staged
    }
    jobs.run_all(work.items())
    return zone


@query(
    "run_records",
    with_views("hourly", "f_humidity")
    + """SELECT 'stage' AS job, 'moisture' AS product_type, 'all_staged_v1' AS dataset_version, 'success' AS status,
           count(*) AS rows_written, true AS timed, false AS has_error FROM hourly
         UNION ALL SELECT 'curate', 'moisture', 'all_staged_v1', 'success', count(*), true, false FROM f_humidity
         UNION ALL SELECT 'curate', 'pressure', NULL, 'failed', NULL, true, true""",
)
def run_records(spark, sf_dir):
    """The records that jobs leave, that of a failed one with its error."""
    log = spark.read.parquet(_ran(spark, sf_dir).log("runs"))
    return log.select(
        "job", "product_type", "dataset_version", "status",
        F.element_at("metrics", "rows_written").cast("bigint").alias("rows_written"),
        ((F.col("elapsed_seconds") >= 0) & (F.col("ended_at") >= F.col("started_at"))).alias("timed"),
        F.col("error").isNotNull().alias("has_error"),
    )


@query(
    "run_catalogue",
    with_views("f_humidity")
    + """SELECT 'curated_humidity_features:' || dataset_version AS version_id,
           'staged_humidity:all_staged_v1' AS parent_id, 'aggregation' AS transformation_type,
           'available' AS status, count(*) AS record_count, round(avg(missingness_ratio), 6) AS avg_missingness_ratio
         FROM f_humidity GROUP BY dataset_version""",
)
def run_catalogue(spark, sf_dir):
    """Version events and lineage edges that a curating job leaves, side by side."""
    zone = _ran(spark, sf_dir)
    edges = spark.read.parquet(zone.log("lineage")).withColumnRenamed("child_id", "version_id")
    told = F.get_json_object("quality_metrics", "$.avg_missingness_ratio").cast("double")
    events = spark.read.parquet(zone.log("versions")).withColumn("avg_missingness_ratio", told)
    return rounded(
        events.join(edges, "version_id", "full").select(
            "version_id", "parent_id", "transformation_type", "status", "record_count", "avg_missingness_ratio"
        )
    )
