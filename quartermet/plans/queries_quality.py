"""Registered queries: quality checks and serving reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..model import KEY, STATION
from ..operators import enrich, quality, serving
from ..operators import features as feats
from . import views
from .registry import query
from .sql import NAMES, with_views
from .views import curated, curated_table

G = "station_id, year, quarter, dataset_version"


# ------------------------------------------------------- counts, coverage

@query(
    "dq_short_quarters",
    with_views("tagged")
    + """SELECT product, year, quarter, count(*) AS row_count
         FROM tagged WHERE count_observations >= 18
         GROUP BY product, year, quarter HAVING count(*) < 11""",
)
def short_quarters(spark, sf_dir):
    return quality.short_quarters(_well_observed(spark, sf_dir, 18), min_rows=11)


@query(
    "dq_station_coverage",
    with_views("tagged")
    + """SELECT product, year, quarter, count(DISTINCT station_id) AS station_count
         FROM tagged WHERE count_observations >= 18
         GROUP BY product, year, quarter HAVING count(DISTINCT station_id) < 11""",
)
def station_coverage(spark, sf_dir):
    return quality.thin_coverage(_well_observed(spark, sf_dir, 18), min_stations=11)


@query(
    "dq_newest_short_quarters",
    with_views("tagged")
    + """SELECT product, year, quarter, row_count FROM (
           SELECT product, year, quarter, count(*) AS row_count,
             row_number() OVER (PARTITION BY product ORDER BY year DESC, quarter DESC) AS place
           FROM tagged WHERE count_observations >= 18
           GROUP BY product, year, quarter HAVING count(*) < 11)
         WHERE place <= 10""",
)
def newest_short_quarters(spark, sf_dir):
    found = quality.short_quarters(_well_observed(spark, sf_dir, 18), min_rows=11)
    return quality.newest(found, 10, "product")


# Statistics are NULL where a group has no value: the spread of a single row.
_SHARES = {
    "temperature": ("temp_mean_c", "temp_stddev_c"),
    "precipitation": ("precip_total_mm", "max_wet_spell_hours"),
    "wind": ("wind_speed_mean_mps", "wind_speed_stddev_mps"),
    "pressure": ("pressure_mean_pa",),
    "humidity": ("humidity_mean_pct", "humidity_stddev_pct"),
}


def _share_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS product, year, quarter, '{c}' AS column_name,
              round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2)::DOUBLE AS null_pct
            FROM f_{n} GROUP BY year, quarter"""
        for n, columns in _SHARES.items()
        for c in columns
    )


@query("dq_null_share", with_views(*[f"f_{n}" for n in NAMES]) + _share_sql())
def null_share(spark, sf_dir):
    return quality.null_shares(curated(spark, sf_dir), _SHARES)


@query(
    "dq_null_excess",
    with_views(*[f"f_{n}" for n in NAMES]) + f"SELECT * FROM ({_share_sql()}) WHERE null_pct > 1",
)
def null_excess(spark, sf_dir):
    return quality.null_excess(curated(spark, sf_dir), 1.0, _SHARES)


@query(
    "dq_null_counts",
    with_views("f_temperature")
    + """SELECT count(*) AS total,
           count(*) FILTER (WHERE temp_mean_c IS NULL) AS temp_mean_c_null,
           count(*) FILTER (WHERE temp_stddev_c IS NULL) AS temp_stddev_c_null,
           count(*) FILTER (WHERE heating_degree_days IS NULL) AS heating_degree_days_null
         FROM f_temperature""",
)
def null_counts(spark, sf_dir):
    rows = curated_table(spark, sf_dir, "temperature")
    return quality.null_counts(rows, "temp_mean_c", "temp_stddev_c", "heating_degree_days")


# -------------------------------------------------------------- continuity

def _well_observed(spark, sf_dir, least=12, names=NAMES):
    """Feature rows resting on enough hours; the rest count as absent."""
    enough = F.col("count_observations") >= least
    return {n: curated_table(spark, sf_dir, n).where(enough) for n in names}


@query(
    "dq_gaps",
    with_views("tagged")
    + """, have AS (SELECT DISTINCT product, station_id, year, quarter FROM tagged
                   WHERE count_observations >= 12),
           bounds AS (SELECT product, station_id, min(year) AS y0, max(year) AS y1 FROM have
                      GROUP BY product, station_id),
           expected AS (SELECT product, station_id, y::INTEGER AS year, q::INTEGER AS quarter
                        FROM bounds, unnest(generate_series(y0, y1)) AS a(y),
                             unnest([1, 2, 3, 4]) AS b(q))
         SELECT e.product, e.station_id, e.year, e.quarter FROM expected e
         LEFT JOIN have h USING (product, station_id, year, quarter) WHERE h.station_id IS NULL""",
)
def gaps(spark, sf_dir):
    rows = quality.tagged(_well_observed(spark, sf_dir), "station_id", "year", "quarter")
    return quality.missing_quarters(rows, "product", "station_id")


def _matrix_sql() -> str:
    sides = " ".join(
        f"""LEFT JOIN (SELECT year, quarter, count(*) AS n FROM tagged
                       WHERE product = '{n}' AND count_observations >= 24
                       GROUP BY year, quarter) {n} USING (year, quarter)"""
        for n in NAMES
    )
    cells = ", ".join(f"CASE WHEN {n}.n IS NULL THEN 'MISSING' ELSE 'OK' END AS {n}" for n in NAMES)
    lacking = " OR ".join(f"{n}.n IS NULL" for n in NAMES)
    return (
        with_views("tagged")
        + f""", expected AS (SELECT y::INTEGER AS year, q::INTEGER AS quarter
                FROM unnest(generate_series(1994, 2002)) AS a(y), unnest([1, 2, 3, 4]) AS b(q))
             SELECT year, quarter, {cells} FROM expected {sides} WHERE {lacking}"""
    )


@query("dq_completeness_matrix", _matrix_sql())
def completeness_matrix(spark, sf_dir):
    expected = quality.year_range(spark, 1994, 2002)
    return quality.completeness_matrix(_well_observed(spark, sf_dir, 24), expected)


@query(
    "dq_alignment_full_outer",
    with_views("f_temperature", "f_humidity")
    + """SELECT coalesce(a.year, b.year) AS year, coalesce(a.quarter, b.quarter) AS quarter,
           coalesce(left_count, 0) AS left_count, coalesce(right_count, 0) AS right_count,
           CASE WHEN abs(coalesce(left_count, 0) - coalesce(right_count, 0)) > 10 THEN 'MISMATCH' ELSE 'OK' END AS status
         FROM (SELECT year, quarter, count(*) AS left_count FROM f_temperature
               WHERE count_observations >= 12 GROUP BY year, quarter) a
         FULL JOIN (SELECT year, quarter, count(*) AS right_count FROM f_humidity
               WHERE count_observations >= 12 GROUP BY year, quarter) b
         ON a.year = b.year AND a.quarter = b.quarter""",
)
def alignment(spark, sf_dir):
    t = _well_observed(spark, sf_dir, names=("temperature", "humidity"))
    return quality.alignment(t["temperature"], t["humidity"])


@query(
    "backfill_worklist",
    with_views("tagged")
    + f""", expected AS (SELECT y::INTEGER AS year, q::INTEGER AS quarter, p AS product
             FROM unnest(generate_series(1994, 2002)) AS a(y), unnest([1, 2, 3, 4]) AS b(q),
                  unnest({list(NAMES)}) AS c(p))
          SELECT year, quarter, product, false AS force FROM expected
          WHERE NOT EXISTS (SELECT 1 FROM tagged t WHERE t.product = expected.product
            AND t.year = expected.year AND t.quarter = expected.quarter
            AND count_observations >= 24)""",
)
def backfill_worklist(spark, sf_dir):
    from ..operators.runs import work_list

    done = quality.tagged(_well_observed(spark, sf_dir, 24), "year", "quarter")
    return work_list(spark, 1994, 2002, products=NAMES, done=done)


# --------------------------------------------------------------- row checks

@query(
    "dq_consistency",
    with_views("f_temperature")
    + f"""SELECT {G}, temp_max_c >= temp_mean_c - 1e-9 AS max_gte_mean,
            temp_mean_c >= temp_min_c - 1e-9 AS mean_gte_min,
            abs(temp_max_c - temp_min_c - temp_range_c) <= 1 AS range_matches,
            frost_hours <= hours_below_0c AS frost_lte_below_zero
          FROM f_temperature""",
)
def consistency(spark, sf_dir):
    rows = views.product_features(spark, sf_dir, "air_temperature", extras=True)
    return quality.temperature_consistency(rows)


def _inside_sql(c: str, lo, hi) -> str:
    tests = ([f"{c} >= {lo}"] if lo is not None else []) + ([f"{c} <= {hi}"] if hi is not None else [])
    return " AND ".join(tests)


def _range_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS product, {G}, '{c}' AS feature, round({c}::DOUBLE, 6) AS value FROM f_{n}
            WHERE NOT ({_inside_sql(c, lo, hi)})"""
        for n, rules in quality.FEATURE_RANGES.items()
        for c, (lo, hi) in rules.items()
    )


@query("dq_out_of_range", with_views(*[f"f_{n}" for n in NAMES]) + _range_sql())
def out_of_range(spark, sf_dir):
    return rounded(quality.out_of_range(curated(spark, sf_dir)))


def _valid_sql(n: str) -> str:
    rules = quality.FEATURE_RANGES[n].items()
    cells = ", ".join(
        f"count(*) FILTER (WHERE {_inside_sql(c, lo, hi)}) AS {c}_valid" for c, (lo, hi) in rules
    )
    return with_views(f"f_{n}") + f"SELECT count(*) AS total, {cells} FROM f_{n}"


@query("dq_range_counts", _valid_sql("temperature"))
def range_counts(spark, sf_dir):
    return quality.range_counts(curated_table(spark, sf_dir, "temperature"), "temperature")


@query(
    "dq_expected_hours",
    with_views("f_wind")
    + f"""SELECT {G}, count_observations + count_missing AS hours_seen,
            (24 * (last_day(make_date(year, quarter * 3, 1)) + 1
                   - make_date(year, (quarter - 1) * 3 + 1, 1)))::INTEGER AS hours_expected,
            round((count_observations + count_missing)::DOUBLE
                  / (24 * (last_day(make_date(year, quarter * 3, 1)) + 1
                     - make_date(year, (quarter - 1) * 3 + 1, 1))), 6) AS coverage
          FROM f_wind""",
)
def expected_hours(spark, sf_dir):
    return rounded(quality.hour_coverage(curated_table(spark, sf_dir, "wind")))


@query(
    "dq_contract_alerts",
    with_views("f_temperature")
    + f"""SELECT {G}, 'missingness' AS rule, 'warn' AS severity FROM f_temperature
          WHERE missingness_ratio > 0.2
          UNION ALL
          SELECT {G}, 'empty_statistic', 'fail' FROM f_temperature
          WHERE count_observations > 0 AND (temp_mean_c IS NULL OR temp_stddev_c IS NULL)""",
)
def contract_alerts(spark, sf_dir):
    rows = enrich.with_quarter_bounds(curated_table(spark, sf_dir, "temperature"))
    return quality.contract_alerts(rows, ("temp_mean_c", "temp_stddev_c"))


@query(
    "dq_missing_by_month",
    with_views("hourly")
    + """, m AS (SELECT station_id, year, month(ts)::INTEGER AS month,
                   avg((f IS NULL)::INTEGER) AS f, avg((d IS NULL)::INTEGER) AS d
                 FROM hourly GROUP BY ALL)
         SELECT station_id AS "STATIONS_ID", year, month, 'F' AS column_name,
           round(f, 6) AS missing_share FROM m WHERE f > 0.2
         UNION ALL SELECT station_id, year, month, 'D', round(d, 6) FROM m WHERE d > 0.2""",
)
def missing_by_month(spark, sf_dir):
    return rounded(quality.missing_by_month(views.staged(spark, sf_dir, "wind"), "wind"))


@query(
    "dq_orphans",
    with_views("f_temperature", "stations")
    + """SELECT DISTINCT f.station_id FROM f_temperature f
         LEFT JOIN (SELECT station_id FROM stations WHERE is_active) s USING (station_id)
         WHERE s.station_id IS NULL""",
)
def orphans(spark, sf_dir):
    active = views.stations(spark, sf_dir).where("is_active")
    return quality.unknown_stations(curated_table(spark, sf_dir, "temperature"), active)


@query(
    "dq_orphan_count",
    with_views("f_temperature", "stations")
    + """SELECT count(*) AS orphaned_rows FROM f_temperature f
         WHERE NOT EXISTS (SELECT 1 FROM stations s WHERE s.station_id = f.station_id AND is_active)""",
)
def orphan_count(spark, sf_dir):
    active = views.stations(spark, sf_dir).where("is_active")
    return quality.orphan_count(curated_table(spark, sf_dir, "temperature"), active, "station_id")


@query(
    "dq_active_dates",
    with_views("f_temperature", "stations")
    + f"""SELECT {G}, start_date, end_date FROM f_temperature JOIN stations USING (station_id)
          WHERE make_date(year, (quarter - 1) * 3 + 1, 1) < start_date
             OR make_date(year, quarter * 3, 28) > end_date""",
)
def active_dates(spark, sf_dir):
    rows = curated_table(spark, sf_dir, "temperature").select(*KEY)
    return quality.outside_active_dates(rows, views.stations(spark, sf_dir))


@query(
    "dq_duplicates",
    """SELECT l_suppkey::INTEGER AS "STATIONS_ID",
         l_shipdate + to_hours(((l_linenumber - 1) + 7 * (l_orderkey % 3))::BIGINT) AS "timestamp",
         count(*) AS copies
       FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicates(spark, sf_dir):
    return quality.duplicate_keys(_undeduplicated(spark, sf_dir), STATION, "timestamp")


def _undeduplicated(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").selectExpr(
        f"CAST(l_suppkey AS INT) AS {STATION}",
        f"{views.LINE_HOUR} AS timestamp",
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
    )


@query(
    "dedupe_latest",
    """SELECT "STATIONS_ID", "timestamp", l_orderkey, l_partkey, l_linenumber, l_quantity FROM (
         SELECT l_suppkey::INTEGER AS "STATIONS_ID",
           l_shipdate + to_hours(((l_linenumber - 1) + 7 * (l_orderkey % 3))::BIGINT) AS "timestamp",
           l_orderkey, l_partkey, l_linenumber, l_quantity,
           row_number() OVER (PARTITION BY l_suppkey,
             l_shipdate + to_hours(((l_linenumber - 1) + 7 * (l_orderkey % 3))::BIGINT)
             ORDER BY l_orderkey DESC, l_partkey DESC, l_linenumber DESC, l_quantity DESC) AS place
         FROM lineitem) WHERE place = 1""",
)
def dedupe_latest(spark, sf_dir):
    rows = _undeduplicated(spark, sf_dir)
    return quality.keep_newest(
        rows, (STATION, "timestamp"), ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    )


@query(
    "type_change_check",
    with_views("f_temperature")
    + """SELECT count(*) AS total, count(temp_mean_c) AS old_count,
           count(round(temp_mean_c, 6)::DECIMAL(18,6)::DECIMAL(4,2)) AS new_count,
           count(*) FILTER (WHERE round(temp_mean_c, 6)::DECIMAL(18,6)
             <> round(temp_mean_c, 6)::DECIMAL(18,6)::DECIMAL(4,2)) AS mismatches
         FROM f_temperature""",
)
def type_change_check(spark, sf_dir):
    rows = rounded(curated_table(spark, sf_dir, "temperature").select("temp_mean_c"))
    exact = rows.select(F.col("temp_mean_c").cast("decimal(18,6)").alias("temp_mean_c"))
    return quality.type_change(exact, "temp_mean_c", "decimal(4,2)")


@query(
    "dq_check_log",
    with_views("tagged")
    + """SELECT check_name, check_type, status, year, quarter, product FROM (
           SELECT 'station_quarter_rows' AS check_name, 'completeness' AS check_type,
             'failed' AS status, year, quarter, product
           FROM tagged WHERE count_observations >= 18
           GROUP BY year, quarter, product HAVING count(*) < 11)""",
)
def dq_check_log(spark, sf_dir):
    found = quality.short_quarters(_well_observed(spark, sf_dir, 18), min_rows=11)
    at = F.make_date("year", F.col("quarter") * 3, F.lit(1)).cast("timestamp")
    log = quality.check_records(found, "station_quarter_rows", "completeness", "fail", at)
    result = F.from_json("result", "product string, year int, quarter int")
    return quality.check_log(log, status="failed").select(
        "check_name", "check_type", "status", result.alias("r")
    ).select("check_name", "check_type", "status", "r.year", "r.quarter", "r.product")


# ----------------------------------------------------------------- serving

_PAGE = "station_id, year, quarter, dataset_version, count_observations, count_missing"


@query(
    "feature_page",
    with_views("f_wind")
    + f"""SELECT {_PAGE} FROM f_wind WHERE year >= 1996 AND year <= 2000 AND quarter = 3
          ORDER BY year DESC, quarter DESC, station_id, dataset_version LIMIT 50 OFFSET 25""",
)
def feature_page(spark, sf_dir):
    rows = curated_table(spark, sf_dir, "wind").select(*_PAGE.split(", "))
    return serving.feature_page(rows, 50, 25, quarter=3, min_year=1996, max_year=2000)


@query(
    "feature_total",
    with_views("f_wind")
    + "SELECT count(*) AS total FROM f_wind WHERE year >= 1996 AND year <= 2000 AND quarter = 3",
)
def feature_total(spark, sf_dir):
    rows = curated_table(spark, sf_dir, "wind")
    return serving.total(serving.filter_features(rows, quarter=3, min_year=1996, max_year=2000))


@query(
    "station_series",
    with_views("f_precipitation")
    + f"""SELECT {_PAGE}, round(precip_total_mm, 6) AS precip_total_mm FROM f_precipitation
          WHERE station_id = 7 ORDER BY year, quarter, dataset_version LIMIT 1000""",
)
def station_series(spark, sf_dir):
    rows = curated_table(spark, sf_dir, "precipitation").select(*_PAGE.split(", "), "precip_total_mm")
    return rounded(serving.station_series(rows, 7, limit=1000))


@query(
    "feature_page_after",
    with_views("f_wind")
    + f"""SELECT {_PAGE} FROM f_wind WHERE (-year, -quarter, station_id, dataset_version) > (-1996, -3, 40, '1996Q3_v1')
          ORDER BY year DESC, quarter DESC, station_id, dataset_version LIMIT 500""",
)
def feature_page_after(spark, sf_dir):
    """The page behind a key: quarters before it are not read."""
    rows = curated_table(spark, sf_dir, "wind").select(*_PAGE.split(", "))
    return serving.feature_page(rows, 500, after=(1996, 3, 40, "1996Q3_v1"))


@query(
    "station_series_after",
    with_views("f_precipitation")
    + f"""SELECT {_PAGE} FROM f_precipitation WHERE station_id = 7 AND (year, quarter) > (1994, 2)
          ORDER BY year, quarter, dataset_version LIMIT 8""",
)
def station_series_after(spark, sf_dir):
    rows = curated_table(spark, sf_dir, "precipitation").select(*_PAGE.split(", "))
    return serving.station_series(rows, 7, limit=8, after=(1994, 2, 7, "1994Q2_v1"))


@query(
    "curated_tables",
    with_views("tagged")
    + """SELECT product, count(*) AS total_rows, count(DISTINCT station_id) AS stations FROM tagged GROUP BY product""",
)
def curated_tables(spark, sf_dir):
    """All five curated tables computed and stored, and counted as they are read back."""
    rows = quality.tagged(curated(spark, sf_dir), "station_id")
    return rows.groupBy("product").agg(
        F.count(F.lit(1)).alias("total_rows"), F.countDistinct("station_id").alias("stations")
    )


@query(
    "station_page",
    with_views("stations")
    + """SELECT station_id, station_name, round(latitude, 6) AS latitude,
           round(longitude, 6) AS longitude, elevation_m, state, start_date, end_date, is_active
         FROM stations WHERE is_active ORDER BY station_id LIMIT 50 OFFSET 5""",
)
def station_page(spark, sf_dir):
    return rounded(serving.station_page(views.stations(spark, sf_dir), 50, 5, is_active=True))


@query(
    "station_lookup",
    with_views("stations") + "SELECT station_id, station_name, state FROM stations WHERE station_id = 7",
)
def station_lookup(spark, sf_dir):
    return serving.station(views.stations(spark, sf_dir), 7).select(
        "station_id", "station_name", "state"
    )


@query("station_total", with_views("stations") + "SELECT count(*) AS station_count FROM stations")
def station_total(spark, sf_dir):
    return serving.station_total(views.stations(spark, sf_dir))


@query(
    "product_stats",
    with_views("f_wind")
    + """SELECT 'wind' AS product, count(*) AS total_records,
           count(DISTINCT station_id) AS station_count, min(year) AS min_year, max(year) AS max_year,
           min(quarter) AS min_quarter, max(quarter) AS max_quarter FROM f_wind""",
)
def product_stats(spark, sf_dir):
    return serving.feature_stats(curated_table(spark, sf_dir, "wind"), "wind")


@query(
    "products",
    with_views("tagged")
    + """SELECT product AS name, count(*) AS record_count,
           count(DISTINCT station_id) AS station_count, 'quarterly_' || product || '_features' AS "table"
         FROM tagged GROUP BY product""",
)
def products(spark, sf_dir):
    return serving.available_products(curated(spark, sf_dir))


@query(
    "union_summary",
    with_views("tagged")
    + """SELECT product, count(*) AS total_rows, count(DISTINCT station_id) AS unique_stations,
           count(DISTINCT year) AS unique_years, min(year) AS min_year, max(year) AS max_year
         FROM tagged GROUP BY product""",
)
def union_summary(spark, sf_dir):
    return serving.product_summary(curated(spark, sf_dir))


def _summary_sql() -> str:
    cells = ", ".join(
        f"count(*) FILTER (WHERE product = '{n}') AS {n}" for n in NAMES
    )
    return (
        with_views("tagged", "stations")
        + f"""SELECT s.station_id, s.station_name, s.state, s.is_active,
                {", ".join(f"coalesce({n}, 0) AS {n}" for n in NAMES)},
                coalesce(total_records, 0) AS total_records
              FROM stations s LEFT JOIN (SELECT station_id, {cells}, count(*) AS total_records
                FROM tagged WHERE count_observations >= 12 GROUP BY station_id) USING (station_id)"""
    )


@query("station_summary", _summary_sql())
def station_summary(spark, sf_dir):
    some = views.stations(spark, sf_dir).select("station_id", "station_name", "state", "is_active")
    return serving.station_summary(some, _well_observed(spark, sf_dir))


@query(
    "freshness",
    with_views("tagged")
    + """SELECT product, max(year) AS latest_year,
           arg_max(quarter, year * 10 + quarter) AS latest_quarter FROM tagged GROUP BY product""",
)
def freshness(spark, sf_dir):
    return serving.freshness(curated(spark, sf_dir))


@query(
    "latest_per_station",
    with_views("f_humidity")
    + """SELECT station_id, max(last_day(make_date(year, quarter * 3, 1))::TIMESTAMP
             + INTERVAL '23:59:59') AS latest_data
         FROM f_humidity GROUP BY station_id ORDER BY latest_data DESC, station_id LIMIT 20""",
)
def latest_per_station(spark, sf_dir):
    rows = enrich.with_quarter_bounds(curated_table(spark, sf_dir, "humidity").select("station_id", "year", "quarter"))
    return serving.latest_per_station(rows)


@query(
    "value_summary",
    with_views("f_temperature")
    + """SELECT count(*) AS total, count(*) FILTER (WHERE temp_stddev_c IS NULL) AS nulls,
           round(100.0 * count(*) FILTER (WHERE temp_stddev_c IS NULL) / count(*), 2)::DOUBLE AS null_pct,
           round(min(temp_stddev_c), 6) AS min_value, round(max(temp_stddev_c), 6) AS max_value,
           round(avg(temp_stddev_c), 6) AS avg_value FROM f_temperature""",
)
def value_summary(spark, sf_dir):
    return rounded(serving.value_summary(curated_table(spark, sf_dir, "temperature"), "temp_stddev_c"))


@query(
    "missingness_report",
    with_views("f_temperature")
    + """SELECT station_id, year, quarter, round(missingness_ratio, 6) AS missingness_ratio
         FROM f_temperature WHERE missingness_ratio > 0.2""",
)
def missingness_report(spark, sf_dir):
    return rounded(serving.missingness_report(curated_table(spark, sf_dir, "temperature")))


@query(
    "counts_by_quarter",
    with_views("f_pressure")
    + "SELECT year, quarter, count(*) AS row_count FROM f_pressure GROUP BY year, quarter",
)
def counts_by_quarter(spark, sf_dir):
    return serving.counts_by_quarter(curated_table(spark, sf_dir, "pressure"))


@query(
    "quarter_row_counts",
    with_views("tagged")
    + """SELECT product, count(*) AS "rows" FROM tagged WHERE year = 1998 AND quarter = 1
         GROUP BY product""",
)
def quarter_row_counts(spark, sf_dir):
    return serving.quarter_row_counts(curated(spark, sf_dir), 1998, 1)


@query(
    "table_sizes",
    with_views("tagged")
    + "SELECT " + ", ".join(f"count(*) FILTER (WHERE product = '{n}') AS {n}" for n in NAMES)
    + " FROM tagged",
)
def table_sizes(spark, sf_dir):
    return serving.table_sizes(curated(spark, sf_dir))


@query(
    "derive_stations",
    with_views("f_wind", "stations")
    + """SELECT station_id, station_name, round(latitude, 6) AS latitude,
           round(longitude, 6) AS longitude, elevation_m,
           min(make_date(year, quarter * 3 - 2, 1)) AS start_date,
           max(last_day(make_date(year, quarter * 3, 1))) AS end_date, true AS is_active
         FROM f_wind LEFT JOIN stations USING (station_id)
         GROUP BY ALL""",
)
def derive_stations(spark, sf_dir):
    rows = curated_table(spark, sf_dir, "wind").select(*KEY)
    return rounded(serving.derive_stations(enrich.with_stations(rows, views.stations(spark, sf_dir))))


@query(
    "temperature_days",
    with_views("t_days")
    + f"""SELECT {G}, day AS date, round(day_mean, 6) AS day_mean, day_min, day_max FROM t_days""",
)
def temperature_days(spark, sf_dir):
    rows = views.staged(spark, sf_dir, "air_temperature").where("quality_acceptable")
    days = views.curated_version(feats.temperature_days(rows))
    return rounded(days.withColumnRenamed(STATION, "station_id"))
