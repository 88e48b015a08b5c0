"""Registered queries: request-log analytics, batch and stream, incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded as _rounded
from ..layout import Layout
from ..model import STATION
from ..session import shared_folder
from ..streaming import requests as log
from ..streaming import runs
from . import views
from .registry import query
from .sql import view, with_views

DIGITS = 12  # durations have five decimals; a mean of few may tie at six


def rounded(df):
    return _rounded(df, DIGITS)


EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def _windows(width: str, extra: str, body: str, every: str | None = None) -> str:
    """Tumbling windows over the requests."""
    return (
        with_views("requests")
        + f"""SELECT time_bucket(INTERVAL '{width}', ts) AS window_start,
                time_bucket(INTERVAL '{width}', ts) + INTERVAL '{width}' AS window_end, {extra} {body}"""
    )


RATE = _windows(
    "5 minutes",
    "method, endpoint, count(*) AS requests, round(count(*) / 300.0::DOUBLE, 12) AS per_second",
    "FROM requests GROUP BY ALL",
)


@query("log_rate", RATE)
def log_rate(spark, sf_dir):
    return rounded(log.request_rate(views.requests(spark, sf_dir)))


LATENCY = _windows(
    "1 day",
    """endpoint, quantile_disc(duration_s, 0.5) AS p50_s, quantile_disc(duration_s, 0.95) AS p95_s,
       quantile_disc(duration_s, 0.99) AS p99_s, avg(duration_s) AS mean_s, count(*) AS requests""",
    "FROM requests GROUP BY ALL",
)
LATENCY = (
    f"""SELECT window_start, window_end, endpoint, round(p50_s, 12) AS p50_s, round(p95_s, 12) AS p95_s,
          round(p99_s, 12) AS p99_s, round(mean_s, 12) AS mean_s, requests FROM ({LATENCY})"""
)


@query("log_latency", LATENCY)
def log_latency(spark, sf_dir):
    return rounded(log.latency(views.requests(spark, sf_dir), "1 day"))


ERRORS = _windows(
    "1 hour",
    "status, endpoint, count(*) AS requests, round(count(*) / 3600.0::DOUBLE, 12) AS per_second",
    "FROM requests WHERE status >= 400 GROUP BY ALL",
)


@query("log_errors", ERRORS)
def log_errors(spark, sf_dir):
    return rounded(log.error_rate(views.requests(spark, sf_dir), "1 hour"))


SUCCESS = _windows(
    "1 hour",
    """count(*) AS requests,
       round(100.0::DOUBLE * count(*) FILTER (WHERE status BETWEEN 200 AND 299) / count(*), 12) AS success_pct""",
    "FROM requests GROUP BY ALL",
)


@query("log_success_share", SUCCESS)
def log_success_share(spark, sf_dir):
    return rounded(log.success_share(views.requests(spark, sf_dir), "1 hour"))


HOURLY = _windows("1 hour", "endpoint, count(*) AS requests", "FROM requests GROUP BY ALL")


@query("log_hourly_requests", HOURLY)
def log_hourly_requests(spark, sf_dir):
    return log.hourly_requests(views.requests(spark, sf_dir))


@query(
    "log_top_slowest",
    with_views("requests")
    + """SELECT endpoint, method, round(quantile_disc(duration_s, 0.95), 12) AS latency_s,
           count(*) AS requests FROM requests GROUP BY endpoint, method
         ORDER BY latency_s DESC, endpoint, method LIMIT 10""",
)
def log_top_slowest(spark, sf_dir):
    return rounded(log.slowest_endpoints(views.requests(spark, sf_dir)))


@query(
    "log_latency_histogram",
    with_views("requests")
    + " UNION ALL ".join(
        f"""SELECT time_bucket(INTERVAL '1 day', ts) AS window_start,
              time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end, '{name}' AS le,
              count(*) FILTER (WHERE {test}) AS requests FROM requests GROUP BY ALL"""
        for name, test in [(str(b), f"duration_s <= {b}::DOUBLE") for b in log.LATENCY_BUCKETS]
        + [("+Inf", "true")]
    ),
)
def log_latency_histogram(spark, sf_dir):
    return log.latency_histogram(views.requests(spark, sf_dir))


@query(
    "log_staleness",
    with_views("requests")
    + """SELECT endpoint, last_success, round(age_s, 12) AS age_s, age_s > 3600 AS is_stale FROM (
           SELECT endpoint, max(ts) FILTER (WHERE status BETWEEN 200 AND 299) AS last_success,
             (epoch_us(TIMESTAMP '2024-01-31 00:00:00')
              - epoch_us(max(ts) FILTER (WHERE status BETWEEN 200 AND 299))) / 1000000.0::DOUBLE AS age_s
           FROM requests GROUP BY endpoint)""",
)
def log_staleness(spark, sf_dir):
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    return rounded(log.last_success(views.requests(spark, sf_dir), as_of, stale_after_s=3600))


@query(
    "log_weekly_usage",
    with_views("requests")
    + """SELECT ts::DATE AS day, endpoint, count(*) AS requests, round(avg(duration_s), 12) AS mean_s
         FROM requests GROUP BY ALL""",
)
def log_weekly_usage(spark, sf_dir):
    return rounded(log.weekly_usage(views.requests(spark, sf_dir)))


@query(
    "log_top_callers",
    with_views("requests")
    + """SELECT caller, count(*) AS requests FROM requests GROUP BY caller
         ORDER BY requests DESC, caller LIMIT 5""",
)
def log_top_callers(spark, sf_dir):
    return log.top_callers(views.requests(spark, sf_dir))


@query(
    "log_mean_latency",
    _windows(
        "1 hour",
        "round(avg(duration_s), 12) AS mean_s, count(*) AS requests",
        "FROM requests WHERE endpoint LIKE '%features%' GROUP BY ALL",
    ),
)
def log_mean_latency(spark, sf_dir):
    some = views.requests(spark, sf_dir).where(F.col("endpoint").like("%features%"))
    return rounded(log.latency(some, "1 hour", by=()).drop("p50_s", "p95_s", "p99_s"))


# ------------------------------------------------------------------ alerts

def _sliding(name: str, width_s: int, step_s: int, where: str = "true") -> None:
    """Every request at each grid point whose trailing window holds it."""
    view(
        name,
        ("requests",),
        f"""SELECT r.*, time_bucket(INTERVAL '{step_s} seconds', ts)
                  + to_seconds(({step_s} * i)::BIGINT) AS "at"
            FROM requests r, unnest(generate_series(1, {width_s // step_s})) AS s(i) WHERE {where}""",
    )


def _held_sql(breached: str, step_s: int, hold_s: int, by: str = "") -> str:
    """Grid points whose holding time is full of breaches, found by self-join counts."""
    return f"""SELECT {by} b."at" FROM (SELECT DISTINCT {by} "at" FROM breached) b
        WHERE (SELECT count(*) FROM breached x WHERE x."at" <= b."at"
               AND x."at" >= b."at" - INTERVAL '{hold_s} seconds'
               {"AND x.endpoint = b.endpoint" if by else ""}) = {hold_s // step_s + 1}"""


_sliding("slide_errors", 1800, 300)


@query(
    "log_sustained_errors",
    with_views("slide_errors")
    + """, breached AS (SELECT "at" FROM slide_errors GROUP BY "at"
           HAVING avg((status >= 500)::INTEGER) * 100 > 5) """
    + _held_sql("breached", 300, 1800),
)
def log_sustained_errors(spark, sf_dir):
    return log.error_ratio_alert(
        views.requests(spark, sf_dir), 5.0, "30 minutes", step_s=300, hold_s=1800
    )


_sliding("slide_latency", 3600, 900)


@query(
    "log_sustained_latency",
    with_views("slide_latency")
    + """, breached AS (SELECT endpoint, "at" FROM slide_latency GROUP BY endpoint, "at"
           HAVING quantile_disc(duration_s, 0.95) > 0.08) """
    + _held_sql("breached", 900, 3600, "endpoint,"),
)
def log_sustained_latency(spark, sf_dir):
    return log.latency_alert(views.requests(spark, sf_dir), 0.08, "1 hour", step_s=900, hold_s=3600)


_sliding("slide_features", 600, 60, "endpoint LIKE '%/features%'")


@query(
    "log_failing_features",
    with_views("slide_features")
    + """, breached AS (SELECT "at" FROM slide_features GROUP BY "at"
           HAVING avg((status NOT BETWEEN 200 AND 299)::INTEGER) > 0.1) """
    + _held_sql("breached", 60, 600),
)
def log_failing_features(spark, sf_dir):
    return log.failing_share_alert(views.requests(spark, sf_dir))


_GRID = """grid AS (SELECT "at" FROM (SELECT unnest(generate_series(
      date_trunc('day', (SELECT min(ts) FROM requests)), (SELECT max(ts) FROM requests),
      INTERVAL '{step} seconds')) AS "at") WHERE "at" >= (SELECT min(ts) FROM requests))"""

_sliding("slide_traffic", 300, 60)


@query(
    "log_low_traffic",
    with_views("slide_traffic")
    + ", " + _GRID.format(step=60)
    + """, seen AS (SELECT "at", count(*) AS n FROM slide_traffic GROUP BY "at"),
           breached AS (SELECT "at" FROM grid LEFT JOIN seen USING ("at") WHERE coalesce(n, 0) < 0.01 * 300) """
    + _held_sql("breached", 60, 900),
)
def log_low_traffic(spark, sf_dir):
    return log.low_traffic_alert(views.requests(spark, sf_dir))


_sliding("slide_success", 1800, 300, "status BETWEEN 200 AND 299")


@query(
    "log_no_success",
    with_views("slide_success")
    + ", " + _GRID.format(step=300)
    + """, breached AS (SELECT "at" FROM grid WHERE "at" NOT IN (SELECT "at" FROM slide_success)) """
    + _held_sql("breached", 300, 600),
)
def log_no_success(spark, sf_dir):
    return log.no_success_alert(views.requests(spark, sf_dir), 1800, 300, 600)


_sliding("slide_failures", 3600, 300, "endpoint LIKE '%/wind' AND status >= 500")


@query(
    "log_failure_rate",
    with_views("slide_failures")
    + """, breached AS (SELECT "at" FROM slide_failures GROUP BY "at" HAVING count(*) / 3600.0::DOUBLE > 0.0002) """
    + _held_sql("breached", 300, 900),
)
def log_failure_rate(spark, sf_dir):
    """Endpoint with too many 5xx a second, held."""
    return log.failure_rate_alert(views.requests(spark, sf_dir), "%/wind", 0.0002, "1 hour", 300, 900)


_sliding("slide_queries", 3600, 300, "endpoint LIKE '%/stations'")


@query(
    "log_few_queries",
    with_views("slide_queries")
    + ", " + _GRID.format(step=300)
    + """, seen AS (SELECT "at", count(*) AS n FROM slide_queries GROUP BY "at"),
           breached AS (SELECT "at" FROM grid LEFT JOIN seen USING ("at") WHERE coalesce(n, 0) < 3) """
    + _held_sql("breached", 300, 7200),
)
def log_few_queries(spark, sf_dir):
    """Endpoint asked too seldom, held for two hours."""
    return log.few_queries_alert(views.requests(spark, sf_dir), below=3, step_s=300)


STALE = (
    with_views("requests")
    + """, good AS (SELECT endpoint, ts, lead(ts) OVER (PARTITION BY endpoint ORDER BY ts) AS later
           FROM requests WHERE status BETWEEN 200 AND 299)
         SELECT endpoint, ts AS last_success, ts + INTERVAL 90 MINUTE AS "at" FROM good
         WHERE ts + INTERVAL 90 MINUTE <= (SELECT max(ts) FROM requests WHERE status BETWEEN 200 AND 299) - INTERVAL 1 HOUR
           AND (later IS NULL OR later > ts + INTERVAL 90 MINUTE)"""
)


@query("log_stale", STALE)
def log_stale(spark, sf_dir):
    """Endpoints without success for an hour, held for half an hour; as far as a stream an hour behind would know."""
    rows = views.requests(spark, sf_dir)
    end = rows.where(F.col("status").between(200, 299)).agg(F.max("ts")).first()[0]
    as_of = F.lit(end).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(1))
    return log.stale_alert(rows, as_of, 3600, 1800)


# ------------------------------------------------------------------ streams

def _stream(spark, sf_dir):
    rows = runs.stream_table(spark, sf_dir, EVENTS, "events.parquet")
    return rows.select(*views.request_columns())


def _as_ntz(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_rate", RATE)
def stream_rate(spark, sf_dir):
    key = ("window_start", "window_end", "method", "endpoint")
    folder = shared_folder(spark, "stream")
    out = runs.stream_metric(spark, _stream(spark, sf_dir), log.request_rate, key, folder)
    return rounded(_as_ntz(out))


@query("stream_latency", LATENCY)
def stream_latency(spark, sf_dir):
    key = ("window_start", "window_end", "endpoint")
    folder = shared_folder(spark, "stream")
    out = runs.stream_metric(
        spark, _stream(spark, sf_dir), lambda df: log.latency(df, "1 day"), key, folder
    )
    return rounded(_as_ntz(out))


@query("stream_errors", ERRORS)
def stream_errors(spark, sf_dir):
    key = ("window_start", "window_end", "status", "endpoint")
    folder = shared_folder(spark, "stream")
    out = runs.stream_metric(
        spark, _stream(spark, sf_dir), lambda df: log.error_rate(df, "1 hour"), key, folder
    )
    return rounded(_as_ntz(out))


@query("stream_stale", STALE)
def stream_stale(spark, sf_dir):
    """The same alerts fired by event-time timers of a stream."""
    folder = shared_folder(spark, "stream")
    good = _stream(spark, sf_dir).where(F.col("status").between(200, 299))
    fired = runs.run_alerts(spark, good, lambda df: log.stale_alerts(df, 3600, 1800), folder)
    return fired.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("last_success", "at")})


@query(
    "stream_late_rows",
    with_views("requests")
    + """SELECT count(*) AS rows_read, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS rows_lost,
           true AS late_rows_seen, true AS refused FROM requests""",
)
def stream_late_rows(spark, sf_dir):
    """A first half of the log that arrives after the second: how much a stream loses, and that it says so."""
    folder = shared_folder(spark, "late")
    rows = views.table(spark, sf_dir, "events")
    late = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    counts, refused = {"rows_read": 0, "rows_late": 0}, False
    for lot in (~late, late):
        rows.where(lot).write.mode("append").parquet(f"{folder}/in")
        stream = runs.stream_table(spark, f"{folder}/in", EVENTS).select(*views.request_columns())
        metric = log.request_rate(runs.with_event_time(stream, "1 hour"))
        try:
            runs.run_windows(metric, f"{folder}/strict", f"{folder}/strict_state")
        except runs.LateRows:
            refused = True
        seen = runs.run_windows(metric, f"{folder}/out", f"{folder}/state", allow_late=True)
        counts = {k: counts[k] + seen[k] for k in counts}
    kept = runs.read_windows(spark, f"{folder}/out", ("window_start", "window_end", "method", "endpoint"))
    return kept.agg(F.sum("requests").alias("kept")).select(
        F.lit(counts["rows_read"]).cast("long").alias("rows_read"),
        (F.lit(counts["rows_read"]) - F.col("kept")).cast("long").alias("rows_lost"),
        F.lit(counts["rows_late"] > 0).alias("late_rows_seen"), F.lit(refused).alias("refused"),
    )


@query(
    "incremental_bad_lot",
    with_views("hourly")
    + """SELECT 'staged' AS outcome, count(*) AS rows_read, 0::BIGINT AS rows_rejected FROM hourly
           WHERE NOT (year(ts) BETWEEN 1994 AND 1995)
         UNION ALL
         SELECT 'set apart', count(*), count(*) FROM hourly WHERE year(ts) BETWEEN 1994 AND 1995""",
)
def incremental_bad_lot(spark, sf_dir):
    """A lot of broken lines between two good ones: it is set apart, the good ones are staged."""
    product = "precipitation"
    zone = Layout(shared_folder(spark, "bad_lot"))
    rows = views.parsed(spark, sf_dir, product)
    year, apart = F.year("timestamp"), zone.log("set_apart")
    for lot in (year < 1994, year.between(1994, 1995), year > 1995):
        lines = rows.where(lot).withColumn("MESS_DATUM", F.when(year.between(1994, 1995), "broken").otherwise(F.col("MESS_DATUM")))
        lines.drop("timestamp").write.mode("append").options(sep=";", header="true").csv(zone.raw(product))
        runs.load_new_files(
            spark, zone.raw(product), product, zone.staged(product), zone.log("load"), "*.csv", set_apart=apart
        )
    staged = spark.read.parquet(zone.staged(product)).agg(F.count(F.lit(1)).alias("rows_read"))
    staged = staged.select(F.lit("staged").alias("outcome"), "rows_read", F.lit(0).cast("long").alias("rows_rejected"))
    bad = runs.files_set_apart(spark, apart).agg(
        F.sum("rows_read").alias("rows_read"), F.sum("rows_rejected").alias("rows_rejected")
    )
    return staged.unionByName(bad.withColumn("outcome", F.lit("set apart")))


@query(
    "incremental_load",
    with_views("hourly")
    + """SELECT station_id AS "STATIONS_ID", ts AS "timestamp", nullif(raw_r1, -999) AS "R1",
           replace(dataset_version, '_v1', '_staged_v1') AS dataset_version FROM hourly""",
)
def incremental_load(spark, sf_dir):
    """Raw files arriving in two lots; each run loads only what is new."""
    product = "precipitation"
    zone = Layout(shared_folder(spark, "incremental"))
    rows = views.parsed(spark, sf_dir, product)
    early = F.year("timestamp") < 1998
    for lot in (early, ~early):
        some = rows.where(lot).drop("timestamp")
        some.write.mode("append").options(sep=";", header="true").csv(zone.raw(product))
        # Lines that do not parse arrive too, and are left out.
        broken = some.where(F.col(STATION) % 10 == 0).withColumn("MESS_DATUM", F.lit("broken"))
        broken.write.mode("append").options(sep=";", header="true").csv(zone.raw(product))
        runs.load_new_files(
            spark, zone.raw(product), product, zone.staged(product), zone.log("load"), "*.csv"
        )
    return spark.read.parquet(zone.staged(product)).select(STATION, "timestamp", "R1", "dataset_version")
