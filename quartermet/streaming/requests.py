"""Metrics over the request log: rates, latencies, errors, alerts.

Input rows: ts, method, endpoint, status, duration_s, caller.  The windowed
metrics run unchanged on a batch table and on a stream (whose ts must be a
TIMESTAMP with a watermark).  Alerts count the log once, in panes of one step;
trailing windows are sums of panes, of which there are few.  They need no
ordering: a point of the time grid fires if the condition held at every grid point
of the holding time, which is a count over points spread forward, not a running
window over the whole log.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Upper bounds of the latency buckets, in seconds.
LATENCY_BUCKETS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)


def _grouped(df: DataFrame, every: str, slide: str | None, by: tuple[str, ...]):
    return df.groupBy(F.window("ts", every, slide), *by)


def _flat(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def _window_seconds(df: DataFrame) -> Column:
    return (F.unix_micros(F.col("window.end").cast("timestamp")) - F.unix_micros(
        F.col("window.start").cast("timestamp"))) / 1_000_000


def request_rate(
    df: DataFrame, every: str = "5 minutes", slide: str | None = None,
    by: tuple[str, ...] = ("method", "endpoint"),
) -> DataFrame:
    """Requests and requests per second by window and group."""
    out = _grouped(df, every, slide, by).agg(F.count(F.lit(1)).alias("requests"))
    return _flat(out.withColumn("per_second", F.col("requests") / _window_seconds(out)))


def latency(
    df: DataFrame, every: str = "5 minutes", slide: str | None = None,
    by: tuple[str, ...] = ("endpoint",), accuracy: int = 10_000,
) -> DataFrame:
    """p50, p95, p99 and mean latency by window and group; one digest for all points.

    Percentiles are exact up to about ``accuracy`` requests a group; beyond, their
    ranks are off by at most one part in ``accuracy``.
    """
    out = _grouped(df, every, slide, by).agg(
        F.percentile_approx("duration_s", [0.5, 0.95, 0.99], accuracy).alias("_p"),
        F.avg("duration_s").alias("mean_s"),
        F.count(F.lit(1)).alias("requests"),
    )
    points = {n: F.get("_p", F.lit(i)) for i, n in enumerate(("p50_s", "p95_s", "p99_s"))}
    return _flat(out.withColumns(points).drop("_p"))


def error_rate(
    df: DataFrame, every: str = "5 minutes", slide: str | None = None,
) -> DataFrame:
    """Rate of 4xx and 5xx responses by window, status and endpoint."""
    return request_rate(df.where(F.col("status") >= 400), every, slide, ("status", "endpoint"))


def success_share(
    df: DataFrame, every: str = "5 minutes", slide: str | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """Percentage of 2xx responses by window and group."""
    good = F.col("status").between(200, 299).cast("int")
    out = _grouped(df, every, slide, by).agg(
        F.count(F.lit(1)).alias("requests"), (F.avg(good) * 100).alias("success_pct")
    )
    return _flat(out)


def hourly_requests(df: DataFrame) -> DataFrame:
    """Requests per endpoint and hour."""
    out = _grouped(df, "1 hour", None, ("endpoint",)).agg(F.count(F.lit(1)).alias("requests"))
    return _flat(out)


def slowest_endpoints(df: DataFrame, k: int = 10, point: float = 0.95, accuracy: int = 10_000) -> DataFrame:
    """The k slowest endpoint-method pairs by a latency percentile; ``accuracy`` as for ``latency``."""
    out = df.groupBy("endpoint", "method").agg(
        F.percentile_approx("duration_s", point, accuracy).alias("latency_s"),
        F.count(F.lit(1)).alias("requests"),
    )
    return out.orderBy(F.desc("latency_s"), "endpoint", "method").limit(k)


def latency_histogram(df: DataFrame, every: str = "1 day") -> DataFrame:
    """Requests not slower than each bucket bound, by window; +Inf holds all."""
    counts = [(str(b), F.count_if(F.col("duration_s") <= b)) for b in LATENCY_BUCKETS]
    counts.append(("+Inf", F.count(F.lit(1))))
    wide = _grouped(df, every, None, ()).agg(
        F.array(
            *[F.struct(F.lit(n).alias("le"), c.alias("requests")) for n, c in counts]
        ).alias("_buckets")
    )
    return _flat(wide).select("window_start", "window_end", F.inline("_buckets"))


def last_success(df: DataFrame, as_of: Column, stale_after_s: int = 86_400) -> DataFrame:
    """Seconds since the last 2xx response of every endpoint, and whether that is stale."""
    good = F.when(F.col("status").between(200, 299), F.col("ts"))
    out = df.groupBy("endpoint").agg(F.max(good).alias("last_success"))

    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    age = (micros(as_of) - micros(F.col("last_success"))) / 1_000_000
    return out.withColumn("age_s", age).withColumn(
        "is_stale", F.coalesce(age > stale_after_s, F.lit(True))
    )


def stale_alert(df: DataFrame, as_of: Column, stale_after_s: int = 86_400, hold_s: int = 3_600) -> DataFrame:
    """Endpoints whose last 2xx response stayed older than a limit for the holding time: endpoint, last_success, at.

    The alert fires at ``at``, which is not after ``as_of``.  An endpoint keeps the
    first and last success of each stretch as long as limit and holding time; no
    longer gap fits into one, so the gaps are between neighbouring stretches.
    """
    reach = stale_after_s + hold_s
    good = df.where(F.col("status").between(200, 299))
    ends = good.groupBy("endpoint", F.window("ts", f"{reach} seconds").alias("_w")).agg(
        F.min("ts").alias("first"), F.max("ts").alias("last")
    )
    later = F.lead("first").over(Window.partitionBy("endpoint").orderBy("_w"))
    at = F.col("last") + _interval(reach)
    rows = ends.select("endpoint", F.col("last").alias("last_success"), at.alias("at"), later.alias("_next"))
    return rows.where((F.col("at") <= as_of) & (F.col("_next").isNull() | (F.col("_next") > F.col("at")))).drop("_next")


def _runs(runs: list[tuple[int, int]], reach: int) -> list[tuple[int, int]]:
    """Stretches of time, those merged that are not more than ``reach`` apart."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start - out[-1][1] <= reach:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def stale_alerts(stream: DataFrame, stale_after_s: int = 86_400, hold_s: int = 3_600) -> DataFrame:
    """``stale_alert`` on a stream with a watermark on ts; alerts fire as the watermark passes them.

    An endpoint's state is the stretches of its successes that are not further
    apart than limit and holding time, so late rows within the watermark can still
    close a gap.  A stretch fires when the watermark is that far behind its end, told by an
    event-time timer; then it is forgotten.
    """
    reach = (stale_after_s + hold_s) * 1_000_000

    def work(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        passed = max(state.getCurrentWatermarkMs(), 0) * 1000
        runs = list(zip(*state.get, strict=True)) if state.exists else []
        if not state.hasTimedOut:
            for batch in batches:
                times = np.sort(batch["ts"].to_numpy("datetime64[us]").astype(np.int64))
                cuts = np.flatnonzero(np.diff(times) > reach)
                starts, ends = times[np.concatenate([[0], cuts + 1])], times[np.concatenate([cuts, [len(times) - 1]])]
                runs = _runs(runs + list(zip(starts.tolist(), ends.tolist(), strict=True)), reach)
        due = [end for _, end in runs if end + reach <= passed]
        rest = [run for run in runs if run[1] + reach > passed]
        if due:
            last = pd.to_datetime(pd.Series(due), unit="us")
            yield pd.DataFrame({"endpoint": key[0], "last_success": last, "at": last + pd.Timedelta(microseconds=reach)})
        if rest:
            state.update(tuple(map(list, zip(*rest, strict=True))))
            state.setTimeoutTimestamp(-(-(min(end for _, end in rest) + reach) // 1000))
        elif state.exists:
            state.remove()

    good = stream.where(F.col("status").between(200, 299)).select("endpoint", "ts")
    return good.groupBy("endpoint").applyInPandasWithState(
        work, "endpoint string, last_success timestamp, at timestamp", "starts array<long>, ends array<long>",
        "update", "EventTimeTimeout",
    )


def weekly_usage(df: DataFrame) -> DataFrame:
    """Requests and mean latency per day and endpoint."""
    return df.groupBy(F.to_date("ts").alias("day"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests"), F.avg("duration_s").alias("mean_s")
    )


def top_callers(df: DataFrame, k: int = 5) -> DataFrame:
    """The k callers with most requests."""
    out = df.groupBy("caller").agg(F.count(F.lit(1)).alias("requests"))
    return out.orderBy(F.desc("requests"), "caller").limit(k)


# ------------------------------------------------------------------ alerts

def _interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def held(breached: DataFrame, step_s: int, hold_s: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Grid points at which a condition has held for ``hold_s`` seconds.

    ``breached`` has a row (column at) per grid point where the condition is
    true.  Each is spread to the points it can support; a point fires if all
    hold_s / step_s + 1 supports are there.
    """
    if hold_s % step_s:
        raise ValueError("the holding time must be a multiple of the step")
    reach = F.sequence(F.col("at"), F.col("at") + _interval(hold_s), _interval(step_s))
    supports = breached.select(*by, F.explode(reach).alias("at"))
    needed = hold_s // step_s + 1
    counted = supports.groupBy(*by, "at").agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") == needed).drop("_n")


def time_grid(df: DataFrame, step_s: int) -> DataFrame:
    """Grid points from the first to the last request, one row each (column at).

    Unfolded by day first, then within the day by several tasks, so no long array is built.
    """
    if 86_400 % step_s:
        raise ValueError("the step must divide a day")
    bounds = df.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    days = bounds.select(
        "lo", "hi", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day")
    )
    points = F.explode(F.sequence(F.lit(0), F.lit(86_400 - step_s), F.lit(step_s))).alias("s")
    at = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("s"))
    grid = days.repartition("day").select("lo", "hi", "day", points).select("lo", "hi", at.alias("at"))
    return grid.where((F.col("at") >= F.col("lo")) & (F.col("at") <= F.col("hi"))).select("at")


# Seconds in the units of interval texts.
_UNITS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}


def _seconds(width: str) -> int:
    number, unit = width.split()
    return int(number) * _UNITS[unit.rstrip("s")]


def panes(df: DataFrame, step_s: int, by: tuple[str, ...] = (), **counts: Column) -> DataFrame:
    """Counts of the requests of each step (column pane, its start) and group; each request counts once."""
    out = df.groupBy(*by, F.window("ts", f"{step_s} seconds").alias("_w"))
    made = out.agg(*[c.alias(n) for n, c in counts.items()])
    return made.select(*by, F.col("_w.start").alias("pane"), *counts)


def trailing(counted: DataFrame, width_s: int, step_s: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums of panes over the trailing window of each grid point (column at) that holds any."""
    if width_s % step_s:
        raise ValueError("the width must be a multiple of the step")
    reach = F.sequence(F.col("pane") + _interval(step_s), F.col("pane") + _interval(width_s), _interval(step_s))
    counts = [c for c in counted.columns if c not in (*by, "pane")]
    spread = counted.select(*by, F.explode(reach).alias("at"), *counts)
    return spread.groupBy(*by, "at").agg(*[F.sum(c).alias(c) for c in counts])


def _share_above(df: DataFrame, bad: Column, above: Column | float, width: str, step_s: int) -> DataFrame:
    """Grid points at which the share of some requests among those with a status exceeds a limit."""
    counted = panes(df, step_s, bad=F.count_if(bad), n=F.count("status"))
    sums = trailing(counted, _seconds(width), step_s)
    return sums.where((F.col("n") > 0) & (F.col("bad") / F.col("n") > above)).select("at")


def error_ratio_alert(
    df: DataFrame, above_pct: float = 5.0, width: str = "5 minutes", step_s: int = 60, hold_s: int = 300
) -> DataFrame:
    """Grid points at which the 5xx share stayed above the limit for the holding time."""
    return held(_share_above(df, F.col("status") >= 500, above_pct / 100, width, step_s), step_s, hold_s)


def latency_alert(
    df: DataFrame, above_s: float = 2.0, width: str = "5 minutes", step_s: int = 60, hold_s: int = 600,
    by: tuple[str, ...] = ("endpoint",), point: float = 0.95,
) -> DataFrame:
    """Groups and grid points whose latency percentile stayed above the limit.

    The percentile is the value at rank ceil(point * n); it exceeds the limit if
    fewer than that many values do not.  So two counts a pane decide it exactly.
    """
    counted = panes(df, step_s, by, low=F.count_if(F.col("duration_s") <= above_s), n=F.count("duration_s"))
    rank = F.ceil(F.lit(str(point)).cast("decimal(9,6)") * F.col("n"))
    breached = trailing(counted, _seconds(width), step_s, by).where(F.col("low") < rank)
    return held(breached.select(*by, "at"), step_s, hold_s, by)


def failing_share_alert(
    df: DataFrame, endpoint_like: str = "%/features%", above: float = 0.1, width: str = "10 minutes",
    step_s: int = 60, hold_s: int = 600,
) -> DataFrame:
    """Grid points at which too many requests of some endpoints were not 2xx."""
    some = df.where(F.col("endpoint").like(endpoint_like))
    return held(_share_above(some, ~F.col("status").between(200, 299), above, width, step_s), step_s, hold_s)


def failure_rate_alert(
    df: DataFrame, endpoint_like: str = "%/stations", above_per_s: float = 0.1, width: str = "10 minutes",
    step_s: int = 60, hold_s: int = 900,
) -> DataFrame:
    """Grid points at which some endpoints answered 5xx more often a second than the limit."""
    some = df.where(F.col("endpoint").like(endpoint_like) & (F.col("status") >= 500))
    sums = trailing(panes(some, step_s, n=F.count(F.lit(1))), _seconds(width), step_s)
    return held(sums.where(F.col("n") / _seconds(width) > above_per_s).select("at"), step_s, hold_s)


def quiet_points(
    df: DataFrame, below: float, width_s: int, step_s: int, counted: Column | None = None
) -> DataFrame:
    """Grid points whose trailing window has fewer requests than ``below``.

    Windows without any request count too: they come from the grid, which spans
    the whole log.  ``counted`` restricts the requests that are counted.
    """
    some = df if counted is None else df.where(counted)
    seen = trailing(panes(some, step_s, requests=F.count(F.lit(1))), width_s, step_s)
    filled = time_grid(df, step_s).join(seen, "at", "left")
    return filled.where(F.coalesce("requests", F.lit(0)) < below).select("at")


def low_traffic_alert(
    df: DataFrame, below_per_s: float = 0.01, width_s: int = 300, step_s: int = 60, hold_s: int = 900,
    counted: Column | None = None,
) -> DataFrame:
    """Grid points at which the request rate stayed below the limit."""
    return held(quiet_points(df, below_per_s * width_s, width_s, step_s, counted), step_s, hold_s)


def few_queries_alert(
    df: DataFrame, endpoint_like: str = "%/stations", below: float = 10, width_s: int = 3_600, step_s: int = 60,
    hold_s: int = 7_200,
) -> DataFrame:
    """Grid points at which some endpoints were asked less often than the limit in the trailing window."""
    return held(quiet_points(df, below, width_s, step_s, F.col("endpoint").like(endpoint_like)), step_s, hold_s)


def no_success_alert(
    df: DataFrame, width_s: int = 21_600, step_s: int = 300, hold_s: int = 1_800
) -> DataFrame:
    """Grid points without a 2xx response in the trailing window, sustained."""
    good = F.col("status").between(200, 299)
    return held(quiet_points(df, 1, width_s, step_s, good), step_s, hold_s)
