"""SQL text of the derived views and feature tables, for the checks.

``with_views("f_wind", ...)`` returns a WITH clause holding the named views and
all they need.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, needs: tuple[str, ...], text: str) -> None:
    VIEWS[name] = (needs, text)


def with_views(*names: str) -> str:
    wanted: list[str] = []

    def visit(n: str) -> None:
        for need in VIEWS[n][0]:
            visit(need)
        if n not in wanted:
            wanted.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in wanted) + "\n"


view(
    "hourly",
    (),
    """
    SELECT station_id, ts,
           year(ts)::INTEGER AS year, quarter(ts)::INTEGER AS quarter, ts::DATE AS day,
           year(ts)::VARCHAR || 'Q' || quarter(ts)::VARCHAR || '_v1' AS dataset_version,
           max(qn) AS qn, max(tt) AS raw_tt, max(rf) AS raw_rf, max(r1) AS raw_r1,
           max(rs) AS raw_rs, max(wr) AS raw_wr, max(f) AS raw_f, max(d) AS raw_d,
           max(p) AS raw_p, max(p0) AS raw_p0, max(tf) AS raw_tf,
           max(vn) AS raw_vn, max(vni) AS raw_vni,
           max(s1) AS raw_s1, max(s2) AS raw_s2, max(s3) AS raw_s3,
           nullif(max(tt), -999) AS tt, nullif(max(rf), -999) AS rf,
           nullif(max(r1), -999) AS r1, nullif(max(f), -999) AS f,
           nullif(max(d), -999) AS d, nullif(max(p), -999) AS p
    FROM (
      SELECT l_suppkey::INTEGER AS station_id,
             l_shipdate + to_hours(((l_linenumber - 1) + 7 * (l_orderkey % 3))::BIGINT) AS ts,
             (1 + l_orderkey % 10)::INTEGER AS qn,
             CASE WHEN l_linenumber = 7 THEN -999.0 WHEN l_orderkey % 97 = 0 THEN l_quantity + 40
                  ELSE l_quantity - 25 END::DOUBLE AS tt,
             CASE WHEN l_orderkey % 109 = 0 THEN 104.0
                  ELSE round(20 + l_discount * 800, 6) END::DOUBLE AS rf,
             CASE WHEN l_orderkey % 101 = 0 THEN -1.0
                  ELSE round(greatest(l_discount - 0.05::DOUBLE, 0.0) * 100, 1) END::DOUBLE AS r1,
             CASE WHEN l_discount > 0.055 THEN 1 ELSE 0 END AS rs,
             l_linenumber::INTEGER AS wr,
             CASE WHEN l_orderkey % 103 = 0 THEN 160.0 ELSE l_quantity / 4 END::DOUBLE AS f,
             CASE WHEN l_orderkey % 11 = 0 THEN -999 ELSE l_partkey * 37 % 361 END::INTEGER AS d,
             CASE WHEN l_orderkey % 107 = 0 THEN 800.0 ELSE l_quantity + 985 END::DOUBLE AS p,
             l_quantity + 993 AS p0, l_quantity - 31.5::DOUBLE AS tf,
             (l_linenumber + 1)::DOUBLE AS vn, l_returnflag AS vni,
             floor(l_extendedprice / 800)::DOUBLE AS s1,
             floor(l_extendedprice / 1000)::DOUBLE AS s2,
             floor(l_extendedprice / 500)::DOUBLE AS s3
      FROM lineitem)
    GROUP BY station_id, ts
    """,
)

view("good", ("hourly",), "SELECT * FROM hourly WHERE qn >= 5")

_G = "station_id, year, quarter, dataset_version"

view(
    "t_days",
    ("good",),
    f"""SELECT {_G}, day, avg(tt) AS day_mean, min(tt) AS day_min, max(tt) AS day_max
        FROM good GROUP BY {_G}, day""",
)
view(
    "t_degree",
    ("t_days",),
    f"""SELECT {_G},
          sum(CASE WHEN day_mean < 18 THEN 18 - day_mean ELSE 0 END)::DOUBLE AS heating_degree_days,
          sum(CASE WHEN day_mean > 18 THEN day_mean - 18 ELSE 0 END)::DOUBLE AS cooling_degree_days,
          count(*) FILTER (WHERE day_min < 0 AND day_max > 0) AS freeze_thaw_cycles
        FROM t_days GROUP BY {_G}""",
)


def spread(c: str, prefix: str, unit: str, *names: str) -> str:
    made = {
        "total": f"sum({c})",
        "mean": f"avg({c})",
        "min": f"min({c})",
        "max": f"max({c})",
        "stddev": f"stddev_samp({c})",
        "median": f"quantile_disc({c}, 0.5)",
        "q25": f"quantile_disc({c}, 0.25)",
        "q75": f"quantile_disc({c}, 0.75)",
        "q95": f"quantile_disc({c}, 0.95)",
    }
    return ", ".join(f"{made[n]} AS {prefix}_{n}_{unit}" for n in names)


def counts(c: str) -> str:
    return (
        f"count({c}) AS count_observations, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS count_missing, "
        f"(count(*) - count({c}))::DOUBLE / count(*) AS missingness_ratio"
    )


view(
    "f_temperature",
    ("good", "t_degree"),
    f"""SELECT h.*, d.heating_degree_days, d.cooling_degree_days, d.freeze_thaw_cycles FROM (
          SELECT {_G},
            {spread('tt', 'temp', 'c', 'mean', 'median', 'min', 'max', 'stddev', 'q25', 'q75')},
            count(*) FILTER (WHERE tt < 0) AS frost_hours, {counts('tt')},
            count(*) FILTER (WHERE tt < 0) AS hours_below_0c,
            count(*) FILTER (WHERE tt > 25) AS hours_above_25c,
            var_samp(tt) AS temp_variance, max(tt) - min(tt) AS temp_range_c
          FROM good GROUP BY {_G}) h
        LEFT JOIN t_degree d USING ({_G})""",
)


def rain(wet: float, heavy: float, wet_mean: bool, name: str) -> None:
    """Spell and feature views under one threshold profile."""
    view(
        f"{name}_runs",
        ("good",),
        f"""SELECT {_G}, is_wet, run, count(*) AS length, min(ts) AS first_hour, max(ts) AS last_hour
            FROM (SELECT *, row_number() OVER (PARTITION BY {_G} ORDER BY ts)
                          - row_number() OVER (PARTITION BY {_G}, is_wet ORDER BY ts) AS run
                  FROM (SELECT {_G}, ts, coalesce(r1 > {wet}, false) AS is_wet FROM good))
            GROUP BY {_G}, is_wet, run""",
    )
    mean = "avg(r1) FILTER (WHERE r1 > 0)" if wet_mean else "avg(r1)"
    view(
        f"{name}_features",
        ("good", f"{name}_runs"),
        f"""SELECT h.*, s.max_wet_spell_hours, s.max_dry_spell_hours FROM (
              SELECT {_G}, {spread('r1', 'precip', 'mm', 'total', 'median', 'max', 'stddev', 'q75', 'q95')},
                {mean} AS precip_mean_mm,
                count(*) FILTER (WHERE r1 > {wet}) AS wet_hours,
                count(*) FILTER (WHERE r1 <= {wet}) AS dry_hours,
                count(*) FILTER (WHERE r1 > {heavy}) AS heavy_precip_hours, {counts('r1')}
              FROM good GROUP BY {_G}) h
            LEFT JOIN (SELECT {_G}, max(length) FILTER (WHERE is_wet) AS max_wet_spell_hours,
                         max(length) FILTER (WHERE NOT is_wet) AS max_dry_spell_hours
                       FROM {name}_runs GROUP BY {_G}) s USING ({_G})""",
    )


rain(0, 2.5, False, "rain")
rain(0.1, 10, True, "contract_rain")
view("f_precipitation", ("rain_features",), "SELECT * FROM rain_features")


def wind(gust: float, calm: float, name: str) -> None:
    view(
        name,
        ("good",),
        f"""SELECT h.*, m.prevailing_direction FROM (
              SELECT {_G},
                {spread('f', 'wind_speed', 'mps', 'mean', 'median', 'min', 'max', 'stddev', 'q75', 'q95')},
                count(*) FILTER (WHERE f > {gust}) AS gust_hours,
                count(*) FILTER (WHERE f < {calm}) AS calm_hours,
                sqrt(var_samp(sin(radians(d))) + var_samp(cos(radians(d)))) AS direction_variability,
                {counts('f')}
              FROM good GROUP BY {_G}) h
            LEFT JOIN (
              SELECT {_G}, sector * 22.5::DOUBLE AS prevailing_direction FROM (
                SELECT {_G}, sector,
                  row_number() OVER (PARTITION BY {_G} ORDER BY count(*) DESC, sector) AS place
                FROM (SELECT {_G}, (floor((d + 11.25) / 22.5)::INTEGER % 16) AS sector
                      FROM good WHERE d IS NOT NULL)
                GROUP BY {_G}, sector)
              WHERE place = 1) m USING ({_G})""",
    )


wind(10.8, 0.3, "f_wind")
wind(10, 1, "contract_wind")


def pressure(low: float, name: str) -> None:
    view(
        name,
        ("good",),
        f"""SELECT {_G},
              {spread('p * 100', 'pressure', 'pa', 'mean', 'median', 'min', 'max', 'stddev', 'q25', 'q75')},
              count(*) FILTER (WHERE p * 100 > 102000) AS high_pressure_hours,
              count(*) FILTER (WHERE p * 100 < {low}) AS low_pressure_hours,
              max(p * 100) - min(p * 100) AS pressure_range_pa, {counts('p')}
            FROM good GROUP BY {_G}""",
    )


pressure(99000, "f_pressure")
pressure(100000, "contract_pressure")


def humidity(low: float, name: str) -> None:
    view(
        name,
        ("good",),
        f"""SELECT {_G},
              {spread('rf', 'humidity', 'pct', 'mean', 'median', 'min', 'max', 'stddev', 'q25', 'q75')},
              count(*) FILTER (WHERE rf > 80) AS high_humidity_hours,
              count(*) FILTER (WHERE rf < {low}) AS low_humidity_hours, {counts('rf')}
            FROM good GROUP BY {_G}""",
    )


humidity(30, "f_humidity")
humidity(40, "contract_humidity")

view(
    "stations",
    (),
    """SELECT s_suppkey::INTEGER AS station_id, s_name AS station_name,
              47.0::DOUBLE + (s_suppkey % 800) / 100.0::DOUBLE AS latitude,
              6.0::DOUBLE + (s_suppkey % 900) / 100.0::DOUBLE AS longitude,
              (s_suppkey * 13 % 2900)::INTEGER AS elevation_m, n_name AS state,
              DATE '1995-01-01' + (s_suppkey % 10 * 100)::INTEGER AS start_date,
              CASE WHEN s_acctbal > 0 THEN NULL ELSE DATE '2000-12-31' END AS end_date,
              s_acctbal > 0 AS is_active
       FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)

NAMES = ("temperature", "precipitation", "wind", "pressure", "humidity")
FEATURES = tuple(f"f_{n}" for n in NAMES)

# Keys of all five tables: every group with an acceptable row has a row in each.
view(
    "tagged",
    FEATURES,
    " UNION ALL ".join(
        f"SELECT '{n}' AS product, station_id, year, quarter, dataset_version, "
        f"count_observations, count_missing, missingness_ratio FROM f_{n}"
        for n in NAMES
    ),
)

view(
    "requests",
    (),
    """SELECT event_id AS request_id, ts,
              CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END AS method,
              (['/stations', '/features/temperature', '/features/wind', '/features/products',
                '/health'])[user_id % 5 + 1] AS endpoint,
              CASE WHEN event_type = 'error' AND value > 20 THEN 500
                   WHEN event_type = 'click' AND value > 60 THEN 404
                   WHEN event_type = 'signup' THEN 201 ELSE 200 END AS status,
              value / 1000 AS duration_s, user_id AS caller
       FROM events""",
)

view(
    "version_events",
    (),
    """SELECT o_orderkey AS version_id, 'dataset_' || o_custkey AS dataset_name,
              'v' || o_orderkey AS version, o_orderdate AS moment, 0::BIGINT AS step,
              'pending' AS status, NULL::BIGINT AS record_count, NULL::BIGINT AS total_size_bytes
       FROM orders
       UNION ALL
       SELECT l_orderkey, NULL, NULL, l_shipdate, l_linenumber::BIGINT * 10000000 + l_partkey,
              CASE WHEN l_linestatus = 'F' THEN 'available'
                   WHEN l_returnflag = 'R' THEN 'failed' ELSE 'processing' END,
              CASE WHEN l_linenumber % 2 = 0 THEN l_quantity::BIGINT END,
              CASE WHEN l_linenumber % 3 = 0 THEN l_suppkey END
       FROM lineitem""",
)
