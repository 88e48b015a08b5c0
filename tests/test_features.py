from __future__ import annotations

import math
import random
import statistics
from datetime import datetime

import pytest

from quartermet.model import CONTRACT, CURATED_TABLES
from quartermet.operators import features as f
from tests.util import one, staged


def quarter_of_hours():
    return range(24 * 90)


def test_null_handling(spark):
    rows = [(1, h, 10.0 if h % 2 == 0 else None, True) for h in range(24)]
    r = one(f.temperature(staged(spark, "TT_TU double", rows)))
    assert (r["temp_mean_c"], r["count_observations"], r["count_missing"]) == (10.0, 12, 12)
    assert r["missingness_ratio"] == 0.5


def test_quality_filter_excludes_rows(spark):
    rows = [(1, h, 10.0, h >= 6) for h in range(24)]
    r = one(f.temperature(staged(spark, "TT_TU double", rows)))
    assert r["count_observations"] == 18


def test_temperature_against_python(spark):
    random.seed(3)
    values = {h: round(random.uniform(-15, 30), 1) for h in quarter_of_hours()}
    rows = [(1, h, v, True) for h, v in values.items()]
    r = one(f.temperature(staged(spark, "TT_TU double", rows), extras=True))
    ordered = sorted(values.values())
    n = len(ordered)
    assert r["temp_mean_c"] == pytest.approx(statistics.fmean(ordered))
    assert r["temp_stddev_c"] == pytest.approx(statistics.stdev(ordered))
    assert r["temp_median_c"] == ordered[math.ceil(n * 0.5) - 1]
    assert r["temp_q25_c"] == ordered[math.ceil(n * 0.25) - 1]
    assert r["temp_q75_c"] == ordered[math.ceil(n * 0.75) - 1]
    days = [[values[24 * d + h] for h in range(24)] for d in range(90)]
    means = [statistics.fmean(d) for d in days]
    assert r["heating_degree_days"] == pytest.approx(sum(max(18 - m, 0) for m in means))
    assert r["cooling_degree_days"] == pytest.approx(sum(max(m - 18, 0) for m in means))
    assert r["freeze_thaw_cycles"] == sum(min(d) < 0 < max(d) for d in days)
    assert r["frost_hours"] == sum(v < 0 for v in ordered)
    assert r["temp_range_c"] == pytest.approx(max(ordered) - min(ordered))


def test_day_of_nulls_adds_no_degree_days(spark):
    rows = [(1, h, None, True) for h in range(24)] + [(1, 24, 8.0, True)]
    r = one(f.temperature(staged(spark, "TT_TU double", rows)))
    assert (r["heating_degree_days"], r["cooling_degree_days"]) == (10.0, 0.0)


def test_freeze_thaw_is_strict_on_both_sides(spark):
    rows = [(1, 0, 0.0, True), (1, 1, 5.0, True), (1, 24, -1.0, True), (1, 25, 0.0, True)]
    rows += [(1, 48, -1.0, True), (1, 49, 1.0, True)]
    assert one(f.temperature(staged(spark, "TT_TU double", rows)))["freeze_thaw_cycles"] == 1


def test_all_null_group_and_single_row(spark):
    r = one(f.temperature(staged(spark, "TT_TU double", [(1, 0, None, True)])))
    assert r["temp_mean_c"] is None and r["temp_median_c"] is None and r["missingness_ratio"] == 1.0
    r = one(f.temperature(staged(spark, "TT_TU double", [(1, 0, 3.0, True)])))
    assert r["temp_stddev_c"] is None and r["temp_mean_c"] == 3.0


def test_empty_input(spark):
    assert f.temperature(staged(spark, "TT_TU double", [(1, 0, 3.0, False)])).collect() == []


def test_groups_by_station_quarter_and_version(spark):
    rows = [(s, datetime(2024, m, 29, 5), 1.0, True) for s in (1, 2) for m in (2, 5, 8)]
    a = staged(spark, "TT_TU double", rows, version="a")
    b = staged(spark, "TT_TU double", rows, version="b")
    assert f.temperature(a.unionByName(b)).count() == 12


def rain(spark, values, times=None, **options):
    values = [None if v is None else float(v) for v in values]
    rows = [(1, (times or range(len(values)))[i], v, True) for i, v in enumerate(values)]
    return one(f.precipitation(staged(spark, "R1 double", rows), **options))


@pytest.mark.parametrize("unique", [False, True])
def test_spells(spark, unique):
    r = rain(spark, [0, 1, 1, 1, 0, 0, 2, 0], one_row_per_hour=unique)
    assert (r["max_wet_spell_hours"], r["max_dry_spell_hours"]) == (3, 2)
    assert r["wet_hours"] + r["dry_hours"] == r["count_observations"]


@pytest.mark.parametrize("unique", [False, True])
def test_no_wet_hour_gives_null(spark, unique):
    r = rain(spark, [0, 0, 0], one_row_per_hour=unique)
    assert (r["max_wet_spell_hours"], r["max_dry_spell_hours"]) == (None, 3)


@pytest.mark.parametrize("unique", [False, True])
def test_null_rain_is_dry_for_spells_only(spark, unique):
    r = rain(spark, [1, None, 1, 0], one_row_per_hour=unique)
    assert (r["max_wet_spell_hours"], r["max_dry_spell_hours"]) == (1, 1)
    assert (r["wet_hours"], r["dry_hours"], r["count_missing"]) == (2, 1, 1)


@pytest.mark.parametrize("unique", [False, True])
def test_gap_breaks_a_spell_only_on_request(spark, unique):
    values, hours = [1, 1, 1, 1], [0, 1, 5, 6]
    assert rain(spark, values, hours, one_row_per_hour=unique)["max_wet_spell_hours"] == 4
    broken = rain(spark, values, hours, one_row_per_hour=unique, break_on_gap=True)
    assert broken["max_wet_spell_hours"] == 2


def test_repeated_hour_counts_its_rows(spark):
    r = rain(spark, [1, 1, 0, 1], [0, 0, 1, 2])
    assert r["max_wet_spell_hours"] == 2
    # The same hour dry and wet: the dry row comes first.
    r = rain(spark, [1, 0, 1], [0, 1, 1])
    assert (r["max_wet_spell_hours"], r["max_dry_spell_hours"]) == (1, 1)


@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("gaps", [False, True])
def test_spells_against_python(spark, unique, gaps):
    random.seed(11)
    hours = sorted(random.sample(range(24 * 90), 1500))
    values = [random.choice([0.0, 0.0, 0.4, 3.0, None]) for _ in hours]
    best, run, last = {True: 0, False: 0}, 0, None
    for i, v in enumerate(values):
        wet = v is not None and v > 0
        joined = wet == last and not (gaps and hours[i] - hours[i - 1] > 1)
        run = run + 1 if joined else 1
        last = wet
        best[wet] = max(best[wet], run)
    r = rain(spark, values, hours, one_row_per_hour=unique, break_on_gap=gaps)
    assert (r["max_wet_spell_hours"], r["max_dry_spell_hours"]) == (best[True], best[False])


def test_contract_profile_of_rain(spark):
    values = [0.0, 0.05, 0.2, 12.0]
    r = rain(spark, values)
    assert (r["wet_hours"], r["heavy_precip_hours"]) == (3, 1)
    rows = staged(spark, "R1 double", [(1, i, v, True) for i, v in enumerate(values)])
    c = one(f.precipitation(rows, CONTRACT))
    assert (c["wet_hours"], c["dry_hours"], c["heavy_precip_hours"]) == (2, 2, 1)
    assert c["precip_mean_mm"] == pytest.approx((0.05 + 0.2 + 12.0) / 3)


def wind(spark, directions, speeds=None):
    rows = [
        (1, h, (speeds or [5.0] * len(directions))[h], d, True) for h, d in enumerate(directions)
    ]
    return one(f.wind(staged(spark, "F double, D int", rows)))


@pytest.mark.parametrize(
    ("directions", "expected"),
    [
        ([350, 355, 5, 90], 0.0),  # across north
        ([360, 0, 180], 0.0),
        ([90, 91, 270, 271], 90.0),  # tie: the lowest sector
        ([None, None, None, 200], 202.5),  # missing is no sector
        ([None, None], None),
        ([11], 0.0),
        ([12], 22.5),
    ],
)
def test_prevailing_direction(spark, directions, expected):
    assert wind(spark, directions)["prevailing_direction"] == expected


def test_direction_variability(spark):
    d = [10, 50, 200, 350]
    r = wind(spark, d)
    s = statistics.stdev(math.sin(math.radians(x)) for x in d)
    c = statistics.stdev(math.cos(math.radians(x)) for x in d)
    assert r["direction_variability"] == pytest.approx(math.hypot(s, c))
    assert wind(spark, [10])["direction_variability"] is None


def test_gusts_and_calms_are_strict(spark):
    r = wind(spark, [1] * 4, [10.8, 10.9, 0.3, 0.2])
    assert (r["gust_hours"], r["calm_hours"]) == (1, 1)


def test_pressure_prefers_pascal_and_falls_back(spark):
    rows = [(1, 0, 101300.0, 1000.0, True), (1, 1, None, 980.0, True)]
    r = one(f.pressure(staged(spark, "P_pa double, P double", rows)))
    assert (r["pressure_max_pa"], r["pressure_min_pa"], r["pressure_range_pa"]) == (101300.0, 98000.0, 3300.0)
    assert (r["low_pressure_hours"], r["high_pressure_hours"]) == (1, 0)
    only = staged(spark, "P_pa double", [(1, 0, 103000.0, True)])
    assert one(f.pressure(only))["high_pressure_hours"] == 1
    with pytest.raises(ValueError):
        f.pressure(staged(spark, "X double", [(1, 0, 1.0, True)]))


def test_humidity(spark):
    rows = [(1, h, v, True) for h, v in enumerate([20.0, 30.0, 80.0, 95.0, None])]
    r = one(f.humidity(staged(spark, "RF_TU double", rows)))
    assert (r["low_humidity_hours"], r["high_humidity_hours"]) == (1, 1)
    assert (r["count_observations"], r["count_missing"]) == (4, 1)


def test_sixty_eight_features():
    assert sum(len(c) for c in CURATED_TABLES.values()) == 68


def test_unknown_product(spark):
    with pytest.raises(ValueError):
        f.features(staged(spark, "V_N double", [(1, 0, 1.0, True)]), "cloud_cover")


def test_exclude_outliers(spark):
    from pyspark.sql import functions as F

    rows = staged(spark, "TT_TU double", [(1, 0, 70.0, True), (1, 1, 10.0, True)])
    rows = rows.withColumn("has_outlier", F.col("TT_TU") > 60)
    assert one(f.temperature(rows))["temp_max_c"] == 70.0
    assert one(f.temperature(rows, exclude_outliers=True))["temp_max_c"] == 10.0
