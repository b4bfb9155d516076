import math
import random
from datetime import date, datetime, timedelta

import pytest

from fieldheat.operators import hourly as op
from fieldheat.operators import readings as readings_op
from fieldheat.operators import weather
from fieldheat.plans.season_heat import (
    completed_hours,
    field_station_days,
    field_station_hours,
    filled_hours,
    hourly_means,
    season_degree_hours,
)
from fieldheat.schemas import CROP_THRESHOLDS, HOURLY, READINGS

DAY = date(2022, 1, 1)
FIELD_STATIONS = (
    "FIELD_ID STRING, CROP_SEASON INT, CROP_NAME STRING, station_id STRING, seeding_date DATE, harvest_date DATE, "
    "field_elev DOUBLE, station_elev DOUBLE"
)


def series(temps, field="F1", station="S1", season=2022, first_hour=0):
    return [(field, season, station, DAY, first_hour + h, t) for h, t in enumerate(temps)]


def filled(table, rows, **options):
    found = op.fill_gaps(table(rows, HOURLY), **options)
    return [r.temp_avg for r in found.orderBy(*op.HOUR_KEY).collect()]


def test_gaps_are_linear_and_edges_stay_open(table):
    assert filled(table, series([10.0, None, None, 40.0])) == [10, 20, 30, 40]
    assert filled(table, series([None, 10.0, None])) == [None, 10, None]
    assert filled(table, series([None, None])) == [None, None]


def test_position_or_time(table):
    rows = [("F1", 2022, "S1", DAY, h, t) for h, t in [(0, 10.0), (1, None), (4, 50.0)]]
    assert filled(table, rows) == [10, 30, 50]
    assert filled(table, rows, x="time") == [10, 20, 50]


def test_global_scope_bridges_series(table):
    rows = series([10.0, None], station="A") + series([None, 40.0], station="B")
    assert filled(table, rows) == [10, None, None, 40]
    assert filled(table, rows, scope="global") == [10, 20, 30, 40]


@pytest.mark.parametrize("buckets", [None, 1, 3, 64, 2000])
def test_global_scope_matches_one_pass(table, buckets):
    rng = random.Random(3)
    rows = []
    for n in range(40):
        empty = rng.random() < 0.3
        temps = [None if empty or rng.random() < 0.5 else rng.uniform(0, 90) for _ in range(rng.randint(1, 20))]
        rows += series(temps, field=f"F{n % 7}", station=f"S{n}")
    rows.sort(key=lambda r: r[:5])
    column = [r[5] for r in rows]
    expected = list(column)
    known = [i for i, v in enumerate(column) if v is not None]
    for a, b in zip(known, known[1:]):
        for i in range(a + 1, b):
            expected[i] = column[a] + (column[b] - column[a]) * (i - a) / (b - a)
    result = filled(table, rows, scope="global", buckets=buckets)
    assert [v is None for v in result] == [v is None for v in expected]
    assert all(v is None or math.isclose(v, e) for v, e in zip(result, expected))


def test_grid_is_the_product_of_what_was_seen(table):
    rows = [("F1", 2022, "S1", DAY, 0, 1.0), ("F1", 2022, "S2", date(2022, 1, 3), 5, 2.0)]
    grid = op.complete_grid(table(rows, HOURLY)).collect()
    assert len(grid) == 8
    assert {r.Date for r in grid} == {DAY, date(2022, 1, 3)}
    assert sorted(r.temp_avg for r in grid if r.temp_avg is not None) == [1.0, 2.0]


def test_first_field_keeps_a_shared_station_hour(table):
    rows = series([1.0], field="F2") + series([1.0], field="F1") + series([2.0], field="F2", station="S2")
    kept = op.first_field_per_station_hour(table(rows, HOURLY)).collect()
    assert sorted((r.FIELD_ID, r.station_id) for r in kept) == [("F1", "S1"), ("F2", "S2")]


def pair(field, station, seeding, harvest, season=2022, crop="corn"):
    return (field, season, crop, station, seeding, harvest, 5000.0, 4000.0)


def test_mean_skips_nulls_and_keeps_empty_hours(table):
    window = (date(2022, 1, 2), date(2022, 1, 3))
    moments = [(1, 23, 9.0), (2, 0, 10.0), (2, 0, None), (2, 0, 20.0), (2, 4, None), (3, 23, 30.0), (4, 0, 9.0)]
    rows = [("S1", datetime(2022, 1, d, h, n), t, 2022) for n, (d, h, t) in enumerate(moments)]
    stations = table([pair("F1", "S1", *window), pair("F1", "S1", *window, crop="wheat")], FIELD_STATIONS)
    found = op.hourly_mean(readings_op.field_readings(stations, table(rows, READINGS)))
    assert sorted((r.Date.day, r.Hour, r.temp_avg) for r in found.collect() if r.temp_avg is not None) == [
        (2, 0, 15.0),
        (3, 23, 30.0),
    ]
    assert found.filter("temp_avg IS NULL").count() == 1


def random_world(seed):
    """Overlapping crops and seasons, inverted windows, sparse stations, readings on midnight."""
    rng = random.Random(seed)
    pairs, rows = [], []
    for f in range(12):
        for season in (2021, 2022):
            for crop in rng.sample(["corn", "wheat", "moss"], rng.randint(1, 3)):
                seeding = date(season, 1, 1) + timedelta(days=rng.randint(-20, 12))
                harvest = seeding + timedelta(days=rng.randint(-2, 15))
                pairs += [pair(f"F{f}", f"S{s}", seeding, harvest, season, crop) for s in rng.sample(range(8), 3)]
    for s in range(9):
        for _ in range(rng.choice([0, 3, 60, 200])):
            moment = datetime(rng.choice([2020, 2021, 2022]), rng.choice([1, 12]), rng.randint(1, 31))
            moment += timedelta(minutes=rng.choice([0, rng.randint(0, 1439)]))
            rows.append((f"S{s}", moment, None if rng.random() < 0.3 else rng.uniform(20, 90), moment.year))
    return pairs, rows


def as_map(df):
    return {tuple(r[c] for c in op.HOUR_KEY): r.temp_avg for r in df.collect()}


@pytest.mark.parametrize("x", ["position", "time"])
@pytest.mark.parametrize("seed", [1, 2])
def test_planned_path_equals_the_chain_of_operators(table, seed, x):
    pairs, rows = random_world(seed)
    stations, readings = table(pairs, FIELD_STATIONS), table(rows, READINGS)
    plan = readings_op.station_season_plan(stations)
    chosen = readings_op.readings_by_plan(readings, plan)
    expected = as_map(op.hourly_temperatures(readings_op.field_readings(stations, chosen), x=x))
    found = as_map(field_station_hours(stations, readings, x=x))
    assert len(expected) > 1000
    assert found.keys() == expected.keys()
    for key, value in expected.items():
        assert (found[key] is None) == (value is None), key
        assert value is None or math.isclose(found[key], value, rel_tol=1e-12), key


def test_planned_means_and_grid_equal_the_operators(table):
    pairs, rows = random_world(3)
    stations, readings = table(pairs, FIELD_STATIONS), table(rows, READINGS)
    days = field_station_days(stations, readings)
    chosen = readings_op.readings_by_plan(readings, readings_op.station_season_plan(stations))
    means = op.hourly_mean(readings_op.field_readings(stations, chosen))
    for found, expected in [(hourly_means(days), means), (completed_hours(days), op.complete_grid(means))]:
        found, expected = as_map(found), as_map(expected)
        assert found.keys() == expected.keys() and len(found) > 100
        assert all(found[k] == pytest.approx(v) if v is not None else found[k] is None for k, v in expected.items())


def test_planned_path_keeps_every_row_of_a_hot_station(table):
    """One station serves all fields and holds most readings."""
    fields = [pair(f"F{n}", "S1", DAY, date(2022, 1, 20)) for n in range(300)]
    rows = [("S1", datetime(2022, 1, d, h, m), 60.0, 2022) for d in range(1, 20) for h in range(24) for m in (0, 20, 40)]
    seasons = table(fields, FIELD_STATIONS).drop("station_id", "field_elev", "station_elev")
    crops = table([("corn", 50.0, 86.0)], CROP_THRESHOLDS)
    heat = season_degree_hours(table(fields, FIELD_STATIONS), table(rows, READINGS), seasons, crops)
    total = heat.selectExpr("count(*) AS n", "sum(gdh) AS total", "count(DISTINCT FIELD_ID) AS fields").first()
    assert tuple(total) == (300 * 19 * 24, 300 * 19 * 24 * 10.0, 300)


def test_one_shuffle_serves_everything_after_the_join(table):
    """Gap filling, weather and degree hours add no exchange keyed on more than field and season."""
    pairs, rows = random_world(1)
    days = field_station_days(table(pairs, FIELD_STATIONS), table(rows, READINGS))
    hours = filled_hours(days)
    field_weather = weather.field_weather(hours, keys=("FIELD_ID", "CROP_SEASON", "Date", "Hour"))

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(field_weather) == exchanges(hours) == exchanges(days)


def test_lapse_rate(table):
    adjusted = weather.lapse_adjusted(
        table(series([60.0, None]), HOURLY), table([pair("F1", "S1", DAY, DAY)], FIELD_STATIONS)
    )
    assert [r.wt_temp for r in adjusted.orderBy("Hour").collect()] == [56.5, None]
    (change,) = weather.elev_change(table([pair("F1", "S1", DAY, DAY)] * 2, FIELD_STATIONS)).collect()
    assert change.elev_dif == 1000


def test_field_weather_is_a_plain_mean(table):
    rows = series([40.0], station="S1") + series([50.0], station="S2") + series([None], station="S3")
    stations = [pair("F1", s, DAY, DAY) for s in ("S1", "S2", "S3")]
    found = weather.field_weather(weather.lapse_adjusted(table(rows, HOURLY), table(stations, FIELD_STATIONS)))
    (r,) = found.collect()
    assert (r.temp_min, r.temp_max, r.temp_combined_avg, r.temp_wt_avg) == (40, 50, 45, 41.5)
    empty = weather.field_weather(table(series([None]), HOURLY).selectExpr("*", "temp_avg AS wt_temp")).first()
    assert (empty.temp_min, empty.temp_combined_avg) == (None, None)


def test_distances(table):
    schema = "FIELD_ID STRING, station_id STRING, field_lat DOUBLE, field_lon DOUBLE, station_lat DOUBLE, station_lon DOUBLE"
    rows = table([("F1", "S1", 43.0, -112.0, 42.0, -113.0)] * 2 + [("F2", "S2", 43.0, -112.0, 43.0, -112.0)], schema)
    degree = 111319.490793
    lat = {r.FIELD_ID: r.lat_dist for r in weather.lat_dist(rows).collect()}
    lon = {r.FIELD_ID: r.long_dist for r in weather.lon_dist(rows).collect()}
    total = {r.FIELD_ID: r.total_dist for r in weather.total_dist(rows).collect()}
    assert lat["F1"] == pytest.approx(degree, abs=1e-5) and lon["F1"] == pytest.approx(degree, abs=1e-5)
    assert lat["F2"] == lon["F2"] == total["F2"] == 0
    assert degree < total["F1"] < 2 * degree
    assert weather.total_dist(rows).count() == 2


def test_grid_of_rows_without_a_key_and_of_rows_that_come_twice(table):
    """Rows without a key only add to what is seen; an hour that is there twice stays twice."""
    one, two = date(2020, 1, 1), date(2020, 1, 2)
    schema = "FIELD_ID STRING, CROP_SEASON INT, station_id STRING, Date DATE, Hour INT, temp_avg DOUBLE"
    rows = [
        ("1", 2020, "A", one, 5, 1.0),
        ("1", 2020, "A", one, 5, 2.0),
        ("1", 2020, "B", None, 7, 3.0),
        ("1", 2020, None, two, 5, 4.0),
        (None, 2020, "A", one, 5, 5.0),
        ("2", 2020, "A", None, 5, 6.0),
        ("3", 2020, None, one, 5, 7.0),
    ]
    grid = [tuple(r) for r in op.complete_grid(table(rows, schema)).collect()]
    assert sorted(grid, key=str) == sorted(
        [("1", 2020, "A", one, 5, 1.0), ("1", 2020, "A", one, 5, 2.0), (None, 2020, "A", one, 5, None)]
        + [("1", 2020, "A", one, 7, None)]
        + [("1", 2020, "A", two, hour, None) for hour in (5, 7)]
        + [("1", 2020, "B", day, hour, None) for day in (one, two) for hour in (5, 7)],
        key=str,
    )


@pytest.mark.parametrize("x", ["position", "time"])
def test_a_grid_passes_one_window_that_carries_numbers(table, x):
    """Each window copies all rows, and structs and unfolded expressions with lambdas make every row dearer."""
    grid = op.complete_grid(table([("F", 2022, "S", date(2022, 5, 1), 1, 1.0)], HOURLY))
    text = op.fill_gaps(grid, x=x)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert len(windows) == 1 and "known#" not in windows[0]
    unfolded = [line for line in text.splitlines() if "Generate inline" in line and "Hour#" in line]
    assert unfolded and not any("lambda" in line for line in unfolded)


def test_series_of_any_kind_are_bridged_in_the_order_of_the_table(table):
    """Series without known hours, with one and with two, their rows in many tasks."""
    rows = []
    for n in range(40):
        known = {0: [], 1: [n % 5], 2: [0, 4], 3: [1, 3]}[n % 4]
        rows += [(f"F{n // 8}", 2020 + n % 2, f"S{n:02}", date(2022, 5, 1 + h // 3), h % 3, float(7 * n % 11 + h) if h in known else None)
                 for h in range(5)]
    grid = table(rows, HOURLY).repartition(7)
    ordered = sorted(rows, key=lambda r: r[:5])
    values, expected = [r[5] for r in ordered], []
    for i, value in enumerate(values):
        before = next((j for j in range(i, -1, -1) if values[j] is not None), None)
        after = next((j for j in range(i, len(values)) if values[j] is not None), None)
        between = None if before is None or after is None else value if value is not None else (
            values[before] + (values[after] - values[before]) * (i - before) / (after - before)
        )
        expected.append((*ordered[i][:5], between))
    found = op.fill_gaps(grid, scope="global", buckets=3).collect()
    found = sorted(tuple(r[c] for c in op.HOUR_KEY) + (r.temp_avg,) for r in found)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert [r[5] for r in found] == [pytest.approx(r[5]) if r[5] is not None else None for r in expected]
