"""What the plans must keep doing as data grows: read once, push filters, bound windows."""

import contextlib
import io
import re
from datetime import date, datetime
from types import SimpleNamespace

import pytest

from fieldheat.operators import fields, hourly, readings, seasons, stations, weather
from fieldheat.plans import changes, season_heat
from fieldheat.plans.catalogue import Tables, gdh_pushed_twice
from fieldheat.plans.season_heat import season_degree_hours
from fieldheat.schemas import (
    BOUNDARIES,
    CROP_THRESHOLDS,
    ELEVATION_GRID,
    FIELD_OPERATIONS,
    FIELDS,
    LOADED_GDH,
    READINGS,
    STATE_POLYGONS,
    STATIONS,
)
from fieldheat.sources import gdh_table
from fieldheat.sources.staging import stage_in_buckets

PAIRS = (
    "FIELD_ID STRING, CROP_SEASON INT, CROP_NAME STRING, station_id STRING, seeding_date DATE, harvest_date DATE, "
    "field_elev DOUBLE, station_elev DOUBLE"
)


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def stored(table, spark, tmp_path):
    def make(name, schema, rows=()):
        table(list(rows), schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return make


def scans(text, name):
    """Scans of one stored table."""
    return len(re.findall(rf"Location: \w+ \[[^\]]*/{name}\]", text))


def test_boundaries_are_read_once_and_not_shuffled(stored, table):
    text = plan(
        fields.field_master(
            stored("ids", FIELDS),
            stored("boundaries", BOUNDARIES),
            table([("ID", 1, 1, n, float(n % 2), float(n // 2)) for n in range(4)], STATE_POLYGONS),
            stored("grid", ELEVATION_GRID),
        )
    )
    assert scans(text, "boundaries") == 1
    shuffled = [part for part in text.split("\n\n") if re.match(r"\(\d+\) Exchange", part)]
    assert shuffled and not any("MULTIPOLYGONS" in part for part in shuffled)
    assert "WindowGroupLimit" in text


def test_readings_are_read_once(stored):
    heat = season_degree_hours(
        stored("pairs", PAIRS),
        stored("readings", READINGS),
        stored("seasons", PAIRS),
        stored("crops", CROP_THRESHOLDS),
    )
    text = plan(heat)
    assert scans(text, "readings") == 1
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_hours_are_not_shuffled_by_crop_and_busy_stations_are_shared_out(spark, stored):
    schemas = {"pairs": PAIRS, "readings": READINGS, "seasons": PAIRS, "crops": CROP_THRESHOLDS}
    tables = [stored(name, schema) for name, schema in schemas.items()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(season_degree_hours(*tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanged = [part for part in text.split("\n\n") if re.match(r"\(\d+\) Exchange", part)]
    assert not any("hashpartitioning(CROP_NAME" in part and "temp_combined_avg" in part for part in exchanged)
    assert any(re.search(r"hashpartitioning\(station_id#\d+, month#\d+, share#\d+", part) for part in exchanged)


def test_date_limits_reach_the_scan(stored):
    chosen = readings.readings_all(
        stored("readings", READINGS), stored("pairs", PAIRS), date(2022, 1, 1), date(2022, 2, 1)
    ).select("air_temp_set_1")
    (scan,) = [p for p in plan(chosen).split("\n\n") if "Scan parquet" in p and "date_time" in p]
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(date_time", scan)
    assert re.search(r"PushedFilters: .*LessThanOrEqual\(date_time", scan)
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(year,2022\), LessThanOrEqual\(year,2022", scan)


def test_season_windows_need_no_window(stored):
    text = plan(
        seasons.season_windows(
            stored("operations", FIELD_OPERATIONS), stored("loaded", LOADED_GDH), stored("crops", CROP_THRESHOLDS)
        )
    )
    assert "Window" not in text
    assert scans(text, "operations") == 1
    assert "END_DATE" not in text


@pytest.mark.parametrize("levels", [0, 4])
def test_nearest_stations_reads_fields_once_and_joins_on_cells(stored, levels):
    schema = "FIELD_ID STRING, field_lat DOUBLE, field_lon DOUBLE, state STRING, seeding_date DATE"
    text = plan(stations.nearest_stations(stored("fields", schema), stored("stations", STATIONS), 20, levels=levels))
    assert scans(text, "fields") == 1
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert "WindowGroupLimit" in text


def test_a_reading_in_two_ranges_of_a_busy_station_is_not_repeated(table):
    rows = [("S", datetime(2022, 1, d), 1.0, 2022) for d in range(1, 20)]
    ranges = [("F", 2022, "c", "S", date(2022, 1, 1), date(2022, 1, 30), 0.0, 0.0)] * 50
    assert readings.readings_by_plan(table(rows, READINGS), table(ranges, PAIRS)).count() == 19


@pytest.fixture
def by_year(table, spark, tmp_path):
    """Readings stored by year, as the loader writes them."""
    rows = [("S", datetime(y, 6, d, 1), 50.0 + d, y) for y in (2020, 2021, 2022) for d in range(1, 9)]
    table(rows, READINGS).write.partitionBy("year").parquet(str(tmp_path / "by_year"))
    return spark.read.parquet(str(tmp_path / "by_year"))


CHOSEN = [("F", 2021, "c", "S", date(2021, 6, 2), date(2021, 6, 5), 0.0, 0.0)]


def scan_of_readings(text):
    (scan,) = [p for p in text.split("\n\n") if "Scan parquet" in p and "by_year" in p]
    return scan


def test_other_years_and_stations_are_not_aggregated(by_year, stored):
    pairs = stored("pairs", PAIRS, CHOSEN)
    text = plan(season_degree_hours(pairs, by_year, pairs, stored("crops", CROP_THRESHOLDS)))
    assert re.search(r"PartitionFilters: .*year#\d+ >= Subquery.*year#\d+ <= Subquery", scan_of_readings(text))
    tree = text[text.index("== Physical Plan ==") : text.index("\n\n\n")].splitlines()
    scan = next(n for n, line in enumerate(tree) if "Scan parquet" in line and f"({re.search(r'[(]([0-9]+)[)]', scan_of_readings(text)).group(1)})" in line)
    above = [line for line in tree[:scan]][::-1]
    depth = tree[scan].index("Scan")
    ancestors = []
    for line in above:
        at = re.search(r"[A-Z]", line)
        if at and at.start() < depth:
            ancestors.append(line[at.start() :])
            depth = at.start()
    joins = [n for n, line in enumerate(ancestors) if "Join" in line]
    sums = [n for n, line in enumerate(ancestors) if "Aggregate" in line]
    assert joins[0] < sums[0] and "LeftSemi" in text


@pytest.mark.parametrize("given", [(None, None), (date(2021, 6, 1), date(2021, 6, 4))])
def test_years_limit_what_is_read(by_year, stored, given):
    pairs = stored("pairs", PAIRS, CHOSEN)
    for chosen, rows in (
        (readings.readings_by_plan(by_year, readings.station_season_plan(pairs)), 3),
        (readings.readings_all(by_year, pairs, *given), 3),
    ):
        assert re.search(r"PartitionFilters: \[.*year#\d+ [<>]=", scan_of_readings(plan(chosen)))
        assert chosen.count() == rows


def test_an_increment_is_the_end_of_the_full_run(table, by_year):
    pairs = table(
        [
            ("F", 2021, "c", "S", date(2021, 6, 1), date(2021, 6, 8), 0.0, 0.0),
            ("F", 2021, "d", "S", date(2021, 6, 1), date(2021, 6, 3), 0.0, 0.0),
            ("G", 2020, "c", "S", date(2020, 6, 1), date(2020, 6, 8), 0.0, 0.0),
        ],
        PAIRS,
    )
    crops = table([("c", 40.0, 86.0), ("d", 40.0, 86.0)], CROP_THRESHOLDS)
    full = season_degree_hours(pairs, by_year, pairs, crops)
    since = season_degree_hours(pairs, by_year, pairs, crops, since=date(2021, 6, 3))
    expected = sorted(map(str, full.filter("GDH_DATE >= '2021-06-03'").collect()))
    assert expected and sorted(map(str, since.collect())) == expected


def test_nan_readings_are_missing_ones(table):
    day = date(2021, 6, 1)
    rows = [("S", datetime(2021, 6, 1, h), t, 2021) for h, t in ((1, 10.0), (2, float("nan")), (3, 30.0))]
    pairs = table([("F", 2021, "c", "S", day, date(2021, 6, 2), 0.0, 0.0)], PAIRS)
    found = season_heat.field_station_hours(pairs, table(rows, READINGS)).orderBy("Hour").collect()
    assert [r.temp_avg for r in found] == [10.0, 20.0, 30.0]
    joined = readings.field_readings(pairs, table(rows, READINGS))
    assert [r.temp_avg for r in hourly.hourly_mean(joined).orderBy("Hour").collect()] == [10.0, None, 30.0]


def test_nan_elevations_are_missing_ones(table):
    points = table([("A", 42.05, -112.95), ("B", 42.05, -112.95)], "FIELD_ID STRING, lat DOUBLE, lon DOUBLE")
    grid = table([(420, -1130, float("nan")), (420, -1130, 5000.0)], ELEVATION_GRID)
    cache = table([("A", float("nan")), ("B", 4000.0)], "FIELD_ID STRING, ELEVATION DOUBLE")
    found = {r.FIELD_ID: r.ELEVATION for r in fields.with_elevation(points, grid, cache).collect()}
    assert found == {"A": 5000.0, "B": 4000.0}
    delta = fields.elevation_cache_delta(points, grid, cache).collect()
    assert [(r.FIELD_ID, r.ELEVATION) for r in delta] == [("A", 5000.0)]


def test_elevations_are_appended_to_the_cache(spark, table):
    delta = table([("A", 5000.0)], "FIELD_ID STRING, ELEVATION DOUBLE")
    try:
        assert [fields.append_elevations(delta, "elevations_under_test") for _ in range(2)] == [1, 1]
        assert spark.table("elevations_under_test").count() == 2
    finally:
        spark.sql("DROP TABLE IF EXISTS elevations_under_test")


@pytest.mark.parametrize("partitions", ["2", "64"])
def test_shares_follow_the_cluster_and_change_no_row(spark, table, partitions):
    rows = [("S", datetime(2021, 6, d, h), float(d + h), 2021) for d in range(1, 5) for h in (0, 5)]
    chosen = [(f"F{n}", 2021, "c", "S", date(2021, 6, 1), date(2021, 6, 5), 0.0, 0.0) for n in range(40)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = season_heat.field_station_hours(table(chosen, PAIRS), table(rows, READINGS)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == 40 * 8 and {r.temp_avg - r.Date.day - r.Hour for r in found} == {0.0}


@pytest.fixture
def shared_station(table):
    """Seasons that share stations: one of 2024 harvested in the next year, one of 2025 harvested before that."""
    pairs = [
        ("F", 2024, "c", "S", date(2024, 12, 1), date(2025, 2, 10), 0.0, 0.0),
        ("G", 2025, "c", "S", date(2025, 1, 2), date(2025, 1, 25), 0.0, 0.0),
        ("G", 2025, "d", "S", date(2025, 1, 2), date(2025, 1, 20), 0.0, 0.0),
        ("G", 2025, "c", "T", date(2025, 1, 2), date(2025, 1, 25), 0.0, 0.0),
        ("H", 2025, "c", "T", date(2025, 1, 20), date(2025, 1, 31), 0.0, 0.0),
    ]
    days = [date(2024, 12, 30), date(2024, 12, 31)] + [date(2025, 1, d) for d in range(1, 32)] + [date(2025, 2, 1)]
    rows = [
        (s, datetime(d.year, d.month, d.day, h), float(d.day + h) if (h + d.day) % 3 else None, d.year)
        for s in "ST"
        for d in days
        for h in range(24)
        if (d.day + h) % 7
    ]
    crops = [("c", 10.0, 40.0), ("d", 20.0, 30.0)]
    return table(pairs, PAIRS), table(rows, READINGS), table(crops, CROP_THRESHOLDS)


def rows_of(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("field", ["F", "G", "H"])
def test_one_field_alone_has_the_hours_of_the_full_run(shared_station, field):
    pairs, measured, crops = shared_station
    full = season_degree_hours(pairs, measured, pairs.drop("station_id").distinct(), crops)
    own = pairs.filter(f"FIELD_ID = '{field}'")
    seasons_of = own.drop("station_id").distinct()
    alone = season_degree_hours(own, measured, seasons_of, crops, plan=readings.station_season_plan(pairs))
    expected = rows_of(full.filter(f"FIELD_ID = '{field}'"))
    assert expected and rows_of(alone) == expected


@pytest.mark.parametrize("day", [date(2024, 12, 31), date(2025, 1, 20), date(2025, 1, 25), date(2025, 2, 1)])
def test_an_increment_over_the_end_of_the_year(shared_station, day):
    pairs, measured, crops = shared_station
    seasons_of = pairs.drop("station_id").distinct()
    full = season_degree_hours(pairs, measured, seasons_of, crops)
    since = season_degree_hours(pairs, measured, seasons_of, crops, since=day)
    assert rows_of(since) == rows_of(full.filter(f"GDH_DATE >= '{day}'"))
    last_day = since.filter("FIELD_ID = 'G' AND CROP_NAME = 'c' AND GDH_DATE = '2025-01-25' AND gdh IS NOT NULL")
    assert day > date(2025, 1, 25) or last_day.count() > 20


def test_days_of_a_season_are_sorted_once_and_never_listed_on_every_row(stored):
    text = plan(
        season_heat.field_station_hours(stored("pairs", PAIRS), stored("readings", READINGS))
    )
    assert "collect_list(new_date" not in text
    sorts = [p for p in text.split("\n\n") if re.match(r"\(\d+\) Sort", p) and "station_id" in p and "Date" in p and "CROP_SEASON" in p]
    assert len(sorts) == 1


@pytest.mark.parametrize("x", ["position", "time"])
def test_filling_in_one_pass_equals_filling_the_grid(shared_station, x):
    pairs, measured, _ = shared_station
    direct = season_heat.field_station_hours(pairs, measured, x=x)
    chosen = readings.readings_by_plan(measured, readings.station_season_plan(pairs))
    means = hourly.hourly_mean(readings.field_readings(pairs, chosen))
    stepwise = hourly.fill_gaps(hourly.complete_grid(means), x=x)
    rounded = ["FIELD_ID", "CROP_SEASON", "station_id", "Date", "Hour", "round(temp_avg, 9) AS t"]
    assert rows_of(direct.selectExpr(*rounded)) == rows_of(stepwise.selectExpr(*rounded))


def test_every_day_of_a_leap_year(table):
    """Every seventh day is known; those between are filled, over the borders of the bitmap's words."""
    days = [date.fromordinal(date(2020, 1, 1).toordinal() + n) for n in range(366)]
    rows = [(s, datetime(d.year, d.month, d.day, 3), float(n) if s == "T" or n % 7 == 0 else None, 2020) for s in "ST" for n, d in enumerate(days)]
    pairs = table([("F", 2020, "c", s, date(2019, 6, 1), date(2021, 3, 1), 0.0, 0.0) for s in "ST"], PAIRS)
    rows = [r for r in rows if r[0] == "T" or r[2] is not None]
    found = season_heat.field_station_hours(pairs, table(rows, READINGS)).filter("station_id = 'S'").collect()
    expected = {d: float(n) if n <= 364 else None for n, d in enumerate(days)}
    assert len(found) == 366
    assert all(r.temp_avg is None if expected[r.Date] is None else abs(r.temp_avg - expected[r.Date]) < 1e-9 for r in found)


def test_nearest_stations_searches_places_and_never_deals_pairs_by_field_season(stored):
    schema = "FIELD_ID STRING, field_lat DOUBLE, field_lon DOUBLE, state STRING, seeding_date DATE"
    fields_at = [(str(n), 42.0 + n % 7 / 50, -112.0, "ID", date(2020 + n % 3, 4, 1)) for n in range(40)]
    places = [(f"S{n}", 1.0, 42.0 + n % 23 / 70, -112.0 + n % 29 / 90, date(2000 + n % 22, 1, 1)) for n in range(300)]
    columns = "STID STRING, ELEVATION DOUBLE, lat DOUBLE, lon DOUBLE, record_start DATE"
    found = stations.nearest_stations(stored("fields", schema, fields_at), stored("stations", columns, places), 20, levels=4)
    windows = [part for part in plan(found).split("\n\n") if re.match(r"\(\d+\) Window", part)]
    assert windows and not any("FIELD_ID" in part for part in windows)
    assert found.count() == 200


def test_what_is_listed_by_month_or_holds_hours_is_not_broadcast(stored):
    pairs, measured = stored("pairs", PAIRS), stored("readings", READINGS)
    heat = season_degree_hours(pairs, measured, stored("seasons", PAIRS), stored("crops", CROP_THRESHOLDS))
    sent = [part for part in plan(heat).split("\n\n") if re.match(r"\(\d+\) BroadcastExchange", part)]
    assert sent and not any("known#" in part or "windows#" in part for part in sent)
    changed = changes.changed_days(measured.selectExpr("*", "1 AS batch"), "batch", after=0)
    touched = changes.touched_by_readings(changed, pairs, readings.station_season_plan(pairs))
    assert "BroadcastHashJoin" not in plan(touched)


def test_partitions_with_duplicates_are_found_without_dealing_whole_rows(stored):
    rows = [("F", 1.0, 2022), ("F", 1.0, 2022), ("F", 1.0, 2023), (None, 0.0, 2024), (None, -0.0, 2024), ("G", None, 2025)]
    heat = stored("heat", "FIELD_ID STRING, GDH DOUBLE, CROP_SEASON INT", rows)
    found = gdh_table._holding_duplicates(heat, ["CROP_SEASON"])
    dealt = [part for part in plan(found).split("\n\n") if re.match(r"\(\d+\) Exchange", part)]
    assert dealt and not any("GDH#" in part or "FIELD_ID#" in part for part in dealt)
    assert sorted(row.CROP_SEASON for row in found.collect()) == [2022, 2024]


def dealt_by(df):
    """Columns by which the rows of a plan are dealt."""
    return [
        tuple(re.findall(r"(\w+)#", keys)) for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan(df))
    ]


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


HOURS = "FIELD_ID STRING, CROP_SEASON INT, station_id STRING, Date DATE, Hour INT, temp_avg DOUBLE"


def test_only_hours_seen_are_dealt_not_their_grid(stored, no_broadcasts):
    filled = hourly.fill_gaps(hourly.complete_grid(stored("hours", HOURS)))
    assert set(dealt_by(filled)) == {("FIELD_ID", "CROP_SEASON")}


def test_a_grid_of_dealt_days_is_not_dealt_again_to_carry_values_over(stored, no_broadcasts):
    days = season_heat.field_station_days(stored("pairs", PAIRS), stored("readings", READINGS))
    grid = season_heat.completed_hours(hourly.dealt_for_grid(days))
    filled = hourly.fill_gaps(grid, scope="global")
    by_series = ("FIELD_ID", "CROP_SEASON", "station_id")
    assert dealt_by(filled).count(by_series) == dealt_by(days).count(by_series)


def test_field_seasons_are_dealt_once_a_season_not_once_a_month(stored, no_broadcasts):
    pairs, measured = stored("pairs", PAIRS), stored("readings", READINGS)
    keys = [key for key in dealt_by(season_heat.field_station_days(pairs, measured)) if "share" in key]
    assert sorted(keys) == [("station_id", "CROP_SEASON", "share")] * 2 + [("station_id", "month", "share")]
    changed = changes.changed_days(measured.selectExpr("*", "1 AS batch"), "batch", after=0)
    text = plan(changes.touched_by_readings(changed, pairs, readings.station_season_plan(pairs)))
    dealt = [part for part in text.split("\n\n") if re.match(r"\(\d+\) Exchange", part)]
    assert dealt and not any("FIELD_ID" in part and "month#" in part for part in dealt)


def test_days_of_a_season_that_reaches_into_other_years_are_its_own_years(table):
    rows = [("S", datetime(y, m, 5, h), float(h), y) for y in (2020, 2021, 2022) for m in (1, 6, 12) for h in (0, 3)]
    pairs = table(
        [
            ("F", 2021, "c", "S", date(2020, 12, 1), date(2022, 2, 1), 0.0, 0.0),
            ("F", 2021, "d", "S", date(2021, 6, 1), date(2021, 6, 30), 0.0, 0.0),
            (None, 2021, "c", "S", date(2021, 6, 1), date(2021, 6, 30), 0.0, 0.0),
            ("G", None, "c", "S", date(2021, 6, 1), date(2021, 6, 30), 0.0, 0.0),
            ("H", 2021, "c", "S", None, date(2021, 6, 30), 0.0, 0.0),
            ("I", 2019, "c", "S", date(2020, 6, 1), date(2020, 6, 30), 0.0, 0.0),
        ],
        PAIRS,
    )
    days = season_heat.field_station_days(pairs, table(rows, READINGS))
    found = sorted((row.FIELD_ID or "", row.CROP_SEASON, str(row.Date)) for row in days.collect())
    assert found == [("", 2021, "2021-06-05"), ("F", 2021, "2021-01-05"), ("F", 2021, "2021-06-05"), ("F", 2021, "2021-12-05")]
    changed = changes.changed_days(table([(*row, 1) for row in rows], READINGS + ", batch INT"), "batch", after=0)
    touched = changes.touched_by_readings(changed, pairs, readings.station_season_plan(pairs)).collect()
    assert sorted(map(tuple, touched), key=str) == [("F", 2021), (None, 2021)]


def test_season_rows_are_dealt_to_more_tasks_than_usual(spark, stored):
    tasks = hourly.GRID_SHARES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    days = season_heat.field_station_days(stored("pairs", PAIRS), stored("readings", READINGS))
    assert re.search(rf"hashpartitioning\(FIELD_ID#\d+, CROP_SEASON#\d+, {tasks}\), REPARTITION_BY_NUM", plan(days))


def test_places_stay_in_their_buckets_through_the_search(stored, monkeypatch):
    written, store = [], stations.stage_in_buckets

    def spied(df, *options):
        written.append(plan(df))
        return store(df, *options)

    monkeypatch.setattr(stations, "stage_in_buckets", spied)
    schema = "FIELD_ID STRING, field_lat DOUBLE, field_lon DOUBLE, state STRING, seeding_date DATE"
    fields_at = [(str(n), 42.0 + n % 97 / 300, -112.0 + n % 89 / 300, "ID", date(2020 + n % 3, 4, 1)) for n in range(3000)]
    places = [(f"S{n}", 1.0, 42.0 + n % 23 / 70, -112.0 + n % 29 / 90, date(2000 + n % 22, 1, 1)) for n in range(300)]
    columns = "STID STRING, ELEVATION DOUBLE, lat DOUBLE, lon DOUBLE, record_start DATE"
    fields, stationed = stored("fields", schema, fields_at), stored("stations", columns, places)
    found = stations.nearest_stations(fields, stationed, 20, levels=4)
    first, *steps = written
    assert first.count("hashpartitioning(place") == 1
    assert steps and not any("hashpartitioning(place" in text for text in [*steps, plan(found)])
    assert rows_of(found) == rows_of(stations.nearest_stations(fields, stationed, 20, levels=0))


def test_rows_in_buckets_are_not_shuffled_and_their_table_has_no_name_left(table, spark):
    rows = [(f"F{n % 5}" if n % 5 else None, 2020 + n % 3, float(n % 2)) for n in range(60)]
    before = spark.catalog.listTables()
    kept = stage_in_buckets(table(rows, "FIELD_ID STRING, CROP_SEASON INT, GDH DOUBLE"), "kept", ["FIELD_ID", "CROP_SEASON"], 3)
    assert spark.catalog.listTables() == before
    assert sorted(map(str, kept.collect())) == sorted(map(str, table(rows, kept.schema).collect()))
    counted = kept.groupBy("CROP_SEASON", "FIELD_ID", "GDH").count()
    assert "Exchange" not in plan(counted)
    assert counted.count() == 30 and {row["count"] for row in counted.collect()} == {2}


def test_rows_pushed_twice_are_compared_where_they_are_stored(spark, shared_station):
    pairs, measured, crops = shared_station
    heat = season_degree_hours(pairs, measured, pairs.drop("station_id").distinct(), crops)
    twice = gdh_pushed_twice(SimpleNamespace(spark=spark, gdh=lambda: heat))
    assert "Exchange" not in plan(twice)
    pushed = gdh_table.rows_to_push(heat)
    assert rows_of(twice) == rows_of(pushed) and twice.count() > 100
    # Buckets are what these rows are dealt into already.
    assert dealt_by(hourly.dealt_for_grid(pushed).distinct()) == dealt_by(pushed.distinct())


def test_weather_of_fields_is_not_dealt_by_hour(spark, shared_station, monkeypatch):
    pairs, measured, _ = shared_station
    days = season_heat.field_station_days(pairs, measured)
    monkeypatch.setattr(Tables, "days", lambda self: days)
    found = Tables(spark, "none").field_weather()
    assert not any("Hour" in key for key in dealt_by(found))
    plainly = weather.field_weather(season_heat.filled_hours(days))
    assert found.columns == plainly.columns
    assert rows_of(found) == rows_of(plainly) and found.count() > 100
