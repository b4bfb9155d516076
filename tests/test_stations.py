import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fieldheat.functions.geo import EARTH_RADIUS_M, METRES_PER_MILE
from fieldheat.operators.stations import (
    CELL,
    PARENT,
    _descended,
    _placed,
    _station_tree,
    active_stations,
    grid_levels,
    nearest_stations,
)
from fieldheat.schemas import STATION_METADATA, STATIONS

FIELD_SEASONS = "FIELD_ID STRING, field_lat DOUBLE, field_lon DOUBLE, state STRING, seeding_date DATE"
SOWN = date(2020, 4, 1)


def metres(lat1, lon1, lat2, lon2):
    lat1, lon1, lat2, lon2 = map(math.radians, (lat1, lon1, lat2, lon2))
    a = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(a)))


def by_hand(field_rows, station_rows, radius_miles, k):
    found = []
    for name, lat, lon, _, seeding in field_rows:
        if lat is None or seeding is None:
            continue
        near = [
            (round(metres(lat, lon, s[2], s[3]), 6), s[0])
            for s in station_rows
            if s[4] is not None and s[4] < seeding and metres(lat, lon, s[2], s[3]) <= radius_miles * METRES_PER_MILE
        ]
        found += [(name, station) for _, station in sorted(near)[:k]]
    return sorted(found)


def by_spark(table, field_rows, station_rows, radius_miles, k, levels):
    result = nearest_stations(
        table(field_rows, FIELD_SEASONS), table(station_rows, STATIONS), radius_miles, k=k, levels=levels
    )
    return sorted((r.FIELD_ID, r.station_id) for r in result.collect())


def station(n, lat, lon, start=date(2000, 1, 1)):
    return (f"S{n:04d}", 1000.0, lat, lon, start, None)


def spread(rng, n, centre, width):
    return [(centre[0] + rng.uniform(-width, width), centre[1] + rng.uniform(-width, width)) for _ in range(n)]


@pytest.mark.parametrize("levels", [0, 1, 3, 6, None])
def test_matches_brute_force_with_hot_spots(table, levels):
    """A third of the fields in one place, a third of the stations in one place, the rest spread."""
    rng = random.Random(11)
    starts = [date(2019, 1, 1) + timedelta(days=30 * n) for n in range(24)]
    places = spread(rng, 150, (43, -112), 0.5) + [(43.01, -112.02)] * 100 + spread(rng, 50, (43.01, -112.02), 0.001)
    stations = [station(n, *p, rng.choice(starts)) for n, p in enumerate(places)]
    points = spread(rng, 60, (43, -112), 0.6) + [(43.012, -112.02)] * 30
    rows = [(f"F{n}", lat, lon, "ID", SOWN + timedelta(days=n % 200)) for n, (lat, lon) in enumerate(points)]
    rows += [("F-none", 43.0, -112.0, "ID", None), ("F-lost", None, None, "ID", SOWN)]
    assert by_spark(table, rows, stations, 20, 5, levels) == by_hand(rows, stations, 20, 5)


@pytest.mark.parametrize("levels", [0, 4])
@pytest.mark.parametrize(
    "centre, lat_width, lon_width",
    [
        ((0.0, 180.0), 0.4, 0.4),
        ((0.05, 0.0), 0.4, 0.4),
        ((65.0, -179.99), 0.4, 0.8),
        ((89.9, 10.0), 0.09, 180),
        ((-89.95, -170.0), 0.04, 180),
    ],
)
def test_matches_brute_force_at_the_edges_of_the_map(table, centre, lat_width, lon_width, levels):
    rng = random.Random(7)

    def place():
        lon = centre[1] + rng.uniform(-lon_width, lon_width)
        return centre[0] + rng.uniform(-lat_width, lat_width), (lon + 180) % 360 - 180

    stations = [station(n, *place()) for n in range(80)]
    rows = [(f"F{n}", *place(), "ID", SOWN) for n in range(40)]
    assert by_spark(table, rows, stations, 15, 3, levels) == by_hand(rows, stations, 15, 3)


def test_crowd_seen_from_afar_and_from_within(table):
    """Many fields in cells without stations look at one crowd; others stand inside it."""
    rng = random.Random(2)
    stations = [station(n, *p, date(2019, 1, 1) + timedelta(days=rng.randint(0, 700)))
                for n, p in enumerate(spread(rng, 300, (43.2, -112.1), 0.004))]
    points = spread(rng, 40, (43.1, -112.0), 0.002) + spread(rng, 20, (43.2, -112.1), 0.004)
    rows = [(f"F{n}", *p, "ID", SOWN + timedelta(days=n)) for n, p in enumerate(points)]
    assert by_spark(table, rows, stations, 20, 5, None) == by_hand(rows, stations, 20, 5)


def test_start_must_be_before_seeding_and_radius_is_inclusive(table):
    stations = [station(1, 43.0, -112.0, SOWN), station(2, 43.0, -112.0, SOWN - timedelta(days=1))]
    rows = [("F1", 43.0, -112.0, "ID", SOWN)]
    assert by_spark(table, rows, stations, 1, 5, 0) == [("F1", "S0002")]
    assert by_spark(table, rows, stations, 0.0001, 5, 0) == [("F1", "S0002")]


def test_equal_rows_are_kept(table):
    rows = [("F1", 43.0, -112.0, "ID", SOWN)] * 3
    stations = [station(n, 43.0, -112.0 + n / 100) for n in range(2)]
    for levels in (0, 2):
        found = by_spark(table, rows, stations, 20, 5, levels)
        assert found == [("F1", "S0000")] * 3 + [("F1", "S0001")] * 3


def test_refinement_follows_density(table):
    sparse = [station(n, 43 + n / 10, -112.0) for n in range(20)]
    dense = [station(n, 43 + n / 10000, -112.0) for n in range(400)]
    assert grid_levels(table(sparse, STATIONS), 30000.0, 5) == 0
    assert grid_levels(table(dense, STATIONS), 30000.0, 5) >= 3
    assert grid_levels(table([], STATIONS), 30000.0, 5) == 0


def test_no_cell_is_too_small_to_be_parted(table):
    """Stations hundredths of a millimetre apart, beside spread ones and two crowds in single places."""
    rng = random.Random(3)
    places = [(43.0 + n * 1e-10, -112.0) for n in range(60)] + [(43.0, -112.0 + n * 1e-9) for n in range(1, 40)]
    places += spread(rng, 60, (43, -112), 0.4) + [(43.2, -112.1)] * 70 + [(43.2, -112.1 + 1e-6)] * 70
    stations = [station(n, *p, date(2019, 1, 1) + timedelta(days=rng.randint(0, 500))) for n, p in enumerate(places)]
    points = [(43.0, -112.0), (43.0 + 3e-9, -112.0), (42.9, -112.0), (43.2, -112.1)] + spread(rng, 30, (43, -112), 0.5)
    rows = [(f"F{n}", *p, "ID", SOWN + timedelta(days=n)) for n, p in enumerate(points)]
    assert by_spark(table, rows, stations, 20, 5, None) == by_hand(rows, stations, 20, 5)
    assert grid_levels(table(stations, STATIONS), 20 * METRES_PER_MILE, 5) > 20


def test_last_cells_hold_few_stations(table, spark):
    """Whatever their density: a third in one small place, a third in a smaller one within it, a third spread."""
    rng = random.Random(4)
    places = [p for width in (2.0, 1e-3, 1e-7) for p in spread(rng, 200, (43, -112), width)]
    placed = _placed(
        table([station(n, *p) for n, p in enumerate(places)], STATIONS).select(
            F.col("STID").alias("station_id"), F.col("lat").alias("station_lat"), F.col("lon").alias("station_lon"),
            "record_start",
        ), "station_lat", "station_lon", 0.3,
    )
    steps, held = _station_tree(placed, 3, None)
    assert held.count() == len(places) == held.select("station_id").distinct().count()
    assert held.groupBy(*CELL).count().agg(F.max("count")).first()[0] <= 6
    assert len(steps) < held.agg(F.max("cell_level")).first()[0] / 2
    assert all(s.groupBy(*PARENT).count().agg(F.max("count")).first()[0] <= 25 for s in steps)


def test_active_stations(table):
    def meta(stid, name, state="ID", status="ACTIVE", lat="43.5"):
        return (stid, name, lat, "-112.25", "4800", state, status, False, ("2001-02-03T00:00:00Z", "2024-01-01T10:00:00Z"))

    document = [meta("A", "COOP-X"), meta("B", "coop"), meta("C", None), meta("D", "RAWS", state="NV")]
    document += [meta("E", "RAWS", status="INACTIVE"), meta("G", "RAWS", lat="unknown"), meta("H", "RAWS", status=None)]
    metadata = table([(document,)], STATION_METADATA)
    fields = table([("F1", "ID"), ("F2", "ID")], "FIELD_ID STRING, state STRING")
    rows = {r.STID: r for r in active_stations(metadata, fields).collect()}
    assert sorted(rows) == ["B", "C", "G", "H"]
    assert tuple(rows["B"]) == ("B", 4800.0, 43.5, -112.25, date(2001, 2, 3), date(2024, 1, 1))
    assert rows["G"].lat is None
    assert sorted(r.STID for r in active_stations(metadata).collect()) == ["B", "C", "D", "G", "H"]


def test_cells_bound_a_search_together(table):
    """Three cells with two stations each hold five in time, so a far cell is dropped, though none holds five alone."""
    search = "place BIGINT, field_lat DOUBLE, field_lon DOUBLE, first_seeding DATE, last_seeding DATE, widest DOUBLE, "
    search += "narrowest DOUBLE, bound_m DOUBLE, cell_level INT, cell_row BIGINT, cell_col BIGINT"
    parallel = math.cos(math.radians(42.0))
    sought = table([(0, 42.0, -113.0, SOWN, SOWN, parallel, parallel, 10_000.0, 0, 0, 0)], search)
    bounds = "south DOUBLE, north DOUBLE, west DOUBLE, east DOUBLE, next_level INT, starts ARRAY<DATE>"
    keys = ", ".join(f"{name} BIGINT" for name in [*PARENT, *CELL])

    def left(k, early):
        rows = [
            (0, 0, 0, 2, n, 0, 42 + lat, 42 + lat + 0.001, -113.0, -112.999, None, [date(2000, 1, 1), early])
            for n, lat in enumerate([0.01, 0.011, -0.012, 0.08])
        ]
        return sorted(r.cell_row for r in _descended(sought, table(rows, f"{keys}, {bounds}"), k).collect())

    assert left(5, SOWN - timedelta(days=1)) == [0, 1, 2]
    assert left(7, SOWN - timedelta(days=1)) == [0, 1, 2, 3]
    assert left(5, SOWN) == [0, 1, 2, 3]
