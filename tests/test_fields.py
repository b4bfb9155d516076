import json
import math
import random

from fieldheat.operators import fields
from fieldheat.schemas import BOUNDARIES, ELEVATION_CACHE, ELEVATION_GRID, FIELDS, STATE_POLYGONS

L_SHAPE = [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)]
TRIANGLE = [(3, 0), (5, 0), (4, 1.7)]
SQUARE_WITH_HOLE = [[(-3, 0), (-1, 0), (-1, 2), (-3, 2)], [(-2.5, 0.5), (-1.5, 0.5), (-1.5, 1.5), (-2.5, 1.5)]]


def polygon_rows():
    rings = [("ID", 1, 1, L_SHAPE), ("ID", 2, 1, TRIANGLE)]
    rings += [("UT", 1, n, ring) for n, ring in enumerate(SQUARE_WITH_HOLE)]
    return [
        (state, part, ring, seq, float(x), float(y))
        for state, part, ring, points in rings
        for seq, (x, y) in enumerate(points)
    ]


def in_ring(x, y, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def state_by_hand(x, y):
    if in_ring(x, y, L_SHAPE) or in_ring(x, y, TRIANGLE):
        return "ID"
    return "UT" if in_ring(x, y, SQUARE_WITH_HOLE[0]) != in_ring(x, y, SQUARE_WITH_HOLE[1]) else None


def document(lat, lon):
    return json.dumps({"multipolygons": [{"rings": [{"points": [{"lat": lat, "lon": lon}, {"lat": 0, "lon": 0}]}]}]})


def test_states_match_an_edge_by_edge_test(table):
    rng = random.Random(5)
    points = [(rng.uniform(-4, 6), rng.uniform(-1, 3)) for _ in range(800)]
    points += [(float(x), float(y)) for x in range(-4, 7) for y in range(-1, 4)]
    rows = [(n, y, x) for n, (x, y) in enumerate(points)] * 2 + [(-1, None, 1.0)]
    polygons = table(polygon_rows(), STATE_POLYGONS)
    for cell in (0.25, 0.7, 50.0):
        found = fields.with_state(table(rows, "n INT, lat DOUBLE, lon DOUBLE"), polygons, cell).collect()
        assert len(found) == len(rows)
        for r in found:
            assert r.state == (None if r.n == -1 else state_by_hand(*points[r.n]))


def test_only_border_cells_carry_edges(table):
    """Inner cells answer for the state without edges, outer ones are not listed, and few are border cells."""
    cell = 0.125
    rings = [L_SHAPE, TRIANGLE, *SQUARE_WITH_HOLE]
    outlines = [edge for ring in rings for edge in zip(ring, ring[1:] + ring[:1])]

    def near_an_edge(row, col):
        """Whether an edge comes within the cell's circle: a bit more than passing through it."""
        x, y, reach = (col + 0.5) * cell, (row + 0.5) * cell, cell * 0.7072
        for (x1, y1), (x2, y2) in outlines:
            along = ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)
            along = min(1.0, max(0.0, along))
            if math.hypot(x - x1 - along * (x2 - x1), y - y1 - along * (y2 - y1)) <= reach:
                return True
        return False

    cover = fields.state_cover(table(polygon_rows(), STATE_POLYGONS), cell).collect()
    found = {(r.cell_row, r.cell_col): r.outlines for r in cover}
    inner = 0
    for row in range(-4, 24):
        for col in range(-40, 48):
            listed = found.pop((row, col), [])
            if any(o.edges is not None for o in listed):
                assert near_an_edge(row, col)
            elif not near_an_edge(row, col):
                state = state_by_hand((col + 0.5) * cell, (row + 0.5) * cell)
                assert [o.state for o in listed] == ([state] if state else [])
                inner += bool(state)
    assert not found and inner > 200


def test_boundary_points(table):
    rows = [
        ("F1", document("43.123456789", -112.5)),
        ("F2", '{"multipolygons":[{"rings":[{"poi'),
        ("F3", document("north", 1)),
        ("F4", '{"multipolygons":[]}'),
        ("F5", None),
    ]
    found = {r.FIELD_ID: (r.lat, r.lon) for r in fields.boundary_points(table(rows, BOUNDARIES)).collect()}
    assert found == {
        "F1": (43.12345679, -112.5),
        "F2": (None, None),
        "F3": (None, 1.0),
        "F4": (None, None),
        "F5": (None, None),
    }


def world(table):
    boundaries = [
        ("F1", document(0.5, 0.5)),
        ("F1", document(0.25, 0.5)),
        ("F2", document(0.5, 4.0)),
        ("F3", document(9.0, 9.0)),
        ("F4", document(0.2, -2.0)),
        ("F5", "{"),
        ("gone", document(0.5, 0.5)),
    ]
    names = [(n,) for n in ("F1", "F2", "F3", "F4", "F5")]
    grid = [(2, 5, 4000.0), (5, 5, 4100.0), (5, 40, 4200.0), (90, 90, 1.0)]
    return (
        table(names, FIELDS),
        table(boundaries, BOUNDARIES),
        table(polygon_rows(), STATE_POLYGONS),
        table(grid, ELEVATION_GRID),
    )


def master(df):
    return sorted((r.FIELD_ID, r.field_lat, r.field_lon, r.state, r.field_elev) for r in df.collect())


def test_field_master(table):
    cache = table([("F2", 5000.0), ("F1", None)], ELEVATION_CACHE)
    assert master(fields.field_master(*world(table), cache)) == [
        ("F1", 0.25, 0.5, "ID", 4000.0),
        ("F2", 0.5, 4.0, "ID", 5000.0),
    ]
    every = master(fields.field_master(*world(table), dedup=False, states=None))
    assert [(r[0], r[4]) for r in every] == [("F1", 4000.0), ("F1", 4100.0), ("F2", 4200.0)]


def test_elevation_cache_delta_appends_only_what_was_missing(table):
    points = table([("F1", 0.25, 0.5), ("F2", 0.5, 4.0), ("F3", 7.0, 7.0)], "FIELD_ID STRING, lat DOUBLE, lon DOUBLE")
    cache = table([("F2", 5000.0), ("F1", None)], ELEVATION_CACHE)
    grid = world(table)[3]
    delta = fields.elevation_cache_delta(points, grid, cache)
    assert [tuple(r) for r in delta.collect()] == [("F1", 4000.0)]
    filled = fields.with_elevation(points, grid, cache.unionByName(delta))
    assert {r.FIELD_ID: r.ELEVATION for r in filled.collect()} == {"F1": 4000.0, "F2": 5000.0, "F3": None}
    assert fields.elevation_cache_delta(points, grid, cache.unionByName(delta)).count() == 0
