"""Field master: where each field lies, in which state, and how high."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldheat.functions.rows import observed
from fieldheat.schemas import BOUNDARY_POINT, number, require_columns

STATES_SERVED = ("AZ", "ID", "UT")
POLYGON_CELL_DEGREES = 0.25
ELEVATION_CELLS_PER_DEGREE = 10


def boundary_points(boundaries: DataFrame) -> DataFrame:
    """First point of the first ring of each boundary, as doubles rounded to eight decimals.

    The whole document is scanned once and only the point leaves the scan stage, so boundary
    text is never shuffled. Unparsable documents or numbers give NULL coordinates.
    """
    require_columns(boundaries, "FIELD_ID", "MULTIPOLYGONS")
    first = F.get_json_object("MULTIPOLYGONS", "$.multipolygons[0].rings[0].points[0]")
    point = F.from_json(first, BOUNDARY_POINT)
    return boundaries.select("FIELD_ID", point.alias("point")).select(
        "FIELD_ID",
        F.col("point.lat").try_cast("decimal(12,8)").cast("double").alias("lat"),
        F.col("point.lon").try_cast("decimal(12,8)").cast("double").alias("lon"),
    )


def first_point_per_field(points: DataFrame) -> DataFrame:
    """One point per field: the smallest by (lat, lon), known points before unknown ones."""
    order = Window.partitionBy("FIELD_ID").orderBy(F.asc_nulls_last("lat"), F.asc_nulls_last("lon"))
    return points.withColumn("rank", F.row_number().over(order)).filter("rank = 1").drop("rank")


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """Closed rings as edges (x1, y1) to (x2, y2)."""
    require_columns(polygons, "state", "part", "ring", "seq", "lon", "lat")
    ring = Window.partitionBy("state", "part", "ring")
    along = ring.orderBy("seq")

    def following(name: str):
        return F.coalesce(F.lead(name).over(along), F.first(name).over(along))

    return polygons.select(
        "state",
        F.col("lon").alias("x1"),
        F.col("lat").alias("y1"),
        following("lon").alias("x2"),
        following("lat").alias("y2"),
        F.min("lon").over(ring).alias("ring_west"),
    )


# Whether a ray from (lat, lon) to the east crosses an odd number of edges; level edges never cross it.
ODD = """size(filter({edges}, e -> (e.y1 > {lat}) <> (e.y2 > {lat})
         AND {lon} < (e.x2 - e.x1) * ({lat} - e.y1) / (e.y2 - e.y1) + e.x1)) % 2 = 1"""
# Degrees by which an edge reaches farther when cells are said to be free of it.
MARGIN = 1e-9


def state_cover(polygons: DataFrame, cell: float) -> DataFrame:
    """Per grid cell the states that reach into it: all of it, without edges, or with the edges that decide.

    A cell that none of a state's edges passes through lies inside the state or outside, which its centre
    tells; outside, the state is not listed. Other cells are border cells and carry the edges that a ray from them to the
    east can cross: those of the cell's row, from their ring's western end to their own eastern end. West of its
    ring a ray crosses the ring an even number of times, which parity does not notice. The lists depend on the
    detail of the map, not on the number of points.
    """
    rows = F.sequence(F.floor(F.least("y1", "y2") / cell), F.floor(F.greatest("y1", "y2") / cell))
    columns = F.sequence(
        F.floor((F.col("ring_west") - MARGIN) / cell), F.floor((F.greatest("x1", "x2") + MARGIN) / cell)
    )
    level = F.col("y1") == F.col("y2")

    def reached_at(lat):
        """Longitude of the edge at a latitude within it, or at its end nearest to one beyond."""
        within = F.least(F.greatest(lat, F.least("y1", "y2")), F.greatest("y1", "y2"))
        return (F.col("x2") - F.col("x1")) * F.try_divide(within - F.col("y1"), F.col("y2") - F.col("y1")) + F.col("x1")

    bottom = F.when(level, F.col("x1")).otherwise(reached_at(F.col("cell_row") * cell - MARGIN))
    top = F.when(level, F.col("x2")).otherwise(reached_at((F.col("cell_row") + 1) * cell + MARGIN))
    passed = {
        "from_col": F.floor((F.least(bottom, top) - MARGIN) / cell),
        "to_col": F.floor((F.greatest(bottom, top) + MARGIN) / cell),
    }
    centre = ODD.format(edges="edges", lat=f"((cell_row + 0.5D) * {cell}D)", lon=f"((cell_col + 0.5D) * {cell}D)")
    return (
        polygon_edges(polygons)
        .withColumn("cell_row", F.explode(rows))
        .withColumns(passed)
        .withColumn("cell_col", F.explode(columns))
        .groupBy("cell_row", "cell_col", "state")
        .agg(
            F.collect_list(F.when(~level, F.struct("x1", "y1", "x2", "y2"))).alias("edges"),
            F.max(F.col("cell_col").between(F.col("from_col"), F.col("to_col"))).alias("border"),
        )
        .filter(F.col("border") | F.expr(centre))
        .select("cell_row", "cell_col", F.struct("state", F.when(F.col("border"), F.col("edges")).alias("edges")).alias("outline"))
        .groupBy("cell_row", "cell_col")
        .agg(F.sort_array(F.collect_list("outline")).alias("outlines"))
    )


def with_state(points: DataFrame, polygons: DataFrame, cell: float = POLYGON_CELL_DEGREES) -> DataFrame:
    """Add the two-letter state of (lat, lon), NULL outside all states.

    Even-odd rule with the half-open test on edge ends, over all rings and parts of a state; where
    states overlap the first by name wins. Points meet their cell's states in one equi-join, read edges in
    border cells only and stay one row each, so with a map small enough to broadcast they are not shuffled at all.
    """
    require_columns(points, "lat", "lon")
    inside = F.expr(f"filter(outlines, o -> o.edges IS NULL OR {ODD.format(edges='o.edges', lat='lat', lon='lon')})")
    return (
        points.withColumn("cell_row", F.floor(F.col("lat") / cell))
        .withColumn("cell_col", F.floor(F.col("lon") / cell))
        .join(state_cover(polygons, cell), ["cell_row", "cell_col"], "left")
        .withColumn("state", F.get(inside, F.lit(0))["state"])
        .drop("cell_row", "cell_col", "outlines")
    )


# Rows of cells that no raster has: beyond the south pole at any resolution.
NO_CELL = -1_000_000_000


def _raster_elevation(points: DataFrame, grid: DataFrame, cells_per_degree: int) -> DataFrame:
    """Points with the raster's elevation, `fetched`; NULL outside it and for points with a `cached` one.

    The latter are sent to cells that do not exist, evenly spread, so that they neither meet a raster row nor each
    other in one task.
    """
    require_columns(grid, "cell_lat", "cell_lon", "elev_ft")
    raster = grid.groupBy("cell_lat", "cell_lon").agg(F.min(number(F.col("elev_ft"))).alias("fetched"))
    asked = F.col("cached").isNull()
    nowhere = F.lit(NO_CELL) - F.pmod(F.xxhash64("FIELD_ID"), F.lit(-NO_CELL))
    located = points.withColumns(
        {
            "cell_lat": F.when(asked, F.floor(F.col("lat") * cells_per_degree)).otherwise(nowhere),
            "cell_lon": F.floor(F.col("lon") * cells_per_degree),
        }
    )
    return located.join(raster, ["cell_lat", "cell_lon"], "left").drop("cell_lat", "cell_lon")


def _cached_elevation(points: DataFrame, cache: DataFrame | None) -> DataFrame:
    """Points with the cached elevation, `cached`; NULL where there is none."""
    require_columns(points, "FIELD_ID", "lat", "lon")
    if cache is None:
        return points.withColumn("cached", F.lit(None).cast("double"))
    one_each = cache.groupBy("FIELD_ID").agg(F.min(number(F.col("ELEVATION"))).alias("cached"))
    return points.join(one_each, "FIELD_ID", "left")


def with_elevation(
    points: DataFrame,
    grid: DataFrame,
    cache: DataFrame | None = None,
    cells_per_degree: int = ELEVATION_CELLS_PER_DEGREE,
) -> DataFrame:
    """Add ELEVATION in feet: the cached value where there is one, else the raster's.

    Only points that the cache lacks are looked up.
    """
    found = _raster_elevation(_cached_elevation(points, cache), grid, cells_per_degree)
    return found.withColumn("ELEVATION", F.coalesce("cached", "fetched")).drop("cached", "fetched")


def elevation_cache_delta(
    points: DataFrame,
    grid: DataFrame,
    cache: DataFrame,
    cells_per_degree: int = ELEVATION_CELLS_PER_DEGREE,
) -> DataFrame:
    """Rows to append to the cache: fields it lacked, with the elevation found for them."""
    missing = _cached_elevation(points, cache).filter("cached IS NULL")
    return (
        _raster_elevation(missing, grid, cells_per_degree)
        .filter("fetched IS NOT NULL")
        .groupBy("FIELD_ID")
        .agg(F.min("fetched").alias("ELEVATION"))
    )


def append_elevations(delta: DataFrame, cache_table: str) -> int:
    """Add the rows of elevation_cache_delta to the cache's table; the first call creates it. Returns their number.

    The rows are worked out from the cache itself, so store them (`stage`) before they are appended to it.
    """
    rows, counted = observed(delta.select("FIELD_ID", "ELEVATION"), "elevations")
    rows.write.mode("append").saveAsTable(cache_table)
    return counted()


def field_master(
    fields: DataFrame,
    boundaries: DataFrame,
    polygons: DataFrame,
    grid: DataFrame,
    cache: DataFrame | None = None,
    *,
    dedup: bool = True,
    states: Sequence[str] | None = STATES_SERVED,
) -> DataFrame:
    """FIELD_ID, field_lat, field_lon, state, field_elev for fields with everything known.

    Elevation is looked up last, for the fields of the wanted states only. With dedup off a field
    appears once per boundary; with states None every state is kept.
    """
    points = boundary_points(boundaries)
    ids = fields.select(F.col("ID").alias("FIELD_ID"))
    if dedup:
        points = first_point_per_field(points).join(ids, "FIELD_ID", "left_semi")
    else:
        points = points.join(ids, "FIELD_ID")
    located = with_state(points.dropna(subset=["FIELD_ID", "lat", "lon"]), polygons)
    located = located.filter(F.col("state").isNotNull() if states is None else F.col("state").isin(*states))
    return (
        with_elevation(located, grid, cache)
        .filter("ELEVATION IS NOT NULL")
        .select(
            "FIELD_ID",
            F.col("lat").alias("field_lat"),
            F.col("lon").alias("field_lon"),
            "state",
            F.col("ELEVATION").alias("field_elev"),
        )
    )
