"""Weather stations and the nearest ones to each field-season."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldheat.functions import geo
from fieldheat.schemas import number, require_columns
from fieldheat.sources.staging import stage, stage_in_buckets

CELL = ["cell_level", "cell_row", "cell_col"]
PARENT = [f"parent_{name}" for name in CELL]
PLACE = ["field_lat", "field_lon"]
SEARCHED = ["place", *PLACE, "first_seeding", "last_seeding", "widest", "narrowest", "bound_m"]
# Parts of its bound within which a place's stations are counted, falling by a fifth each.
REACHES = [2 ** (-n / 3) for n in range(1, 17)]


def active_stations(metadata: DataFrame, fields: DataFrame | None = None) -> DataFrame:
    """Station master from landed metadata responses.

    Keeps active stations, in the states of the given fields if any are given, and leaves out the
    cooperative network by its short name; stations without a name stay.
    """
    require_columns(metadata, "STATION")
    stations = metadata.select(F.explode("STATION").alias("station")).select("station.*")
    stations = stations.filter(F.coalesce(F.upper("STATUS"), F.lit("ACTIVE")) == "ACTIVE")
    stations = stations.filter(~F.coalesce("SHORTNAME", F.lit("")).contains("COOP"))
    if fields is not None:
        wanted = fields.select(F.col("state").alias("STATE")).distinct()
        stations = stations.join(wanted, "STATE", "left_semi")
    return stations.select(
        "STID",
        number(F.col("ELEVATION")).alias("ELEVATION"),
        number(F.col("LATITUDE")).alias("lat"),
        number(F.col("LONGITUDE")).alias("lon"),
        F.col("PERIOD_OF_RECORD.start").try_cast("date").alias("record_start"),
        F.col("PERIOD_OF_RECORD.end").try_cast("date").alias("record_end"),
    )


# Nearest stations. Fields and stations meet in the cells of a grid as wide as the radius. Where
# stations are dense that would pair every field of a busy cell with every station around it. There
# the search goes down a tree of ever smaller cells instead: from cells with stations to those within
# them, always dropping the cells that lie wholly beyond a distance within which k usable stations
# are known to be. Only the last cells are opened. How deep the tree goes follows, cell by cell, from
# the stations inside. Every step is exact. What is searched for are places, not field-seasons: a bound
# that holds for a place's first seeding date holds for all of them.


def _usable_stations(stations: DataFrame, k: int, dense: bool) -> DataFrame:
    """Located stations; where stations are dense, without those that can never be chosen.

    Of stations in the same place, one is never among the k chosen when k others with smaller ids
    started no later. First only the k smallest ids per place and start date are kept, which Spark
    limits before the shuffle. Then layers are peeled off: a layer holds the stations with a
    smaller id than any earlier start left over by the layers before. A station beyond layer k has
    k such others.
    """
    usable = stations.select(
        F.col("STID").alias("station_id"),
        F.col("ELEVATION").alias("station_elev"),
        F.col("lat").alias("station_lat"),
        F.col("lon").alias("station_lon"),
        "record_start",
    ).dropna(subset=["station_lat", "station_lon", "record_start"])
    if not dense:
        return usable
    alike = Window.partitionBy("station_lat", "station_lon", "record_start").orderBy("station_id")
    usable = usable.withColumn("rank", F.row_number().over(alike)).filter(F.col("rank") <= k).drop("rank")
    earlier = (
        Window.partitionBy("station_lat", "station_lon")
        .orderBy("record_start", "station_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    usable = usable.withColumn("layered", F.lit(False))
    for _ in range(k):
        smallest = F.min(F.when(~F.col("layered"), F.col("station_id"))).over(earlier)
        usable = usable.withColumn("smallest", smallest).withColumn(
            "layered", F.col("layered") | F.col("smallest").isNull() | (F.col("station_id") < F.col("smallest"))
        )
    return usable.filter("layered").drop("layered", "smallest")


def _placed(df: DataFrame, lat: str, lon: str, step: float) -> DataFrame:
    """Add the position on the coarse grid."""
    return (
        df.withColumn("row_at", geo.row_position(F.col(lat), step))
        .withColumn("cells", geo.cells_in_row(geo.whole(F.col("row_at")), step))
        .withColumn("col_at", geo.column_position(F.col(lon), F.col("cells")))
    )


def _with_cell(df: DataFrame, level: int | Column) -> DataFrame:
    """Add the cell of a level from the position on the coarse grid."""
    scale = F.pow(F.lit(2.0), F.lit(level))
    return df.withColumns(
        {
            "cell_level": F.lit(level).cast("int"),
            "cell_row": geo.whole(F.col("row_at") * scale),
            "cell_col": geo.whole(F.col("col_at") * scale),
        }
    )


def _seen_from(stations: DataFrame, step: float) -> DataFrame:
    """List rows with station_lat and station_lon once per coarse cell they can be reached from."""
    col = F.col("own_col")
    around = F.when(F.col("cells_there") == 1, F.array(col)).otherwise(
        F.array(F.pmod(col - 1, F.col("cells_there")), col, F.pmod(col + 1, F.col("cells_there")))
    )
    row = geo.whole(geo.row_position(F.col("station_lat"), step))
    return (
        stations.withColumn("from_row", F.explode(F.array(row - 1, row, row + 1)))
        .withColumn("cells_there", geo.cells_in_row(F.col("from_row"), step))
        .withColumn("own_col", geo.whole(geo.column_position(F.col("station_lon"), F.col("cells_there"))))
        .withColumn("from_col", F.explode(around))
        .drop("cells_there", "own_col")
    )


def _cells_with_stations(stations: DataFrame, k: int, levels: int | None) -> DataFrame:
    """The cells that stations lie in, each with its parent and the bounds of its stations.

    starts lists when the first k of them started, next_level is the level of the cells a crowded one is cut
    into: there its stations reach over two to four cells, so they part, and at most five rows by five columns
    are filled. It is NULL for up to 2 k stations, for a single position, and at the deepest level asked for.
    """
    by_start = Window.partitionBy(*CELL).orderBy("record_start", "station_id")
    first = stations.withColumn("rank", F.row_number().over(by_start)).filter(F.col("rank") <= k)
    starts = first.groupBy(*CELL).agg(F.sort_array(F.collect_list("record_start")).alias("starts"))
    extent = F.greatest(F.max("row_at") - F.min("row_at"), F.max("col_at") - F.min("col_at"))
    cells = stations.groupBy(*CELL, *PARENT).agg(
        F.min("station_lat").alias("south"),
        F.max("station_lat").alias("north"),
        F.min("station_lon").alias("west"),
        F.max("station_lon").alias("east"),
        F.count(F.lit(1)).alias("held"),
        extent.alias("extent"),
    )
    crowded = (F.col("held") > 2 * k) & (F.col("extent") > 0)
    parted = (F.ceil(-F.log2("extent")) + 1).cast("int")
    if levels is not None:
        crowded &= F.col("cell_level") < levels
        parted = F.least(parted, F.lit(levels))
    return (
        cells.withColumn("next_level", F.when(crowded, parted))
        .join(starts, CELL)
        .drop("held", "extent")
    )


def _station_tree(placed: DataFrame, k: int, levels: int | None) -> tuple[list[DataFrame], DataFrame]:
    """The steps down the tree, and the stations with their last cell.

    A step holds, by parent, the cells its stations lie in; cells that were last ones before stand for
    themselves. Only the stations of crowded cells go on, and levels on which a cell's stations do
    not part are passed over. The tree ends because positions are doubles: a cell reaches over
    no more than half of its parent's stations' extent.
    """
    moving = _with_cell(placed, 0)
    moving = moving.withColumns({parent: F.col(name) for parent, name in zip(PARENT, CELL)})
    steps, ended, last = [], [], None
    while True:
        cells = stage(_cells_with_stations(moving, k, levels), "station_cells")
        steps.append(cells if last is None else cells.unionByName(last))
        done = cells.filter("next_level IS NULL").withColumns({p: F.col(name) for p, name in zip(PARENT, CELL)})
        last = done if last is None else last.unionByName(done)
        held = moving.join(cells.select(*CELL, "next_level"), CELL)
        ended.append(held.filter("next_level IS NULL").drop(*PARENT, "next_level"))
        if cells.filter("next_level IS NOT NULL").isEmpty():
            return steps[1:], reduce(DataFrame.unionByName, ended)
        crowded = held.filter("next_level IS NOT NULL").drop(*PARENT).withColumnsRenamed(dict(zip(CELL, PARENT)))
        moving = stage(_with_cell(crowded, F.col("next_level")).drop("next_level"), "crowded_stations")


def _descended(search: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """Replace each place's cells by those of the next step that may hold one of the k nearest, stored.

    A cell's stations are no nearer than their bounds allow, counting longitude as narrow as it gets
    around the place, and no farther, counting it as wide. A cell whose nearest point lies beyond
    bound_m is dropped. The bound falls to the least reach within which whole cells hold k stations that started in time,
    one cell or several together; no station is in two cells. Pairs of places and cells are many more than what is left of them, so they are never shuffled or
    sorted: a first pass adds them up to the bound of each place, a second one keeps those within it. From step to step a
    place's cells stay in its bucket, so neither they nor the bounds are shuffled as long as the cells are broadcast.
    """
    lat = F.col("field_lat")
    lat_near = F.greatest(F.col("south") - lat, lat - F.col("north"), F.lit(0.0))
    lat_far = F.greatest(F.col("north") - lat, lat - F.col("south"))
    half = (F.col("east") - F.col("west")) * 0.5
    lon_apart = geo.degrees_apart(F.col("field_lon"), F.col("west") + half)
    lon_near, lon_far = F.greatest(lon_apart - half, F.lit(0.0)), lon_apart + half
    nearest = geo.shortest_m(lat_near, lon_near, F.col("narrowest")) * (1 - 1e-9)
    enough = geo.longest_m(lat_far, lon_far, F.col("widest")) * (1 + 1e-9)

    def pairs(reached: DataFrame) -> DataFrame:
        return reached.withColumnsRenamed(dict(zip(CELL, PARENT))).join(cells, PARENT).filter(nearest <= F.col("bound_m"))

    in_time = [F.when(F.get("starts", F.lit(n)) < F.col("first_seeding"), 1).otherwise(0) for n in range(k)]
    known = pairs(search).select("place", "bound_m", enough.alias("enough_m"), reduce(Column.__add__, in_time).alias("in_time"))
    known = known.filter("in_time > 0 AND enough_m < bound_m")
    within = [F.sum(F.when(F.col("enough_m") <= F.col("bound_m") * reach, F.col("in_time"))) for reach in REACHES]
    counted = known.groupBy("place").agg(
        F.first("bound_m").alias("reach_m"),
        F.min(F.when(F.col("in_time") >= k, F.col("enough_m"))).alias("one_cell_m"),
        *[held.alias(f"within_{n}") for n, held in enumerate(within)],
    )
    reached = [F.when(F.col(f"within_{n}") >= k, F.col("reach_m") * reach) for n, reach in enumerate(REACHES)]
    bounds = counted.select("place", F.least("one_cell_m", *reached).alias("enough_m"))
    bounded = search.join(bounds, "place", "left").withColumn("bound_m", F.least("bound_m", "enough_m"))
    return _searched(pairs(bounded).select(*SEARCHED, *CELL))


def _searched(search: DataFrame) -> DataFrame:
    """Places with the cells they may look into, stored in buckets by place, as many as Spark deals places to."""
    return stage_in_buckets(search, "searched_cells", ["place"], _tasks(search))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _crowded(stations: DataFrame, step: float, k: int) -> bool:
    """Whether a cell of the coarse grid holds so many stations that the tree is worth its passes."""
    located = _placed(stations.dropna(subset=["lat", "lon", "record_start"]), "lat", "lon", step)
    busiest = _with_cell(located, 0).groupBy(*CELL).count().agg(F.max("count")).first()[0] or 0
    return busiest > 8 * k


def grid_levels(stations: DataFrame, radius_m: float, k: int) -> int:
    """How often the cells of the radius are halved where the stations are densest; 0 where a search needs no tree."""
    step = radius_m / geo.METRES_PER_DEGREE
    if not _crowded(stations, step, k):
        return 0
    usable = _usable_stations(stations, k, dense=True)
    _, held = _station_tree(stage(_placed(usable, "station_lat", "station_lon", step), "placed_stations"), k, None)
    return held.agg(F.max("cell_level")).first()[0]


def nearest_stations(
    field_seasons: DataFrame,
    stations: DataFrame,
    radius_miles: float,
    *,
    k: int = 5,
    levels: int | None = None,
    with_distance: bool = False,
) -> DataFrame:
    """The k nearest stations within the radius whose records start before the seeding date.

    One row per field-season and station, ties by station id; field-seasons without a station
    disappear. Each place is searched once, whatever its field-seasons, and its near stations are listed by
    distance; a field-season takes the first k of them that started in time. Use a stored table of field-seasons:
    it is read for the places and again for what they get. Whether stations crowd
    is found by one count over them; if so, the thinned stations, their tree and the cells that places may
    still look into are staged, which runs a few jobs. With levels given the tree is halved no oftener, 0 being no tree at all.
    """
    require_columns(field_seasons, "FIELD_ID", "field_lat", "field_lon", "seeding_date")
    require_columns(stations, "STID", "ELEVATION", "lat", "lon", "record_start")
    radius_m = radius_miles * geo.METRES_PER_MILE
    step = radius_m / geo.METRES_PER_DEGREE
    dense = _crowded(stations, step, k) if levels is None else levels > 0
    usable = _usable_stations(stations, k, dense)

    field = [name for name in field_seasons.columns if name != "state"]
    rows = field_seasons.select(*field).dropna(subset=["field_lat", "field_lon", "seeding_date"])
    places = rows.groupBy(*PLACE).agg(F.min("seeding_date").alias("first_seeding"), F.max("seeding_date").alias("last_seeding"))
    here = [F.col("cell_row").alias("from_row"), F.col("cell_col").alias("from_col")]
    located = _with_cell(_placed(places, *PLACE, step), 0)
    # Stored, so that a place keeps its number; by numbers, not by coordinates, Spark sees that a place is dealt already.
    number = F.monotonically_increasing_id().alias("place")
    searches = stage(located.select(number, *PLACE, "first_seeding", "last_seeding", *here), "searched_places")
    if not dense:
        pairs = searches.withColumn("bound_m", F.lit(radius_m)).join(_seen_from(usable, step), ["from_row", "from_col"])
    else:
        # How much a degree of longitude shrinks, at most and at least, in the cells around a place.
        away = F.abs("field_lat")
        # Stored: the first cells and the tree read them.
        placed = stage(_placed(usable, "station_lat", "station_lon", step), "placed_stations")
        seen = _seen_from(_with_cell(placed, 0), step).select("from_row", "from_col", *CELL).distinct()
        search = (
            searches.repartition(_tasks(searches), "place")
            .withColumn("widest", F.cos(F.radians(F.greatest(away - 2.1 * step, F.lit(0.0)))))
            .withColumn("narrowest", F.cos(F.radians(F.least(away + 2.1 * step, F.lit(90.0)))))
            .withColumn("bound_m", F.lit(radius_m))
            .join(seen, ["from_row", "from_col"])
            .drop("from_row", "from_col")
        )
        steps, held = _station_tree(placed, k, levels)
        search = _searched(search)
        for cells in steps:
            search = _descended(search, cells, k)
        # Stored, so that their size is known: places meet them in their buckets while they may be broadcast.
        held = stage(held.select(*CELL, "station_id", "station_elev", "station_lat", "station_lon", "record_start"), "held_stations")
        pairs = search.join(held, CELL)

    # Most pairs are ruled out by their differences in latitude and by the bound of their place.
    lat_apart = F.abs(F.col("field_lat") - F.col("station_lat"))
    distance = geo.haversine_m(F.col("field_lat"), F.col("field_lon"), F.col("station_lat"), F.col("station_lon"))
    station = ["station_id", "station_elev", "station_lat", "station_lon"]
    # Of stations that started together only the k nearest can be chosen, and none beyond k that started before
    # all seeding dates of the place, which bounds a place's list.
    together = Window.partitionBy("place", "record_start").orderBy("distance_m", "station_id")
    listed = ["distance_m", *station, "record_start"]
    nearer = Window.partitionBy("place").orderBy(*listed).rowsBetween(Window.unboundedPreceding, -1)
    near = (
        pairs.filter("record_start < last_seeding")
        .filter(lat_apart <= step * (1 + 1e-9))
        .withColumn("distance_m", distance)
        .filter("distance_m <= bound_m")
        .select("place", *PLACE, "first_seeding", *listed)
        .repartition("place")
        .withColumn("rank", F.row_number().over(together))
        .filter(F.col("rank") <= k)
        .withColumn("preferred", F.count_if(F.col("record_start") < F.col("first_seeding")).over(nearer))
        .filter(F.col("preferred") < k)
        .groupBy("place", *PLACE)
        .agg(F.sort_array(F.collect_list(F.struct(*listed))).alias("near"))
    )
    chosen = F.expr(f"slice(filter(near, s -> s.record_start < seeding_date), 1, {k})")
    found = rows.join(near.drop("place").hint("merge"), PLACE).select(*field, F.inline(chosen))
    return found.select(*field, *station, *(["distance_m"] if with_distance else []))
