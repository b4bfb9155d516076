"""Named queries over the benchmark tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldheat.operators import coverage, degree_hours, fields, hourly, readings, seasons, stations, weather
from fieldheat.plans import changes, season_heat
from fieldheat.plans.testmap import AS_OF, RADIUS_MILES, SINCE, TestTables
from fieldheat.schemas import STATION_METADATA, STATION_TIMESERIES
from fieldheat.session import configure
from fieldheat.sources import gdh_table, landed, readings_table
from fieldheat.sources.staging import remove_at_end, stage, stage_in_buckets, staging_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[["Tables"], DataFrame]) -> Callable[["Tables"], DataFrame]:
    """Register a query under its function's name, with output types any client can compare."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presentable(build(Tables(configure(spark), sf_dir)))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return build


def presentable(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, dates and times as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if field.dataType == T.DoubleType():
            column = F.round(column, 6)
        elif field.dataType == T.DateType():
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Tables(TestTables):
    """The derived tables every later stage starts from."""

    __test__ = False

    def located_fields(self) -> DataFrame:
        return fields.field_master(
            self.fields(), self.boundaries(), self.polygons(), self.elevation_grid(), self.elevation_cache()
        )

    @cached_property
    def field_master(self) -> DataFrame:
        """Staged: it gives the stations' states as well as the fields."""
        return stage(self.located_fields(), "field_master")

    def windows(self) -> DataFrame:
        return seasons.season_windows(self.operations(), self.loaded(), self.thresholds())

    @cached_property
    def stored_windows(self) -> DataFrame:
        """Staged for a table that is written and then partly replaced: both runs take them."""
        return stage(self.windows(), "season_windows")

    def field_seasons(self, master: DataFrame | None = None) -> DataFrame:
        columns = ["FIELD_ID", "CROP_NAME", "CROP_SEASON", "seeding_date", "harvest_date"]
        return seasons.field_seasons(self.field_master if master is None else master, self.windows().select(*columns))

    def stations(self) -> DataFrame:
        return stations.active_stations(self.station_metadata(), self.field_master)

    @cached_property
    def stored_field_seasons(self) -> DataFrame:
        """Staged: they give the places to search from, and then receive the stations."""
        return stage(self.field_seasons(), "field_seasons")

    def nearest(self) -> DataFrame:
        return stations.nearest_stations(self.stored_field_seasons, self.stations(), RADIUS_MILES)

    @cached_property
    def field_stations(self) -> DataFrame:
        """Staged: it plans the readings to take and then receives them."""
        return stage(self.nearest(), "field_stations")

    def plan(self) -> DataFrame:
        return readings.station_season_plan(self.field_stations)

    @cached_property
    def stored_plan(self) -> DataFrame:
        """Station ranges of all field-seasons, staged: whoever asks for some of them needs all ranges."""
        return stage(self.plan(), "station_ranges")

    def planned_readings(self) -> DataFrame:
        return readings.readings_by_plan(self.readings(), self.plan())

    def field_readings(self) -> DataFrame:
        stations_of = self.field_stations
        chosen = readings.readings_by_plan(self.readings(), readings.station_season_plan(stations_of))
        return readings.field_readings(stations_of, chosen)

    def days(self) -> DataFrame:
        return season_heat.field_station_days(self.field_stations, self.readings())

    def hourly(self) -> DataFrame:
        return season_heat.hourly_means(self.days())

    @cached_property
    def stored_hourly(self) -> DataFrame:
        return stage(self.hourly(), "hourly")

    def new_path(self, name: str) -> str:
        return f"{staging_folder(self.spark)}/{name}-{uuid.uuid4().hex}"

    def landed_responses(self, kind: str) -> DataFrame:
        """Responses written as lines of JSON, and read as they landed."""
        path = self.new_path("responses")
        self.responses(kind).write.text(path)
        schema = STATION_METADATA if kind == "metadata" else STATION_TIMESERIES
        return landed.parsed_responses(self.spark, path, schema, lines=True)

    def through_table(self, work: Callable[[str, str], None]) -> DataFrame:
        """What some work leaves in a degree-hour table at a path, which loses its name afterwards.

        Its files are read where they are, not copied; they go with the staged tables.
        """
        name, path = f"gdh_{uuid.uuid4().hex}", self.new_path("gdh_table")
        remove_at_end(self.spark, path)
        try:
            work(name, path)
            return self.spark.read.schema(self.spark.table(name).schema).parquet(path)
        finally:
            gdh_table.drop(self.spark, name)

    def heat_of(
        self, chosen: DataFrame, measured: DataFrame, windows: DataFrame | None = None, **options
    ) -> DataFrame:
        windows = self.windows() if windows is None else windows
        return season_heat.season_degree_hours(chosen, measured, windows, self.thresholds(), **options)

    def landed_windows(self) -> DataFrame:
        """Every third of the five-day windows planned for stations, as requests answered before."""
        windows = readings.date_windows(self.plan(), days=5, as_of=AS_OF)
        return windows.filter("(CAST(substr(station_id, 2) AS INT) + unix_date(starts) div 5) % 3 = 0")

    def missing_ranges(self) -> DataFrame:
        planned = self.stored_plan.selectExpr("station_id", "seeding_date AS starts", "harvest_date AS ends")
        return coverage.uncovered(planned, self.landed_windows())

    def field_weather(self) -> DataFrame:
        """By season as well, as hours are dealt: a season's hours lie in its own calendar year, so a date names the season."""
        by_season = weather.field_weather(season_heat.filled_hours(self.days()), keys=(*hourly.FIELD_SEASON, "Date", "Hour"))
        return by_season.drop("CROP_SEASON")

    def gdh(self) -> DataFrame:
        return season_heat.season_degree_hours(
            self.field_stations, self.readings(), self.windows(), self.thresholds()
        )


@query
def fields_master(t: Tables) -> DataFrame:
    return t.located_fields()


@query
def fields_all(t: Tables) -> DataFrame:
    return fields.field_master(
        t.fields(), t.boundaries(), t.polygons(), t.elevation_grid(), t.elevation_cache(), dedup=False, states=None
    )


@query
def state_of_point(t: Tables) -> DataFrame:
    return fields.with_state(t.points(), t.polygons())


@query
def elevation_fill(t: Tables) -> DataFrame:
    return fields.with_elevation(t.points(), t.elevation_grid(), t.elevation_cache())


@query
def elevation_cache_delta(t: Tables) -> DataFrame:
    return fields.elevation_cache_delta(t.points(), t.elevation_grid(), t.elevation_cache())


@query
def season_windows(t: Tables) -> DataFrame:
    return t.windows()


@query
def season_windows_year(t: Tables) -> DataFrame:
    return seasons.season_windows(
        t.operations(), t.loaded(), t.thresholds(), fallback="year", extra_types=["application"]
    )


@query
def season_windows_strict(t: Tables) -> DataFrame:
    return seasons.season_windows(t.operations(), t.loaded(), t.thresholds(), fallback=None, min_season=2019)


@query
def crops_long(t: Tables) -> DataFrame:
    return seasons.crop_operations(t.operations(), t.thresholds(), 2019, 2024)


@query
def crops_wide(t: Tables) -> DataFrame:
    return seasons.crop_operations(
        t.operations(), t.thresholds(), 2018, 2025, shape="wide", extra_types=["application"]
    )


@query
def crops_wide_seeding_harvest(t: Tables) -> DataFrame:
    return seasons.crop_operations(t.operations(), t.thresholds(), shape="wide", require="seeding_harvest")


@query
def seasons_historic(t: Tables) -> DataFrame:
    return seasons.clean_seasons(t.operations(), "historic", AS_OF)


@query
def seasons_current(t: Tables) -> DataFrame:
    return seasons.clean_seasons(t.operations(), "current", AS_OF)


@query
def seasons_current_actual(t: Tables) -> DataFrame:
    return seasons.clean_seasons(t.operations(), "current", AS_OF, use_actual_harvest=True)


@query
def field_seasons(t: Tables) -> DataFrame:
    return t.field_seasons(t.located_fields())


@query
def active_stations(t: Tables) -> DataFrame:
    return t.stations()


@query
def nearest_stations(t: Tables) -> DataFrame:
    return t.nearest()


@query
def nearest_stations_wide(t: Tables) -> DataFrame:
    """A radius that binds less than k, and the distance rounded to millimetres."""
    found = stations.nearest_stations(t.stored_field_seasons, t.stations(), 20, k=3, with_distance=True)
    return found.withColumn("distance_m", F.round("distance_m", 3))


@query
def nearest_stations_descent(t: Tables) -> DataFrame:
    """The same by the descent through smaller cells that crowded regions get, forced on this table."""
    found = stations.nearest_stations(t.stored_field_seasons, t.stations(), 20, k=3, with_distance=True, levels=3)
    return found.withColumn("distance_m", F.round("distance_m", 3))


@query
def date_windows(t: Tables) -> DataFrame:
    return readings.date_windows(t.plan(), days=5, as_of=AS_OF)


@query
def station_season_plan(t: Tables) -> DataFrame:
    return t.plan()


@query
def timeseries_readings(t: Tables) -> DataFrame:
    return readings.timeseries_readings(t.timeseries())


@query
def timeseries_pages(t: Tables) -> DataFrame:
    """Responses with several readings, uneven arrays and times that cannot be parsed."""
    return readings.timeseries_readings(t.timeseries_pages())


@query
def readings_by_plan(t: Tables) -> DataFrame:
    return t.planned_readings()


@query
def readings_all(t: Tables) -> DataFrame:
    return readings.readings_all(t.readings(), t.field_stations, max_date=AS_OF)


@query
def field_readings(t: Tables) -> DataFrame:
    return t.field_readings()


@query
def hourly_mean(t: Tables) -> DataFrame:
    return t.hourly()


@query
def hourly_mean_of_readings(t: Tables) -> DataFrame:
    """The same from readings already joined to fields, as hourly_mean takes them."""
    return hourly.hourly_mean(t.field_readings())


@query
def hourly_dedup_station(t: Tables) -> DataFrame:
    return hourly.first_field_per_station_hour(t.hourly())


@query
def hourly_grid(t: Tables) -> DataFrame:
    return season_heat.completed_hours(t.days())


@query
def hourly_grid_of_hours(t: Tables) -> DataFrame:
    """The same from a stored table of hourly means, as complete_grid takes it."""
    return hourly.complete_grid(t.stored_hourly)


@query
def hourly_filled(t: Tables) -> DataFrame:
    return season_heat.field_station_hours(t.field_stations, t.readings())


@query
def hourly_filled_time(t: Tables) -> DataFrame:
    return season_heat.field_station_hours(t.field_stations, t.readings(), x="time")


@query
def hourly_filled_rows(t: Tables) -> DataFrame:
    """Gaps filled on the completed grid itself, row by row."""
    return hourly.fill_gaps(hourly.complete_grid(t.stored_hourly))


@query
def hourly_filled_global(t: Tables) -> DataFrame:
    """The days are staged, not their grid: the carried values and the rows that take them both spread them."""
    days = hourly.dealt_for_grid(stage(t.days(), "field_station_days"))
    return hourly.fill_gaps(season_heat.completed_hours(days), scope="global")


@query
def lat_dist(t: Tables) -> DataFrame:
    return weather.lat_dist(t.field_stations).withColumn("lat_dist", F.round("lat_dist", 3))


@query
def lon_dist(t: Tables) -> DataFrame:
    return weather.lon_dist(t.field_stations).withColumn("long_dist", F.round("long_dist", 3))


@query
def total_dist(t: Tables) -> DataFrame:
    return weather.total_dist(t.field_stations).withColumn("total_dist", F.round("total_dist", 3))


@query
def elev_change(t: Tables) -> DataFrame:
    return weather.elev_change(t.field_stations)


@query
def lapse_adjusted(t: Tables) -> DataFrame:
    return weather.lapse_adjusted(t.hourly(), t.field_stations)


@query
def field_weather(t: Tables) -> DataFrame:
    return t.field_weather()


@query
def gdh_input(t: Tables) -> DataFrame:
    return degree_hours.gdh_input(t.field_weather(), t.windows(), t.thresholds())


@query
def gdh_hourly(t: Tables) -> DataFrame:
    return t.gdh()


@query
def gdh_one_field(t: Tables) -> DataFrame:
    """The report for one grower's field: only its own stations' readings are taken, in the ranges of all fields."""
    chosen = t.field_stations.filter("FIELD_ID = '144'")
    return season_heat.season_degree_hours(
        chosen, t.readings(), t.windows().filter("FIELD_ID = '144'"), t.thresholds(), plan=t.stored_plan
    )


@query
def gdh_since(t: Tables) -> DataFrame:
    """The increment: degree hours from one day on."""
    return season_heat.season_degree_hours(
        t.field_stations, t.readings(), t.windows(), t.thresholds(), since=SINCE
    )


@query
def gdh_with_nan(t: Tables) -> DataFrame:
    """Degree hours where every seventh station, and every cold reading, is NaN instead of NULL."""
    broken = F.when(
        (F.col("air_temp_set_1") < 35) | (F.substring("station_id", 2, 9).cast("int") % 7 == 0), F.lit(float("nan"))
    ).otherwise(F.col("air_temp_set_1"))
    readings_with_nan = t.readings().withColumn("air_temp_set_1", broken)
    return season_heat.season_degree_hours(t.field_stations, readings_with_nan, t.windows(), t.thresholds())


@query
def gdh_daily(t: Tables) -> DataFrame:
    return degree_hours.gdh_daily(t.gdh())


@query
def latest_gdh_date(t: Tables) -> DataFrame:
    return gdh_table.latest_date(t.loaded())


@query
def gdh_push_rows(t: Tables) -> DataFrame:
    return gdh_table.rows_to_push(t.gdh())


@query
def gdh_pushed_twice(t: Tables) -> DataFrame:
    """Rows that are left of two pushes of the same degree hours, which lie in buckets as their field-seasons were dealt."""
    pushed = gdh_table.rows_to_push(t.gdh())
    rows = stage_in_buckets(pushed, "pushed", hourly.FIELD_SEASON, hourly.grid_tasks(t.spark), gdh_table.COMPRESSION)
    return gdh_table.distinct_rows(rows.unionByName(rows))


@query
def gdh_dedup(t: Tables) -> DataFrame:
    return gdh_table.distinct_rows(t.loaded())


def _partitioned(rows: DataFrame, table: str, path: str) -> None:
    gdh_table.push(rows, table, partition_by=["CROP_SEASON"], path=path)


@query
def gdh_table_rewritten(t: Tables) -> DataFrame:
    """The table after two pushes of the same degree hours and a removal of duplicates, partition by partition."""

    def work(table: str, path: str) -> None:
        rows = stage(t.gdh(), "heat", gdh_table.COMPRESSION)
        _partitioned(rows, table, path)
        _partitioned(rows, table, path)
        gdh_table.remove_duplicates(t.spark, table)

    return t.through_table(work)


@query
def gdh_after_late_batch(t: Tables) -> DataFrame:
    """The table after a run over the first batch of readings, and replacement of what the second one touches."""
    batches = t.batches()

    def work(table: str, path: str) -> None:
        first = batches.filter("batch = 1").drop("batch")
        _partitioned(t.heat_of(t.field_stations, first, t.stored_windows, plan=t.stored_plan), table, path)
        changed = changes.changed_days(batches, "batch", after=1)
        touched = stage(changes.touched_by_readings(changed, t.field_stations, t.stored_plan), "touched")
        current = changes.current_readings(batches, "batch").drop("batch")
        fresh = changes.recomputed(
            t.field_stations, current, t.stored_windows, t.thresholds(), t.stored_plan, touched
        )
        gdh_table.replace(fresh, table, keys=touched)

    return t.through_table(work)


@query
def touched_field_seasons(t: Tables) -> DataFrame:
    """Field-seasons whose degree hours the second batch of readings can alter."""
    changed = changes.changed_days(t.batches(), "batch", after=1)
    return changes.touched_by_readings(changed, t.field_stations, t.stored_plan)


@query
def gdh_after_new_fields(t: Tables) -> DataFrame:
    """The table after a run without every fourth field, whose stations' ranges then grow as those fields join."""
    old = stage(t.field_stations.filter("CAST(FIELD_ID AS INT) % 4 <> 0"), "earlier_stations")
    old_plan = stage(readings.station_season_plan(old), "earlier_ranges")

    def work(table: str, path: str) -> None:
        _partitioned(t.heat_of(old, t.readings(), t.stored_windows, plan=old_plan), table, path)
        by_plan = changes.touched_by_plan(t.field_stations, t.stored_plan, old_plan)
        by_rows = changes.touched_by_rows(t.field_stations, old, ["station_id", "CROP_NAME", "seeding_date", "harvest_date"])
        touched = stage(by_plan.unionByName(by_rows).distinct(), "touched")
        fresh = changes.recomputed(
            t.field_stations, t.readings(), t.stored_windows, t.thresholds(), t.stored_plan, touched
        )
        gdh_table.replace(fresh, table, keys=touched)

    return t.through_table(work)


@query
def gdh_csv(t: Tables) -> DataFrame:
    """Degree hours written as CSV files and read back."""
    heat, folder = t.gdh(), t.new_path("csv")
    remove_at_end(t.spark, folder)
    path = gdh_table.write_csv(heat, folder, AS_OF, compression="gzip")
    return t.spark.read.schema(heat.schema).option("header", True).csv(path)


@query
def gdh_of_bucketed(t: Tables) -> DataFrame:
    """Daily degree hours of readings stored in buckets by station, which are averaged where they are read."""
    table = f"readings_{uuid.uuid4().hex}"
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        readings_table.store(t.readings(), table, buckets, path=t.new_path("readings"))
        heat = t.heat_of(t.field_stations, t.spark.table(table), buckets=buckets)
        return stage(degree_hours.gdh_daily(heat), "gdh_daily")
    finally:
        t.spark.sql(f"DROP TABLE IF EXISTS {table}")


@query
def landed_metadata(t: Tables) -> DataFrame:
    """Active stations of metadata responses written as JSON, broken ones among them."""
    return stations.active_stations(landed.accepted(t.landed_responses("metadata")))


@query
def landed_timeseries(t: Tables) -> DataFrame:
    """Readings of time-series responses written as JSON, broken ones among them."""
    return readings.timeseries_readings(landed.accepted(t.landed_responses("timeseries")))


@query
def rejected_responses(t: Tables) -> DataFrame:
    """The broken ones, set aside in a table."""
    path, rejects = t.new_path("responses"), t.new_path("rejects")
    t.responses("timeseries").write.text(path)
    landed.set_aside(t.spark, path, STATION_TIMESERIES, rejects, lines=True)
    return t.spark.read.parquet(rejects).groupBy("text", "reason").count()


@query
def missing_ranges(t: Tables) -> DataFrame:
    """Planned days of stations that have not landed yet."""
    return t.missing_ranges()


@query
def request_manifests(t: Tables) -> DataFrame:
    """Requests for them: windows of at most ten days, at most four stations and fourteen characters of ids each."""
    return coverage.request_manifests(coverage.shared_windows(t.missing_ranges(), 10), max_ids=4, max_length=14)


@query
def pull_report(t: Tables) -> DataFrame:
    return readings.pull_report(t.plan(), t.planned_readings())
