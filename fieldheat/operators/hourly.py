"""Hourly station temperatures per field-season: means, grid completion, gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldheat.functions.rows import in_ranges
from fieldheat.schemas import number, require_columns
from fieldheat.sources.staging import stage

FIELD_SEASON = ["FIELD_ID", "CROP_SEASON"]
SERIES = [*FIELD_SEASON, "station_id"]
HOUR_KEY = [*SERIES, "Date", "Hour"]
GRID_SHARES = 4  # a grid is many times as large as what it is made of, which is dealt to so many times the usual tasks


def hourly_mean(field_readings: DataFrame) -> DataFrame:
    """Mean temperature per field-season, station and hour, over the days of the season window.

    An hour whose readings are all missing stays, with a NULL mean. Crops grown in the same
    field-season share one series.
    """
    require_columns(field_readings, *SERIES, "date_time", "air_temp_set_1", "seeding_date", "harvest_date")
    day = F.to_date("date_time")
    return (
        field_readings.filter((day >= F.col("seeding_date")) & (day <= F.col("harvest_date")))
        .groupBy(*SERIES, day.alias("Date"), F.hour("date_time").alias("Hour"))
        .agg(F.avg(number(F.col("air_temp_set_1"))).alias("temp_avg"))
    )


def first_field_per_station_hour(hourly: DataFrame) -> DataFrame:
    """Keep each station-hour for its first field-season only (compatibility)."""
    first = Window.partitionBy("station_id", "Date", "Hour").orderBy(*FIELD_SEASON)
    return hourly.withColumn("rank", F.row_number().over(first)).filter("rank = 1").drop("rank")


def grid_tasks(spark: SparkSession) -> int:
    return GRID_SHARES * int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt_for_grid(df: DataFrame) -> DataFrame:
    """Rows dealt by field and season, to more tasks than usual, so that the grid made of them needs no dealing."""
    return df.repartition(grid_tasks(df.sparkSession), *FIELD_SEASON)


def complete_grid(hourly: DataFrame) -> DataFrame:
    """Every combination of the stations, dates and hours seen in a field-season.

    Added rows have a NULL temperature. The three sets are small by nature (the stations of one
    field, the days of one season, 24 hours). Use a stored table: it is read twice. The grid is never shuffled: the hours
    seen are dealt once, each series lists its days with their hours, and its rows follow in order. So filling gaps finds
    series together and nearly sorted. From readings, fieldheat.plans.season_heat gets the same grid in one pass.
    """
    dealt = dealt_for_grid(hourly.select(*HOUR_KEY, "temp_avg"))
    seen = dealt.groupBy(*FIELD_SEASON).agg(
        F.collect_set("station_id").alias("stations"),
        F.collect_set("Date").alias("dates"),
        F.collect_set("Hour").alias("hours"),
    )
    # Joined by field and season alone, as both are dealt. Rows with a NULL key only add to what is seen.
    kept = F.when(F.col("Hour").isNotNull(), F.struct("Hour", "temp_avg"))
    days = dealt.filter("station_id IS NOT NULL").groupBy(*SERIES, "Date").agg(F.collect_list(kept).alias("own"))
    listed = F.when(F.col("Date").isNotNull(), F.struct("Date", "own"))
    series = days.groupBy(*SERIES).agg(F.collect_list(listed).alias("days"))
    nameless = "FIELD_ID IS NULL OR CROP_SEASON IS NULL"
    value = dealt.schema["temp_avg"].dataType.simpleString()
    no_hours = f"CAST(array() AS ARRAY<STRUCT<Hour: {dealt.schema['Hour'].dataType.simpleString()}, temp_avg: {value}>>)"
    other_days = f"transform(array_except(dates, days.Date), d -> named_struct('Date', d, 'own', {no_hours}))"
    all_days = f"transform(dates, d -> named_struct('Date', d, 'own', {no_hours}))"
    unknown = f"h -> named_struct('Hour', h, 'temp_avg', CAST(NULL AS {value}))"
    other_hours = f"transform(array_except(hours, own.Hour), {unknown})"
    # Most days of a series have no rows of their own, so what they get is listed once.
    of_day = f"if(size(own) = 0, no_own, sort_array(concat(own, {other_hours})))"
    # An hour that is there twice stays twice. A day's rows are listed before they are unfolded: Spark does not compile
    # the unfolding of an expression with a lambda, and would evaluate that of a bare column twice.
    return (
        seen.withColumn("no_own", F.expr(f"sort_array(transform(hours, {unknown}))"))
        .join(series, FIELD_SEASON, "left")
        .withColumn("station_id", F.explode(F.expr(f"if({nameless}, stations, array_compact(array(station_id)))")))
        .select(
            *SERIES,
            "hours",
            "no_own",
            F.expr(f"inline(sort_array(if({nameless}, {all_days}, concat(days, {other_days}))))"),
        )
        .select(*SERIES, "Date", F.expr(of_day).alias("of_day"))
        .select(*SERIES, "Date", F.expr("inline(if(size(of_day) > 0, of_day, NULL))"))
    )


def _hours_since_epoch(day: str, hour: str) -> Column:
    return F.unix_date(F.col(day)) * 24 + F.col(hour)


def _between(position: str, x0: str, v0: str, x1: str, v1: str) -> Column:
    """Linear interpolation; NULL when either neighbour is."""
    return F.col(v0) + (F.col(v1) - F.col(v0)) * (F.col(position) - F.col(x0)) / (F.col(x1) - F.col(x0))


def _next_known(value: str, partition: list[str], order: list[str]) -> Column:
    """Next non-NULL value after the row; one linear pass over the sorted partition."""
    return F.expr(
        f"lead({value}) IGNORE NULLS OVER (PARTITION BY {', '.join(partition)} ORDER BY {', '.join(order)})"
    )


def fill_gaps(grid: DataFrame, *, x: str = "position", scope: str = "series", buckets: int | None = None) -> DataFrame:
    """Fill missing hours of a completed grid linearly between the known hours around them.

    Distance is counted in rows ("position") or hours ("time"). Within "series", hours before the
    first or after the last known one stay NULL. Scope "global" (compatibility) treats the whole
    table, sorted by field, season, station, date and hour, as one column; its series are summed up in so many
    ranges, by default as many as there are shuffle tasks. A grid that is dealt already (`dealt_for_grid`) is not shuffled.
    """
    if x not in ("position", "time") or scope not in ("series", "global"):
        raise ValueError(f"unknown x {x!r} or scope {scope!r}")
    if scope == "global" and x != "position":
        raise ValueError("scope 'global' counts in positions")
    # Rows are counted along a task's rows once they are in order, so that one window sees them, and it carries plain
    # numbers: only distances between the rows of a series matter.
    dealt = dealt_for_grid(grid.select(*HOUR_KEY, "temp_avg"))
    if x == "position":
        placed = dealt.sortWithinPartitions(*SERIES, "Date", "Hour").withColumn("at", F.monotonically_increasing_id())
    else:
        placed = dealt.withColumn("at", _hours_since_epoch("Date", "Hour"))
    placed = placed.withColumn("known_at", F.when(F.col("temp_avg").isNotNull(), F.col("at")))
    order = ["Date", "Hour"]
    so_far = Window.partitionBy(*SERIES).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    neighbours = {
        "x0": F.last("known_at", ignorenulls=True).over(so_far),
        "v0": F.last("temp_avg", ignorenulls=True).over(so_far),
        "x1": _next_known("known_at", SERIES, order),
        "v1": _next_known("temp_avg", SERIES, order),
    }
    if scope == "global":
        neighbours["start"] = F.first("at").over(so_far)
    around = placed.withColumns(neighbours)
    if scope == "global":
        around = _reach_across_series(around, placed, buckets)
    return around.select(
        *HOUR_KEY, F.coalesce("temp_avg", _between("at", "x0", "v0", "x1", "v1")).alias("temp_avg")
    )


def _moved(known: str, by: Column) -> Column:
    """A known value with its position counted from elsewhere."""
    at = (F.col(f"{known}.at") + by).alias("at")
    return F.when(F.col(known).isNotNull(), F.struct(at, F.col(f"{known}.temp_avg").alias("temp_avg")))


def _reach_across_series(around: DataFrame, placed: DataFrame, buckets: int | None) -> DataFrame:
    """Give the open ends of each series the nearest known value of the series before and after.

    A prefix scan: series are reduced to a summary row each, and these are dealt into key ranges. Within a range
    windows carry known values along; across ranges the same is done over one row per range, and what they carry is
    joined back by range. No task sees more than one range of summaries, or one row per range. Summaries are stored, since
    finding bounds for the ranges would read the whole grid once more.
    """
    summary = placed.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("at").alias("start"),
        F.min("known_at").alias("first_at"),
        F.min_by("temp_avg", "known_at").alias("first_temp"),
        F.max("known_at").alias("last_at"),
        F.max_by("temp_avg", "known_at").alias("last_temp"),
    )
    # Known values with their position in the series, from 0.
    summary = summary.select(
        *SERIES,
        "rows",
        *[
            F.when(
                F.col(f"{end}_at").isNotNull(),
                F.struct((F.col(f"{end}_at") - F.col("start")).alias("at"), F.col(f"{end}_temp").alias("temp_avg")),
            ).alias(f"{end}_known")
            for end in ("first", "last")
        ],
    )
    ranged = in_ranges(stage(summary, "series_summaries"), SERIES, "series", buckets)

    # Positions counted in the range.
    earlier = Window.partitionBy("bucket").orderBy(*SERIES).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    own = ranged.withColumn("offset", offset).withColumns(
        {"first_known": _moved("first_known", F.col("offset")), "last_known": _moved("last_known", F.col("offset"))}
    )
    own = own.withColumn("previous", F.last("last_known", ignorenulls=True).over(earlier)).withColumn(
        "following", _next_known("first_known", ["bucket"], SERIES)
    )

    # Positions counted in the whole column, from one row per range.
    before = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        own.groupBy("bucket")
        .agg(F.sum("rows").alias("rows"), F.min("first_known").alias("first"), F.max("last_known").alias("last"))
        .withColumn("base", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .withColumns({"first": _moved("first", F.col("base")), "last": _moved("last", F.col("base"))})
        .select(
            "bucket",
            "base",
            F.last("last", ignorenulls=True).over(before).alias("range_before"),
            F.expr("lead(first) IGNORE NULLS OVER (PARTITION BY 0 ORDER BY bucket)").alias("range_after"),
        )
    )

    # Positions counted from the start of the series that takes the values.
    carried = (
        own.join(totals, "bucket")
        .withColumn("previous", F.coalesce(_moved("previous", F.col("base")), "range_before"))
        .withColumn("following", F.coalesce(_moved("following", F.col("base")), "range_after"))
        .withColumn("start", -F.col("base") - F.col("offset"))
        .select(
            *SERIES, _moved("previous", F.col("start")).alias("previous"), _moved("following", F.col("start")).alias("following")
        )
    )
    # Joined by field and season alone, as the grid is dealt; a field-season has few series.
    by_station = F.map_from_entries(F.collect_list(F.struct("station_id", F.struct("previous", "following"))))
    carried = dealt_for_grid(carried.filter("station_id IS NOT NULL")).groupBy(*FIELD_SEASON).agg(by_station.alias("carried"))
    return (
        around.filter("station_id IS NOT NULL")
        .join(carried, FIELD_SEASON)
        .withColumn("reached", F.expr("try_element_at(carried, station_id)"))
        .withColumns(
            {
                "x0": F.coalesce("x0", F.col("start") + F.col("reached.previous.at")),
                "v0": F.coalesce("v0", "reached.previous.temp_avg"),
                "x1": F.coalesce("x1", F.col("start") + F.col("reached.following.at")),
                "v1": F.coalesce("v1", "reached.following.temp_avg"),
            }
        )
    )


def hourly_temperatures(
    field_readings: DataFrame, *, x: str = "position", scope: str = "series", dedup: str = "field"
) -> DataFrame:
    """Hourly means, completed to the grid and gap-filled, from readings joined to field-seasons.

    The means are staged, since the grid reads them twice.
    """
    if dedup not in ("field", "station"):
        raise ValueError(f"unknown dedup {dedup!r}")
    hourly = hourly_mean(field_readings)
    if dedup == "station":
        hourly = first_field_per_station_hour(hourly)
    return fill_gaps(complete_grid(stage(hourly, "hourly")), x=x, scope=scope)
