"""The whole computation in few shuffles: readings and field-seasons to degree hours.

Equal in result to chaining the operators of fieldheat.operators, arranged for large inputs:

* Only readings of station-years that some field-season needs are read.
* Readings are averaged per station and hour once, before they meet fields, with map-side combine.
* A station-day then travels as one row with its (at most 24) hours inside.
* Stations and fields meet per station and year, where a field-season is one row and a station's days are a list
  a month; the fields of a busy station are split into shares.
* After that, one shuffle by field and season serves gap filling, field weather, degree hours and
  daily sums.
* Rows with windows or a day's hours inside are many times larger than the files they come from, by which
  Spark would judge them; a hint to merge keeps such a side from being broadcast.
* Gaps are filled by spreading each known hour over the missing hours that follow it, so the
  completed grid is never built, joined or sorted; only day rows are sorted.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldheat.functions.heat import LAPSE_F_PER_1000_FT, lapse_shift
from fieldheat.operators.degree_hours import gdh_hourly, gdh_input
from fieldheat.operators.hourly import FIELD_SEASON, HOUR_KEY, SERIES, dealt_for_grid
from fieldheat.operators.readings import of_years, station_season_plan
from fieldheat.operators.weather import field_weather
from fieldheat.schemas import number, require_columns

STATION_MONTH = ["station_id", "month"]
STATION_SHARE = ["station_id", "CROP_SEASON", "share"]


def station_days(readings: DataFrame, *, by_station: bool = False) -> DataFrame:
    """One row per station and day, partitioned by station and month, or by station as the readings are.

    Holds the known hourly means in order, a bit per hour that has readings (known or not), and
    the same for the readings at midnight sharp alone. Readings stored in buckets by station are together already:
    then neither they nor their means are shuffled.
    """
    require_columns(readings, "station_id", "date_time", "air_temp_set_1")
    day = F.to_date("date_time")
    at_midnight = F.col("date_time") == day.cast("timestamp")
    temp = number(F.col("air_temp_set_1"))
    hours = readings.groupBy("station_id", day.alias("Date"), F.hour("date_time").alias("Hour")).agg(
        F.avg(temp).alias("temp_avg"),
        F.avg(F.when(at_midnight, temp)).alias("midnight_avg"),
        F.max(at_midnight).alias("has_midnight"),
    )
    known_hour = F.when(F.col("temp_avg").isNotNull(), F.struct("Hour", "temp_avg"))
    hours = hours.withColumn("month", F.trunc("Date", "month"))
    return (
        (hours if by_station else hours.repartition(*STATION_MONTH))
        .groupBy(*STATION_MONTH, "Date")
        .agg(
            F.sort_array(F.collect_list(known_hour)).alias("known"),
            F.bit_or(F.expr("shiftleft(1, Hour)")).alias("hour_bits"),
            F.max("has_midnight").alias("has_midnight"),
            F.max("midnight_avg").alias("midnight_avg"),
        )
    )


def _months_of(windows: str) -> Column:
    """First days of the months that an array of windows (low, high) touches."""
    return F.expr(
        f"array_distinct(flatten(transform({windows}, w -> sequence(trunc(w.low, 'month'), w.high, interval 1 month))))"
    )


def planned_by_month(plan: DataFrame) -> DataFrame:
    """Per station and month the planned ranges (low, high) that touch it.

    A station has one range per season, so the list is short.
    """
    return (
        plan.filter("seeding_date <= harvest_date")
        .select("station_id", F.struct(F.col("seeding_date").alias("low"), F.col("harvest_date").alias("high")).alias("w"))
        .select("station_id", "w", F.explode(_months_of("array(w)")).alias("month"))
        .groupBy(*STATION_MONTH)
        .agg(F.sort_array(F.collect_set("w")).alias("ranges"))
    )


def _open_days(measured: DataFrame, ranges: DataFrame) -> DataFrame:
    """Station-days inside any range planned for their station, from midnight to midnight.

    Of a range's last day only midnight is inside, unless another range covers that day.
    """
    whole_day = F.expr("exists(ranges, w -> Date >= w.low AND Date < w.high)")
    last_day = F.expr("exists(ranges, w -> Date = w.high)")
    midnight = F.when(
        F.col("midnight_avg").isNotNull(),
        F.array(F.struct(F.lit(0).alias("Hour"), F.col("midnight_avg").alias("temp_avg"))),
    ).otherwise(F.expr("filter(known, h -> false)"))
    return (
        measured.join(ranges, STATION_MONTH)
        .withColumn("whole_day", whole_day)
        .filter(F.col("whole_day") | (last_day & F.col("has_midnight")))
        .select(
            *STATION_MONTH,
            "Date",
            F.when(F.col("whole_day"), F.col("known")).otherwise(midnight).alias("known"),
            F.when(F.col("whole_day"), F.col("hour_bits")).otherwise(F.lit(1)).alias("hour_bits"),
        )
    )


def season_parts(field_stations: DataFrame) -> DataFrame:
    """Each row's dates as a window cut to its season's calendar year; rows without any day there are left out."""
    window = F.struct(
        F.greatest("seeding_date", F.make_date("CROP_SEASON", F.lit(1), F.lit(1))).alias("low"),
        F.least("harvest_date", F.make_date("CROP_SEASON", F.lit(12), F.lit(31))).alias("high"),
    )
    return (
        field_stations.filter("CROP_SEASON IS NOT NULL AND seeding_date IS NOT NULL AND harvest_date IS NOT NULL")
        .withColumn("window", window)
        .filter("window.low <= window.high")
    )


def _fields_by_station(field_stations: DataFrame, busy: DataFrame, rate: float) -> DataFrame:
    """Each field-season and station once with its windows, dealt by station, season and share.

    The crops of a field-season share its weather, so their windows are listed together (one entry
    per crop).
    """
    own_share = F.pmod(F.xxhash64("FIELD_ID"), F.coalesce("shares", F.lit(1))).cast("int")
    return (
        season_parts(field_stations)
        .select(*SERIES, "window", (F.col("field_elev") - F.col("station_elev")).alias("rise"))
        .join(busy, "station_id", "left")
        .withColumn("share", own_share)
        .repartition(*STATION_SHARE)
        .groupBy(*SERIES, "share")
        .agg(F.collect_set("window").alias("windows"), lapse_shift(F.min("rise"), rate).alias("adjusted_wt"))
    )


def _station_years(field_stations: DataFrame) -> DataFrame:
    """The years in which stations serve a field-season: a season takes readings of its own calendar year."""
    return field_stations.filter("seeding_date <= harvest_date").select("station_id", F.col("CROP_SEASON").alias("year"))


def _busy_stations(field_stations: DataFrame, tasks: int) -> DataFrame:
    """Stations that serve more field-seasons than one task's part of all of them, and their number of shares.

    There are fewer of them than shuffle tasks, so the table may be broadcast.
    """
    served = field_stations.groupBy("station_id").count()
    total = field_stations.agg(F.count(F.lit(1))).scalar()
    busy = served.filter(F.col("count") * tasks > total)
    return busy.select("station_id", F.ceil(F.col("count") * tasks / total).cast("int").alias("shares"))


def field_station_days(
    field_stations: DataFrame,
    readings: DataFrame,
    rate: float = LAPSE_F_PER_1000_FT,
    *,
    plan: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Days of each field-season's stations with their hours, partitioned by field and season.

    `plan` holds the ranges planned for stations (`station_season_plan`), of all field-seasons even if only some are asked
    for here: fields share stations, and a day that one field's range only touches may lie inside another's. Without
    a plan the given field-seasons are all there are.

    The days of a busy station are repeated for as many shares of its fields as it fills shuffle tasks, so that
    no task meets all fields of one. Use a stored field_stations: it is read several times. `buckets` is the number of
    buckets that readings are stored in by station, if they are (`readings_table.store`); what meets them is dealt
    into as many.
    """
    if plan is None:
        plan = station_season_plan(field_stations)
    else:
        plan = plan.join(field_stations.select("station_id").distinct(), "station_id", "left_semi")
    tasks = int(field_stations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    busy = F.broadcast(_busy_stations(field_stations, tasks))
    share_list = F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1)
    years, ranges = _station_years(field_stations), planned_by_month(plan)
    if buckets:
        years, ranges = years.distinct().repartition(buckets, "station_id"), ranges.repartition(buckets, "station_id")
    needed = of_years(readings, years)
    # Dealt by share before they are listed, so that no task lists all shares of a busy station.
    listed = (
        _open_days(station_days(needed, by_station=buckets is not None), ranges)
        .join(busy, "station_id", "left")
        .withColumn("share", F.explode(share_list))
        .repartition(*STATION_MONTH, "share")
        .groupBy(*STATION_MONTH, "share")
        .agg(F.collect_list(F.struct("Date", "known", "hour_bits")).alias("days"))
        .select("station_id", F.year("month").alias("CROP_SEASON"), "share", "days")
    )
    in_window = F.expr("filter(days, d -> exists(windows, w -> d.Date BETWEEN w.low AND w.high))")
    return dealt_for_grid(
        _fields_by_station(field_stations, busy, rate)
        .join(listed.hint("merge"), STATION_SHARE)
        .select(*SERIES, "adjusted_wt", F.inline(in_window))
    )


def hourly_means(days: DataFrame) -> DataFrame:
    """Hours seen, one row each, from field_station_days; same result as hourly_mean.

    Stays partitioned by field and season, which grid completion and gap filling can use as it is.
    """
    seen = F.explode(F.expr("filter(sequence(0, 23), h -> (hour_bits & shiftleft(1, h)) <> 0)"))
    return (
        days.withColumn("by_hour", F.map_from_entries("known"))
        .withColumn("Hour", seen)
        .select(*HOUR_KEY, F.expr("try_element_at(by_hour, Hour)").alias("temp_avg"))
    )


# Days of a season as bits of six longs, by their number in the year; a season's days lie in its own calendar year.
# The sign bit stays free, since one is subtracted from single bits.
DAY_WORDS, WORD_BITS = 6, 62


def _day_word(n: int) -> str:
    """The bits of one row's day in the n-th long."""
    at = "(dayofyear(Date) - 1)"
    return f"if({at} div {WORD_BITS} = {n}, shiftleft(1L, {at} % {WORD_BITS}), 0L)"


def _days_before(day: str) -> str:
    """How many of the season's days lie before a date."""
    at = f"(dayofyear({day}) - 1)"
    counts = [
        f"CASE WHEN {at} div {WORD_BITS} > {n} THEN bit_count(days_{n})"
        f" WHEN {at} div {WORD_BITS} = {n} THEN bit_count(days_{n} & (shiftleft(1L, {at} % {WORD_BITS}) - 1L)) ELSE 0 END"
        for n in range(DAY_WORDS)
    ]
    return "(" + " + ".join(counts) + ")"


def _spread(days: DataFrame) -> DataFrame:
    """Rows of the completed grid from field_station_days, each with the known hours around it.

    A grid position p is the rank of the day among the field-season's days times the number of
    hours seen, plus the rank of the hour. Each known hour (position at, value v0, time t0) is
    spread from its position to just before the next known one (next_at, v1, t1); the first of a
    series also covers what lies before it. A series without any known hour is carried by its first
    day.

    One sort by series and date serves all windows. The days of a field-season are a bitmap, from which ranks are
    counted; only rows spread beyond their own day list days, those that they are spread over.
    """
    by_day = "OVER (PARTITION BY FIELD_ID, CROP_SEASON, station_id ORDER BY Date{})"
    in_season = "OVER (PARTITION BY FIELD_ID, CROP_SEASON)"
    rank_of = "bit_count(season_bits & (shiftleft(1, {0}) - 1))"
    first_known = F.expr(
        "if(size(known) > 0, struct(Date, get(known, 0).Hour AS Hour, get(known, 0).temp_avg AS temp_avg), NULL)"
    )
    words = [f"days_{n}" for n in range(DAY_WORDS)]
    along = (
        days.withColumn("first_known", first_known)
        .withColumn("later", F.expr(f"lead(first_known) IGNORE NULLS {by_day.format('')}"))
        .withColumn("days_before", F.expr(f"row_number() {by_day.format('')} - 1"))
        .withColumn("known_days", F.expr(f"count(first_known) {by_day.format(' ROWS UNBOUNDED PRECEDING')}"))
        .withColumns({word: F.expr(_day_word(n)) for n, word in enumerate(words)})
    )
    placed = (
        along.withColumns(
            {word: F.expr(f"bit_or({word}) {in_season}") for word in words}
            | {"season_bits": F.expr(f"bit_or(hour_bits) {in_season}")}
        )
        .filter("size(known) > 0 OR (days_before = 0 AND later IS NULL)")
        .withColumn("per_day", F.expr("bit_count(season_bits)"))
        .withColumn("hours_seen", F.expr("filter(sequence(0, 23), h -> (season_bits & shiftleft(1, h)) <> 0)"))
        .withColumn("day_no", F.expr(_days_before("Date")))
        .withColumn("day_at", F.expr("day_no * per_day"))
        .withColumn("later_at", F.expr(_days_before("later.Date") + " * per_day + " + rank_of.format("later.Hour")))
        .withColumn("later_at", F.expr("if(later IS NULL, NULL, later_at)"))
        .withColumn("grid_size", F.expr("(" + " + ".join(f"bit_count({word})" for word in words) + ") * per_day"))
        .withColumn("first_day", F.expr("known_days <= 1"))
    )
    # The season's days from the first to the last one that a row is spread over, if that is more than its own day.
    word_of = f"CASE d div {WORD_BITS} " + " ".join(f"WHEN {n} THEN {word}" for n, word in enumerate(words)) + " END"
    from_day = "if(first_day, 0, dayofyear(Date) - 1)"
    to_day = f"coalesce(dayofyear(later.Date), {WORD_BITS * DAY_WORDS}) - 1"
    covered = f"filter(sequence({from_day}, {to_day}), d -> ({word_of}) & shiftleft(1L, d % {WORD_BITS}) <> 0)"
    beyond = "(first_day AND day_no > 0) OR coalesce(later_at, grid_size) > day_at + per_day"
    # Hours of the day with the next known hour, which may lie on a later day.
    hours = placed.withColumn("covered_days", F.expr(f"if({beyond}, {covered}, NULL)")).select(
        *SERIES,
        "adjusted_wt",
        "covered_days",
        F.expr("if(first_day, 0, day_no)").alias("covered_from"),
        "hours_seen",
        "per_day",
        "grid_size",
        "first_day",
        "Date",
        "day_no",
        "day_at",
        "season_bits",
        "known",
        "later",
        "later_at",
        F.expr("posexplode(if(size(known) > 0, known, array(CAST(NULL AS STRUCT<Hour: INT, temp_avg: DOUBLE>))))").alias(
            "i", "hour"
        ),
    )
    following = F.expr("i + 1 < size(known)")
    spread = (
        hours.withColumn("v0", F.col("hour.temp_avg"))
        .withColumn("at", F.expr("day_at + " + rank_of.format("hour.Hour")))
        .withColumn("after", F.expr("get(known, i + 1)"))
        .withColumn("v1", F.when(following, F.col("after.temp_avg")).otherwise(F.col("later.temp_avg")))
        .withColumn(
            "next_at",
            F.when(following, F.expr("day_at + " + rank_of.format("after.Hour"))).otherwise(F.col("later_at")),
        )
        .withColumn("t0", F.expr("unix_date(Date) * 24 + hour.Hour"))
        .withColumn(
            "t1",
            F.when(following, F.expr("unix_date(Date) * 24 + after.Hour")).otherwise(
                F.expr("unix_date(later.Date) * 24 + later.Hour")
            ),
        )
        .withColumn("from_at", F.expr("if(v0 IS NULL OR (first_day AND i = 0), 0, at)"))
        .withColumn("p", F.explode(F.expr("sequence(from_at, coalesce(next_at, grid_size) - 1)")))
    )
    other_day = "date_add(make_date(CROP_SEASON, 1, 1), get(covered_days, p div per_day - covered_from))"
    return spread.withColumn("Date", F.expr(f"if(p div per_day = day_no, Date, {other_day})")).withColumn(
        "Hour", F.expr("hours_seen[p % per_day]")
    )


def completed_hours(days: DataFrame) -> DataFrame:
    """The completed grid with NULL gaps; same result as complete_grid of hourly_means."""
    known = F.when(F.col("p") == F.col("at"), F.col("v0"))
    return _spread(days).select(*HOUR_KEY, known.alias("temp_avg"))


def filled_hours(days: DataFrame, *, x: str = "position") -> DataFrame:
    """Completed and gap-filled hours, with wt_temp; same result as complete_grid and fill_gaps."""
    if x not in ("position", "time"):
        raise ValueError(f"unknown x {x!r}")
    share = "(p - at) / (next_at - at)" if x == "position" else "(unix_date(Date) * 24 + Hour - t0) / (t1 - t0)"
    between = F.expr("v0 + (v1 - v0) * " + share)
    filled = F.when(F.col("p") == F.col("at"), F.col("v0")).when(F.col("p") > F.col("at"), between)
    hours = _spread(days).select(*SERIES, "adjusted_wt", "Date", "Hour", filled.alias("temp_avg"))
    return hours.withColumn("wt_temp", F.col("temp_avg") + F.col("adjusted_wt"))


def field_station_hours(field_stations: DataFrame, readings: DataFrame, *, x: str = "position") -> DataFrame:
    """Gap-filled hourly temperatures per field-season and station, straight from readings."""
    return filled_hours(field_station_days(field_stations, readings), x=x).select(*HOUR_KEY, "temp_avg")


def season_degree_hours(
    field_stations: DataFrame,
    readings: DataFrame,
    seasons: DataFrame,
    thresholds: DataFrame,
    *,
    plan: DataFrame | None = None,
    x: str = "position",
    rate: float = LAPSE_F_PER_1000_FT,
    temp_col: str = "temp_combined_avg",
    since: date | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Degree hours per field, crop and hour, from the chosen stations and their readings.

    Given only some field-seasons, the rows are those of the full run if `plan` holds the station ranges of all of them
    (see field_station_days).

    With `since`, the rows of the full result from that day on. Gaps are filled along whole seasons, so the
    field-seasons that are open that day or later are computed from all their readings; those of other
    station-years are not read. Ranges of closed seasons still count, since one may end in the year after.
    """
    if since is not None:
        plan = station_season_plan(field_stations) if plan is None else plan
        field_stations = open_field_seasons(field_stations, since)
    adjusted = filled_hours(field_station_days(field_stations, readings, rate, plan=plan, buckets=buckets), x=x)
    weather = field_weather(adjusted, keys=(*FIELD_SEASON, "Date", "Hour"))
    if since is not None:
        weather = weather.filter(F.col("Date") >= F.lit(since))
    return gdh_hourly(gdh_input(weather, seasons, thresholds), temp_col=temp_col)


def open_field_seasons(field_stations: DataFrame, since: date) -> DataFrame:
    """All rows of the field-seasons of which some crop's window reaches a day or goes beyond it."""
    last = F.least("harvest_date", F.make_date("CROP_SEASON", F.lit(12), F.lit(31)))
    still_open = field_stations.filter(last >= F.lit(since)).select(*FIELD_SEASON).distinct()
    return field_stations.join(still_open, FIELD_SEASON, "left_semi")
