"""Station readings: which to take, and their layout."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldheat.schemas import number, require_columns


def date_windows(
    df: DataFrame,
    from_col: str = "seeding_date",
    to_col: str = "harvest_date",
    *,
    days: int = 5,
    as_of: date | None = None,
) -> DataFrame:
    """Split each row's date range into consecutive windows (starts, ends) of at most some days.

    A range that ends on as_of ends a day earlier: that day is not over. Empty ranges give no rows.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    require_columns(df, from_col, to_col)
    end = F.col(to_col)
    if as_of is not None:
        end = F.when(end == F.lit(as_of), F.lit(as_of - timedelta(days=1))).otherwise(end)
    ranged = df.withColumn("range_end", end).filter(F.col(from_col) <= F.col("range_end"))
    starts = F.expr(f"sequence(`{from_col}`, range_end, interval {days} days)")
    return (
        ranged.withColumn("starts", F.explode(starts))
        .withColumn("ends", F.least(F.date_add("starts", days - 1), F.col("range_end")))
        .drop("range_end")
    )


def station_season_plan(field_stations: DataFrame) -> DataFrame:
    """One date range per station and season that covers all its fields."""
    return field_stations.groupBy("station_id", "CROP_SEASON").agg(
        F.min("seeding_date").alias("seeding_date"), F.max("harvest_date").alias("harvest_date")
    )


def timeseries_readings(responses: DataFrame) -> DataFrame:
    """Readings from landed time-series responses, each labelled with its own station's id."""
    require_columns(responses, "STATION")
    stations = responses.select(F.explode("STATION").alias("station")).select(
        F.col("station.STID").alias("station_id"),
        F.col("station.OBSERVATIONS.date_time").alias("date_time"),
        F.col("station.OBSERVATIONS.air_temp_set_1").alias("air_temp_set_1"),
    )
    rows = stations.select("station_id", F.inline(F.arrays_zip("date_time", "air_temp_set_1")))
    return with_year(
        rows.select(
            "station_id",
            F.col("date_time").try_cast("timestamp").alias("date_time"),
            number(F.col("air_temp_set_1")).alias("air_temp_set_1"),
        )
    )


def with_year(readings: DataFrame) -> DataFrame:
    return readings.withColumn("year", F.year("date_time"))


def of_years(readings: DataFrame, years: DataFrame) -> DataFrame:
    """Readings of the listed station-years (station_id, year) only.

    The first and last year reach the scan as limits on the year column, by which readings are stored; the rest is a
    semi-join, before anything is computed.
    """
    bounds = years.agg(F.min("year").alias("low"), F.max("year").alias("high"))
    if "year" not in readings.columns:
        readings = with_year(readings)
    limited = readings.filter(
        (F.col("year") >= bounds.select("low").scalar()) & (F.col("year") <= bounds.select("high").scalar())
    )
    return limited.join(years.select("station_id", "year").distinct(), ["station_id", "year"], "left_semi")


def _at_or_after(day: Column) -> Column:
    return F.col("date_time") >= day.cast("timestamp")


def _at_or_before(day: Column) -> Column:
    return F.col("date_time") <= day.cast("timestamp")


def readings_by_plan(readings: DataFrame, plan: DataFrame) -> DataFrame:
    """Readings inside any range of their station, each once.

    Ranges run from midnight to midnight, so of the last day only the midnight reading is inside.
    """
    require_columns(readings, "station_id", "date_time", "year")
    ranges = plan.filter("seeding_date <= harvest_date").select(
        F.col("station_id").alias("planned_id"),
        "seeding_date",
        "harvest_date",
        F.explode(F.sequence(F.year("seeding_date"), F.year("harvest_date"))).alias("planned_year"),
    )
    bounds = ranges.agg(F.min("planned_year").alias("low"), F.max("planned_year").alias("high"))
    inside = (
        (F.col("station_id") == F.col("planned_id"))
        & (F.col("year") == F.col("planned_year"))
        & _at_or_after(F.col("seeding_date"))
        & _at_or_before(F.col("harvest_date"))
    )
    limited = readings.filter(
        (F.col("year") >= bounds.select("low").scalar()) & (F.col("year") <= bounds.select("high").scalar())
    )
    return limited.join(ranges, inside, "left_semi")


def pull_report(plan: DataFrame, chosen: DataFrame) -> DataFrame:
    """Per planned station how many readings came: `n_seasons` asked for, `n_readings`, `n_missing` among them, first and last.

    Stations without readings have zeros. Readings are counted before they are shuffled.
    """
    require_columns(chosen, "station_id", "date_time", "air_temp_set_1")
    asked = plan.groupBy("station_id").agg(F.count_distinct("CROP_SEASON").alias("n_seasons"))
    came = chosen.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.count_if(number(F.col("air_temp_set_1")).isNull()).alias("n_missing"),
        F.min("date_time").alias("first_time"),
        F.max("date_time").alias("last_time"),
    )
    return asked.join(came, "station_id", "left").fillna(0, ["n_readings", "n_missing"])


def readings_all(
    readings: DataFrame,
    field_stations: DataFrame,
    min_date: date | None = None,
    max_date: date | None = None,
) -> DataFrame:
    """Readings of all the fields' stations in one shared range.

    The range defaults to the earliest seeding and the latest harvest. Given dates reach the scan
    as literals. Either way the years of the range limit the year column, by which readings are stored.
    """
    require_columns(readings, "station_id", "date_time", "year")
    stations = field_stations.select("station_id").distinct()
    bounds = field_stations.agg(F.min("seeding_date").alias("low"), F.max("harvest_date").alias("high"))
    low = F.lit(min_date) if min_date is not None else bounds.select("low").scalar()
    high = F.lit(max_date) if max_date is not None else bounds.select("high").scalar()
    limited = readings.filter((F.col("year") >= F.year(low)) & (F.col("year") <= F.year(high)))
    return limited.filter(_at_or_after(low) & _at_or_before(high)).join(stations, "station_id", "left_semi")


def field_readings(field_stations: DataFrame, readings: DataFrame) -> DataFrame:
    """Each field-season's stations with their readings of the season's calendar year."""
    require_columns(field_stations, "station_id", "CROP_SEASON")
    require_columns(readings, "station_id", "date_time", "air_temp_set_1", "year")
    of_season = readings.withColumnRenamed("year", "CROP_SEASON")
    return field_stations.join(of_season, ["station_id", "CROP_SEASON"])
