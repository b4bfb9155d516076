"""Growing degree hours per field, crop and hour, and their daily sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldheat.functions import heat
from fieldheat.schemas import require_columns

GDH_KEY = ["FIELD_ID", "CROP_NAME", "CROP_SEASON", "GDH_DATE"]


def gdh_input(weather: DataFrame, seasons: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Field weather with the season it belongs to and the crop's thresholds.

    A season takes the hours of its own calendar year. Crops without thresholds stay, with NULLs.
    Thresholds are joined to the seasons, not to their hours: crops are few and some are common.
    """
    require_columns(seasons, "FIELD_ID", "CROP_NAME", "CROP_SEASON", "seeding_date", "harvest_date")
    if "CROP_SEASON" in weather.columns:  # kept as a column, since the table may be partitioned by it
        weather = weather.filter(F.col("CROP_SEASON") == F.year("Date"))
    else:
        weather = weather.withColumn("CROP_SEASON", F.year("Date"))
    limits = thresholds.select(F.col("CROP").alias("CROP_NAME"), "Base_Fahrenheit", "Upper_Fahrenheit")
    windows = seasons.select("FIELD_ID", "CROP_SEASON", "CROP_NAME", "seeding_date", "harvest_date").join(
        limits, "CROP_NAME", "left"
    )
    return weather.join(windows, ["FIELD_ID", "CROP_SEASON"]).select(
        "FIELD_ID",
        "CROP_NAME",
        "Base_Fahrenheit",
        "Upper_Fahrenheit",
        "temp_combined_avg",
        "temp_wt_avg",
        "Date",
        "Hour",
        "seeding_date",
        "harvest_date",
        "CROP_SEASON",
    )


def gdh_hourly(data: DataFrame, field: str | None = None, temp_col: str = "temp_combined_avg") -> DataFrame:
    """Degree hours for the hours of each season window, both ends included."""
    require_columns(data, "Date", "Hour", "seeding_date", "harvest_date", temp_col)
    if field is not None:
        data = data.filter(F.col("FIELD_ID") == F.lit(field))
    value = heat.degree_hours(F.col(temp_col), F.col("Base_Fahrenheit"), F.col("Upper_Fahrenheit"))
    return data.filter((F.col("Date") >= F.col("seeding_date")) & (F.col("Date") <= F.col("harvest_date"))).select(
        "FIELD_ID",
        "CROP_NAME",
        "CROP_SEASON",
        F.col("Date").alias("GDH_DATE"),
        "Hour",
        "seeding_date",
        "harvest_date",
        value.alias("gdh"),
    )


def gdh_daily(hourly: DataFrame) -> DataFrame:
    """Degree hours per day and their sum since the season began."""
    require_columns(hourly, *GDH_KEY, "gdh")
    days = hourly.groupBy(*GDH_KEY).agg(F.sum("gdh").alias("gdh_day"), F.count("gdh").alias("hours"))
    so_far = (
        Window.partitionBy("FIELD_ID", "CROP_NAME", "CROP_SEASON")
        .orderBy("GDH_DATE")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return days.withColumn("gdh_to_date", F.sum("gdh_day").over(so_far))
