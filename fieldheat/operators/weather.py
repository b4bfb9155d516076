"""Pairs of field and station, and the weather of a field per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldheat.functions.geo import haversine_m
from fieldheat.functions.heat import LAPSE_F_PER_1000_FT, lapse_shift
from fieldheat.schemas import require_columns

PAIR = ["FIELD_ID", "station_id"]


def _per_pair(data: DataFrame, name: str, value: Column) -> DataFrame:
    return data.select(*PAIR, value.alias(name)).distinct()


def lat_dist(data: DataFrame) -> DataFrame:
    """Metres between the parallels of field and station."""
    zero = F.lit(0.0)
    return _per_pair(data, "lat_dist", haversine_m(F.col("field_lat"), zero, F.col("station_lat"), zero))


def lon_dist(data: DataFrame) -> DataFrame:
    """Metres between the meridians of field and station, measured at the equator."""
    zero = F.lit(0.0)
    return _per_pair(data, "long_dist", haversine_m(zero, F.col("field_lon"), zero, F.col("station_lon")))


def total_dist(data: DataFrame) -> DataFrame:
    """Great-circle metres between field and station."""
    metres = haversine_m(F.col("field_lat"), F.col("field_lon"), F.col("station_lat"), F.col("station_lon"))
    return _per_pair(data, "total_dist", metres)


def elev_change(data: DataFrame) -> DataFrame:
    """Feet by which the field lies above the station."""
    require_columns(data, *PAIR, "field_elev", "station_elev")
    return _per_pair(data, "elev_dif", F.col("field_elev") - F.col("station_elev"))


def pair_shift(field_stations: DataFrame, rate: float = LAPSE_F_PER_1000_FT) -> DataFrame:
    """One elevation correction per field and station."""
    require_columns(field_stations, *PAIR, "field_elev", "station_elev")
    elev_dif = F.min(F.col("field_elev") - F.col("station_elev"))
    return field_stations.groupBy(*PAIR).agg(lapse_shift(elev_dif, rate).alias("adjusted_wt"))


def lapse_adjusted(hourly: DataFrame, field_stations: DataFrame, rate: float = LAPSE_F_PER_1000_FT) -> DataFrame:
    """Hourly station temperatures with wt_temp, the value expected at the field's elevation."""
    return (
        hourly.join(pair_shift(field_stations, rate), PAIR, "left")
        .withColumn("wt_temp", F.col("temp_avg") + F.col("adjusted_wt"))
        .drop("adjusted_wt")
    )


def field_weather(adjusted: DataFrame, keys: tuple[str, ...] = ("FIELD_ID", "Date", "Hour")) -> DataFrame:
    """Lowest, highest and mean station temperature per field and hour; a plain mean, not by distance."""
    require_columns(adjusted, *keys, "temp_avg", "wt_temp")
    return adjusted.groupBy(*keys).agg(
        F.min("temp_avg").alias("temp_min"),
        F.max("temp_avg").alias("temp_max"),
        F.avg("temp_avg").alias("temp_combined_avg"),
        F.avg("wt_temp").alias("temp_wt_avg"),
    )
