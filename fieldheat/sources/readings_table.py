"""Readings as a table by year, in buckets by station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.operators.readings import with_year
from fieldheat.schemas import require_columns


def store(readings: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Write readings as a table partitioned by year and bucketed by station, sorted by time within.

    Each task writes one bucket, so a year has one file per bucket. `season_heat` called with the same number of buckets
    then averages readings where they are read: neither readings nor hourly means are shuffled, if the stations' years and
    ranges are small enough to be broadcast or the session sets spark.sql.requireAllClusterKeysForCoPartition to
    false (Spark else deals both sides of a join by all its keys). A station's readings of all
    years share a bucket, so choose at least as many buckets as there are cores, and few enough stations a bucket that one
    station does not matter; where single stations hold a large part of all readings, store them by year alone.
    """
    require_columns(readings, "station_id", "date_time", "air_temp_set_1")
    if "year" not in readings.columns:
        readings = with_year(readings)
    writer = (
        readings.repartition(buckets, F.col("station_id"))
        .write.mode("overwrite")
        .partitionBy("year")
        .bucketBy(buckets, "station_id")
        .sortBy("station_id", "date_time")
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)
