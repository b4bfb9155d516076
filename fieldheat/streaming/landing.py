"""Load newly landed time-series files into the readings table.

The file stream's checkpoint remembers which responses were taken, so each file is loaded once
however often the job is started. Only parsing happens here: the later stages need whole seasons
and stay batch work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from fieldheat.operators.readings import timeseries_readings
from fieldheat.schemas import STATION_TIMESERIES


def stream_timeseries(
    spark: SparkSession, path: str, files_per_batch: int | None = None, lines: bool = False
) -> DataFrame:
    """Readings of a folder of responses, as a stream. With `lines`, responses are one to a line and files are split."""
    reader = spark.readStream.schema(STATION_TIMESERIES).option("multiLine", not lines)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return timeseries_readings(reader.json(path))


def load_landed(
    spark: SparkSession,
    path: str,
    table_path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    lines: bool = False,
) -> StreamingQuery:
    """Append everything landed so far to a Parquet table by year, then stop."""
    return (
        stream_timeseries(spark, path, files_per_batch, lines)
        .writeStream.format("parquet")
        .partitionBy("year")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(table_path)
    )
