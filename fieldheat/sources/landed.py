"""Files landed from the weather service: station metadata and time series.

A file holds one JSON document, or one per line when lines is set; the latter splits well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldheat.functions.rows import observed
from fieldheat.operators.readings import timeseries_readings
from fieldheat.schemas import STATION_METADATA, STATION_TIMESERIES

BROKEN = "broken_text"


def _read(spark: SparkSession, path: str, schema: str, lines: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_station_metadata(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Metadata responses, for active_stations."""
    return _read(spark, path, STATION_METADATA, lines)


def read_timeseries(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Readings from time-series responses."""
    return timeseries_readings(_read(spark, path, STATION_TIMESERIES, lines))


def parsed_responses(spark: SparkSession, path: str, schema: str, *, lines: bool = False) -> DataFrame:
    """Responses as they landed: `file`, `text`, and `response`, in which BROKEN holds the text if it does not fit the schema.

    Blank lines and files are left out.
    """
    texts = spark.read.text(path, wholetext=not lines).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    response = F.from_json("text", f"{schema}, {BROKEN} STRING", options)
    return texts.filter(F.trim("text") != "").withColumn("response", response)


def accepted(responses: DataFrame) -> DataFrame:
    """Responses that fit the schema, as columns. What lacks STATION altogether is not a response."""
    good = F.col(f"response.{BROKEN}").isNull() & F.col("response.STATION").isNotNull()
    return responses.filter(good).select("response.STATION")


def rejected(responses: DataFrame) -> DataFrame:
    """`file`, `text` and `reason` of the others: broken JSON or values of other kinds, or no stations."""
    broken = F.col("response").isNull() | F.col(f"response.{BROKEN}").isNotNull()
    reason = F.when(broken, F.lit("unreadable")).when(F.col("response.STATION").isNull(), F.lit("no stations"))
    return responses.select("file", "text", reason.alias("reason")).filter("reason IS NOT NULL")


def set_aside(
    spark: SparkSession, path: str, schema: str, rejects: str, *, lines: bool = False
) -> tuple[DataFrame, int]:
    """Append what cannot be read to a folder of rejects. Returns the other responses and the number of rejects."""
    responses = parsed_responses(spark, path, schema, lines=lines)
    rows, counted = observed(rejected(responses), "rejected_responses")
    rows.write.mode("append").parquet(rejects)
    return accepted(responses), counted()
