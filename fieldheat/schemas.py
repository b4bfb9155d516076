"""Table schemas and the checks applied where data enters an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELDS = "ID STRING"
BOUNDARIES = "FIELD_ID STRING, MULTIPOLYGONS STRING"
FIELD_MASTER = "FIELD_ID STRING, field_lat DOUBLE, field_lon DOUBLE, state STRING, field_elev DOUBLE"
STATE_POLYGONS = "state STRING, part INT, ring INT, seq INT, lon DOUBLE, lat DOUBLE"
ELEVATION_CACHE = "FIELD_ID STRING, ELEVATION DOUBLE"
ELEVATION_GRID = "cell_lat BIGINT, cell_lon BIGINT, elev_ft DOUBLE"
FIELD_OPERATIONS = (
    "FIELD_ID STRING, FIELD_OPERATION_TYPE STRING, CROP_NAME STRING, CROP_SEASON STRING, "
    "START_DATE TIMESTAMP, END_DATE TIMESTAMP"
)
CROP_THRESHOLDS = "CROP STRING, Base_Fahrenheit DOUBLE, Upper_Fahrenheit DOUBLE"
LOADED_GDH = "FIELD_ID STRING, CROP_SEASON INT, GDH_DATE DATE"
STATION_METADATA = (
    "STATION ARRAY<STRUCT<STID: STRING, SHORTNAME: STRING, LATITUDE: STRING, LONGITUDE: STRING, "
    "ELEVATION: STRING, STATE: STRING, STATUS: STRING, RESTRICTED: BOOLEAN, "
    "PERIOD_OF_RECORD: STRUCT<start: STRING, end: STRING>>>"
)
STATION_TIMESERIES = (
    "STATION ARRAY<STRUCT<STID: STRING, "
    "OBSERVATIONS: STRUCT<date_time: ARRAY<STRING>, air_temp_set_1: ARRAY<DOUBLE>>>>"
)
BOUNDARY_POINT = "lat STRING, lon STRING"
STATIONS = "STID STRING, ELEVATION DOUBLE, lat DOUBLE, lon DOUBLE, record_start DATE, record_end DATE"
READINGS = "station_id STRING, date_time TIMESTAMP, air_temp_set_1 DOUBLE, year INT"
HOURLY = "FIELD_ID STRING, CROP_SEASON INT, station_id STRING, Date DATE, Hour INT, temp_avg DOUBLE"
GDH = (
    "FIELD_ID STRING, CROP_NAME STRING, CROP_SEASON INT, GDH_DATE DATE, Hour INT, "
    "seeding_date DATE, harvest_date DATE, gdh DOUBLE"
)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail when the plan is built, not halfway through a job."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")
    return df


def number(column: Column) -> Column:
    """Text or number to double; unparsable text and NaN become NULL."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Select the schema's columns in order, cast leniently, with NaN as NULL."""
    fields = T.StructType.fromDDL(schema).fields
    require_columns(df, *[field.name for field in fields])
    columns = []
    for field in fields:
        source = F.col(field.name)
        value = number(source) if field.dataType == T.DoubleType() else source.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)
