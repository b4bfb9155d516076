"""Domain tables derived from the driver's benchmark tables.

Those tables hold no farms or weather, so positions, thresholds and temperatures are invented by
fixed formulas. Every row of customer, supplier, orders and events is used. The same formulas in
SQL are in fieldheat.plans.oracle.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2024, 7, 1)
SINCE = date(2024, 1, 20)
RADIUS_MILES = 8
DATE_SHIFT_DAYS = 8401  # orders of 1995 to 2001 become seasons 2018 to 2024

# Crop thresholds; 5-LOW is left out on purpose.
CROPS = [("1-URGENT", 40.0, 86.0), ("2-HIGH", 50.0, 86.0), ("3-MEDIUM", 45.0, 80.0)]

# State outlines as (state, part, [(lon, lat), ...]); one is concave, one has two
# parts, and between them lies land of no state.
OUTLINES = [
    (
        "ID",
        1,
        [
            (-113.0005, 42.5005),
            (-112.4005, 42.5005),
            (-112.4005, 42.7505),
            (-112.7005, 42.7505),
            (-112.7005, 43.0005),
            (-113.0005, 43.0005),
        ],
    ),
    ("UT", 1, [(-112.3505, 42.5005), (-112.0005, 42.5005), (-112.0005, 43.0005), (-112.3505, 43.0005)]),
    ("UT", 2, [(-113.0005, 41.9995), (-112.6505, 41.9995), (-112.8255, 42.4505)]),
    ("AZ", 1, [(-112.6005, 41.9995), (-112.1005, 41.9995), (-112.0505, 42.4505), (-112.5505, 42.3505)]),
    ("NV", 1, [(-112.6905, 42.7605), (-112.3605, 42.7605), (-112.3605, 43.0005), (-112.6905, 43.0005)]),
]


def outline_rows() -> list[tuple[str, int, int, int, float, float]]:
    return [
        (state, part, 1, seq, lon, lat)
        for state, part, points in OUTLINES
        for seq, (lon, lat) in enumerate(points)
    ]


def _values(rows) -> str:
    def cell(value) -> str:
        return f"'{value}'" if isinstance(value, str) else f"{value}D" if isinstance(value, float) else str(value)

    return ", ".join("(" + ", ".join(cell(value) for value in row) + ")" for row in rows)


class TestTables:
    """Lazily built domain tables over one directory of Parquet files."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def fields(self) -> DataFrame:
        return self._table("customer").select(F.col("c_custkey").cast("string").alias("ID"))

    def _places(self) -> DataFrame:
        return self._table("customer").selectExpr(
            "c_custkey",
            "CAST(c_custkey AS STRING) AS FIELD_ID",
            "round(42 + (c_custkey * 7919 % 997) / 1e3, 8) AS lat",
            "round(-113 + (c_custkey * 104729 % 991) / 1e3, 8) AS lon",
        )

    def points(self) -> DataFrame:
        return self._places().select("FIELD_ID", "lat", "lon")

    def boundaries(self) -> DataFrame:
        """JSON documents; some fields have two, some a broken one."""
        document = (
            "concat('{{\"multipolygons\":[{{\"rings\":[{{\"points\":[{{\"lat\":', {0}, ',\"lon\":', lon, "
            "'}},{{\"lat\":0,\"lon\":0}}]}}]}}]}}')"
        )
        first, second = document.format("lat"), document.format("round(lat - 0.002, 8)")
        documents = f"""
            CASE WHEN c_custkey % 50 = 2 THEN array(substr({first}, 1, 40))
                 WHEN c_custkey % 50 = 1 THEN array({first}, {second})
                 ELSE array({first}) END"""
        return self._places().selectExpr("FIELD_ID", f"explode({documents}) AS MULTIPOLYGONS")

    def polygons(self) -> DataFrame:
        return self.spark.sql(
            f"SELECT * FROM VALUES {_values(outline_rows())} AS t(state, part, ring, seq, lon, lat)"
        )

    def elevation_grid(self) -> DataFrame:
        cells = self._places().selectExpr("floor(lat * 10) AS cell_lat", "floor(lon * 10) AS cell_lon").distinct()
        return cells.withColumn("elev_ft", F.expr("4000 + pmod(cell_lat * 31 + cell_lon * 17, 50) * 2e1"))

    def elevation_cache(self) -> DataFrame:
        return self._places().selectExpr(
            "FIELD_ID", "CASE WHEN c_custkey % 3 = 0 THEN 4000 + (c_custkey % 700) * 1e0 END AS ELEVATION"
        )

    def operations(self) -> DataFrame:
        shifted = f"date_add(CAST(o_orderdate AS DATE), {DATE_SHIFT_DAYS})"
        week = f"CAST(date_trunc('week', {shifted}) AS DATE)"
        return self._table("orders").selectExpr(
            "CAST(o_custkey AS STRING) AS FIELD_ID",
            "CASE o_orderstatus WHEN 'O' THEN 'seeding' WHEN 'F' THEN 'harvest' ELSE 'application' END"
            " AS FIELD_OPERATION_TYPE",
            "nullif(o_orderpriority, '4-NOT SPECIFIED') AS CROP_NAME",
            f"CAST(year({shifted}) AS STRING) AS CROP_SEASON",
            f"CAST({week} AS TIMESTAMP) AS START_DATE",
            f"CAST(date_add({week}, CAST(o_orderkey % 2 AS INT)) AS TIMESTAMP) AS END_DATE",
        )

    def thresholds(self) -> DataFrame:
        return self.spark.sql(
            f"SELECT * FROM VALUES {_values(CROPS)} AS t(CROP, Base_Fahrenheit, Upper_Fahrenheit)"
        )

    def loaded(self) -> DataFrame:
        return self._table("events").selectExpr(
            "CAST(user_id AS STRING) AS FIELD_ID", "year(ts) AS CROP_SEASON", "CAST(ts AS DATE) AS GDH_DATE"
        )

    def station_metadata(self) -> DataFrame:
        return self._table("supplier").selectExpr(
            """array(named_struct(
                'STID', concat('S', s_suppkey),
                'SHORTNAME', CASE s_suppkey % 10 WHEN 7 THEN 'COOP-X' WHEN 3 THEN NULL ELSE 'RAWS' END,
                'LATITUDE', CAST(42 + (s_suppkey * 613 % 499) / 5e2 AS STRING),
                'LONGITUDE', CAST(-113 + (s_suppkey * 811 % 503) / 5e2 AS STRING),
                'ELEVATION', CAST(4000 + (s_suppkey * 71 % 1000) * 2e0 AS STRING),
                'STATE', CASE s_nationkey % 4 WHEN 0 THEN 'ID' WHEN 1 THEN 'UT' WHEN 2 THEN 'AZ' ELSE 'NV' END,
                'STATUS', CASE WHEN s_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END,
                'RESTRICTED', false,
                'PERIOD_OF_RECORD', named_struct(
                    'start', concat(date_add(DATE'2000-01-01', CAST(s_suppkey * 97 % 9000 AS INT)), 'T00:00:00Z'),
                    'end', '2024-07-01T00:00:00Z')
            )) AS STATION"""
        )

    def timeseries(self) -> DataFrame:
        """One response per reading, as a service with the smallest possible pages would give."""
        return self._table("events").selectExpr(
            """array(named_struct(
                'STID', concat('S', user_id),
                'OBSERVATIONS', named_struct(
                    'date_time', array(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
                    'air_temp_set_1', array(CASE WHEN event_type <> 'error' THEN 30 + 4e0 * sqrt(value) END))
            )) AS STATION"""
        )

    def timeseries_pages(self) -> DataFrame:
        """A response per station and day. Each lacks its last temperature, and some times cannot be parsed."""
        time = "CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") END"
        reading = f"struct(event_id, {time} AS time, CASE WHEN event_type <> 'error' THEN 30 + 4e0 * sqrt(value) END AS temp)"
        pages = (
            self._table("events")
            .groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.sort_array(F.collect_list(F.expr(reading))).alias("page"))
        )
        return pages.selectExpr(
            """array(named_struct(
                'STID', concat('S', user_id),
                'OBSERVATIONS', named_struct(
                    'date_time', page.time,
                    'air_temp_set_1', slice(page.temp, 1, size(page) - 1))
            )) AS STATION"""
        )

    def responses(self, kind: str) -> DataFrame:
        """The same responses as JSON texts, `value`. Every eleventh station's are cut off or of another form."""
        found = self.station_metadata() if kind == "metadata" else self.timeseries_pages()
        number = "CAST(substr(STATION[0].STID, 2) AS INT)"
        return found.selectExpr(
            f"""CASE {number} % 11 WHEN 3 THEN substr(to_json(struct(STATION)), 1, 30)
                               WHEN 5 THEN '{{"SUMMARY":"none"}}'
                               WHEN 7 THEN '{{"STATION":"none"}}' ELSE to_json(struct(STATION)) END AS value"""
        )

    def batches(self) -> DataFrame:
        """Readings with the number of their batch. In a third of the moments at every tenth station the first batch lacks
        the readings, in another third it holds others, and the second one brings the right ones."""
        moment = "pmod(CAST(unix_timestamp(date_time) / 60 AS BIGINT), 3)"
        few = "CAST(substr(station_id, 2) AS INT) % 10 = 1"
        rows = self.readings()
        first = rows.selectExpr(
            "station_id",
            "date_time",
            f"CASE WHEN {few} AND {moment} = 1 THEN 99e0 ELSE air_temp_set_1 END AS air_temp_set_1",
            "year",
            "1 AS batch",
        ).filter(f"NOT ({few} AND {moment} = 0)")
        return first.unionByName(rows.filter(f"{few} AND {moment} < 2").selectExpr("*", "2 AS batch"))

    def readings(self) -> DataFrame:
        """Readings as a landed table; seconds are dropped so that some fall exactly on midnight."""
        return self._table("events").selectExpr(
            "concat('S', user_id) AS station_id",
            "CAST(date_trunc('minute', ts) AS TIMESTAMP) AS date_time",
            "CASE WHEN event_type <> 'error' THEN 30 + 4e0 * sqrt(value) END AS air_temp_set_1",
            "year(ts) AS year",
        )
