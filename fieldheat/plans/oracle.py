"""The catalogue's queries in plain SQL, for an independent engine to check against.

Written from the definitions, not from the Spark plans: nearest stations by comparing all pairs,
states by testing all edges, gaps by windows over the full grid.
"""

from __future__ import annotations

import re

from fieldheat.plans.testmap import AS_OF, CROPS, DATE_SHIFT_DAYS, SINCE, outline_rows


def _values(rows) -> str:
    def cell(value) -> str:
        return f"'{value}'" if isinstance(value, str) else f"{value}::DOUBLE" if isinstance(value, float) else str(value)

    return ", ".join("(" + ", ".join(cell(value) for value in row) + ")" for row in rows)


def _metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6378137e0 * asin(sqrt(least(1e0, "
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) "
        f"+ cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


FIELD_TO_STATION = _metres("field_lat", "field_lon", "station_lat", "station_lon")


def _nearest(radius_miles: float, k: int) -> str:
    return f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY FIELD_ID, CROP_SEASON, CROP_NAME
                                         ORDER BY distance_m, station_id) AS rnk
            FROM (SELECT f.* EXCLUDE (state), s.STID AS station_id, s.ELEVATION AS station_elev,
                         s.lat AS station_lat, s.lon AS station_lon,
                         {_metres('f.field_lat', 'f.field_lon', 's.lat', 's.lon')} AS distance_m
                  FROM field_seasons f JOIN stations s ON s.record_start < f.seeding_date)
            WHERE distance_m <= {radius_miles} * 1609.344e0)
        WHERE rnk <= {k}"""


def _windows(min_season: int, seeding: str, harvest: str) -> str:
    return f"""
        SELECT w.FIELD_ID, w.CROP_NAME, w.CROP_SEASON, g.GDH_MAX_DATE, g.GDH_MIN_DATE,
               {seeding} AS seeding_date, {harvest} AS harvest_date,
               make_date(w.CROP_SEASON, 1, 1) AS start_of_year, make_date(w.CROP_SEASON, 12, 31) AS end_of_year,
               w.application
        FROM wide w LEFT JOIN loaded_range g ON g.FIELD_ID = w.FIELD_ID AND g.CROP_SEASON = w.CROP_SEASON
        WHERE w.CROP_NAME IN (SELECT CROP FROM thresholds) AND w.CROP_SEASON > {min_season}"""


def _filled(partition: str, x: str) -> str:
    """Fill grid gaps along an order; x is the coordinate."""
    return f"""
        SELECT FIELD_ID, CROP_SEASON, station_id, Date, Hour,
               coalesce(temp_avg, v0 + (v1 - v0) * (x - x0) / (x1 - x0)) AS temp_avg
        FROM (SELECT *,
                     last_value(temp_avg IGNORE NULLS) OVER back AS v0,
                     last_value(kx IGNORE NULLS) OVER back AS x0,
                     first_value(temp_avg IGNORE NULLS) OVER ahead AS v1,
                     first_value(kx IGNORE NULLS) OVER ahead AS x1
              FROM (SELECT *, CASE WHEN temp_avg IS NOT NULL THEN x END AS kx
                    FROM (SELECT *, {x} AS x FROM grid))
              WINDOW back AS ({partition} ORDER BY FIELD_ID, CROP_SEASON, station_id, Date, Hour
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     ahead AS ({partition} ORDER BY FIELD_ID, CROP_SEASON, station_id, Date, Hour
                               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


_PER_SERIES = "PARTITION BY FIELD_ID, CROP_SEASON, station_id"
_ALONG = "OVER ({} ORDER BY FIELD_ID, CROP_SEASON, station_id, Date, Hour)"
_SHIFTED = f"(CAST(o_orderdate AS DATE) + {DATE_SHIFT_DAYS})"

# Named steps; each may use any other by name.
STEPS: dict[str, str] = {
    "places": """
        SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS FIELD_ID,
               round(42 + (c_custkey * 7919 % 997) / 1e3, 8) AS lat,
               round(-113 + (c_custkey * 104729 % 991) / 1e3, 8) AS lon
        FROM customer""",
    "boundary_points": """
        SELECT FIELD_ID, CASE WHEN c_custkey % 50 <> 2 THEN lat END AS lat,
               CASE WHEN c_custkey % 50 <> 2 THEN lon END AS lon
        FROM places
        UNION ALL
        SELECT FIELD_ID, round(lat - 2e-3, 8), lon FROM places WHERE c_custkey % 50 = 1""",
    "one_point": """
        SELECT FIELD_ID, lat, lon
        FROM (SELECT *, row_number() OVER (PARTITION BY FIELD_ID ORDER BY lat NULLS LAST, lon NULLS LAST) AS rnk
              FROM boundary_points)
        WHERE rnk = 1""",
    "every_point": """
        SELECT lat, lon FROM boundary_points WHERE lat IS NOT NULL UNION SELECT lat, lon FROM places""",
    "outlines": f"SELECT * FROM (VALUES {_values(outline_rows())}) AS t(state, part, ring, seq, lon, lat)",
    "edges": """
        SELECT state, lon AS x1, lat AS y1,
               coalesce(lead(lon) OVER r, first_value(lon) OVER r) AS x2,
               coalesce(lead(lat) OVER r, first_value(lat) OVER r) AS y2
        FROM outlines WINDOW r AS (PARTITION BY state, part, ring ORDER BY seq)""",
    "state_of": """
        SELECT lat, lon, min(state) AS state
        FROM (SELECT p.lat, p.lon, e.state, count(*) AS n
              FROM every_point p
              JOIN edges e ON (e.y1 > p.lat) <> (e.y2 > p.lat)
                          AND p.lon < (e.x2 - e.x1) * (p.lat - e.y1) / (e.y2 - e.y1) + e.x1
              GROUP BY ALL)
        WHERE n % 2 = 1 GROUP BY lat, lon""",
    "elevation_of": """
        SELECT lat, lon, 4000 + ((((floor(lat * 10)::BIGINT * 31 + floor(lon * 10)::BIGINT * 17) % 50) + 50) % 50) * 2e1
                 AS fetched,
               floor(lat * 10)::BIGINT AS i, floor(lon * 10)::BIGINT AS j
        FROM every_point""",
    "raster_cells": "SELECT DISTINCT floor(lat * 10)::BIGINT AS i, floor(lon * 10)::BIGINT AS j FROM places",
    "cache": """
        SELECT FIELD_ID, CASE WHEN c_custkey % 3 = 0 THEN 4000 + (c_custkey % 700) * 1e0 END AS cached FROM places""",
    "located": """
        SELECT p.FIELD_ID, p.lat AS field_lat, p.lon AS field_lon, s.state,
               coalesce(c.cached, CASE WHEN r.i IS NOT NULL THEN e.fetched END) AS field_elev
        FROM boundary_points p JOIN state_of s ON s.lat = p.lat AND s.lon = p.lon
        LEFT JOIN cache c ON c.FIELD_ID = p.FIELD_ID
        LEFT JOIN elevation_of e ON e.lat = p.lat AND e.lon = p.lon
        LEFT JOIN raster_cells r ON r.i = e.i AND r.j = e.j""",
    "master": """
        SELECT l.* FROM located l JOIN one_point p ON p.FIELD_ID = l.FIELD_ID AND p.lat = l.field_lat AND p.lon = l.field_lon
        WHERE state IN ('AZ', 'ID', 'UT') AND field_elev IS NOT NULL""",
    "ops": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS FIELD_ID,
               CASE o_orderstatus WHEN 'O' THEN 'seeding' WHEN 'F' THEN 'harvest' ELSE 'application' END
                 AS FIELD_OPERATION_TYPE,
               nullif(o_orderpriority, '4-NOT SPECIFIED') AS CROP_NAME,
               CAST(year({_SHIFTED}) AS INTEGER) AS CROP_SEASON,
               CAST(date_trunc('week', {_SHIFTED}) AS DATE) AS START_DATE,
               CAST(date_trunc('week', {_SHIFTED}) AS DATE) + CAST(o_orderkey % 2 AS INTEGER) AS END_DATE
        FROM orders""",
    "thresholds": f"SELECT * FROM (VALUES {_values(CROPS)}) AS t(CROP, Base_Fahrenheit, Upper_Fahrenheit)",
    "loaded": """
        SELECT CAST(user_id AS VARCHAR) AS FIELD_ID, CAST(year(ts) AS INTEGER) AS CROP_SEASON,
               CAST(ts AS DATE) AS GDH_DATE
        FROM events""",
    "loaded_range": """
        SELECT FIELD_ID, CROP_SEASON, max(GDH_DATE) AS GDH_MAX_DATE, min(GDH_DATE) AS GDH_MIN_DATE
        FROM loaded GROUP BY ALL""",
    "single": """
        SELECT * EXCLUDE (n)
        FROM (SELECT *, count(*) OVER (PARTITION BY FIELD_ID, CROP_SEASON, CROP_NAME, FIELD_OPERATION_TYPE) AS n
              FROM (SELECT DISTINCT FIELD_ID, FIELD_OPERATION_TYPE, CROP_NAME, CROP_SEASON, START_DATE AS DATE FROM ops))
        WHERE n = 1 AND CROP_NAME IS NOT NULL""",
    "wide": """
        SELECT FIELD_ID, CROP_SEASON, CROP_NAME,
               max(DATE) FILTER (FIELD_OPERATION_TYPE = 'seeding') AS seeding,
               max(DATE) FILTER (FIELD_OPERATION_TYPE = 'harvest') AS harvest,
               max(DATE) FILTER (FIELD_OPERATION_TYPE = 'application') AS application
        FROM single GROUP BY FIELD_ID, CROP_SEASON, CROP_NAME""",
    "season_windows": _windows(
        2018,
        "coalesce(w.seeding, g.GDH_MIN_DATE, make_date(w.CROP_SEASON, 1, 1))",
        "coalesce(w.harvest, g.GDH_MAX_DATE, make_date(w.CROP_SEASON, 12, 31))",
    ),
    "season_windows_year": _windows(
        2018,
        "coalesce(w.seeding, make_date(w.CROP_SEASON, 1, 1))",
        "coalesce(w.harvest, make_date(w.CROP_SEASON, 12, 31))",
    ),
    "season_windows_strict": _windows(2019, "w.seeding", "w.harvest")
    + " AND w.seeding IS NOT NULL AND w.harvest IS NOT NULL",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY FIELD_ID, CROP_SEASON, CROP_NAME, FIELD_OPERATION_TYPE
                                     ORDER BY START_DATE, END_DATE) AS k
        FROM (SELECT DISTINCT * FROM ops)""",
    "paired": """
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, k,
               max(START_DATE) FILTER (FIELD_OPERATION_TYPE = 'seeding') AS seeding_date,
               max(START_DATE) FILTER (FIELD_OPERATION_TYPE = 'harvest') AS harvest_date
        FROM numbered GROUP BY FIELD_ID, CROP_NAME, CROP_SEASON, k""",
    "field_seasons": """
        SELECT m.*, w.CROP_NAME, w.CROP_SEASON, w.seeding_date, w.harvest_date
        FROM master m JOIN season_windows w ON w.FIELD_ID = m.FIELD_ID""",
    "stations": """
        SELECT 'S' || s_suppkey AS STID, 4000 + (s_suppkey * 71 % 1000) * 2e0 AS ELEVATION,
               42 + (s_suppkey * 613 % 499) / 5e2 AS lat, -113 + (s_suppkey * 811 % 503) / 5e2 AS lon,
               DATE '2000-01-01' + CAST(s_suppkey * 97 % 9000 AS INTEGER) AS record_start,
               DATE '2024-07-01' AS record_end
        FROM supplier
        WHERE s_suppkey % 10 <> 7 AND NOT s_acctbal < 0
          AND CASE s_nationkey % 4 WHEN 0 THEN 'ID' WHEN 1 THEN 'UT' WHEN 2 THEN 'AZ' ELSE 'NV' END
              IN (SELECT state FROM master)""",
    "field_stations": _nearest(8, 5),
    "plan": """
        SELECT station_id, CROP_SEASON, min(seeding_date) AS seeding_date, max(harvest_date) AS harvest_date
        FROM field_stations GROUP BY station_id, CROP_SEASON""",
    "day_windows": f"""
        SELECT *, least(starts + 4, last_day) AS ends
        FROM (SELECT *, CAST(unnest(generate_series(CAST(seeding_date AS TIMESTAMP), CAST(last_day AS TIMESTAMP),
                                                    INTERVAL 5 DAY)) AS DATE) AS starts
              FROM (SELECT *, CASE WHEN harvest_date = DATE '{AS_OF}' THEN harvest_date - 1 ELSE harvest_date END
                                AS last_day
                    FROM plan))""",
    "missing_days": """
        SELECT station_id, CAST(unnest(generate_series(CAST(seeding_date AS TIMESTAMP), CAST(harvest_date AS TIMESTAMP),
                                                       INTERVAL 1 DAY)) AS DATE) AS day
        FROM plan
        EXCEPT
        SELECT station_id, CAST(unnest(generate_series(CAST(starts AS TIMESTAMP), CAST(ends AS TIMESTAMP),
                                                       INTERVAL 1 DAY)) AS DATE)
        FROM day_windows
        WHERE (CAST(substr(station_id, 2) AS INTEGER) + (starts - DATE '1970-01-01') // 5) % 3 = 0""",
    "missing": """
        SELECT station_id, min(day) AS starts, max(day) AS ends
        FROM (SELECT *, day - CAST(row_number() OVER (PARTITION BY station_id ORDER BY day) AS INTEGER) AS island
              FROM missing_days)
        GROUP BY station_id, island""",
    "missing_pieces": """
        SELECT station_id, min(day) AS starts, max(day) AS ends
        FROM (SELECT *, (day - DATE '1970-01-01') // 10 AS piece,
                     day - CAST(row_number() OVER (PARTITION BY station_id ORDER BY day) AS INTEGER) AS island
              FROM missing_days)
        GROUP BY station_id, island, piece""",
    "page_rows": """
        SELECT user_id, CASE WHEN readable THEN ts END AS ts,
               CASE WHEN later > 0 AND event_type <> 'error' THEN 30 + 4e0 * sqrt(value) END AS temp
        FROM (SELECT *, event_id % 17 <> 0 AS readable,
                     count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id
                                    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later
              FROM events)""",
    "readings": """
        SELECT 'S' || user_id AS station_id, date_trunc('minute', ts) AS date_time,
               CASE WHEN event_type <> 'error' THEN 30 + 4e0 * sqrt(value) END AS air_temp_set_1,
               CAST(year(ts) AS INTEGER) AS year
        FROM events""",
    "planned": """
        SELECT * FROM readings r
        WHERE EXISTS (SELECT 1 FROM plan p WHERE p.station_id = r.station_id
                      AND r.date_time >= p.seeding_date AND r.date_time <= p.harvest_date)""",
    "field_readings": """
        SELECT f.* EXCLUDE (distance_m, rnk), r.date_time, r.air_temp_set_1
        FROM field_stations f JOIN planned r ON r.station_id = f.station_id AND r.year = f.CROP_SEASON""",
    "hourly": """
        SELECT FIELD_ID, CROP_SEASON, station_id, CAST(date_time AS DATE) AS Date,
               CAST(hour(date_time) AS INTEGER) AS Hour, avg(air_temp_set_1) AS temp_avg
        FROM field_readings WHERE CAST(date_time AS DATE) BETWEEN seeding_date AND harvest_date
        GROUP BY ALL""",
    "grid": """
        SELECT s.FIELD_ID, s.CROP_SEASON, s.station_id, d.Date, h.Hour, y.temp_avg
        FROM (SELECT DISTINCT FIELD_ID, CROP_SEASON, station_id FROM hourly) s
        JOIN (SELECT DISTINCT FIELD_ID, CROP_SEASON, Date FROM hourly) d USING (FIELD_ID, CROP_SEASON)
        JOIN (SELECT DISTINCT FIELD_ID, CROP_SEASON, Hour FROM hourly) h USING (FIELD_ID, CROP_SEASON)
        LEFT JOIN hourly y ON y.FIELD_ID = s.FIELD_ID AND y.CROP_SEASON = s.CROP_SEASON
                          AND y.station_id = s.station_id AND y.Date = d.Date AND y.Hour = h.Hour""",
    "filled": _filled(_PER_SERIES, f"row_number() {_ALONG.format(_PER_SERIES)}"),
    "filled_time": _filled(_PER_SERIES, "(Date - DATE '1970-01-01') * 24 + Hour"),
    "filled_global": _filled("", f"row_number() {_ALONG.format('')}"),
    "shifts": """
        SELECT FIELD_ID, station_id, min(-(field_elev - station_elev) / 1000 * 3.5e0) AS adjusted_wt
        FROM field_stations GROUP BY FIELD_ID, station_id""",
    "weather": """
        SELECT FIELD_ID, Date, Hour, min(temp_avg) AS temp_min, max(temp_avg) AS temp_max,
               avg(temp_avg) AS temp_combined_avg, avg(temp_avg + adjusted_wt) AS temp_wt_avg
        FROM filled JOIN shifts USING (FIELD_ID, station_id) GROUP BY FIELD_ID, Date, Hour""",
    "heat_input": """
        SELECT w.FIELD_ID, s.CROP_NAME, t.Base_Fahrenheit, t.Upper_Fahrenheit, w.temp_combined_avg, w.temp_wt_avg,
               w.Date, w.Hour, s.seeding_date, s.harvest_date, s.CROP_SEASON
        FROM weather w JOIN season_windows s ON s.FIELD_ID = w.FIELD_ID AND s.CROP_SEASON = year(w.Date)
        LEFT JOIN thresholds t ON t.CROP = s.CROP_NAME""",
    "heat": """
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, Date AS GDH_DATE, Hour, seeding_date, harvest_date,
               CASE WHEN temp_combined_avg - Base_Fahrenheit < 0 THEN 0
                    WHEN temp_combined_avg > Upper_Fahrenheit THEN Upper_Fahrenheit - Base_Fahrenheit
                    ELSE temp_combined_avg - Base_Fahrenheit END AS gdh
        FROM heat_input WHERE Date BETWEEN seeding_date AND harvest_date""",
    "daily": """
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, GDH_DATE, sum(gdh) AS gdh_day, count(gdh) AS hours
        FROM heat GROUP BY ALL""",
}


def _text(*names: str) -> str:
    return ", ".join(f"CAST({name} AS VARCHAR) AS {name}" for name in names)


def _rounded(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({name}, {digits}) AS {name}" for name in names)


_MASTER = f"FIELD_ID, state, {_rounded('field_lat', 'field_lon', 'field_elev')}"
_WINDOW = "FIELD_ID, CROP_NAME, CROP_SEASON, " + _text(
    "GDH_MAX_DATE", "GDH_MIN_DATE", "seeding_date", "harvest_date", "start_of_year", "end_of_year"
)
_SEASON = "FIELD_ID, CROP_NAME, CROP_SEASON, " + _text("seeding_date", "harvest_date")
_PAIRING = (
    "FIELD_ID, CROP_NAME, CROP_SEASON, station_id, "
    + _text("seeding_date", "harvest_date")
    + ", "
    + _rounded("field_lat", "field_lon", "field_elev", "station_elev", "station_lat", "station_lon")
)
_READING = "station_id, strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time, round(air_temp_set_1, 6) AS air_temp_set_1"
_HOUR = "FIELD_ID, CROP_SEASON, station_id, CAST(Date AS VARCHAR) AS Date, Hour, round(temp_avg, 6) AS temp_avg"
_HEAT = "FIELD_ID, CROP_NAME, CROP_SEASON, Hour, round(gdh, 6) AS gdh, " + _text(
    "GDH_DATE", "seeding_date", "harvest_date"
)
_WIDE_TYPES = "CAST(seeding AS VARCHAR) AS seeding_date, CAST(harvest AS VARCHAR) AS harvest_date"


def _pairs(metres: str, name: str) -> str:
    return f"SELECT DISTINCT FIELD_ID, station_id, round({metres}, 3) AS {name} FROM field_stations"


_PAGE = (
    "'S' || user_id AS station_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time, "
    "round(temp, 6) AS air_temp_set_1, CAST(year(ts) AS INTEGER) AS year"
)
_PUSHED = """
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, CAST(GDH_DATE AS VARCHAR) AS GDH_DATE, Hour AS HOUR,
               CAST(seeding_date AS VARCHAR) AS SEEDING_DATE, CAST(harvest_date AS VARCHAR) AS HARVEST_DATE,
               round(gdh, 6) AS GDH, Hour || '_' || FIELD_ID || '_' || GDH_DATE AS ID
        FROM heat"""
_DAILY = """
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, CAST(GDH_DATE AS VARCHAR) AS GDH_DATE, round(gdh_day, 6) AS gdh_day,
               hours, round(sum(gdh_day) OVER (PARTITION BY FIELD_ID, CROP_NAME, CROP_SEASON ORDER BY GDH_DATE
                                               ROWS UNBOUNDED PRECEDING), 6) AS gdh_to_date
        FROM daily"""


FINAL: dict[str, str] = {
    "fields_master": f"SELECT {_MASTER} FROM master",
    "fields_all": f"SELECT {_MASTER} FROM located WHERE field_elev IS NOT NULL",
    "state_of_point": f"SELECT FIELD_ID, state, {_rounded('lat', 'lon')} FROM places LEFT JOIN state_of USING (lat, lon)",
    "elevation_fill": f"""
        SELECT p.FIELD_ID, {_rounded('lat', 'lon')}, round(coalesce(cached, fetched), 6) AS ELEVATION
        FROM places p JOIN elevation_of USING (lat, lon) LEFT JOIN cache c ON c.FIELD_ID = p.FIELD_ID""",
    "elevation_cache_delta": """
        SELECT p.FIELD_ID, round(fetched, 6) AS ELEVATION
        FROM places p JOIN elevation_of USING (lat, lon) LEFT JOIN cache c ON c.FIELD_ID = p.FIELD_ID
        WHERE cached IS NULL""",
    "season_windows": f"SELECT {_WINDOW} FROM season_windows",
    "season_windows_year": f"SELECT {_WINDOW}, {_text('application')} FROM season_windows_year",
    "season_windows_strict": f"SELECT {_WINDOW} FROM season_windows_strict",
    "crops_long": """
        SELECT FIELD_ID, FIELD_OPERATION_TYPE, CROP_NAME, CROP_SEASON,
               strftime(DATE, '%Y-%m-%d %H:%M:%S') AS "DATE"
        FROM single WHERE CROP_SEASON > 2019 AND CROP_SEASON < 2024""",
    "crops_wide": f"""
        SELECT FIELD_ID, CROP_SEASON, CROP_NAME, {_WIDE_TYPES}, {_text('application')} FROM wide
        WHERE CROP_SEASON > 2018 AND CROP_SEASON < 2025 AND CROP_NAME IN (SELECT CROP FROM thresholds)
          AND seeding IS NOT NULL AND harvest IS NOT NULL AND application IS NOT NULL""",
    "crops_wide_seeding_harvest": f"""
        SELECT FIELD_ID, CROP_SEASON, CROP_NAME, {_WIDE_TYPES} FROM wide
        WHERE CROP_NAME IN (SELECT CROP FROM thresholds) AND seeding IS NOT NULL AND harvest IS NOT NULL""",
    "seasons_historic": f"""
        SELECT {_SEASON} FROM paired
        WHERE CROP_SEASON <= {AS_OF.year - 1} AND CROP_NAME IS NOT NULL
          AND seeding_date IS NOT NULL AND harvest_date IS NOT NULL""",
    "seasons_current": f"""
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, CAST(START_DATE AS VARCHAR) AS seeding_date,
               '{AS_OF}' AS harvest_date
        FROM (SELECT DISTINCT * FROM ops)
        WHERE CROP_SEASON = {AS_OF.year} AND FIELD_OPERATION_TYPE = 'seeding'""",
    "seasons_current_actual": f"""
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, CAST(seeding_date AS VARCHAR) AS seeding_date,
               CAST(coalesce(harvest_date, DATE '{AS_OF}') AS VARCHAR) AS harvest_date
        FROM paired WHERE CROP_SEASON = {AS_OF.year} AND seeding_date IS NOT NULL""",
    "field_seasons": f"SELECT {_MASTER}, CROP_NAME, CROP_SEASON, {_text('seeding_date', 'harvest_date')} FROM field_seasons",
    "active_stations": f"""
        SELECT STID, {_rounded('ELEVATION', 'lat', 'lon')}, {_text('record_start', 'record_end')} FROM stations""",
    "nearest_stations": f"SELECT {_PAIRING} FROM field_stations",
    "nearest_stations_descent": f"SELECT {_PAIRING}, round(distance_m, 3) AS distance_m FROM ({_nearest(20, 3)})",
    "nearest_stations_wide": f"SELECT {_PAIRING}, round(distance_m, 3) AS distance_m FROM ({_nearest(20, 3)})",
    "date_windows": f"""
        SELECT station_id, CROP_SEASON, {_text('seeding_date', 'harvest_date', 'starts', 'ends')} FROM day_windows""",
    "station_season_plan": f"SELECT station_id, CROP_SEASON, {_text('seeding_date', 'harvest_date')} FROM plan",
    "timeseries_readings": """
        SELECT 'S' || user_id AS station_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time,
               round(CASE WHEN event_type <> 'error' THEN 30 + 4e0 * sqrt(value) END, 6) AS air_temp_set_1,
               CAST(year(ts) AS INTEGER) AS year
        FROM events""",
    "timeseries_pages": f"SELECT {_PAGE} FROM page_rows",
    "landed_timeseries": f"SELECT {_PAGE} FROM page_rows WHERE user_id % 11 NOT IN (3, 5, 7)",
    "landed_metadata": f"""
        SELECT 'S' || s_suppkey AS STID, {_rounded('ELEVATION', 'lat', 'lon')}, {_text('record_start', 'record_end')}
        FROM (SELECT *, 4000 + (s_suppkey * 71 % 1000) * 2e0 AS ELEVATION, 42 + (s_suppkey * 613 % 499) / 5e2 AS lat,
                     -113 + (s_suppkey * 811 % 503) / 5e2 AS lon, DATE '2024-07-01' AS record_end,
                     DATE '2000-01-01' + CAST(s_suppkey * 97 % 9000 AS INTEGER) AS record_start
              FROM supplier)
        WHERE s_suppkey % 11 NOT IN (3, 5, 7) AND s_suppkey % 10 <> 7 AND NOT s_acctbal < 0""",
    "rejected_responses": """
        SELECT CASE kind WHEN 3 THEN left('{"STATION":[{"STID":"S' || user_id || '","OBSERVATIONS":{"date_time"', 30)
                         WHEN 5 THEN '{"SUMMARY":"none"}' ELSE '{"STATION":"none"}' END AS text,
               CASE kind WHEN 5 THEN 'no stations' ELSE 'unreadable' END AS reason, count(*) AS count
        FROM (SELECT DISTINCT user_id, CAST(ts AS DATE), user_id % 11 AS kind FROM events) WHERE kind IN (3, 5, 7) GROUP BY ALL""",
    "missing_ranges": f"SELECT station_id, {_text('starts', 'ends')} FROM missing",
    "request_manifests": f"""
        SELECT {_text('starts', 'ends')}, request_no, CAST(count(*) AS INTEGER) AS n_stations,
               string_agg(station_id, ',' ORDER BY station_id) AS station_ids,
               strftime(starts, '%Y%m%d0000') AS start_time, strftime(ends + 1, '%Y%m%d0000') AS end_time
        FROM (SELECT *, CAST((row_number() OVER (PARTITION BY starts, ends ORDER BY station_id) - 1)
                             // greatest(1, least(4, 15 // (longest + 1))) + 1 AS INTEGER) AS request_no
              FROM (SELECT *, max(length(station_id)) OVER (PARTITION BY starts, ends) AS longest FROM missing_pieces))
        GROUP BY starts, ends, request_no""",
    "pull_report": """
        SELECT station_id, count(DISTINCT CROP_SEASON) AS n_seasons, any_value(coalesce(n, 0)) AS n_readings,
               any_value(coalesce(unknown, 0)) AS n_missing,
               any_value(strftime(low, '%Y-%m-%d %H:%M:%S')) AS first_time,
               any_value(strftime(high, '%Y-%m-%d %H:%M:%S')) AS last_time
        FROM plan LEFT JOIN (SELECT station_id, count(*) AS n, count(*) FILTER (air_temp_set_1 IS NULL) AS unknown,
                                    min(date_time) AS low, max(date_time) AS high
                             FROM planned GROUP BY station_id) USING (station_id)
        GROUP BY station_id""",
    "touched_field_seasons": """
        SELECT DISTINCT FIELD_ID, CROP_SEASON FROM field_readings
        WHERE CAST(substr(station_id, 2) AS INTEGER) % 10 = 1 AND (epoch(date_time)::BIGINT // 60) % 3 < 2
          AND CAST(date_time AS DATE) BETWEEN seeding_date AND harvest_date""",
    "gdh_csv": f"SELECT {_HEAT} FROM heat",
    "gdh_table_rewritten": _PUSHED,
    "gdh_after_late_batch": _PUSHED,
    "gdh_after_new_fields": _PUSHED,
    "gdh_of_bucketed": _DAILY,
    "readings_by_plan": f"SELECT {_READING}, year FROM planned",
    "readings_all": f"""
        SELECT {_READING}, year FROM readings
        WHERE station_id IN (SELECT station_id FROM field_stations)
          AND date_time >= (SELECT min(seeding_date) FROM field_stations) AND date_time <= DATE '{AS_OF}'""",
    "field_readings": f"""
        SELECT {_PAIRING}, strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time,
               round(air_temp_set_1, 6) AS air_temp_set_1
        FROM field_readings""",
    "hourly_mean": f"SELECT {_HOUR} FROM hourly",
    "hourly_mean_of_readings": f"SELECT {_HOUR} FROM hourly",
    "hourly_dedup_station": f"""
        SELECT {_HOUR}
        FROM (SELECT *, row_number() OVER (PARTITION BY station_id, Date, Hour ORDER BY FIELD_ID, CROP_SEASON) AS rnk
              FROM hourly)
        WHERE rnk = 1""",
    "hourly_grid": f"SELECT {_HOUR} FROM grid",
    "hourly_grid_of_hours": f"SELECT {_HOUR} FROM grid",
    "hourly_filled": f"SELECT {_HOUR} FROM filled",
    "hourly_filled_rows": f"SELECT {_HOUR} FROM filled",
    "hourly_filled_time": f"SELECT {_HOUR} FROM filled_time",
    "hourly_filled_global": f"SELECT {_HOUR} FROM filled_global",
    "lat_dist": _pairs(_metres("field_lat", "0e0", "station_lat", "0e0"), "lat_dist"),
    "lon_dist": _pairs(_metres("0e0", "field_lon", "0e0", "station_lon"), "long_dist"),
    "total_dist": _pairs(FIELD_TO_STATION, "total_dist"),
    "elev_change": """
        SELECT DISTINCT FIELD_ID, station_id, round(field_elev - station_elev, 6) AS elev_dif FROM field_stations""",
    "lapse_adjusted": f"""
        SELECT {_HOUR}, round(temp_avg + adjusted_wt, 6) AS wt_temp
        FROM hourly JOIN shifts USING (FIELD_ID, station_id)""",
    "field_weather": f"""
        SELECT FIELD_ID, CAST(Date AS VARCHAR) AS Date, Hour,
               {_rounded('temp_min', 'temp_max', 'temp_combined_avg', 'temp_wt_avg')}
        FROM weather""",
    "gdh_input": f"""
        SELECT FIELD_ID, CROP_NAME, CROP_SEASON, CAST(Date AS VARCHAR) AS Date, Hour,
               {_rounded('Base_Fahrenheit', 'Upper_Fahrenheit', 'temp_combined_avg', 'temp_wt_avg')},
               {_text('seeding_date', 'harvest_date')}
        FROM heat_input""",
    "gdh_hourly": f"SELECT {_HEAT} FROM heat",
    "gdh_one_field": f"SELECT {_HEAT} FROM heat WHERE FIELD_ID = '144'",
    "gdh_since": f"SELECT {_HEAT} FROM heat WHERE GDH_DATE >= DATE '{SINCE}'",
    "gdh_with_nan": f"SELECT {_HEAT} FROM heat",
    "gdh_daily": _DAILY,
    "latest_gdh_date": "SELECT CAST(max(GDH_DATE) AS VARCHAR) AS GDH_DATE FROM loaded",
    "gdh_push_rows": _PUSHED,
    "gdh_pushed_twice": _PUSHED.replace("SELECT", "SELECT DISTINCT", 1),
    "gdh_dedup": "SELECT DISTINCT FIELD_ID, CROP_SEASON, CAST(GDH_DATE AS VARCHAR) AS GDH_DATE FROM loaded",
}


def _needed(sql: str) -> list[str]:
    """Steps a statement uses, each after the steps it uses itself."""
    found: list[str] = []

    def visit(text: str, busy: tuple[str, ...]) -> None:
        for name in STEPS:
            if name in found or name in busy or not re.search(rf"(FROM|JOIN)\s+{name}\b", text):
                continue
            visit(STEPS[name], (*busy, name))
            found.append(name)

    visit(sql, ())
    return found


# Steps that a query sees otherwise: temperatures that a query's mapping turns into NaN are missing ones.
CHANGED: dict[str, dict[str, str]] = {
    "gdh_with_nan": {
        "readings": """
        SELECT station_id, date_time, year,
               CASE WHEN air_temp_set_1 >= 35 AND CAST(substr(station_id, 2) AS INTEGER) % 7 <> 0 THEN air_temp_set_1 END
                 AS air_temp_set_1
        FROM (SELECT 'S' || user_id AS station_id, date_trunc('minute', ts) AS date_time,
                     CASE WHEN event_type <> 'error' THEN 30 + 4e0 * sqrt(value) END AS air_temp_set_1,
                     CAST(year(ts) AS INTEGER) AS year
              FROM events)"""
    }
}


def oracle_queries() -> dict[str, str]:
    statements = {}
    for name, sql in FINAL.items():
        steps = _needed(sql)
        own = {**STEPS, **CHANGED.get(name, {})}
        head = "WITH " + ", ".join(f"{step} AS MATERIALIZED ({own[step]})" for step in steps) + " " if steps else ""
        statements[name] = head + sql
    return statements
