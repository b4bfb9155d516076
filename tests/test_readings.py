import json
from datetime import date, datetime

from fieldheat.operators import readings as op
from fieldheat.schemas import READINGS, STATION_TIMESERIES
from fieldheat.sources.landed import read_station_metadata, read_timeseries
from fieldheat.streaming.landing import load_landed

RANGES = "station_id STRING, CROP_SEASON INT, seeding_date DATE, harvest_date DATE"


def day(d, month=1):
    return date(2022, month, d)


def split(table, first, last, **options):
    found = op.date_windows(table([("S", 2022, first, last)], RANGES), **options)
    return sorted((r.starts.day, r.ends.day) for r in found.collect())


def test_date_windows(table):
    assert split(table, day(1), day(10), days=5) == [(1, 5), (6, 10)]
    assert split(table, day(1), day(12), days=5) == [(1, 5), (6, 10), (11, 12)]
    assert split(table, day(1), day(3), days=5) == [(1, 3)]
    assert split(table, day(1), day(3), days=1) == [(1, 1), (2, 2), (3, 3)]
    assert split(table, day(1), day(6), days=5, as_of=day(6)) == [(1, 5)]
    assert split(table, day(4), day(3), days=5) == []


def test_plan_covers_all_fields_of_a_station(table):
    rows = [("S", 2022, day(5), day(9)), ("S", 2022, day(3), day(7)), ("S", 2021, day(1), day(2))]
    found = op.station_season_plan(table(rows, RANGES)).orderBy("CROP_SEASON").collect()
    assert [tuple(r) for r in found] == [("S", 2021, day(1), day(2)), ("S", 2022, day(3), day(9))]


def reading(station, moment, temp=50.0):
    return (station, moment, temp, moment.year)


def test_readings_by_plan_ends_at_midnight_and_takes_each_once(table):
    moments = [datetime(2022, 1, 3), datetime(2022, 1, 3, 0, 5), datetime(2022, 1, 1), datetime(2021, 12, 31, 23, 59)]
    rows = [reading("S", m) for m in moments] + [reading("T", moments[0])]
    plan = [("S", 2022, day(1), day(3)), ("S", 2021, day(2), day(3))]
    found = op.readings_by_plan(table(rows, READINGS), table(plan, RANGES)).collect()
    assert sorted(r.date_time for r in found) == [datetime(2022, 1, 1), datetime(2022, 1, 3)]


def test_readings_all_share_one_range(table):
    rows = [reading(s, datetime(2022, 1, d)) for s in "STU" for d in range(1, 12)]
    stations = table([("S", 2022, day(3), day(5)), ("T", 2022, day(4), day(6))], RANGES)
    found = op.readings_all(table(rows, READINGS), stations).collect()
    assert sorted((r.station_id, r.date_time.day) for r in found) == [(s, d) for s in "ST" for d in (3, 4, 5, 6)]
    assert op.readings_all(table(rows, READINGS), stations, day(1), day(2)).count() == 4


def test_field_readings_match_on_the_calendar_year(table):
    rows = [reading("S", datetime(2022, 1, 1)), reading("S", datetime(2021, 12, 1))]
    found = op.field_readings(table([("S", 2022, day(1), day(3))], RANGES), table(rows, READINGS))
    assert [r.date_time for r in found.collect()] == [datetime(2022, 1, 1)]


def response(*stations):
    return {
        "STATION": [
            {"STID": s, "OBSERVATIONS": {"date_time": times, "air_temp_set_1": temps}} for s, times, temps in stations
        ]
    }


TWO = response(
    ("S", ["2022-01-01T00:00:00Z", "2022-01-01T01:30:00Z"], [40.0, None]), ("T", ["2022-01-01T00:00:00Z"], [41.5])
)
EXPECTED = [
    ("S", datetime(2022, 1, 1), 40.0, 2022),
    ("S", datetime(2022, 1, 1, 1, 30), None, 2022),
    ("T", datetime(2022, 1, 1), 41.5, 2022),
]


def test_parallel_arrays_keep_their_own_station(table):
    rows = [([("S", (["2022-01-01T00:00:00Z", "soon"], [float("nan"), 1.0]))],)]
    found = op.timeseries_readings(table(rows, STATION_TIMESERIES)).collect()
    assert [tuple(r) for r in found] == [("S", datetime(2022, 1, 1), None, 2022), ("S", None, 1.0, None)]


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(TWO, indent=1))
    assert sorted(tuple(r) for r in read_timeseries(spark, str(tmp_path)).collect()) == EXPECTED
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text(json.dumps(TWO) + "\n" + json.dumps(response()) + "\n")
    assert sorted(tuple(r) for r in read_timeseries(spark, str(lines), lines=True).collect()) == EXPECTED
    metadata = tmp_path / "metadata"
    metadata.mkdir()
    (metadata / "a.json").write_text(json.dumps({"STATION": [{"STID": "S", "LATITUDE": "43.5", "SHORTNAME": "X"}]}))
    (station,) = read_station_metadata(spark, str(metadata)).first().STATION
    assert (station.STID, station.LATITUDE, station.STATUS) == ("S", "43.5", None)


def test_stream_takes_each_file_once(spark, tmp_path):
    landed, stored, marks = tmp_path / "landed", str(tmp_path / "stored"), str(tmp_path / "marks")
    landed.mkdir()

    def load():
        load_landed(spark, str(landed), stored, marks, files_per_batch=1).awaitTermination()
        rows = spark.read.parquet(stored).select("station_id", "date_time", "air_temp_set_1", "year")
        return sorted(tuple(r) for r in rows.collect())

    (landed / "a.json").write_text(json.dumps(TWO))
    assert load() == EXPECTED
    assert load() == EXPECTED
    (landed / "b.json").write_text(json.dumps(response(("U", ["2023-01-01T00:00:00Z"], [42.0]))))
    assert load() == [*EXPECTED, ("U", datetime(2023, 1, 1), 42.0, 2023)]
