"""Recomputing what changes touch gives the rows of a full run, and touches nothing else."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldheat.operators.readings import station_season_plan
from fieldheat.plans import changes
from fieldheat.plans.season_heat import season_degree_hours
from fieldheat.schemas import CROP_THRESHOLDS
from tests.test_plans import PAIRS, plan

BATCHED = "station_id string, date_time timestamp, air_temp_set_1 double, year int, batch int"


@pytest.fixture(scope="module")
def farm(spark):
    """F and G share station S; G and H share T; I has U alone. H's range on T ends on a day that G's only touches."""
    pairs = [
        ("F", 2021, "c", "S", date(2021, 5, 1), date(2021, 5, 10), 0.0, 0.0),
        ("G", 2021, "c", "S", date(2021, 5, 3), date(2021, 5, 12), 0.0, 0.0),
        ("G", 2021, "c", "T", date(2021, 5, 3), date(2021, 5, 12), 0.0, 0.0),
        ("H", 2021, "c", "T", date(2021, 5, 8), date(2021, 5, 20), 0.0, 0.0),
        ("I", 2021, "c", "U", date(2021, 5, 1), date(2021, 5, 20), 0.0, 0.0),
    ]
    rows = [
        (s, datetime(2021, 5, d, h), float(d + h), 2021, 1) for s in "STU" for d in range(1, 22) for h in (0, 6, 12)
    ]
    crops = spark.createDataFrame([("c", 10.0, 40.0)], CROP_THRESHOLDS)
    return spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(rows, BATCHED), crops


def names(df):
    return sorted(r.FIELD_ID for r in df.collect())


def late(spark, *rows):
    return spark.createDataFrame([(s, t, v, t.year, 2) for s, t, v in rows], BATCHED)


CASES = {
    "late hour at a shared station": ([("S", datetime(2021, 5, 4, 15), 90.0)], ["F", "G"]),
    "correction of one field's hours": ([("T", datetime(2021, 5, 15, 6), 1.0)], ["H"]),
    "midnight of the last day": ([("U", datetime(2021, 5, 20), 3.0)], ["I"]),
    "last day after midnight": ([("U", datetime(2021, 5, 20, 6), 3.0)], []),
    "outside all ranges": ([("U", datetime(2021, 5, 21, 6), 3.0), ("X", datetime(2021, 5, 4), 1.0)], []),
    "a known reading goes missing": ([("S", datetime(2021, 5, 11, 6), None)], ["G"]),
}


@pytest.mark.parametrize("case", CASES)
def test_late_and_corrected_readings(spark, farm, case):
    pairs, measured, crops = farm
    added, expected = CASES[case]
    both = measured.unionByName(late(spark, *added))
    planned = station_season_plan(pairs)
    touched = changes.touched_by_readings(changes.changed_days(both, "batch", after=1), pairs, planned)
    assert names(touched) == expected
    current = changes.current_readings(both, "batch")
    before = season_degree_hours(pairs, measured, pairs, crops)
    after = season_degree_hours(pairs, current, pairs, crops)
    moved = before.exceptAll(after).unionByName(after.exceptAll(before))
    assert set(names(moved.select("FIELD_ID").distinct())) <= set(expected)
    fresh = changes.recomputed(pairs, current, pairs, crops, planned, touched)
    own = after.join(touched, ["FIELD_ID", "CROP_SEASON"], "left_semi")
    assert sorted(map(str, fresh.collect())) == sorted(map(str, own.select(*fresh.columns).collect()))


def test_a_new_field_touches_those_whose_stations_it_extends(farm):
    pairs, measured, crops = farm
    old = pairs.filter("FIELD_ID <> 'H'")
    by_plan = changes.touched_by_plan(pairs, station_season_plan(pairs), station_season_plan(old))
    assert names(by_plan) == ["G", "H"]
    columns = ["station_id", "CROP_NAME", "seeding_date", "harvest_date"]
    assert names(changes.touched_by_rows(pairs, old, columns)) == ["H"]
    assert names(changes.touched_by_rows(old, pairs, columns)) == ["H"]
    moved = pairs.withColumn("harvest_date", F.when(F.col("FIELD_ID") == "I", F.lit(date(2021, 5, 18))).otherwise(F.col("harvest_date")))
    assert names(changes.touched_by_rows(moved, pairs, columns)) == ["I"]
    assert names(changes.touched_by_rows(pairs, pairs, columns)) == []
    assert names(changes.touched_by_plan(pairs, station_season_plan(pairs), station_season_plan(pairs))) == []


def test_readings_in_buckets_are_averaged_where_they_are_read(spark, farm, tmp_path):
    from fieldheat.sources import readings_table

    pairs, measured, crops = farm
    for name, df in (("pairs", pairs), ("crops", crops)):
        df.write.parquet(str(tmp_path / name))
    pairs, crops = spark.read.parquet(str(tmp_path / "pairs")), spark.read.parquet(str(tmp_path / "crops"))
    readings_table.store(measured.drop("batch"), "readings_under_test", 3, path=str(tmp_path / "readings"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        stored = spark.table("readings_under_test")
        heat = season_degree_hours(pairs, stored, pairs, crops, buckets=3)
        text = plan(heat)
        shuffled = [p for p in text.split("\n\n") if re.match(r"\(\d+\) Exchange", p)]
        assert "Bucketed: true" in text
        # Neither readings nor hourly means; days are, with the fields' shares.
        assert not any("air_temp_set_1" in p or "midnight_avg" in p or "Hour#" in p for p in shuffled)
        assert any("known#" in p and "share#" in p for p in shuffled)
        assert sorted(map(str, heat.collect())) == sorted(
            map(str, season_degree_hours(pairs, measured, pairs, crops).collect())
        )
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.sql("DROP TABLE readings_under_test")


def test_touched_field_seasons_meet_the_chosen_stations_once(spark, farm, tmp_path):
    """The plan of the recomputation does not repeat that join for each reading of the stations."""
    pairs, measured, crops = farm
    spark.createDataFrame([("G", 2021)], "FIELD_ID STRING, CROP_SEASON INT").write.parquet(str(tmp_path / "touched"))
    touched = spark.read.parquet(str(tmp_path / "touched"))
    fresh = changes.recomputed(pairs, measured.drop("batch"), pairs, crops, station_season_plan(pairs), touched)
    assert len(re.findall(r"Location: \w+ \[[^\]]*/touched\]", plan(fresh))) == 1
    assert set(names(fresh.select("FIELD_ID").distinct())) == {"G"}
