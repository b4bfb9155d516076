from datetime import date, datetime

import pytest

from fieldheat.operators.seasons import clean_seasons, crop_operations, season_windows
from fieldheat.schemas import CROP_THRESHOLDS, FIELD_OPERATIONS, LOADED_GDH

AS_OF = date(2024, 7, 1)


def op(kind, day, season=2020, crop="corn", end=None, field="F1"):
    start = None if day is None else datetime.combine(day, datetime.min.time())
    return (field, kind, crop, str(season), start, datetime(season, 12, 1) if end is None else end)


@pytest.fixture
def windows(table):
    def run(rows, loaded=(), **options):
        crops = table([("corn", 50.0, 86.0), ("corn", 51.0, 86.0)], CROP_THRESHOLDS)
        found = season_windows(table(rows, FIELD_OPERATIONS), table(list(loaded), LOADED_GDH), crops, **options)
        return found.orderBy("FIELD_ID", "CROP_SEASON").collect()

    return run


def test_two_dates_make_a_type_vanish(windows):
    rows = [op("seeding", date(2020, 4, 1)), op("seeding", date(2020, 4, 2)), op("harvest", date(2020, 9, 1))]
    (found,) = windows(rows)
    assert (found.seeding_date, found.harvest_date) == (date(2020, 1, 1), date(2020, 9, 1))
    assert windows(rows, fallback=None) == []


def test_rows_alike_but_for_the_end_are_one(windows):
    rows = [op("seeding", date(2020, 4, 1)), op("seeding", date(2020, 4, 1), end=datetime(2020, 4, 9))]
    (found,) = windows(rows)
    assert (found.seeding_date, found.harvest_date) == (date(2020, 4, 1), date(2020, 12, 31))


def test_unknown_date_beside_a_known_one_is_ambiguous(windows):
    (found,) = windows([op("seeding", date(2020, 4, 1)), op("seeding", None), op("harvest", date(2020, 9, 1))])
    assert found.seeding_date == date(2020, 1, 1)


def test_loaded_range_fills_both_ends(windows):
    loaded = [("F1", 2020, date(2020, 5, d)) for d in (3, 9)]
    rows = [op("application", date(2020, 6, 1))]
    (found,) = windows(rows, loaded)
    assert (found.seeding_date, found.harvest_date) == (date(2020, 5, 3), date(2020, 5, 9))
    (found,) = windows(rows, loaded, fallback="year", extra_types=["application"])
    assert (found.seeding_date, found.harvest_date) == (date(2020, 1, 1), date(2020, 12, 31))
    assert found.application == date(2020, 6, 1)


def test_only_known_crops_and_late_seasons(windows):
    rows = [
        op("seeding", date(2018, 4, 1), season=2018),
        op("seeding", date(2020, 4, 1), crop="moss"),
        op("seeding", date(2020, 4, 1), crop=None),
        op("seeding", date(2019, 4, 1), season=2019),
        ("F1", "seeding", "corn", "unknown", datetime(2020, 4, 1), None),
    ]
    assert [r.CROP_SEASON for r in windows(rows)] == [2019]


def test_crop_operations_bounds_are_exclusive(table):
    rows = [op("seeding", date(year, 4, 1), season=year, crop="moss") for year in (2020, 2021, 2022)]
    found = crop_operations(table(rows, FIELD_OPERATIONS), table([], CROP_THRESHOLDS), 2020, 2022).collect()
    assert [(r.CROP_SEASON, r.DATE) for r in found] == [(2021, datetime(2021, 4, 1))]


def test_crop_operations_wide_requirements(table):
    rows = [op("seeding", date(2020, 4, 1)), op("harvest", date(2020, 9, 1))]
    crops = table([("corn", 50.0, 86.0)], CROP_THRESHOLDS)

    def wide(**options):
        return crop_operations(table(rows, FIELD_OPERATIONS), crops, shape="wide", **options).collect()

    assert len(wide()) == 1
    assert wide(extra_types=["application"]) == []
    assert len(wide(extra_types=["application"], require="seeding_harvest")) == 1


def clean(table, rows, method, **options):
    found = clean_seasons(table(rows, FIELD_OPERATIONS), method, AS_OF, **options)
    return sorted((r.seeding_date, r.harvest_date) for r in found.collect())


def test_historic_pairs_by_number(table):
    rows = [op("seeding", date(2020, 4, 1)), op("seeding", date(2020, 5, 1)), op("seeding", date(2020, 6, 1))]
    rows += [op("harvest", date(2020, 9, 2)), op("harvest", date(2020, 9, 1)), op("seeding", date(2024, 4, 1), season=2024)]
    assert clean(table, rows, "historic") == [
        (date(2020, 4, 1), date(2020, 9, 1)),
        (date(2020, 5, 1), date(2020, 9, 2)),
    ]


def test_historic_counts_rows_that_differ_in_end(table):
    twice = [op("seeding", date(2020, 4, 1)), op("seeding", date(2020, 4, 1), end=datetime(2020, 4, 9))]
    twice += [op("harvest", date(2020, 9, 1)), op("harvest", date(2020, 9, 1), end=datetime(2020, 9, 9))]
    assert clean(table, twice + twice, "historic") == [(date(2020, 4, 1), date(2020, 9, 1))] * 2


def test_historic_with_one_busy_key(spark, table):
    """More operations on one day than fit a block, against plain numbering."""
    n = 10_000
    busy = spark.range(n).selectExpr(
        "'F1' AS FIELD_ID", "if(id % 2 = 0, 'seeding', 'harvest') AS FIELD_OPERATION_TYPE", "'corn' AS CROP_NAME",
        "'2020' AS CROP_SEASON", "TIMESTAMP'2020-04-01' + make_interval(0, 0, 0, CAST(id % 3 AS INT)) AS START_DATE",
        "TIMESTAMP'2020-10-01' + make_interval(0, 0, 0, 0, 0, 0, id) AS END_DATE",
    )
    rows = busy.collect()
    dates = {
        kind: sorted((r.START_DATE, r.END_DATE) for r in rows if r.FIELD_OPERATION_TYPE == kind)
        for kind in ("seeding", "harvest")
    }
    expected = sorted((s[0].date(), h[0].date()) for s, h in zip(dates["seeding"], dates["harvest"]))
    found = clean_seasons(busy, "historic", AS_OF).collect()
    assert sorted((r.seeding_date, r.harvest_date) for r in found) == expected


def test_current_is_open_until_today(table):
    rows = [op("seeding", date(2024, 4, 1), season=2024), op("harvest", date(2024, 6, 1), season=2024)]
    rows += [op("seeding", None, season=2024), op("seeding", date(2023, 4, 1), season=2023)]
    assert clean(table, rows, "current") == [(date(2024, 4, 1), AS_OF)]
    assert clean(table, rows, "current", use_actual_harvest=True) == [(date(2024, 4, 1), date(2024, 6, 1))]


def test_unknown_choices_raise(table, windows):
    with pytest.raises(ValueError):
        clean(table, [], "recent")
    with pytest.raises(ValueError):
        windows([], fallback="guess")
