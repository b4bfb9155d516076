import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from fieldheat.plans.catalogue import QUERIES, Tables
from fieldheat.schemas import GDH
from fieldheat.sources import gdh_table

ROWS = [
    ("F1", "corn", 2022, date(2022, 5, 1), 5, date(2022, 4, 1), date(2022, 9, 1), 12.5),
    ("F1", "wheat", 2022, date(2022, 5, 1), 5, date(2022, 4, 1), date(2022, 9, 1), 10.0),
    ("F1", "corn", 2021, date(2021, 5, 1), 6, date(2021, 4, 1), date(2021, 9, 1), None),
]


@pytest.fixture
def gdh(table):
    return table(ROWS, GDH)


@pytest.fixture
def name(spark):
    yield "gdh_under_test"
    for found in spark.catalog.listTables():
        if found.name.startswith("gdh_under_test"):
            spark.sql(f"DROP TABLE IF EXISTS {found.name}")


def test_row_key(gdh, table):
    keys = [r.ID for r in gdh_table.rows_to_push(gdh).collect()]
    assert keys == ["5_F1_2022-05-01", "5_F1_2022-05-01", "6_F1_2021-05-01"]
    assert gdh_table.rows_to_push(gdh, key="with_crop").first().ID == "5_F1_2022-05-01_corn"
    assert gdh_table.rows_to_push(gdh).columns[-2:] == ["GDH", "ID"]
    assert gdh_table.rows_to_push(table([(None,) * 8], GDH)).first().ID == "NA_NA_NA"


def contents(spark, name):
    columns = sorted(spark.table(name).columns)
    return sorted(map(str, spark.table(name).select(*columns).collect()))


@pytest.mark.parametrize("partitions", [[], ["CROP_SEASON"]])
def test_pushing_twice_and_removing_duplicates_is_pushing_once(spark, gdh, name, partitions):
    assert gdh_table.push(gdh, name, partition_by=partitions) == 3
    once = contents(spark, name)
    assert gdh_table.push(gdh.select(*reversed(gdh.columns)), name) == 3
    assert spark.table(name).count() == 6
    for _ in range(2):
        gdh_table.remove_duplicates(spark, name)
        assert contents(spark, name) == once
    assert tables(spark, name) == [name]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == partitions


def tables(spark, name):
    """The table and copies of it."""
    return [t.name for t in spark.catalog.listTables() if t.name.startswith(name) and not t.name.endswith("__checked")]


class Died(Exception):
    pass


def die_at(monkeypatch, spark, statement):
    """Let remove_duplicates die just before the first SQL statement that holds a text."""
    plain = type(spark).sql

    def sql(self, query, *args, **kwargs):
        if statement in query:
            raise Died
        return plain(self, query, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)


@pytest.mark.parametrize("partitions", [[], ["CROP_SEASON"]])
@pytest.mark.parametrize("statement", ["fieldheat.copy_of", "fieldheat.overwriting", "RENAME TO", "__distinct_", "DROP TABLE"])
def test_recovery_of_an_interrupted_removal(spark, gdh, name, partitions, statement, monkeypatch):
    """Rows added after the death are kept, whatever the removal had done by then."""
    gdh_table.push(gdh, name, partition_by=partitions)
    once = contents(spark, name)
    gdh_table.push(gdh, name)
    with monkeypatch.context() as patch:
        die_at(patch, spark, statement)
        try:
            gdh_table.remove_duplicates(spark, name)
        except Died:
            pass
    gdh_table.push(gdh.limit(1), name)
    assert sorted(set(contents(spark, name))) == once
    assert spark.table(name).count() in (4, 7)
    gdh_table.remove_duplicates(spark, name)
    assert contents(spark, name) == once
    assert tables(spark, name) == [name]


def test_a_half_written_table_is_filled_from_its_copy(spark, gdh, name):
    gdh_table.push(gdh, name, partition_by=["CROP_SEASON"])
    once = contents(spark, name)
    copy = f"{name}__distinct_x"
    spark.table(name).write.saveAsTable(copy)
    gdh_table._mark(spark, copy, gdh_table.COPY_OF, "")
    gdh_table._mark(spark, copy, gdh_table.OVERWRITING, "true")
    spark.sql(f"TRUNCATE TABLE {name}")
    gdh_table.recover(spark, name)
    assert contents(spark, name) == once


def test_rows_appended_beside_a_finished_copy_are_kept(spark, gdh, name):
    gdh_table.push(gdh.limit(1), name, partition_by=["CROP_SEASON"])
    spark.table(name).write.saveAsTable(f"{name}__distinct_x")
    gdh_table._mark(spark, f"{name}__distinct_x", gdh_table.COPY_OF, "")
    rows = gdh_table.rows_to_push(gdh.filter("CROP_SEASON = 2021"))
    rows.write.mode("append").partitionBy("CROP_SEASON").saveAsTable(name)
    gdh_table.recover(spark, name)
    assert spark.table(name).count() == 2


def test_a_copy_that_died_being_written_is_not_in_the_way(spark, gdh, name, tmp_path):
    from pathlib import Path

    gdh_table.push(gdh, name)
    gdh_table.push(gdh, name)
    left = Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")) / f"{name}__distinct" / "_temporary"
    left.mkdir(parents=True)
    gdh_table.remove_duplicates(spark, name)
    assert spark.table(name).count() == 3


def test_rows_added_while_copying_are_not_lost(spark, gdh, name, monkeypatch):
    gdh_table.push(gdh, name)
    added = []

    def distinct(df):
        if not added:
            added.append(True)
            gdh_table.rows_to_push(gdh.withColumn("CROP_NAME", F.lit("oats"))).write.mode("append").saveAsTable(name)
        return df.distinct()

    monkeypatch.setattr(gdh_table, "distinct_rows", distinct)
    gdh_table.remove_duplicates(spark, name)
    assert spark.table(name).count() == 6


def test_recomputed_hours_replace_old_ones(spark, gdh, name):
    gdh_table.push(gdh, name)
    newer = gdh.filter("CROP_NAME = 'corn'").withColumn("gdh", F.lit(1.0))
    found = gdh_table.replace_hours(newer, name)
    assert sorted(r.GDH for r in found.collect()) == [1.0, 1.0, 10.0]


def test_high_water_mark(gdh, table):
    assert gdh_table.latest_date(gdh).first().GDH_DATE == date(2022, 5, 1)
    assert gdh_table.latest_date(table([], GDH)).collect()[0].GDH_DATE is None
    assert gdh_table.after_latest(gdh, gdh.filter("CROP_SEASON = 2021")).count() == 2
    assert gdh_table.after_latest(gdh, table([], GDH)).count() == 3


def test_csv(spark, gdh, tmp_path):
    path = gdh_table.write_csv(gdh, str(tmp_path), date(2024, 7, 1))
    assert path.endswith("GDH-2024-07-01")
    back = spark.read.option("header", True).csv(path)
    assert back.columns == gdh.columns and back.count() == 3


def test_compressed_csv(spark, gdh, tmp_path):
    path = gdh_table.write_csv(gdh, str(tmp_path), date(2024, 7, 1), compression="gzip")
    back = spark.read.schema(gdh.schema).option("header", True).csv(path)
    assert back.inputFiles() and all(file.endswith(".csv.gz") for file in back.inputFiles())
    assert sorted(map(str, back.collect())) == sorted(map(str, gdh.collect()))


def test_the_csv_query_writes_compressed_files(spark, gdh, monkeypatch):
    monkeypatch.setattr(Tables, "gdh", lambda self: gdh)
    back = QUERIES["gdh_csv"](spark, "none")
    assert back.inputFiles() and all(file.endswith(".csv.gz") for file in back.inputFiles())
    assert back.count() == 3


def files(spark, name):
    spark.catalog.refreshTable(name)
    return set(spark.table(name).inputFiles())


DAYS = [
    (f"F{n % 4}", "corn", 2020 + n % 3, date(2020 + n % 3, 5, 1 + n % 5), n % 24, date(2020, 4, 1), date(2020, 9, 1), 1.0 * n)
    for n in range(60)
]


@pytest.fixture
def seasons_table(spark, table, name):
    gdh_table.push(table(DAYS, GDH), name, partition_by=["CROP_SEASON"])
    return name


def test_replacing_rewrites_touched_partitions_only(spark, table, seasons_table):
    before = files(spark, seasons_table)
    fresh = [(*row[:7], -1.0) for row in DAYS if row[0] == "F1" and row[2] == 2021]
    assert gdh_table.replace(table(fresh, GDH), seasons_table) == 1
    after = files(spark, seasons_table)
    assert {f for f in before if "CROP_SEASON=2021" not in f} == {f for f in after if "CROP_SEASON=2021" not in f}
    assert not {f for f in before if "CROP_SEASON=2021" in f} & after
    expected = [row for row in DAYS if not (row[0] == "F1" and row[2] == 2021)] + fresh
    found = spark.table(seasons_table).selectExpr("FIELD_ID", "CROP_SEASON", "HOUR", "GDH").collect()
    assert sorted(map(tuple, found)) == sorted((r[0], r[2], r[4], r[7]) for r in expected)


def test_keys_without_new_rows_lose_theirs_and_partitions_may_become_empty(spark, table, seasons_table):
    gone = table([(f"F{n}", 2022) for n in range(4)] + [("F9", 2020)], "FIELD_ID string, CROP_SEASON int")
    assert gdh_table.replace(table([], GDH), seasons_table, keys=gone) == 1
    seasons = spark.table(seasons_table).groupBy("CROP_SEASON").count().collect()
    assert sorted(map(tuple, seasons)) == [(2020, 20), (2021, 20)]
    assert gdh_table.replace(table([], GDH), seasons_table) == 0
    moved = [("F1", "corn", 2023, date(2023, 5, 1), 1, date(2020, 4, 1), date(2020, 9, 1), 1.0)]
    assert gdh_table.replace(table(moved, GDH), seasons_table, key=["FIELD_ID"]) == 3
    seasons = spark.table(seasons_table).groupBy("CROP_SEASON").count().collect()
    assert sorted(map(tuple, seasons)) == [(2020, 15), (2021, 15), (2023, 1)]


def test_replacing_in_a_table_without_partitions(spark, table, name):
    gdh_table.push(table(DAYS, GDH), name)
    assert gdh_table.replace(table([(*DAYS[0][:7], -5.0)], GDH), name) == 1
    rows = spark.table(name).filter("FIELD_ID = 'F0' AND CROP_SEASON = 2020").collect()
    assert [r.GDH for r in rows] == [-5.0] and spark.table(name).count() == 56
    assert tables(spark, name) == [name]


@pytest.mark.parametrize("statement", ["fieldheat.copy_of", "fieldheat.overwriting", "DROP TABLE"])
def test_recovery_of_an_interrupted_replacement(spark, table, seasons_table, statement, monkeypatch):
    """The table holds either all old rows or all new ones, and the replacement can be repeated."""
    gone = table([(f"F{n}", 2022) for n in range(4)], "FIELD_ID string, CROP_SEASON int")
    fresh = table([(*row[:7], -1.0) for row in DAYS if row[0] == "F1" and row[2] == 2021], GDH)
    with monkeypatch.context() as patch:
        die_at(patch, spark, statement)
        try:
            gdh_table.replace(fresh, seasons_table, keys=gone)
        except Died:
            pass
    gdh_table.recover(spark, seasons_table)
    new = statement == "DROP TABLE"
    assert spark.table(seasons_table).count() == (40 if new else 60)
    assert spark.table(seasons_table).filter("GDH = -1.0").count() == (5 if new else 0)
    gdh_table.replace(fresh, seasons_table, keys=gone)
    assert spark.table(seasons_table).count() == 40 and tables(spark, seasons_table) == [seasons_table]


def test_one_new_day_rewrites_one_partition(spark, table, seasons_table):
    assert gdh_table.remove_duplicates(spark, seasons_table) == 0
    before = files(spark, seasons_table)
    again = [row for row in DAYS if row[2] == 2022][:3]
    gdh_table.push(table(again, GDH), seasons_table)
    assert gdh_table.remove_duplicates(spark, seasons_table) == 1
    after = files(spark, seasons_table)
    assert {f for f in before if "=2022" not in f} == {f for f in after if "=2022" not in f}
    assert spark.table(seasons_table).count() == 60
    # Nothing was added since, so nothing is looked at; new rows without duplicates are not rewritten.
    assert gdh_table._unchecked(spark, seasons_table, gdh_table.partition_states(spark, seasons_table)).count() == 0
    gdh_table.push(table([(*DAYS[0][:7], 0.5)], GDH), seasons_table)
    states = gdh_table._unchecked(spark, seasons_table, gdh_table.partition_states(spark, seasons_table))
    assert [(r.CROP_SEASON, r.rows) for r in states.collect()] == [(2020, 21)]
    grown = files(spark, seasons_table)
    assert gdh_table.remove_duplicates(spark, seasons_table) == 0 and files(spark, seasons_table) == grown


def test_steady_appends_end_a_removal(spark, gdh, name, monkeypatch):
    """It gives up after some attempts, and the table keeps all rows."""
    gdh_table.push(gdh, name)

    def distinct(df):
        gdh_table.rows_to_push(gdh).write.mode("append").saveAsTable(name)
        return df.distinct()

    monkeypatch.setattr(gdh_table, "distinct_rows", distinct)
    with pytest.raises(RuntimeError):
        gdh_table.remove_duplicates(spark, name)
    assert spark.table(name).count() == 3 * (1 + gdh_table.ATTEMPTS) and tables(spark, name) == [name]


def test_partitions_of_several_columns_and_null_values(spark, table, name):
    rows = [*DAYS[:20], *DAYS[:5], ("F1", None, None, date(2020, 5, 1), 1, None, None, 1.0)] + [("F1", None, None, date(2020, 5, 1), 1, None, None, 1.0)]
    gdh_table.push(table(rows, GDH), name, partition_by=["CROP_NAME", "CROP_SEASON"])
    assert gdh_table.remove_duplicates(spark, name) == 4
    assert spark.table(name).count() == 21
    assert gdh_table.remove_duplicates(spark, name) == 0
    lost = table([("F1", None)], "FIELD_ID string, CROP_SEASON int")
    assert gdh_table.replace(table([], GDH), name, keys=lost) == 1
    assert spark.table(name).count() == 20


def test_what_is_left_in_a_table_is_read_where_it_was_written(spark, gdh):
    def work(name, path):
        gdh_table.push(gdh, name, partition_by=["CROP_SEASON"], path=path)
        gdh_table.replace(gdh, name)

    left = Tables(spark, "none").through_table(work)
    files = left.inputFiles()
    assert files and all("/gdh_table-" in file and "/CROP_SEASON=" in file and ".zstd." in file for file in files)
    pushed = gdh_table.rows_to_push(gdh)
    assert left.schema["CROP_SEASON"].dataType == pushed.schema["CROP_SEASON"].dataType
    assert sorted(map(str, left.select(*pushed.columns).collect())) == sorted(map(str, pushed.collect()))


def test_rows_are_not_sorted_to_be_written_by_season(spark, gdh, table, seasons_table):
    """Sorting a large table's rows by partition before they are overwritten spilled more than the rows' size."""
    before = files(spark, seasons_table)
    mixed = table([(f"N{n % 3}", "corn", 2015 + n % 12, date(2022, 5, 1), 5, None, None, float(n)) for n in range(40)], GDH)
    gdh_table.rows_to_push(mixed).select(*spark.table(seasons_table).columns).createOrReplaceTempView("mixed_rows")
    text = spark.sql(f"EXPLAIN INSERT INTO {seasons_table} SELECT * FROM mixed_rows").first()[0]
    assert "CROP_SEASON" in text and "Sort" not in text
    gdh_table.push(mixed, seasons_table)
    assert before < files(spark, seasons_table)
    assert spark.table(seasons_table).filter("FIELD_ID LIKE 'N%'").count() == 40


def test_rows_are_dealt_once_as_they_lie_to_be_compared(spark, seasons_table, monkeypatch):
    """Comparing them before they were dealt as well spilled and doubled what is shuffled."""
    monkeypatch.setattr(gdh_table, "ROWS_PER_TASK", 50)
    rows = spark.table(seasons_table)
    compared = gdh_table.distinct_rows(gdh_table._dealt_for_comparison(rows.unionByName(rows), 120))
    text = compared._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\w+)#\d+, (\d+)\)", text) == [("FIELD_ID", "CROP_SEASON", "3")]
    assert text.index("HashAggregate") < text.index("Exchange") and "HashAggregate" not in text[text.index("Exchange") :]
    assert sorted(map(str, compared.collect())) == sorted(map(str, rows.collect()))
    other = rows.select("GDH", "HOUR")
    assert gdh_table._dealt_for_comparison(other, 120) is other


def test_duplicates_of_many_fields_are_removed_by_several_tasks(spark, table, name, monkeypatch):
    monkeypatch.setattr(gdh_table, "ROWS_PER_TASK", 7)
    once = gdh_table.rows_to_push(table(DAYS, GDH)).count()
    for _ in range(3):
        gdh_table.push(table([*DAYS, *DAYS[:9]], GDH), name, partition_by=["CROP_SEASON"])
    assert gdh_table.remove_duplicates(spark, name) == 3
    assert spark.table(name).count() == spark.table(name).distinct().count() == once
