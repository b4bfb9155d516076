"""The degree-hour table: high-water mark, append, replacement, and removal of duplicates."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fieldheat.functions.rows import observed
from fieldheat.schemas import require_columns
from fieldheat.sources.staging import stage


# Degree hours and their row keys take some 40 % less room than with Parquet's default, in about the same time.
COMPRESSION = "zstd"


def latest_date(loaded: DataFrame) -> DataFrame:
    """One row with the last date loaded; NULL for an empty table."""
    require_columns(loaded, "GDH_DATE")
    return loaded.agg(F.max("GDH_DATE").alias("GDH_DATE"))


def after_latest(df: DataFrame, loaded: DataFrame, date_col: str = "GDH_DATE") -> DataFrame:
    """Rows later than anything loaded, all rows if nothing is."""
    latest = latest_date(loaded).scalar()
    return df.filter(latest.isNull() | (F.col(date_col).cast("date") > latest))


def rows_to_push(gdh: DataFrame, key: str = "as_is") -> DataFrame:
    """Upper-case columns and the row key Hour_FIELD_ID_GDH_DATE.

    Two crops of a field share that key; "with_crop" adds the crop's name to it.
    """
    if key not in ("as_is", "with_crop"):
        raise ValueError(f"unknown key {key!r}")
    parts = ["Hour", "FIELD_ID", "GDH_DATE"] + (["CROP_NAME"] if key == "with_crop" else [])
    require_columns(gdh, *parts)
    text = [F.coalesce(F.col(part).cast("string"), F.lit("NA")) for part in parts]
    return gdh.withColumn("ID", F.concat_ws("_", *text)).toDF(*[name.upper() for name in gdh.columns], "ID")


def push(
    gdh: DataFrame, table: str, key: str = "as_is", partition_by: Sequence[str] = (), path: str | None = None
) -> int:
    """Append by column name; the first push creates the table, partitioned if asked, and at a path if one is given.

    Returns the rows pushed. Not to be run beside a replacement or a removal of duplicates, which it would take for a
    dead one.
    """
    spark = gdh.sparkSession
    recover(spark, table)
    there = spark.catalog.tableExists(table)
    partitions = _partition_columns(spark, table) if there else list(partition_by)
    rows, counted = observed(rows_to_push(gdh, key), "pushed")
    writer = rows.write.mode("append").partitionBy(*partitions).option("compression", COMPRESSION)
    if path is not None and not there:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return counted()


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


# By what a table's rows are dealt before they are compared, and how many a task gets, about 200 MB while it compares them.
DEALT_BY, ROWS_PER_TASK = ("FIELD_ID", "CROP_SEASON"), 2_000_000


def _dealt_for_comparison(rows: DataFrame, count: int) -> DataFrame:
    """Rows of a degree-hour table with equal ones in one task, dealt as they lie in its files.

    Otherwise each task that reads rows first looks for equal ones among its own, of which there are few, and sends on a shuffled
    heap of them, which takes twice the room. Other tables are left as they are.
    """
    if not set(DEALT_BY) <= set(rows.columns):
        return rows
    return rows.repartition(1 + count // ROWS_PER_TASK, *DEALT_BY)


# Marks on a copy, as table properties: the table's files when the copy was taken, set once it is complete, that
# the table is being overwritten from it, and the folders of partitions that are to be emptied then.
COPY_OF, OVERWRITING, EMPTIED = "fieldheat.copy_of", "fieldheat.overwriting", "fieldheat.emptied"
ATTEMPTS = 3


def _partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(table) if column.isPartition]


def _beside(spark: SparkSession, table: str, kind: str) -> list[str]:
    """Tables beside a table that removals and replacements have left, by kind: 'distinct' or 'replaced'."""
    database, _, name = table.rpartition(".")
    prefix = f"{name}__{kind}_".lower()
    listed = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    names = [t.name for t in listed if t.name.lower().startswith(prefix)]
    return [f"{database}.{n}" if database else n for n in names]


def partition_states(spark: SparkSession, table: str, only: Column | None = None) -> DataFrame:
    """A row per partition: its columns, `rows`, and `digest` of its files' paths. One row for a table without partitions.

    Counted by tasks that read the files' footers only; no list of files is gathered.
    """
    spark.catalog.refreshTable(table)
    columns = _partition_columns(spark, table)
    rows = spark.table(table) if only is None else spark.table(table).filter(only)
    files = rows.groupBy(*columns, F.col("_metadata.file_path").alias("file")).count()
    # Sums and not only one of them, so that neither pairs of files nor their number go unseen.
    digest = F.concat_ws(
        "-", F.count(F.lit(1)), F.expr("bit_xor(xxhash64(file))"), F.expr("bit_xor(xxhash64('second', file))")
    )
    return files.groupBy(*columns).agg(F.sum("count").alias("rows"), digest.alias("digest"))


def _digest(spark: SparkSession, table: str, only: Column | None = None) -> str:
    """What identifies the contents of some partitions."""
    states = partition_states(spark, table, only)
    each = F.sort_array(F.collect_list(F.xxhash64(*states.columns)))  # a number per partition
    return states.agg(F.sha2(F.array_join(each.cast("array<string>"), ","), 256)).first()[0]


def _in_partitions(partitions: list[Row]) -> Column:
    """A condition on partition columns alone, which Spark answers without opening files."""
    found = F.lit(False)
    by_rest: dict[tuple, list] = {}
    for row in partitions:  # one column is looked up in a list, the others are compared
        *rest, last = row.asDict().items()
        by_rest.setdefault((tuple(rest), last[0]), []).append(last[1])
    for (rest, name), values in by_rest.items():
        known = [v for v in values if v is not None]
        here = F.col(name).isin(known) if known else F.lit(False)
        if len(known) < len(values):
            here = here | F.col(name).isNull()
        for other, value in rest:
            here = here & F.col(other).eqNullSafe(F.lit(value))
        found = found | F.coalesce(here, F.lit(False))
    return found


def _mark(spark: SparkSession, table: str, name: str, value: str) -> None:
    quoted = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{name}' = '{quoted}')")


def _marks(spark: SparkSession, table: str) -> dict[str, str]:
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


@contextmanager
def _only_given_partitions(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces the partitions that rows are written to, and no others."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _overwrite(spark: SparkSession, table: str, fresh: str) -> None:
    """Put a copy's rows in the place of its partitions' rows (of all rows, without partitions); can be repeated."""
    if OVERWRITING not in _marks(spark, fresh):
        _mark(spark, fresh, OVERWRITING, "true")
    with _only_given_partitions(spark):
        spark.table(fresh).select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    for folder in json.loads(_marks(spark, fresh).get(EMPTIED, "[]")):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE {fresh}")


def recover(spark: SparkSession, table: str) -> None:
    """Settle a replacement or a removal of duplicates that died halfway; harmless otherwise.

    A copy is put into its table again only if it is marked as being written there, since the table may be half
    written then. Any other copy is dropped: its table is whole, with whatever was added since. If the table
    has lost its name, the replaced table gets it back, or else the complete copy takes it.
    """
    copies, replaced = _beside(spark, table, "distinct"), _beside(spark, table, "replaced")
    if not spark.catalog.tableExists(table):
        complete = [c for c in copies if COPY_OF in _marks(spark, c)]
        for name in [*replaced, *complete][:1]:
            spark.sql(f"ALTER TABLE {name} RENAME TO {table}")
            copies, replaced = [c for c in copies if c != name], [r for r in replaced if r != name]
    for name in copies:
        if OVERWRITING in _marks(spark, name):
            _overwrite(spark, table, name)
        else:
            spark.sql(f"DROP TABLE {name}")
    for name in replaced:
        spark.sql(f"DROP TABLE {name}")


def _put(spark: SparkSession, table: str, copied: Callable[[], DataFrame], where: Column | None, emptied: Callable) -> None:
    """Replace a table, or those of its partitions that a condition names, by what is worked out from them.

    It is written as a copy beside the table first. A table without partitions and its copy then swap names. Renaming does not
    carry partitions along on every catalog, so partitions are overwritten from the copy, and no others are touched. Each
    attempt has a name of its own, so what a dead one left is never in the way. If rows were added to the
    same partitions while the copy was taken, it is dropped and taken again, a few times at most.
    """
    partitions = _partition_columns(spark, table)
    for _ in range(ATTEMPTS):
        attempt = uuid.uuid4().hex[:12]
        fresh, old = f"{table}__distinct_{attempt}", f"{table}__replaced_{attempt}"
        before = _digest(spark, table, where)
        copied().write.partitionBy(*partitions).option("compression", COMPRESSION).saveAsTable(fresh)
        _mark(spark, fresh, COPY_OF, before)
        if _digest(spark, table, where) == before:
            break
        spark.sql(f"DROP TABLE {fresh}")
    else:
        raise RuntimeError(f"rows kept being added to {table}; nothing was changed")
    if partitions:
        if folders := emptied(fresh):
            _mark(spark, fresh, EMPTIED, json.dumps(folders))
        _overwrite(spark, table, fresh)
        return
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    spark.sql(f"DROP TABLE {old}")


def _checked(table: str) -> str:
    return f"{table}__checked"


def _unchecked(spark: SparkSession, table: str, states: DataFrame) -> DataFrame:
    """States of the partitions whose files are others than when they were last found without duplicates."""
    if not spark.catalog.tableExists(_checked(table)):
        return states
    known = spark.table(_checked(table)).withColumnRenamed("digest", "known")
    same = [states[c].eqNullSafe(known[c]) for c in _partition_columns(spark, table)]
    return states.join(known, [*same, states["digest"] == known["known"]], "left_anti")


def _remember(spark: SparkSession, table: str, states: DataFrame) -> None:
    """States in which partitions are known to hold no duplicates; those of other partitions stay as they were."""
    checked = _checked(table)
    if spark.catalog.tableExists(checked):
        known = spark.table(checked)
        same = [known[c].eqNullSafe(states[c]) for c in _partition_columns(spark, table)]
        states = known.join(states, same, "left_anti").unionByName(states)
    stage(states, "states").write.mode("overwrite").saveAsTable(checked)


def _holding_duplicates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Partitions with rows that are there twice.

    Rows are counted by a hash, a fraction of their size. Two that share it by chance have a partition rewritten that
    need not be, which loses nothing.
    """
    whole = F.xxhash64(*rows.columns).alias("whole_row")
    twice = rows.select(*columns, whole).groupBy(*columns, "whole_row").count().filter("count > 1")
    return twice.select(*columns).distinct()


def remove_duplicates(spark: SparkSession, table: str) -> int:
    """Keep one of each set of equal rows. Returns the number of partitions rewritten (1 for a whole table without any).

    Of a partitioned table only partitions are looked at whose files are others than after the last removal; their
    states are kept in a table beside it, named with __checked. Only those that do hold duplicates are rewritten. Rows in
    different partitions differ, so nothing else needs to be compared. recover() settles a run that died.

    One writer at a time: nothing may be added between the last look at a partition's files and its overwriting. A
    table format with transactions would do all this in one commit.
    """
    recover(spark, table)
    columns = _partition_columns(spark, table)
    if not columns:
        _put(spark, table, lambda: distinct_rows(spark.table(table)), None, lambda fresh: [])
        return 1
    changed = stage(_unchecked(spark, table, partition_states(spark, table)), "changed_partitions")
    names = changed.select(*columns).collect()  # a row per changed partition
    if not names:
        return 0
    rows = spark.table(table).filter(_in_partitions(names))
    dirty = _holding_duplicates(rows, columns).collect()
    if dirty:
        where = _in_partitions(dirty)
        count = changed.filter(where).agg(F.sum("rows")).first()[0]

        def copied() -> DataFrame:
            return distinct_rows(_dealt_for_comparison(spark.table(table).filter(where), count))

        _put(spark, table, copied, where, lambda fresh: [])
        # Clean partitions keep the state they were looked at in: rows may have been added to them since.
        changed = changed.filter(~where).unionByName(partition_states(spark, table, where))
    _remember(spark, table, changed)
    return len(dirty)


def drop(spark: SparkSession, table: str) -> None:
    """Drop a table and what removals and replacements keep beside it."""
    for name in [table, _checked(table), *_beside(spark, table, "distinct"), *_beside(spark, table, "replaced")]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_hours(gdh: DataFrame, table: str, key: Sequence[str] = ("FIELD_ID", "CROP_NAME", "GDH_DATE", "HOUR")) -> DataFrame:
    """A table's rows without those that recomputed rows replace, with these.

    Pushing and removing exact duplicates keeps both an old row and a recomputed one that differ, as after a gap at
    the season's edge was filled or the harvest date moved. `replace` writes such rows into the table itself.
    """
    fresh = rows_to_push(gdh)
    return _without(gdh.sparkSession.table(table), fresh, key).unionByName(fresh)


def _without(kept: DataFrame, gone: DataFrame, key: Sequence[str]) -> DataFrame:
    return kept.join(gone, [kept[k].eqNullSafe(gone[k]) for k in key], "left_anti")


def replace(
    gdh: DataFrame,
    table: str,
    keys: DataFrame | None = None,
    key: Sequence[str] = ("FIELD_ID", "CROP_SEASON"),
    push_key: str = "as_is",
) -> int:
    """Put recomputed degree hours in the place of all rows of a table that agree with them in a key.

    `keys` lists more keys whose rows go, such as field-seasons that have no degree hours any more. Only
    partitions that hold such rows, or receive new ones, are rewritten; the files of others stay. A partition that loses
    all its rows is emptied. Returns the number of partitions rewritten (1 for a whole table without any). A death halfway
    is settled by recover(), with which every push, removal and replacement begins.
    """
    spark = gdh.sparkSession
    recover(spark, table)
    fresh = stage(rows_to_push(gdh, push_key), "replacement", COMPRESSION)
    gone = fresh.select(*key)
    if keys is not None:
        gone = gone.unionByName(keys.select(*key))
    gone = stage(gone.distinct(), "replaced_keys")
    columns = _partition_columns(spark, table)
    if not columns:
        _put(spark, table, lambda: _without(spark.table(table), gone, key).unionByName(fresh), None, lambda name: [])
        return 1
    stored = spark.table(table)
    hit = stored.join(gone, [stored[k].eqNullSafe(gone[k]) for k in key], "left_semi").select(*columns)
    touched = hit.unionByName(fresh.select(*columns)).distinct().collect()  # a row per touched partition
    if not touched:
        return 0
    where = _in_partitions(touched)

    def emptied(name: str) -> list[str]:
        """Folders of the partitions that the copy has no rows of; no more than there are partitions."""
        left = {tuple(row) for row in spark.table(name).select(*columns).distinct().collect()}
        empty = spark.table(table).filter(_in_partitions([row for row in touched if tuple(row) not in left]))
        folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
        return [row[0] for row in empty.select(folder).distinct().collect()]

    _put(
        spark, table, lambda: _without(spark.table(table).filter(where), gone, key).unionByName(fresh), where, emptied
    )
    return len(touched)


def write_csv(gdh: DataFrame, folder: str, as_of: date, compression: str | None = None) -> str:
    """Write degree hours as CSV files with a header under a folder named by day; returns its path.

    As plain text the hours of a season take several times the room of all that they are made from. `compression` ("gzip")
    avoids that; readers know such files by their names.
    """
    path = f"{folder.rstrip('/')}/GDH-{as_of.isoformat()}"
    gdh.write.mode("overwrite").option("header", True).csv(path, compression=compression)
    return path
