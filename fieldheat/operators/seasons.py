"""Season windows (seeding to harvest) from the log of field operations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldheat.functions.rows import explode_range
from fieldheat.schemas import require_columns

SEASON_KEY = ["FIELD_ID", "CROP_SEASON", "CROP_NAME"]
LOG_COLUMNS = ["FIELD_ID", "FIELD_OPERATION_TYPE", "CROP_NAME", "CROP_SEASON", "START_DATE", "END_DATE"]


def _operations(operations: DataFrame) -> DataFrame:
    require_columns(operations, *LOG_COLUMNS)
    season = F.col("CROP_SEASON").try_cast("int")
    return operations.select(*LOG_COLUMNS).withColumn("CROP_SEASON", season)


def _only_crops(df: DataFrame, thresholds: DataFrame) -> DataFrame:
    crops = thresholds.select(F.col("CROP").alias("CROP_NAME"))
    return df.join(crops, "CROP_NAME", "left_semi")


def unambiguous_dates(operations: DataFrame) -> DataFrame:
    """Operations logged with exactly one start date per field, season, crop and type.

    Keys with several different dates vanish altogether, they are not reduced to one. An unknown
    date counts as a value of its own. One aggregation with map-side combine decides this from the
    smallest and largest date; no group is ever gathered.
    """
    return (
        operations.filter("CROP_NAME IS NOT NULL")
        .groupBy(*SEASON_KEY, "FIELD_OPERATION_TYPE")
        .agg(
            F.min("START_DATE").alias("DATE"),
            F.max("START_DATE").alias("latest"),
            F.count("START_DATE").alias("dated"),
            F.count(F.lit(1)).alias("logged"),
        )
        .filter("dated = 0 OR (dated = logged AND DATE = latest)")
        .select("FIELD_ID", "FIELD_OPERATION_TYPE", "CROP_NAME", "CROP_SEASON", "DATE")
    )


def _date_column(kind: str) -> str:
    return f"{kind}_date" if kind in ("seeding", "harvest") else kind


def _widen(dates: DataFrame, kinds: Sequence[str], extra_key: Sequence[str] = ()) -> DataFrame:
    """One row per key with one date column per operation type; an absent type gives NULL."""
    columns = [
        F.max(F.when(F.col("FIELD_OPERATION_TYPE") == kind, F.col("DATE")).cast("date")).alias(_date_column(kind))
        for kind in kinds
    ]
    return dates.groupBy(*SEASON_KEY, *extra_key).agg(*columns)


def loaded_date_range(loaded: DataFrame) -> DataFrame:
    """First and last date already in the degree-hour table, per field and season."""
    require_columns(loaded, "FIELD_ID", "CROP_SEASON", "GDH_DATE")
    return (
        loaded.select("FIELD_ID", F.col("CROP_SEASON").try_cast("int").alias("CROP_SEASON"), "GDH_DATE")
        .groupBy("FIELD_ID", "CROP_SEASON")
        .agg(F.max("GDH_DATE").alias("GDH_MAX_DATE"), F.min("GDH_DATE").alias("GDH_MIN_DATE"))
    )


def season_windows(
    operations: DataFrame,
    loaded: DataFrame,
    thresholds: DataFrame,
    *,
    fallback: str | None = "gdh",
    min_season: int = 2018,
    extra_types: Sequence[str] = (),
) -> DataFrame:
    """Seeding and harvest date per field, season and crop, for seasons after min_season.

    Missing ends come from the loaded date range, then the calendar year (fallback "gdh"), from the
    calendar year only ("year"), or drop the row (None). Season and crop filters run before the
    first shuffle; both are grouping keys, so the result is the same.
    """
    if fallback not in ("gdh", "year", None):
        raise ValueError(f"unknown fallback {fallback!r}")
    wanted = _only_crops(_operations(operations).filter(F.col("CROP_SEASON") > min_season), thresholds)
    wide = _widen(unambiguous_dates(wanted), ["seeding", "harvest", *extra_types])
    wide = (
        wide.join(loaded_date_range(loaded), ["FIELD_ID", "CROP_SEASON"], "left")
        .withColumn("end_of_year", F.make_date("CROP_SEASON", F.lit(12), F.lit(31)))
        .withColumn("start_of_year", F.make_date("CROP_SEASON", F.lit(1), F.lit(1)))
    )
    if fallback is None:
        wide = wide.filter("seeding_date IS NOT NULL AND harvest_date IS NOT NULL")
    else:
        from_loaded = ["GDH_MIN_DATE"] if fallback == "gdh" else []
        to_loaded = ["GDH_MAX_DATE"] if fallback == "gdh" else []
        wide = wide.withColumn("seeding_date", F.coalesce("seeding_date", *from_loaded, "start_of_year"))
        wide = wide.withColumn("harvest_date", F.coalesce("harvest_date", *to_loaded, "end_of_year"))
    return wide.select(
        "FIELD_ID",
        "CROP_NAME",
        "CROP_SEASON",
        "GDH_MAX_DATE",
        "GDH_MIN_DATE",
        "seeding_date",
        "harvest_date",
        "start_of_year",
        "end_of_year",
        *extra_types,
    )


def crop_operations(
    operations: DataFrame,
    thresholds: DataFrame,
    min_year: int | None = None,
    max_year: int | None = None,
    *,
    shape: str = "long",
    require: str = "all",
    extra_types: Sequence[str] = (),
) -> DataFrame:
    """Unambiguous operations of seasons strictly between the two years.

    "long" gives one row per operation, whatever its crop. "wide" gives one row per field, season
    and crop with known thresholds, keeping rows complete in every listed type ("all") or in
    seeding and harvest ("seeding_harvest"). Types beyond those two are listed in extra_types.
    """
    if shape not in ("long", "wide") or require not in ("all", "seeding_harvest"):
        raise ValueError(f"unknown shape {shape!r} or requirement {require!r}")
    season = F.col("CROP_SEASON")
    low = 0 if min_year is None else min_year
    high = 9999 if max_year is None else max_year
    within = _operations(operations).filter((season > low) & (season < high))
    if shape == "long":
        return unambiguous_dates(within)
    kinds = ["seeding", "harvest", *extra_types]
    needed = kinds if require == "all" else kinds[:2]
    wide = _widen(unambiguous_dates(_only_crops(within, thresholds)), kinds)
    return wide.dropna(subset=[_date_column(kind) for kind in needed])


def _numbered_days(operations: DataFrame) -> DataFrame:
    """Days of the k-th operation of each type, numbered by date within field, season and crop.

    Equal days are interchangeable, so the numbering runs over distinct days with their counts (at
    most one entry per calendar day) and each entry is then spread over its range of numbers. No
    window ever holds the raw rows of a busy key.
    """
    key = [*SEASON_KEY, "FIELD_OPERATION_TYPE"]
    days = (
        operations.filter("FIELD_ID IS NOT NULL AND CROP_SEASON IS NOT NULL AND START_DATE IS NOT NULL")
        .distinct()
        .groupBy(*key, F.to_date("START_DATE").alias("DATE"))
        .agg(F.count(F.lit(1)).alias("times"))
    )
    running = Window.partitionBy(*key).orderBy("DATE").rowsBetween(Window.unboundedPreceding, 0)
    runs = days.withColumn("last", F.sum("times").over(running)).withColumn("first", F.col("last") - F.col("times") + 1)
    return explode_range(runs, "first", "last", "k").select(*key, "DATE", "k")


def _paired(operations: DataFrame) -> DataFrame:
    pairs = _widen(_numbered_days(operations), ["seeding", "harvest"], extra_key=["k"])
    return pairs.drop("k")


def clean_seasons(
    operations: DataFrame,
    method: str,
    as_of: date,
    *,
    use_actual_harvest: bool = False,
) -> DataFrame:
    """Seeding and harvest dates of past seasons ("historic") or of the current one ("current").

    Historic: the k-th seeding goes with the k-th harvest, incomplete pairs are dropped. Rows that
    differ only in END_DATE count separately. Current: one row per seeding, open until as_of; with
    use_actual_harvest the k-th harvest closes the k-th seeding where there is one.
    """
    log = _operations(operations)
    columns = ["FIELD_ID", "CROP_NAME", "CROP_SEASON", "seeding_date", "harvest_date"]
    if method == "historic":
        past = log.filter((F.col("CROP_SEASON") <= as_of.year - 1) & F.col("CROP_NAME").isNotNull())
        return _paired(past).dropna(subset=["seeding_date", "harvest_date"]).select(*columns)
    if method == "current":
        now = log.filter(F.col("CROP_SEASON") == as_of.year)
        if use_actual_harvest:
            pairs = _paired(now).filter("seeding_date IS NOT NULL")
            harvest = F.coalesce("harvest_date", F.lit(as_of))
        else:
            sown = now.filter("FIELD_OPERATION_TYPE = 'seeding' AND START_DATE IS NOT NULL")
            pairs = sown.distinct().withColumn("seeding_date", F.to_date("START_DATE"))
            harvest = F.lit(as_of)
        return pairs.withColumn("harvest_date", harvest).select(*columns)
    raise ValueError(f"method must be 'historic' or 'current', not {method!r}")


def field_seasons(fields: DataFrame, seasons: DataFrame) -> DataFrame:
    """Field master rows with each of their seasons."""
    return fields.join(seasons, "FIELD_ID")
