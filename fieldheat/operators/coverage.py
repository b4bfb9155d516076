"""Which days of which stations are still to be requested, and in which requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldheat.functions.rows import numbered
from fieldheat.schemas import require_columns


def _steps(ranges: DataFrame, key: Sequence[str], start: str, end: str, name: str, other: str) -> DataFrame:
    """Days on which a range begins (+1) or no longer runs (-1); ranges that end before they begin are empty."""
    require_columns(ranges, *key, start, end)
    step = F.array(
        F.struct(F.col(start).alias("day"), F.lit(1).alias("step")),
        F.struct(F.date_add(end, 1).alias("day"), F.lit(-1).alias("step")),
    )
    rows = ranges.filter(F.col(start) <= F.col(end)).select(*key, F.inline(step))
    return rows.select(*key, "day", F.col("step").alias(name), F.lit(0).alias(other))


def uncovered(
    planned: DataFrame,
    landed: DataFrame | None = None,
    key: Sequence[str] = ("station_id",),
    start: str = "starts",
    end: str = "ends",
) -> DataFrame:
    """Planned days that have not landed, as the longest ranges without a gap; both ends are inside.

    Ranges may overlap, repeat and touch; the result's do not. Without landed ranges this is the union of the planned
    ones. Days are never listed: ranges are reduced to the days on which their number changes, summed before they are
    shuffled, and a running sum tells what runs on a day.
    """
    steps = _steps(planned, key, start, end, "planned", "landed")
    if landed is not None:
        steps = steps.unionByName(_steps(landed, key, start, end, "landed", "planned"))
    changes = steps.groupBy(*key, "day").agg(F.sum("planned").alias("planned"), F.sum("landed").alias("landed"))
    along = Window.partitionBy(*key).orderBy("day")
    running = along.rowsBetween(Window.unboundedPreceding, 0)
    needed = (F.sum("planned").over(running) > 0) & (F.sum("landed").over(running) == 0)
    turns = (
        changes.withColumn("needed", needed)
        .withColumn("before", F.lag("needed", 1, False).over(along))
        .filter("needed <> before")
        .withColumn("next", F.lead("day").over(along))
    )
    return turns.filter("needed").select(*key, F.col("day").alias(start), F.date_sub("next", 1).alias(end))


def shared_windows(ranges: DataFrame, days: int, start: str = "starts", end: str = "ends") -> DataFrame:
    """Ranges cut where windows of some days begin, which are the same for all stations (counted from 1970-01-01).

    So stations that lack the same days can share requests, and no day is in two pieces of a range.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    require_columns(ranges, start, end)
    number = F.explode(F.sequence(F.floor(F.unix_date(start) / days), F.floor(F.unix_date(end) / days)))
    first = F.date_from_unix_date((F.col("window_no") * days).cast("int"))
    return (
        ranges.filter(F.col(start) <= F.col(end))
        .withColumn("window_no", number)
        .withColumns({start: F.greatest(start, first), end: F.least(end, F.date_add(first, days - 1))})
        .drop("window_no")
    )


def request_manifests(
    windows: DataFrame, *, max_ids: int = 100, max_length: int = 2000, ranges: int | None = None
) -> DataFrame:
    """Requests for readings: a row per window of days and group of stations, with their ids as one text.

    `windows` holds station_id, starts, ends. Stations of a window are taken in the order of their ids, each once, and cut into
    groups of at most `max_ids`, and so few that the ids joined by commas are never longer than `max_length`, judged
    by the window's longest id. Returns starts, ends, request_no (from 1 in each window), n_stations, station_ids, and
    the times start_time and end_time (yyyyMMddHHmm; the end is midnight after the last day) as the service takes them.

    A window may hold all stations there are: they are numbered over many tasks, and no group is larger than a request.
    An id longer than `max_length` alone is an error of the caller's; it still gets a request of its own.
    """
    require_columns(windows, "station_id", "starts", "ends")
    if max_ids < 1 or max_length < 1:
        raise ValueError("a request holds at least one station")
    window = ["starts", "ends"]
    stations = windows.select(*window, "station_id").filter("station_id IS NOT NULL").distinct()
    placed = numbered(stations, window, ["station_id"], "nth", ranges)
    longest = stations.groupBy(*window).agg(F.max(F.length("station_id")).alias("longest"))
    fitting = F.floor((F.lit(max_length) + 1) / (F.col("longest") + 1))
    size = F.greatest(F.lit(1), F.least(F.lit(max_ids), fitting))
    requests = placed.join(longest, window).withColumn("request_no", (F.floor((F.col("nth") - 1) / size) + 1).cast("int"))
    ids = F.array_join(F.sort_array(F.collect_list("station_id")), ",")
    return (
        requests.groupBy(*window, "request_no")
        .agg(F.count(F.lit(1)).cast("int").alias("n_stations"), ids.alias("station_ids"))
        .withColumn("start_time", F.date_format("starts", "yyyyMMdd'0000'"))
        .withColumn("end_time", F.date_format(F.date_add("ends", 1), "yyyyMMdd'0000'"))
    )
