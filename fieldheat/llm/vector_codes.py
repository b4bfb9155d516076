"""Vector code compression: product quantisation whose nearest entries are found by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, stage
from fieldheat.llm.vectors import common_length, finite_rows, scaled

LIMIT = 1 << 24  # of an integer component, so that squared distances and four times them are longs


class Codebook:
    """Entries of one part of the vectors, each with the other entries sorted by their distance from it."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        order = np.argsort(gaps, axis=1, kind="stable")
        others = order != np.arange(len(entries))[:, None]
        self.neighbours = order[others].reshape(len(entries), -1)
        self.gaps = np.take_along_axis(gaps, self.neighbours, axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry, ties to the lower one, and the squared distance to it, for every point.

        A point starts at entry 0 and goes down that entry's neighbours. It jumps to the list of an entry that is
        better, marks what it has visited, and stops where a neighbour is farther from the current entry than twice
        the point is: any entry from there on is farther from the point than the current one.
        """
        at = np.zeros(len(points), np.int64)
        distance = ((points - self.entries[0]) ** 2).sum(axis=1)
        visited = np.zeros((len(points), len(self.entries)), bool)
        visited[:, 0] = True
        place = np.zeros(len(points), np.int64)
        length = self.neighbours.shape[1]
        walking = np.arange(len(points)) if length else np.arange(0)
        while len(walking):
            here, step = at[walking], place[walking]
            near = self.gaps[here, step] <= 4 * distance[walking]
            walking, other = walking[near], self.neighbours[here, step][near]
            place[walking] += 1
            new = ~visited[walking, other]
            point, other = walking[new], other[new]
            visited[point, other] = True
            found = ((points[point] - self.entries[other]) ** 2).sum(axis=1)
            better = (found < distance[point]) | ((found == distance[point]) & (other < at[point]))
            point = point[better]
            at[point], distance[point], place[point] = other[better], found[better], 0
            walking = walking[place[walking] < length]
        return at, distance


def part_borders(size: int, parts: int) -> list[int]:
    """Where consecutive parts begin and end; as equal as can be, the first ones longer."""
    return [0, *np.cumsum([size // parts + (n < size % parts) for n in range(parts)]).tolist()]


def integer_vectors(vectors: DataFrame, size: int, factor: int) -> DataFrame:
    """Rows with `cells`, the integer components, of the usable vectors."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            kept, found = finite_rows(batch.column("vector"), size)
            cells = scaled(found, factor, LIMIT)
            ends = pa.array(np.arange(len(kept) + 1, dtype=np.int32) * size)
            index = pa.array(kept)
            yield {
                "id": batch.column("id").take(index),
                "label": batch.column("label").take(index),
                "cells": pa.ListArray.from_arrays(ends, pa.array(cells.reshape(-1))),
            }

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return arrow_map(vectors, rows, f"id {kinds['id']}, label {kinds['label']}, cells array<long>")


def matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def part_sums(cells: DataFrame, books: list[Codebook], borders: list[int]) -> DataFrame:
    """Per part, entry and position within the part: the number of nearest parts and their sum. A task adds up its own."""
    size = borders[-1]

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        totals = [np.zeros_like(b.entries) for b in books]
        counts = [np.zeros(len(b.entries), np.int64) for b in books]
        for batch in stream:
            found = matrix(batch.column("cells"), size)
            for n, book in enumerate(books):
                own = found[:, borders[n] : borders[n + 1]]
                at, _ = book.nearest(own)
                np.add.at(totals[n], at, own)
                counts[n] += np.bincount(at, minlength=len(book.entries))
        for n, (total, count) in enumerate(zip(totals, counts)):
            entry, place = np.nonzero(np.broadcast_to(count[:, None], total.shape))
            if len(entry):
                yield {
                    "part": np.full(len(entry), n, np.int32),
                    "entry": entry.astype(np.int32),
                    "place": place.astype(np.int32),
                    "n": count[entry],
                    "total": total[entry, place],
                }

    summed = arrow_map(cells.select("cells"), rows, "part int, entry int, place int, n long, total long")
    return summed.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def coded(cells: DataFrame, books: list[Codebook], borders: list[int]) -> DataFrame:
    """`id`, `label`, `codes` (an entry number per part, a byte each) and `error` of every row."""
    size = borders[-1]

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            found = matrix(batch.column("cells"), size)
            codes = np.zeros((len(found), len(books)), np.uint8)
            error = np.zeros(len(found), np.int64)
            for n, book in enumerate(books):
                at, distance = book.nearest(found[:, borders[n] : borders[n + 1]])
                codes[:, n] = at
                error += distance
            texts = pa.array([row.tobytes() for row in codes], pa.binary())
            yield {"id": batch.column("id"), "label": batch.column("label"), "codes": texts, "error": error}

    kinds = {f.name: f.dataType.simpleString() for f in cells.schema.fields}
    return arrow_map(cells, rows, f"id {kinds['id']}, label {kinds['label']}, codes binary, error long")


def compress_vectors(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    factor: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """A code per vector, and the codebooks they refer to.

    The table has `id`, `label`, `codes` (binary, an entry number per part), `error` (squared distances of the parts to
    their entries, summed) and `label_error` (errors summed over equal labels, null labels together). The codebooks are
    an integer matrix per part, an entry a row. All arithmetic is in integers, so neither the order of rows nor the
    number of tasks matters.

    A component x counts as floor(factor * x), limited to plus and minus 2^24. A codebook starts as that part of the vectors with the
    least ids (ties by components, null ids last); each round gives every part its nearest entry (ties to the lower
    one) and then replaces entries by the floored means of their parts. An entry without parts stays.

    Rows whose vector is null, empty, holds null or non-finite components, or is not as long as most, are left out.
    A vector shorter than a multiple of `parts` makes the first parts longer by one, and parts may be empty. Fewer
    vectors than entries make shorter codebooks. Rows without an id are coded like others; repeated rows count each;
    an empty table gives no rows and no codebooks; other columns are not read.

    Only codebooks and their sums reach the driver, which no amount of data makes larger.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry number must fit a byte")
    picked = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    size = common_length(picked, "vector")
    cells = stage(integer_vectors(picked, size, factor), "vector_cells")
    first = cells.orderBy(F.asc_nulls_last("id"), "cells").limit(entries).collect()
    borders = part_borders(size, parts)
    books: list[np.ndarray] = []
    if first:
        seeds = np.array([row.cells for row in first], np.int64)
        books = [seeds[:, begin:end].copy() for begin, end in zip(borders, borders[1:])]
    for _ in range(rounds if books else 0):
        for part, entry, place, n, total in part_sums(cells, [Codebook(b) for b in books], borders).collect():
            books[part][entry, place] = total // n
    found = stage(coded(cells, [Codebook(b) for b in books], borders), "vector_codes")
    # Stored, so that its size is known: few labels are broadcast, with many a common one is split by Spark.
    by_label = stage(found.groupBy("label").agg(F.sum("error").alias("label_error")), "label_errors")
    same = found["label"].eqNullSafe(by_label["label"])
    return found.join(by_label, same, "left").select(found["*"], "label_error"), books


def codebook_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
    text = ",".join(str(x) for book in books for x in book.reshape(-1).tolist())
    return hashlib.sha256(text.encode()).hexdigest()
