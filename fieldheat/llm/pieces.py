"""Documents cut into pieces of token ids, and places for pieces in windows planned by their lengths alone.

Pieces of one length are alike to a packer. So it plans from the counts per length, at most as many numbers as a window has
tokens, however many documents there are; and the n-th piece of a length goes to the n-th place for that length. Pieces are
numbered within tasks, and tasks by running sums: no document moves to find its place, and no length, however common, is
gathered anywhere.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, prepare_workers, stage, text_bytes
from fieldheat.llm.word_encoder import encoder

OUT_BYTES = 8 << 20


class Pattern(NamedTuple):
    """A way to fill a window, as (length, times) from its start, and the number of windows filled so."""

    members: tuple[tuple[int, int], ...]
    windows: int


class Slots:
    """Where the n-th piece of a length goes: arrays of places for runs of pieces, by length and number of the first."""

    RANKS = 1 << 44

    def __init__(self, patterns: list[Pattern]):
        used: Counter[int] = Counter()
        rows, sequence = [], 0
        for members, windows in patterns:
            offset = 0
            for length, times in members:
                rows.append((length * self.RANKS + used[length], times, sequence, offset))
                used[length] += times * windows
                offset += length * times
            sequence += windows
        found = np.array(sorted(rows), np.int64).reshape(-1, 4)
        self.first, self.times, self.sequence, self.offset = found.T

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces by length and number."""
        key = length * self.RANKS + rank
        at = np.searchsorted(self.first, key, side="right") - 1
        nth = key - self.first[at]
        return self.sequence[at] + nth // self.times[at], self.offset[at] + nth % self.times[at] * length


def texts_of(pieces: Iterator[tuple[int, bytes]], end: bytes) -> Iterator[tuple[int, bytes]]:
    """All ids of each text, with the end id."""
    number, parts = None, []
    for n, ids in pieces:
        if n != number and number is not None:
            yield number, b"".join([*parts, end])
            parts = []
        number = n
        parts.append(ids)
    if number is not None:
        yield number, b"".join([*parts, end])


def cut(docs: DataFrame, tokenizer: str, end_id: int, window: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of all documents: `id`, `piece` (from 0), `length`, `ids`, `doc_tokens`, and `task` and `nth`: the number of
    the task that read it and its number among the task's pieces of its length.

    A document longer than a window gives full windows and a rest. Only one document's ids are held at a time.
    """

    def pieces(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = encoder(tokenizer)
        full, end = 4 * window, end_id.to_bytes(4, "little")
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        seen = [0] * (window + 1)

        def taken(names: pa.Array, rows: list[tuple]) -> dict:
            at, piece, length, ids, doc_tokens, nth = zip(*rows)
            return {
                "id": names.take(pa.array(at)),
                "piece": pa.array(piece, pa.int32()),
                "length": pa.array(length, pa.int64()),
                "ids": pa.array(ids, pa.binary()),
                "doc_tokens": pa.array(doc_tokens, pa.int64()),
                "task": pa.array([task] * len(at), pa.int64()),
                "nth": pa.array(nth, pa.int64()),
            }

        for batch in stream:
            names, rows, size = batch.column(0), [], 0
            for row, ids in texts_of(known.pieces(batch.column(1).to_pylist()), end):
                total = len(ids) // 4
                for piece, begin in enumerate(range(0, len(ids), full)):
                    own = ids[begin : begin + full] if total > window else ids
                    length = len(own) // 4
                    rows.append((row, piece, length, own, total, seen[length]))
                    seen[length] += 1
                    size += len(own) + 64
                    if size > OUT_BYTES:
                        yield taken(names, rows)
                        rows, size = [], 0
            if rows:
                yield taken(names, rows)

    picked = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    columns = "piece int, length long, ids binary, doc_tokens long, task long, nth long"
    return arrow_map(picked, pieces, f"id {kind}, {columns}")


def placed(pieces: DataFrame, plan: Callable[[np.ndarray], list[Pattern]], window: int) -> DataFrame:
    """Pieces with `sequence_id` (from 0, without holes) and `offset`, by a plan made from the counts of their lengths.

    The pieces are stored with their ids, so texts are encoded once and a repeated task numbers them as before.
    """
    pieces = stage(pieces, "pieces")
    # Stored, so that its size is known: Spark broadcasts it only if it is small.
    per_task = stage(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(window + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # a row per length
        counts[length] = n
    slots = Slots(plan(counts))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = slots.of(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    prepare_workers(pieces.sparkSession)
    found = pieces.join(bases, ["length", "task"]).withColumn("at", place("length", F.col("base") + F.col("nth")))
    return found.select("*", "at.sequence_id", "at.offset").drop("at", "base", "task", "nth")
