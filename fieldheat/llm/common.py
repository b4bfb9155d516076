"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldheat.sources.staging import stage

__all__ = [
    "Unsqueezed",
    "WordHashes",
    "arrow_map",
    "load",
    "mix",
    "row_key",
    "runs",
    "safe_pieces",
    "squeezed",
    "stage",
    "text_bytes",
]

WHITE = re.compile(rb"[\x09-\x0d\x20]")
PIECE_BYTES = 1 << 20
HOME = str(Path(__file__).resolve().parents[2])


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_bytes(column: str | Column) -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def row_key(*columns: str) -> list[Column]:
    """Two longs, r1 and r2, equal for rows that agree in these columns and, but for a chance of 2^-128, only for them."""
    null_marks = [F.col(c).isNull() for c in columns]
    values = [F.col(c) for c in columns]
    return [
        F.xxhash64(*values, *null_marks).alias("r1"),
        F.xxhash64(F.lit("second"), *values, *null_marks).alias("r2"),
    ]


def safe_pieces(text: bytes, limit: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in pieces of about a limit, each cut before a white-space byte. A word is never cut."""
    begin = 0
    while len(text) - begin > limit:
        space = WHITE.search(text, begin + limit)
        if not space:
            break
        yield text[begin : space.start()]
        begin = space.start()
    yield text[begin:] if begin else text


def prepare_workers(spark: SparkSession) -> None:
    """What Python workers start with.

    On this machine they import the package from where the driver did; a cluster installs it. Arrays of a megabyte and more
    go back to the system when they are freed, so a worker does not keep the most it ever held.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in known:
        environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, known)])
    environment.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")


def arrow_map(
    df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str
) -> DataFrame:
    """mapInArrow for a function that yields columns by name, in the order of the schema."""
    prepare_workers(df.sparkSession)

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows(stream):
            yield pa.RecordBatch.from_pydict(columns)

    return df.mapInArrow(batches, schema)


def runs(stream: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the keys (longs without nulls), as one table each, across batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in stream:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for v in values:
            changed[1:] |= v[1:] != v[:-1]
        starts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for begin, end in zip(starts, starts[1:]):
            key = tuple(v[begin] for v in values)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held)


class WordHashes(dict):
    """64-bit hashes of words; forgets all of them rather than grow without bound."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    """Hashes of ordered pairs of hashes."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    x ^= x >> np.uint64(32)
    x = (x + right) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other, each with the first byte of all numbers first, then the second of all, and so on."""
    flat = [np.ascontiguousarray(a).reshape(-1) for a in arrays]
    return zstandard.compress(b"".join(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in flat), 1)


class Unsqueezed:
    """Reads the arrays of `squeezed` in order."""

    def __init__(self, data: bytes) -> None:
        self.data = zstandard.decompress(data)
        self.at = 0

    def take(self, n: int, kind: type) -> np.ndarray:
        size = np.dtype(kind).itemsize
        found = np.frombuffer(self.data, np.uint8, n * size, self.at).reshape(size, n)
        self.at += n * size
        return np.ascontiguousarray(found.T).view(kind).reshape(n)
