"""Line dedup: hashes range-partitioned and sorted, repeats streamed, bitmaps returned."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, row_key, stage, text_bytes


def line_keys(docs: DataFrame, text_col: str, id_col: str, min_length: int) -> DataFrame:
    """A row per line whose key is long enough: two halves of the key's hash, document, row and position.

    The key is the line without white space [\\x20\\x09-\\x0D] at its ends and with A-Z in lower case.
    """

    def keys(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            rows, positions, digests = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for position, line in enumerate(text.lower().split(b"\n")):
                    line = line.strip()
                    if len(line) >= min_length and (min_length < 2 or len(line.decode()) >= min_length):
                        rows.append(row)
                        positions.append(position)
                        digests.append(xxhash.xxh3_128_digest(line))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            at = pa.array(rows, pa.int64())
            yield {
                "h1": pa.array(np.ascontiguousarray(halves[:, 0])),
                "h2": pa.array(np.ascontiguousarray(halves[:, 1])),
                "d": batch.column("d").take(at),
                "r1": batch.column("r1").take(at),
                "r2": batch.column("r2").take(at),
                "position": pa.array(positions, pa.int32()),
            }

    # Documents are told apart by a hash of their id, which has no nulls and sorts like any number.
    picked = docs.select(
        text_bytes(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("d"), *row_key(id_col, text_col)
    )
    return arrow_map(picked, keys, "h1 long, h2 long, d long, r1 long, r2 long, position int")


class Stream:
    """Counts documents along sorted lines; marks the rows of lines that lie in enough documents."""

    def __init__(self, min_docs: int):
        self.min_docs = min_docs
        self.key: tuple | None = None
        self.n_docs, self.last_doc, self.first = 0, None, True
        self.held: list[pa.RecordBatch] = []

    def _marks(self, rows: pa.RecordBatch, key: tuple | None) -> dict:
        empty = pa.nulls(rows.num_rows, pa.int64())
        hashes = [empty, empty] if key is None else [np.full(rows.num_rows, k) for k in key]
        own = {c: rows.column(c) for c in ("r1", "r2", "position")}
        return {"h1": hashes[0], "h2": hashes[1], "n_docs": empty, **own}

    def close(self, last: bool) -> Iterator[dict]:
        """The run is over. At an edge of the partition its count goes out too, and rows that still depend on it."""
        if self.key is not None and (self.first or last):
            none = {"r1": pa.nulls(1, pa.int64()), "r2": pa.nulls(1, pa.int64()), "position": pa.nulls(1, pa.int32())}
            yield {"h1": [self.key[0]], "h2": [self.key[1]], "n_docs": [self.n_docs], **none}
            for rows in self.held:
                yield self._marks(rows, self.key)
        self.first = self.first and self.key is None
        self.key, self.n_docs, self.last_doc, self.held = None, 0, None, []

    def add(self, rows: pa.RecordBatch, key: tuple, n_docs: int, last_doc: int) -> Iterator[dict]:
        """Rows of one run; a run held until now goes out as soon as it has enough documents."""
        self.key, self.last_doc = key, last_doc
        self.n_docs += n_docs
        self.held.append(rows)
        if self.n_docs >= self.min_docs:
            for held in self.held:
                yield self._marks(held, None)
            self.held = []

    def batches(self, stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            n = batch.num_rows
            if not n:
                continue
            h1, h2, d = (batch.column(c).to_numpy() for c in ("h1", "h2", "d"))
            new_run, new_doc = np.ones(n, bool), np.ones(n, bool)
            new_run[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            new_doc[1:] = new_run[1:] | (d[1:] != d[:-1])
            key = (h1[0], h2[0])
            if key == self.key:
                new_doc[0] = d[0] != self.last_doc
            starts = np.flatnonzero(new_run)
            ends = np.append(starts[1:], n)
            counts = np.add.reduceat(new_doc.astype(np.int64), starts)
            # Runs that lie inside the batch and have too few documents need no further look.
            look = counts >= self.min_docs
            look[0] = look[-1] = True
            for k in np.flatnonzero(look).tolist():
                begin, end = int(starts[k]), int(ends[k])
                key = (h1[begin], h2[begin])
                if key != self.key:
                    yield from self.close(last=False)
                yield from self.add(batch.slice(begin, end - begin), key, int(counts[k]), int(d[end - 1]))
        yield from self.close(last=True)


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """The rows (r1, r2, position) of `lines` whose key lies in at least so many documents.

    Hashes are range-partitioned together with the document, so that a very common line spreads over many tasks, and
    sorted by hash, document and position. Each task streams its runs of equal hashes. A run inside a partition is
    complete. The first and the last run may go on in a neighbour, so their counts are added up over the partitions,
    two rows from each. A document never straddles a border, so the counts add up exactly.
    """
    in_order = lines.repartitionByRange("h1", "h2", "d").sortWithinPartitions("h1", "h2", "d", "position")
    seen = stage(
        arrow_map(
            in_order.select("h1", "h2", "d", "r1", "r2", "position"),
            lambda stream: Stream(min_docs).batches(stream),
            "h1 long, h2 long, n_docs long, r1 long, r2 long, position int",
        ),
        "line_marks",
    )
    counts = seen.where("n_docs is not null").groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
    # At most two rows per partition.
    enough = F.broadcast(counts.where(F.col("n_docs") >= min_docs).select("h1", "h2"))
    marks = seen.where("n_docs is null")
    sure = marks.where("h1 is null").select("r1", "r2", "position")
    return sure.unionByName(marks.join(enough, ["h1", "h2"]).select("r1", "r2", "position"))


def keep_bitmap(dropped: list[int]) -> bytes:
    """Bits of the lines, first line first, 1 to keep it; lines beyond the last bit are kept. Compressed."""
    bits = np.ones(-(-(max(dropped) + 1) // 8) * 8, np.uint8)
    bits[dropped] = 0
    return zlib.compress(np.packbits(bits).tobytes())


def dropped_lines(bitmap: bytes, n_lines: int) -> list[int]:
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
    return np.flatnonzero(bits == 0).tolist()


def line_bitmaps(
    docs: DataFrame, min_docs: int = 10, min_length: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: r1, r2 (`row_key` of id and text) and `keep`.

    A line goes, in every document, if its key has at least `min_length` code points and lies in at least `min_docs`
    documents (different ids; null counts as one id). Nulls and empty texts hold one empty line, which has no key.
    Lines repeated in one document count once. Repeated rows share a bitmap. An empty table gives no bitmaps.
    """
    lines = stage(line_keys(docs, text_col, id_col, min_length), "lines")
    dropped = frequent_lines(lines, min_docs).groupBy("r1", "r2").agg(F.collect_set("position").alias("dropped"))

    def packed(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            bitmaps = [keep_bitmap(p) for p in batch.column("dropped").to_pylist()]
            yield {"r1": batch.column("r1"), "r2": batch.column("r2"), "keep": pa.array(bitmaps, pa.binary())}

    return arrow_map(dropped, packed, "r1 long, r2 long, keep binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without their dropped lines, with all other columns as they are.

    Returns `doc` (a struct of the other columns), `kept` (the text that is left; null stays null), `n_lines` and
    `n_dropped`. Only this join moves the texts; the bitmaps are its hashed side, so texts are not sorted.
    """
    others = [F.col(c) for c in docs.columns if c != text_col]
    keyed = docs.select(F.struct(*others).alias("doc"), F.col(text_col).cast("binary").alias("text"), *row_key(id_col, text_col))
    joined = keyed.join(bitmaps.hint("shuffle_hash"), ["r1", "r2"], "left").select("doc", "text", "keep")

    def applied(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            kept, n_lines, n_dropped = [], [], []
            for text, bitmap in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
                lines = text.count(b"\n") + 1 if text else 1
                gone: list[int] = []
                if bitmap is not None:
                    parts = text.split(b"\n")
                    gone = dropped_lines(bitmap, lines)
                    for position in reversed(gone):
                        del parts[position]
                    text = b"\n".join(parts)
                kept.append(text)
                n_lines.append(lines)
                n_dropped.append(len(gone))
            yield {
                "doc": batch.column("doc"),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
            }

    fields = {f.name: f.dataType.simpleString() for f in joined.schema.fields}
    return arrow_map(joined, applied, f"doc {fields['doc']}, kept string, n_lines long, n_dropped long")


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_length: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`apply_bitmaps` of `line_bitmaps`."""
    return apply_bitmaps(docs, line_bitmaps(docs, min_docs, min_length, id_col, text_col), id_col, text_col)
