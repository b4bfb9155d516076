"""Benchmark decontamination: Wu-Manber multi-pattern search over words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, safe_pieces, stage, text_bytes

# Words are runs of 0-9, a-z (A-Z lower-cased) and bytes from 0x80; all else separates them.
KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in KEEP else 0x20 for b in range(256))
BLOCK = 2
# Searched at a time. As Python words and tables they take about 160 times that in a worker: 4 MB were measured at 649 MB.
PATTERN_BYTES = 2 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def search(engines: list["WuManber"], text: bytes) -> tuple[int, list[tuple[int, int]], set]:
    """Words of a text, hit stretches (they may overlap) and items found.

    A long text is searched in pieces, with the last words of one in front of the next.
    """
    overlap = max((e.length for e in engines), default=1) - 1
    words: list[bytes] = []
    before, hits, items = 0, [], set()
    for piece in safe_pieces(text.translate(WORD_BYTES)):
        words += piece.split()
        for engine in engines:
            for begin, own in engine.search(words):
                hits.append((before + begin, before + begin + engine.length))
                items |= own
        gone = max(0, len(words) - overlap)
        before, words = before + gone, words[gone:]
    return before + len(words), hits, items


class WuManber:
    """Patterns of one length, in words, with blocks of BLOCK words as the shift table's keys."""

    def __init__(self, length: int, patterns: dict[tuple, set]):
        self.length, self.block = length, min(BLOCK, length)
        self.beyond = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, set]] = defaultdict(dict)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.beyond), length - end)
            self.buckets[pattern[length - self.block :]][pattern] = items

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(first word, items) of each occurrence, in order."""
        length, block, beyond, shift, buckets = self.length, self.block, self.beyond, self.shift, self.buckets
        end, n = length, len(words)
        step = shift.get
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            by = step(key, beyond)
            if by:
                end += by
                continue
            found = buckets[key].get(tuple(words[end - length : end]))
            if found is not None:
                yield end - length, found
            end += 1


def searchers(items: list[tuple[str | None, bytes]], window: int) -> list[WuManber]:
    """One searcher per pattern length. A shorter item is one pattern, an item without words none."""
    patterns: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        length = min(window, len(words))
        for begin in range(len(words) - length + 1 if length else 0):
            patterns[length][tuple(words[begin : begin + length])].add(item)
    return [WuManber(length, found) for length, found in sorted(patterns.items())]


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Spans as begin, end, begin, end, ... without overlaps."""
    out: list[int] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    item_col: str = "item_id",
    item_text_col: str = "text",
    text_col: str = "text",
    pattern_bytes: int = PATTERN_BYTES,
) -> DataFrame:
    """Where windows of benchmark items occur in documents.

    Returns all columns of `docs` in a struct `doc`, with `n_words`, `spans` (begin and end word of each hit stretch,
    flat, merged) and `items` (ids of the items found as text, distinct and sorted). One row per row of `docs`.

    Each document is searched where it is read, so nothing is shuffled. The patterns go to the tasks by value: their
    bytes are summed first, and a benchmark of more than `pattern_bytes` is searched in that many parts, one pass
    over the documents after the other with the passes' results written in between.

    Null and empty texts have no words and no hits. An item without an id is searched, and its hits count, but it is
    not listed. Repeated items are one; repeated documents are judged each. An empty benchmark hits nothing.
    """
    rows = benchmark.select(
        F.col(item_col).cast("string").alias("item"), text_bytes(item_text_col).alias("text")
    ).distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-size // pattern_bytes) or 1
    found = docs.select(
        F.struct("*").alias("doc"),
        text_bytes(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part) if parts > 1 else rows
        found = _search(found, [(r.item, bytes(r.text)) for r in own.collect()], window)
        if part + 1 < parts:
            found = stage(found, "benchmark_hits")
    return found.drop("text")


def _search(found: DataFrame, items: list[tuple[str | None, bytes]], window: int) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(items)

    def hits(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        engines = searchers(shared.value, window)
        for batch in stream:
            n_words, spans, names = [], [], []
            earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            for text, (old_spans, old_items) in zip(batch.column("text").to_pylist(), earlier):
                n, here, listed = search(engines, text)
                here += zip(old_spans[::2], old_spans[1::2])
                listed.update(old_items)
                n_words.append(n)
                spans.append(merged(here) if here else here)
                names.append(sorted(listed - {None}) if listed else [])
            yield {
                "doc": batch.column("doc"),
                "text": batch.column("text"),
                "n_words": pa.array(n_words, pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.int64())),
                "items": pa.array(names, pa.list_(pa.string())),
            }

    return arrow_map(found, hits, found.schema)
