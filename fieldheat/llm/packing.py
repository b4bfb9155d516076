"""Packing: best-fit decreasing into windows of a fixed number of tokens."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.pieces import Pattern, cut, placed


class OpenWindows:
    """Open windows in a segment tree over remaining capacity; finds the tightest ones that still fit.

    Windows filled alike are one pattern, so a leaf holds patterns, and inner nodes count them.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.open = [0] * (2 * self.leaves)
        self.at: list[list[Pattern]] = [[] for _ in range(window + 1)]

    def _count(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.open[node] += by
            node >>= 1

    def put(self, capacity: int, pattern: Pattern) -> None:
        if pattern.windows:
            self.at[capacity].append(pattern)
            self._count(capacity, 1)

    def take(self, length: int) -> tuple[int, Pattern] | None:
        """The least capacity of at least a length that open windows have, and some of them, filled alike."""
        node = length + self.leaves
        if not self.open[node]:
            while node & 1 or not self.open[node + 1]:  # up until a right neighbour holds something
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.leaves:  # down to its leftmost leaf
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._count(capacity, -1)
        return capacity, self.at[capacity].pop()

    def patterns(self) -> list[Pattern]:
        return [pattern for alike in self.at for pattern in alike]


def best_fit_decreasing(counts: np.ndarray, window: int) -> list[Pattern]:
    """Windows for pieces of given lengths (their counts, by length): longest first, each into the tightest open window.

    Pieces of one length follow each other into a window while they fit, since it stays the tightest; so windows that
    are alike take as many each, and one may take the last few.
    """
    tree = OpenWindows(window)
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        while left:
            found = tree.take(length)
            capacity, alike = found if found else (window, Pattern((), left))
            times = capacity // length
            full = min(alike.windows, left // times)
            rest = min(left - full * times, times - 1) if full < alike.windows else 0
            left -= full * times + rest
            tree.put(capacity - times * length, Pattern((*alike.members, (length, times)), full))
            if rest:
                tree.put(capacity - rest * length, Pattern((*alike.members, (length, rest)), 1))
            if found:
                tree.put(capacity, Pattern(alike.members, alike.windows - full - (rest > 0)))
    return tree.patterns()


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Sequences of at most `window` token ids from all texts, as one row per piece of a document.

    Returns the id, `start` (ids of the document before the piece), `length`, `ids` (binary, unsigned 32-bit
    little-endian), `doc_tokens` (all ids of the document, its `end_id` included), `sequence_id` and `offset` (place
    in the sequence; pieces follow each other without gaps).

    A document longer than a window gives full windows first. Then all pieces of all documents are packed best-fit
    decreasing, planned from the counts of their lengths (see `pieces`); so sequences are filled as well from many
    tasks as from one. No text is shuffled, and a repeated task gives the same sequences.

    Nulls and empty texts are documents of `end_id` alone; a null id stays null; repeated rows are packed each;
    an empty table gives no rows; other columns are not read.
    """
    pieces = cut(docs, tokenizer, end_id, window, id_col, text_col)
    found = placed(pieces, lambda counts: best_fit_decreasing(counts, window), window)
    start = F.col("piece").cast("long") * window
    return found.select(
        F.col("id").alias(id_col), start.alias("start"), "length", "ids", "doc_tokens", "sequence_id", "offset"
    )
