"""Best-fit packing by exact complements: lengths that fill a window exactly first, the rest best-fit."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.pieces import Pattern, cut, placed


class SumIndex:
    """Which sums the lengths still available give: alone, as pairs, and as a length and a pair.

    Sums are at most the window, so each index is an array addressed by the sum itself. Pairs of two different
    lengths are counted per sum, and the counts go down as a length runs out.
    """

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        self.single = counts > 0
        self.pairs = np.zeros(len(counts), np.int64)
        present = np.flatnonzero(self.single)
        for k, length in enumerate(present.tolist()):
            sums = present[:k] + length
            self.pairs[sums[sums < len(counts)]] += 1

    def _has_pair(self) -> np.ndarray:
        """Per sum, whether a pair gives it, two of one length included."""
        found = self.pairs > 0
        twice = np.flatnonzero(self.left >= 2)
        twice = twice[2 * twice < len(found)]
        found[2 * twice] = True
        return found

    def take(self, length: int, times: int) -> None:
        self.left[length] -= times
        if not self.left[length] and self.single[length]:
            self.single[length] = False
            sums = np.flatnonzero(self.single) + length
            self.pairs[sums[sums < len(self.pairs)]] -= 1

    def _windows(self, lengths: tuple[int, ...]) -> int:
        """How many windows the availability allows with these lengths."""
        return min(int(self.left[length]) // times for length, times in Counter(lengths).items())

    def _pairs_of(self, total: int) -> Iterator[tuple[int, int]]:
        """Pairs with a sum, the most uneven first."""
        larger = np.flatnonzero(self.single[: total + 1])
        larger = larger[2 * larger >= total]
        for length in larger[self.single[total - larger]][::-1].tolist():
            yield length, total - length

    def exactly(self, length: int, window: int) -> tuple[tuple[int, ...], int] | None:
        """A combination of a length and one to three others that fills a window, the fewest pieces first, and how often."""
        gap = window - length
        if windows := self._windows((length, gap)):
            return (length, gap), windows
        if self._has_pair()[gap]:
            for pair in self._pairs_of(gap):
                if windows := self._windows((length, *pair)):
                    return (length, *pair), windows
        firsts = np.flatnonzero(self.single[: gap + 1])
        firsts = firsts[3 * firsts >= gap]
        for first in firsts[self._has_pair()[gap - firsts]][::-1].tolist():
            for pair in self._pairs_of(gap - first):
                if windows := self._windows((length, first, *pair)):
                    return (length, first, *pair), windows
        return None


def exact_patterns(counts: np.ndarray, window: int) -> tuple[list[Pattern], np.ndarray]:
    """Windows filled exactly, longest lengths first, and the counts of what is left."""
    index, patterns = SumIndex(counts), []
    if counts[window]:
        patterns.append(Pattern(((window, 1),), int(counts[window])))
        index.take(window, int(counts[window]))
    for length in range(window - 1, 0, -1):
        while index.left[length] and (found := index.exactly(length, window)):
            members = tuple(sorted(Counter(found[0]).items(), reverse=True))
            patterns.append(Pattern(members, found[1]))
            for member, times in members:
                index.take(member, times * found[1])
    return patterns, index.left


def best_fit(counts: np.ndarray, window: int) -> list[Pattern]:
    """Best-fit decreasing over counts: windows that are alike are handled together.

    Equal lengths go one after another into the tightest window, which stays the tightest while another one fits; so
    a window takes as many as it can before the next.
    """
    open_windows: dict[int, list[Pattern]] = {}
    for length in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[length])
        for room in sorted(r for r in open_windows if r >= length):
            times = room // length
            for pattern in open_windows.pop(room):
                if not left:
                    open_windows.setdefault(room, []).append(pattern)
                    continue
                full = min(pattern.windows, left // times)
                rest = min(left - full * times, times) if full < pattern.windows else 0
                left -= full * times + rest
                same = pattern.windows - full - (rest > 0)
                for n, windows in ((times, full), (rest, int(rest > 0)), (0, same)):
                    if windows:
                        members = (*pattern.members, (length, n)) if n else pattern.members
                        open_windows.setdefault(room - n * length, []).append(Pattern(members, windows))
            if not left:
                break
        times = window // length
        for n, windows in ((times, left // times), (left % times, int(left % times > 0))):
            if windows:
                open_windows.setdefault(window - n * length, []).append(Pattern(((length, n),), windows))
    return [pattern for alike in open_windows.values() for pattern in alike]


def plan(counts: np.ndarray, window: int) -> list[Pattern]:
    """How to fill windows with pieces of the given lengths (their counts, by length)."""
    exact, rest = exact_patterns(counts, window)
    return exact + best_fit(rest, window)


def pack_exactly(
    docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All texts as few sequences of at most `window` token ids, as one row per piece of a document.

    Returns the id, `piece` (from 0), `start` (ids of the document before it), `length`, `ids` (binary, unsigned
    32-bit little-endian), `sequence_id` (from 0, without holes) and `offset` (place in the sequence; pieces follow each other
    without gaps). A document's ids end with `end_id`; only documents longer than a window are cut, into full windows and a rest.

    Pieces of one length are alike, so the packing is planned once for all documents from the counts per length, at
    most `window` numbers however many documents there are. Lengths from the longest down are complemented to full windows by one,
    two or three others, found in indexes of the sums that the lengths still available give, and as often as all of
    them last. What no complement fills is packed best-fit decreasing. The n-th piece of a length then goes to the
    n-th place for that length; pieces are numbered within tasks, and tasks by running sums. So no document moves to
    find its place, and no length, however common, is gathered anywhere.

    Pieces are stored once with their ids; the texts are encoded once. Nulls and empty texts are documents of
    `end_id` alone; a null id stays null; repeated rows are packed each; an empty table gives no rows; other columns
    are not read.
    """
    pieces = cut(docs, tokenizer, end_id, window, id_col, text_col)
    found = placed(pieces, lambda counts: plan(counts, window), window)
    start = F.col("piece").cast("long") * window
    return found.select(
        F.col("id").alias(id_col), "piece", start.alias("start"), "length", "ids", "sequence_id", "offset"
    )
