"""Substring dedup: windows of words that repeat, found by doubling their length."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import Unsqueezed, WordHashes, arrow_map, mix, runs, safe_pieces, squeezed, stage, text_bytes

SKETCH_BITS = 28
FREQUENT_BITS = 24
WORDS_AT_ONCE = 1 << 18
ANCHORS_AT_ONCE = 1 << 20
WINDOWS_AT_ONCE = 1 << 19
BUCKET_BYTES = 12 << 20
SHORTEST = 5
FREQUENT = 4096  # an anchor that occurs more often has its windows dealt one by one


class Segments(NamedTuple):
    """Words of some documents, or of parts of them, one after the other."""

    hashes: np.ndarray  # of all words
    lengths: np.ndarray  # words of each segment
    doc: np.ndarray  # number of each segment's document in the batch
    skipped: np.ndarray  # words of that document before the segment
    live: np.ndarray | None = None  # whether each window, segment by segment, is looked at; None: all are


def segments(texts: list[bytes], known: WordHashes, window: int) -> Iterator[Segments]:
    """Texts in groups of bounded size. Segments of one text overlap, so that each window lies in exactly one whole."""
    held: list[tuple[np.ndarray, int, int]] = []
    size = 0

    def group() -> Segments:
        arrays, docs, skipped = zip(*held)
        lengths = np.array([len(a) for a in arrays], np.int64)
        return Segments(np.concatenate(arrays), lengths, np.array(docs), np.array(skipped, np.int64))

    for number, text in enumerate(texts):
        words = np.concatenate([known.of(piece.split()) for piece in safe_pieces(text)])
        for begin in range(0, max(0, len(words) - window + 1), WORDS_AT_ONCE):
            part = words[begin : begin + WORDS_AT_ONCE + window - 1]
            held.append((part, number, begin))
            size += len(part)
            if size >= WORDS_AT_ONCE:
                yield group()
                held, size = [], 0
    if held:
        yield group()


def packed_segments(group: Segments, docs: np.ndarray) -> bytes:
    """Segments, and their documents (d, r1), with each different word's hash once."""
    used, doc = np.unique(group.doc, return_inverse=True)
    words, place = np.unique(group.hashes, return_inverse=True)
    sizes = np.array([len(used), len(group.lengths), len(words), len(place), len(group.live)], np.int64)
    own = docs[used].T
    parts = (sizes, *own, group.lengths, doc.astype(np.uint32), group.skipped, words, place.astype(np.uint32), group.live)
    return squeezed(*parts)


def unpacked_segments(data: bytes) -> tuple[Segments, np.ndarray]:
    found = Unsqueezed(data)
    n_docs, n, n_words, size, n_live = found.take(5, np.int64).tolist()
    docs = np.stack([found.take(n_docs, np.int64), found.take(n_docs, np.int64)], axis=1)
    lengths, doc, skipped = found.take(n, np.int64), found.take(n, np.uint32), found.take(n, np.int64)
    words = found.take(n_words, np.uint64)
    return Segments(words[found.take(size, np.uint32)], lengths, doc, skipped, found.take(n_live, np.uint8).astype(bool)), docs


def segments_of(batch: pa.RecordBatch, known: WordHashes, window: int) -> Iterator[tuple[Segments, np.ndarray]]:
    """Segments and documents of a batch of texts, or of stretches that a level left (`surviving_stretches`)."""
    if "text" in batch.schema.names:
        docs = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "r1")], axis=1)
        for group in segments(batch.column("text").to_pylist(), known, window):
            yield group, docs
    else:
        for data in batch.column("stretches"):
            yield unpacked_segments(data.as_py())


def doubled(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of `length` words, from runs of half that length; an odd word is added at the end."""
    if length == 1:
        return hashes
    half = doubled(hashes, length // 2)
    both = mix(half[: len(half) - length // 2], half[length // 2 :], length)
    return mix(both[: len(hashes) - length + 1], hashes[length - 1 :], 1) if length % 2 else both


class Windows(NamedTuple):
    """The windows of a group of segments."""

    runs: np.ndarray  # hashes of all runs of the level's length
    anchor: np.ndarray  # place in `runs` of the least hash inside each window
    place: np.ndarray  # first word of each window in the group
    segment: np.ndarray  # its segment
    start: np.ndarray  # its first word in the document


def levels_of(window: int) -> list[int]:
    """Lengths looked at before the window's own: half of it, half of that, and so on, down to SHORTEST or more."""
    levels = [max(1, window // 2)]
    while levels[0] // 2 >= SHORTEST:
        levels.insert(0, levels[0] // 2)
    return levels


def windows(group: Segments, window: int, length: int) -> Windows:
    """Live windows and their anchors of a length: equal windows hold equal anchors at equal places."""
    found = doubled(group.hashes, length)
    ends = np.cumsum(group.lengths)
    counts = group.lengths - window + 1
    segment = np.repeat(np.arange(len(counts)), counts)
    first = ends - group.lengths
    inside = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    if group.live is not None:
        segment, inside = segment[group.live], inside[group.live]
    place = first[segment] + inside
    spans = np.lib.stride_tricks.sliding_window_view(found, window - length + 1)
    anchor = spans.argmin(axis=1)[place] + place
    return Windows(found, anchor, place, segment, inside + group.skipped[segment])


def scattered(hashes: np.ndarray) -> np.ndarray:
    """Least hashes have leading zeros; these have even leading bits, and differ where the hashes do."""
    return hashes * np.uint64(0x9E3779B97F4A7C15)


def marked(hashes: np.ndarray, bits: bytes, size: int) -> np.ndarray:
    """Whether the bit of each hash is set, among 2^size bits."""
    at = (scattered(hashes) >> np.uint64(64 - size)).astype(np.int64)
    return (np.frombuffer(bits, np.uint8)[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


class Sketch(NamedTuple):
    """Where anchors of a length occur more than once."""

    length: int
    bits: Broadcast
    frequent: Broadcast  # where anchors occur more than FREQUENT times, in 2^FREQUENT_BITS bits

    def surviving(self, found: Windows) -> np.ndarray:
        """The windows whose anchor may occur more than once."""
        return np.flatnonzero(marked(found.runs[found.anchor], self.bits.value, SKETCH_BITS))


def anchor_blocks(source: DataFrame, window: int, length: int, slices: int) -> DataFrame:
    """Hashes of the anchors of all live windows, scattered.

    Dealt to slices by their leading bits: `slice`, `once`, `more` (seen more than once) and `times` (how often).
    """
    shift = np.uint64(64 - slices.bit_length() + 1)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known, held, size = WordHashes(), [], 0
        for batch in stream:
            for group, _ in segments_of(batch, known, window):
                found = windows(group, window, length)
                own = found.anchor[np.diff(found.anchor, prepend=-1) != 0]
                held.append(scattered(found.runs[own]))
                size += len(own)
                if size >= ANCHORS_AT_ONCE:
                    yield flushed(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield flushed(np.concatenate(held))

    def flushed(hashes: np.ndarray) -> dict:
        values, counts = np.unique(hashes, return_counts=True)  # sorted, so slices follow each other
        at = (values >> shift).astype(np.int64) if slices > 1 else np.zeros(len(values), np.int64)
        used, begins = np.unique(at, return_index=True)
        once, more, times = [], [], []
        for begin, end in zip(begins, [*begins[1:], len(at)]):
            alone = counts[begin:end] == 1
            once.append(values[begin:end][alone].tobytes())
            more.append(values[begin:end][~alone].tobytes())
            times.append(counts[begin:end][~alone].astype(np.uint32).tobytes())
        return {"slice": used, "once": once, "more": more, "times": times}

    return arrow_map(source, rows, "slice long, once binary, more binary, times binary")


def repeated_sketch(source: DataFrame, window: int, length: int, slices: int) -> Sketch | None:
    """A bit for each value of the leading SKETCH_BITS bits of a scattered hash, set where an anchor occurs more than once.

    None if none does.

    Its size is fixed (32 MB). The more anchors repeat, the more others pass for repeated too; none that repeats is
    ever missed, and what passes is compared exactly. Anchors that occur more than FREQUENT times are marked in the
    same way, in 2 MB.
    """
    least = FREQUENT

    def packed(hashes: np.ndarray, size: int) -> bytes:
        width = (1 << size) // slices
        bits = np.zeros(width, np.uint8)
        bits[((hashes >> np.uint64(64 - size)) & np.uint64(width - 1)).astype(np.int64)] = 1
        return zstandard.compress(np.packbits(bits).tobytes(), 1)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for run in runs(stream, ["slice"]):
            more = np.frombuffer(b"".join(run.column("more").to_pylist()), np.uint64)
            once, counts = np.unique(
                np.frombuffer(b"".join(run.column("once").to_pylist()), np.uint64), return_counts=True
            )
            again = np.concatenate([more, once[counts > 1]])
            if not len(again):
                continue
            times = np.frombuffer(b"".join(run.column("times").to_pylist()), np.uint32)
            values, place = np.unique(again, return_inverse=True)
            total = np.bincount(place, np.concatenate([times, counts[counts > 1]]), len(values))
            # Once in a group of one, and more often in others.
            alone = once[counts == 1]
            at = np.minimum(np.searchsorted(values, alone), len(values) - 1)
            total[at[values[at] == alone]] += 1
            yield {
                "slice": [run.column("slice")[0].as_py()],
                "bits": [packed(again, SKETCH_BITS)],
                "frequent": [packed(values[total > least], FREQUENT_BITS)],
            }

    blocks = anchor_blocks(source, window, length, slices).repartition("slice").sortWithinPartitions("slice")
    found = arrow_map(blocks, rows, "slice long, bits binary, frequent binary").collect()  # 34 MB at most, packed
    if not found:
        return None

    def joined(column: str, size: int) -> Broadcast:
        empty, own = bytes((1 << size) // slices // 8), {r["slice"]: r[column] for r in found}
        whole = b"".join(zstandard.decompress(own[k]) if k in own else empty for k in range(slices))
        return source.sparkSession.sparkContext.broadcast(whole)

    return Sketch(length, joined("bits", SKETCH_BITS), joined("frequent", FREQUENT_BITS))


def surviving_stretches(source: DataFrame, sketch: Sketch, window: int) -> DataFrame:
    """Stretches of words that the surviving windows cover, in groups of bounded size: what the next level works on.

    Windows that share words are in one stretch, which says which windows in it survived.
    """

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = WordHashes()
        for batch in stream:
            for group, docs in segments_of(batch, known, window):
                found = windows(group, window, sketch.length)
                left = sketch.surviving(found)
                if len(left):
                    yield {"stretches": pa.array([packed_segments(stretches(group, found, left), docs)], pa.binary())}

    def stretches(group: Segments, found: Windows, left: np.ndarray) -> Segments:
        place, segment = found.place[left], found.segment[left]
        new = np.ones(len(left), bool)
        new[1:] = (np.diff(place) >= window) | (np.diff(segment) != 0)
        begins = np.flatnonzero(new)
        lengths = place[np.append(begins[1:], len(left)) - 1] - place[begins] + window
        live = np.zeros(len(group.hashes), np.uint8)
        live[place] = 1
        hashes = group.hashes[joined(place[begins], lengths)]
        starts = live[joined(place[begins], lengths - window + 1)]
        return Segments(hashes, lengths, group.doc[segment[begins]], found.start[left[begins]], starts)

    def joined(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        ends = np.cumsum(lengths)
        return np.arange(ends[-1]) + np.repeat(first - ends + lengths, lengths)

    return arrow_map(source, rows, "stretches binary")


class Batch:
    """Candidate windows of some documents, until they are sent."""

    def __init__(self) -> None:
        self.docs: list[list[int]] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def arrays(self) -> tuple[np.ndarray, ...]:
        """Documents (d, r1) in order, and hash, check, anchor, document's place and start of each window."""
        docs = np.array(self.docs, np.int64).reshape(-1, 2)
        order = np.lexsort((docs[:, 1], docs[:, 0]))
        rank = np.empty(len(docs), np.int64)
        rank[order] = np.arange(len(docs))
        docs = docs[order]
        new = np.ones(len(docs), bool)
        new[1:] = (docs[1:] != docs[:-1]).any(axis=1)
        rank = (np.cumsum(new) - 1)[rank]  # repeated rows are one document
        hashes, checks, anchors, doc, start = (np.concatenate(p) for p in zip(*self.parts))
        self.parts = []
        return docs[new], hashes, checks, anchors, rank[doc], start.astype(np.int64)


def firsts(hashes: np.ndarray, checks: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows that are the earliest of their kind, and of those that are not."""
    order = np.argsort(doc << 32 | start, kind="stable")
    order = order[np.argsort(hashes[order], kind="stable")]
    h, c, d, s = hashes[order], checks[order], doc[order], start[order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (d != d[first]) | (s != s[first])
    return order[new], order[later]


def ranges(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a document that start next to each other, as document, first start and number."""
    key = np.unique(doc << 32 | start)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1] + 1
    at = np.flatnonzero(new)
    return key[at] >> 32, key[at] & 0xFFFFFFFF, np.diff(np.append(at, len(key)))


BLOCK = "bucket long, packed binary, d long, r1 long, start long, n long"


def block(hashes: np.ndarray, checks: np.ndarray, local: np.ndarray, steps: np.ndarray, docs: np.ndarray) -> bytes:
    """Windows in the order of documents and starts. `steps` leads from each start to the next."""
    sizes = np.array([len(hashes), len(docs)], np.int64)
    parts = (sizes, docs[:, 0], docs[:, 1], steps, hashes, local.astype(np.uint32), checks.astype(np.uint32))
    return zstandard.compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts), 1)


def unblock(data: bytes) -> tuple[np.ndarray, ...]:
    """Hashes, checks, document's place, start; and the documents (d, r1)."""
    data = zstandard.decompress(data)
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    docs = np.frombuffer(data, np.int64, 2 * m, 16).reshape(2, m).T
    at = 16 + 16 * m
    steps = np.frombuffer(data, np.int64, n, at)
    hashes = np.frombuffer(data, np.uint64, n, at + 8 * n)
    local = np.frombuffer(data, np.uint32, n, at + 16 * n).astype(np.int64)
    checks = np.frombuffer(data, np.uint32, n, at + 20 * n)
    return hashes, checks, local, np.cumsum(steps), docs


def marks_columns(docs: np.ndarray, doc: np.ndarray, start: np.ndarray) -> dict:
    """Ranges of later windows, as rows without a bucket."""
    doc, start, n = ranges(doc, start)
    nothing = pa.nulls(len(doc))
    own = {"d": docs[doc, 0], "r1": docs[doc, 1], "start": start, "n": n}
    return {"bucket": nothing.cast(pa.int64()), "packed": nothing.cast(pa.binary())} | own


def candidate_blocks(source: DataFrame, sketch: Sketch, window: int, buckets: int) -> DataFrame:
    """Windows that survived the last level, of half a window, extended to full length.

    Among the windows a task holds at a time, only the earliest of a kind goes on, in a block for its bucket; the
    later ones are marks already. So a passage that very many documents share is sent once per block at most.
    Windows go to buckets by their anchor, which keeps neighbours together, but by their own hash if the anchor is a
    frequent one: a short line that very many documents share has a different window in each.
    """

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known, held = WordHashes(), Batch()
        for batch in stream:
            for group, docs in segments_of(batch, known, window):
                found = windows(group, window, sketch.length)
                maybe = sketch.surviving(found)
                if not len(maybe):
                    continue
                place, segment = found.place[maybe], found.segment[maybe]
                anchors = found.runs[found.anchor[maybe]]
                left, right = found.runs[place], found.runs[place + window - window // 2]
                hashes = mix(left, right, window)
                if window % 2:
                    hashes = mix(hashes, group.hashes[place + window // 2], 1)
                checks = (mix(right, left, 3) >> np.uint64(32)).astype(np.uint32)
                used, local = np.unique(group.doc[segment], return_inverse=True)
                doc, start = (local + len(held.docs)).astype(np.int32), found.start[maybe].astype(np.int32)
                held.docs += docs[used].tolist()
                held.parts.append((hashes, checks, anchors, doc, start))
                held.size += len(maybe)
                if held.size >= WINDOWS_AT_ONCE:
                    yield from sent(held)
                    held = Batch()
        if held.parts:
            yield from sent(held)

    def sent(held: Batch) -> Iterator[dict]:
        documents, hashes, checks, anchors, doc, start = held.arrays()
        first, later = firsts(hashes, checks, doc, start)
        if len(later):
            yield marks_columns(documents, doc[later], start[later])
        spread = marked(anchors, sketch.frequent.value, FREQUENT_BITS)
        bucket = (np.where(spread, hashes, anchors) % np.uint64(buckets)).astype(np.int64)
        first = first[np.lexsort((start[first], doc[first], bucket[first]))]
        bucket = bucket[first]
        names, begins = np.unique(bucket, return_index=True)
        blocks = []
        for begin, end in zip(begins, [*begins[1:], len(bucket)]):
            own = first[begin:end]
            used, local = np.unique(doc[own], return_inverse=True)
            steps = np.diff(start[own], prepend=0).astype(np.int64)
            blocks.append(block(hashes[own], checks[own], local, steps, documents[used]))
        nothing = pa.nulls(len(names), pa.int64())
        yield {"bucket": names, "packed": pa.array(blocks, pa.binary())} | {c: nothing for c in ("d", "r1", "start", "n")}

    return arrow_map(source, rows, BLOCK)


def later_windows(blocks: DataFrame) -> DataFrame:
    """Ranges of windows that also start earlier, found in one bucket: `d`, `r1`, `start`, `n`."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for run in runs(stream, ["bucket"]):
            held = Batch()
            for data in run.column("packed").to_pylist():
                hashes, checks, local, start, docs = unblock(data)
                held.parts.append((hashes, checks, hashes, local + len(held.docs), start))
                held.docs += docs.tolist()
            documents, hashes, checks, _, doc, start = held.arrays()
            _, later = firsts(hashes, checks, doc, start)
            if len(later):
                found = marks_columns(documents, doc[later], start[later])
                yield {c: found[c] for c in ("d", "r1", "start", "n")}

    dealt = blocks.select("bucket", "packed").repartition("bucket").sortWithinPartitions("bucket")
    return arrow_map(dealt, rows, "d long, r1 long, start long, n long")


def with_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`doc` (a struct of all columns but the text), `text` as bytes, and what orders documents: `d`, then `r1`."""
    others = [F.col(c) for c in docs.columns if c != text_col]
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)).cast("long"))
    content = F.xxhash64(F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull())
    return docs.select(
        F.struct(*others).alias("doc"), F.col(text_col).cast("binary").alias("text"), ident.alias("d"), content.alias("r1")
    )


def repeated_ranges(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ranges of windows whose words also start earlier: `d`, `r1` (`with_order`), `start`, `n`; repeats possible.

    Short runs of words are looked at first (`levels_of`), by the windows' anchors: the run with the least hash inside
    each window. Equal windows have equal anchors, so a window whose anchor occurs once is settled. Only the others are
    looked at with runs of twice the length, and so on until none survives or the window itself is compared. Texts are
    hashed on the first level; from then on the words of surviving windows go from level to level as hashes.
    """
    ordered = with_order(docs, id_col, text_col)
    size = ordered.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 << (size // BUCKET_BYTES).bit_length()
    slices = min(buckets, 1 << SKETCH_BITS - 10)
    source = ordered.select(text_bytes("text").alias("text"), "d", "r1")
    levels = levels_of(window)
    for length in levels:
        sketch = repeated_sketch(source, window, length, slices)
        if sketch is None:
            return docs.sparkSession.createDataFrame([], "d long, r1 long, start long, n long")
        if length != levels[-1]:
            source = stage(surviving_stretches(source, sketch, window), "stretches")
    blocks = stage(candidate_blocks(source, sketch, window, buckets), "windows")
    at_once = blocks.where("bucket is null").select("d", "r1", "start", "n")
    return at_once.unionByName(later_windows(blocks.where("bucket is not null")))


def dedup_substrings(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the words covered by a window that also starts earlier.

    Words are runs of bytes other than white space [\\x20\\x09-\\x0D], unchanged. A window is `window` consecutive words
    of one document; it is later than an equal one in a document of smaller id, or further ahead in the same
    document. Windows are judged on the input, not on what is left.

    Returns `doc` (a struct of the other columns), `kept` (kept words joined by one space), `spans` (first and one past
    the last of each stretch of removed words, flat), `n_words` and `n_removed`, one row per row of `docs`.

    Ids are whole numbers. Nulls and empty texts have no words. A null id comes before all others. Repeated rows (same id and text) are one
    document; rows that share an id but not the text come in the order of a hash of the text. An empty table gives
    no rows.
    """
    if window < 2:
        raise ValueError("window must be at least 2")
    ranged = repeated_ranges(docs, window, id_col, text_col)
    marks = ranged.groupBy("d", "r1").agg(F.collect_list("start").alias("start"), F.collect_list("n").alias("n"))
    joined = with_order(docs, id_col, text_col).join(marks.hint("shuffle_hash"), ["d", "r1"], "left")

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            out: tuple[list, ...] = ([], [], [], [])
            for text, start, n in zip(*(batch.column(c).to_pylist() for c in ("text", "start", "n"))):
                for values, value in zip(out, cleaned(text or b"", start, n, window)):
                    values.append(value)
            kinds = (pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64())
            kept, spans, n_words, n_removed = (pa.array(v, k) for v, k in zip(out, kinds))
            yield {
                "doc": batch.column("doc"),
                "kept": kept.cast(pa.string()),
                "spans": spans,
                "n_words": n_words,
                "n_removed": n_removed,
            }

    kind = joined.schema["doc"].dataType.simpleString()
    schema = f"doc {kind}, kept string, spans array<long>, n_words long, n_removed long"
    return arrow_map(joined.select("doc", "text", "start", "n"), rows, schema)


def cleaned(text: bytes, start: list[int] | None, n: list[int] | None, window: int) -> tuple[bytes, list[int], int, int]:
    """Kept words, removed stretches, and numbers of words and of removed ones."""
    if not start:
        words = [piece.split() for piece in safe_pieces(text)]
        return b" ".join(b" ".join(own) for own in words if own), [], sum(map(len, words)), 0
    begins, lengths = np.array(start, np.int64), np.array(n, np.int64)
    depth = np.zeros(int((begins + lengths).max()) + window, np.int64)
    np.add.at(depth, begins, 1)
    np.add.at(depth, begins + lengths - 1 + window, -1)
    gone = np.cumsum(depth) > 0
    spans = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).tolist()
    kept, before = [], 0
    for piece in safe_pieces(text):
        words = piece.split()
        mask = gone[before : before + len(words)]
        left = np.flatnonzero(~mask).tolist() + list(range(len(mask), len(words)))
        before += len(words)
        if left:
            kept.append(b" ".join([words[k] for k in left]))
    return b" ".join(kept), spans, before, int(gone.sum())
