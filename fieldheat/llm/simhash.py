"""SimHash near-dedup: fingerprints of word shingles, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, safe_pieces, stage, text_bytes
from fieldheat.llm.components import connected_components

TILE = 2048
BITS = 64
PARTS = 4
LEVELS = BITS // PARTS + 1


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of each run of `size` words joined by spaces; of all words if there are fewer.

    Long texts are taken in pieces, with the last words of one in front of the next.
    """
    words: list[bytes] = []
    seen = 0
    for piece in safe_pieces(text.lower()):
        words += piece.split()
        if len(words) < size:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-size]]).tolist()
        stops = (ends[size - 1 :] - 1).tolist()
        seen += len(starts)
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, stops)], np.uint64)
        words = words[len(words) - size + 1 :]
    if words and not seen:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)


def fingerprint(text: bytes, size: int) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes; 0 for a text without words."""
    total, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, size):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    bits = (2 * total > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id` and `fp` (the 64 bits as a long) of every row."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield {"id": batch.column("id"), "fp": pa.array(found.view(np.int64))}

    picked = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return arrow_map(picked, rows, f"id {picked.schema['id'].dataType.simpleString()}, fp long")


def counts_of(fp: Column) -> list[Column]:
    """Bits set in each quarter of a fingerprint."""
    mask = F.lit((1 << BITS // PARTS) - 1).cast("long")
    return [F.bit_count(F.shiftrightunsigned(fp, k * BITS // PARTS).bitwiseAND(mask)) for k in range(PARTS)]


def offsets(radius: int) -> list[tuple[int, ...]]:
    """Differences of counts, of two tiles, that add up to the radius or less; one of each pair of opposites."""
    steps = product(range(-radius, radius + 1), repeat=PARTS)
    zero = (0,) * PARTS
    return [s for s in steps if s > zero and sum(map(abs, s)) <= radius]


def tiles_of(classes: DataFrame) -> DataFrame:
    """Fingerprints (`fp`, distinct) in tiles of equal counts: `c0`.. `c3`, `part`, `fps`, about TILE in each."""
    counted = classes.select("fp", *[c.alias(f"c{k}") for k, c in enumerate(counts_of(F.col("fp")))])
    keys = [f"c{k}" for k in range(PARTS)]
    # At most LEVELS ** PARTS = 83,521 rows, whatever the data.
    sizes = F.broadcast(counted.groupBy(*keys).agg(F.ceil(F.count("*") / TILE).alias("parts")).where("parts > 1"))
    split = counted.join(sizes, keys, "left").withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    )
    return split.groupBy(*keys, "part").agg(F.collect_list("fp").alias("fps"))


def tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Pairs of tiles to compare, `home` and `fps`; each pair once, a tile with itself included.

    Two fingerprints differ in at least as many bits as the counts of their quarters differ in sum, so pairs of
    tiles beyond the radius are never formed.
    """
    keys = [f"c{k}" for k in range(PARTS)]
    steps = F.array(*[F.struct(*[F.lit(d).alias(f"s{k}") for k, d in enumerate(s)]) for s in offsets(radius)])
    near = tiles.select("*", F.explode(steps).alias("step"))
    for k in range(PARTS):
        near = near.withColumn(f"c{k}", F.col(f"c{k}") + F.col(f"step.s{k}"))
    inside = " and ".join(f"c{k} between 0 and {LEVELS - 1}" for k in range(PARTS))
    visitors = near.where(inside).select(*keys, F.lit(-1).alias("from_part"), "fps")
    same = tiles.select(*keys, F.col("part").alias("from_part"), "fps")
    homes = tiles.select(*keys, "part", F.col("fps").alias("home"))
    met = homes.join(visitors.unionByName(same), keys).where("from_part <= part")
    return met.select(*keys, "part", "home", "fps")


def link_pairs(pairs: DataFrame, radius: int) -> DataFrame:
    """Links between fingerprints of compared tiles, thinned to a forest: `src`, `dst`."""

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            key = np.stack([batch.column(c).to_numpy() for c in ("c0", "c1", "c2", "c3", "part")], axis=1)
            starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            home, others = batch.column("home"), batch.column("fps")
            for begin, end in zip(starts, starts[1:]):  # rows of one home tile, side by side
                left = home.slice(begin, 1).flatten().to_numpy()
                right = others.slice(begin, end - begin).flatten().to_numpy()
                src, dst = forest(left, right, radius)
                if len(src):
                    yield {"src": pa.array(src), "dst": pa.array(dst)}

    return arrow_map(pairs, rows, "src long, dst long")


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from each linked fingerprint to one of its component, among the links within the radius."""
    nodes, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    at_left, at_right = place[: len(left)], place[len(left) :]
    label = np.arange(len(nodes))
    step = max(1, (1 << 18) // max(1, len(right)))
    for begin in range(0, len(left), step):
        differing = left[begin : begin + step, None] ^ right[None, :]
        apart = np.bitwise_count(differing.view(np.uint64))  # of signed numbers it would count the magnitude's bits
        i, j = np.nonzero(apart <= radius)
        if len(i):
            label = joined(label, at_left[begin + i], at_right[j])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels (least place of the component) after joining places i and j pairwise."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:  # each label to the least one it leads to
            further = label[label]
            if (further == label).all():
                break
            label = further


def near_duplicates(
    docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprint and component of every row: `id`, `fp` (long), `component_id`.

    Texts are lower-cased (A-Z) and split at white space [\\x20\\x09-\\x0D]; a text with fewer words than a shingle is
    one shingle. Fingerprints link at `radius` or fewer differing bits; the component's id is its smallest document id.

    Nulls and empty texts have no words and fingerprint zero, which links like any other. A null id never is a
    component's id unless the component holds no other. Repeated rows give one row each. An empty table gives no rows.

    Equal fingerprints are one class from the start, so copies cost nothing further. Every two classes whose bit
    counts allow a link are compared; only a forest of links leaves a task, so a dense group does not emit its pairs.
    """
    found = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = found.groupBy("fp").agg(F.min("id").alias("least"))
    tiles = stage(tiles_of(classes), "tiles")
    links = link_pairs(tile_pairs(tiles, radius), radius)
    roots = connected_components(links).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    rooted = stage(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return found.join(named, "fp").select("id", "fp", "component_id")
