"""Embedding near-dedup: sign hashes in several tables, exact cosines, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, runs, stage
from fieldheat.llm.components import connected_components
from fieldheat.llm.simhash import joined

BUCKET = 256
TILE = 1024
RECALL = 0.9999


def usable(vector: str = "vector") -> F.Column:
    """Whether a vector can link: not null, not zero, all components finite."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def table_plan(most: int, threshold: float) -> tuple[int, int]:
    """Bits and tables: about BUCKET unrelated vectors in a bucket, and a pair at the threshold found with RECALL."""
    bits = max(1, round(math.log2(max(2, most) / BUCKET)))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - RECALL) / math.log(1 - meet)))


def hyperplanes(size: int, bits: int, tables: int, seed: int) -> np.ndarray:
    """Normals of the planes, one column each, table by table; a function of the numbers given."""
    return np.random.default_rng([seed, size]).standard_normal((size, bits * tables))


def codes(vectors: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """A number per vector and table, from the sides of the table's planes it lies on."""
    sides = (vectors @ planes >= 0).reshape(len(vectors), -1, bits)
    return (sides * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long vectors of a batch, in double precision and of length one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    found = flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
    found = found / np.abs(found).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def class_rows(vectors: DataFrame) -> DataFrame:
    """Classes of equal vectors with one label: `label`, `h1`, `h2`, `vector`, `rep` (least id), `members` (ids)."""
    keyed = vectors.groupBy("label", "h1", "h2", "id").agg(F.first("vector").alias("vector"))
    return keyed.groupBy("label", "h1", "h2").agg(
        F.first("vector").alias("vector"), F.min("id").alias("rep"), F.count("*").alias("members")
    )


def bucket_rows(classes: DataFrame, size: int, bits: int, tables: int, seed: int) -> DataFrame:
    """A row per class and table, with its bucket: `label`, `place` (table), `code`, `rep`, `members`, `vector`."""
    planes = hyperplanes(size, bits, tables, seed)

    def hashed(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            found = codes(matrix(batch.column("vector")), planes, bits) if batch.num_rows else np.zeros((0, tables))
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * tables
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1).astype(np.int64)))
            yield {c: batch.column(c) for c in ("label", "rep", "members", "vector")} | {"codes": lists}

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema.fields}
    picked = classes.where(F.size("vector") == size).select("label", "rep", "members", "vector")
    schema = f"label {kinds['label']}, rep long, members long, vector {kinds['vector']}, codes array<long>"
    coded = arrow_map(picked, hashed, schema)
    return coded.select("label", "rep", "members", "vector", F.posexplode("codes").alias("place", "code"))


def tile_rows(rows: DataFrame) -> DataFrame:
    """Bucket rows as sorted runs: every two rows of a bucket meet in one run (`k1`, `k2`), at least once.

    A bucket of more than TILE rows is split into parts, and a row goes to the run of its part with each part, so that
    no task holds more than two parts at a time.
    """
    bucket = ["label", "place", "code"]
    large = rows.groupBy(*bucket).count().where(F.col("count") > TILE)
    # Stored, so that its size is known to the join, which can then be a broadcast, or be split where a bucket is hot.
    large = stage(large.select(*bucket, F.ceil(F.col("count") / TILE).cast("int").alias("parts")), "large_buckets")
    split = rows.join(large, bucket, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    split = split.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    met = split.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = [*bucket, F.least("part", "with"), F.greatest("part", "with")]
    keyed = met.withColumns({"k1": F.xxhash64(*pair), "k2": F.xxhash64(F.lit("second"), *pair)})
    own = F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high")
    columns = ["k1", "k2", F.col("place").cast("long").alias("place"), "part", *own, "rep", "members", "vector"]
    return keyed.select(*columns).repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part", "rep")


def verified(tiles: DataFrame, size: int, bits: int, tables: int, seed: int, threshold: float) -> DataFrame:
    """Per run and class with links there: `rep`, `links` (vectors linked), `root` (least class of its component).

    A pair that meets in several tables counts in the first of them only.
    """
    planes = hyperplanes(size, bits, tables, seed)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for run in runs(stream, ["k1", "k2"]):
            if run.num_rows > 1:
                yield from compared(run)

    def compared(run: pa.Table) -> Iterator[dict]:
        vectors = matrix(run.column("vector"))
        rep, members = run.column("rep").to_numpy(), run.column("members").to_numpy()
        place, low, high = (int(run.column(c)[0].as_py()) for c in ("place", "low", "high"))
        sides = codes(vectors, planes, bits)
        part = run.column("part").to_numpy()
        second = np.flatnonzero(part == high)
        first = np.flatnonzero(part == low)
        links = np.zeros(len(rep), np.int64)
        label = np.arange(len(rep))
        for begin in range(0, len(first), 128):
            mine = first[begin : begin + 128]
            i, j = np.nonzero(vectors[mine] @ vectors[second].T >= threshold)
            i, j = mine[i], second[j]
            if low == high:
                i, j = i[i < j], j[i < j]
            if place and len(i):
                new = ~(sides[i, :place] == sides[j, :place]).any(axis=1)
                i, j = i[new], j[new]
            if len(i):
                np.add.at(links, i, members[j])
                np.add.at(links, j, members[i])
                label = joined(label, i, j)
        linked = np.flatnonzero(links)
        if len(linked):
            yield {"rep": rep[linked], "links": links[linked], "root": rep[label[linked]]}

    return arrow_map(tiles, rows, "rep long, links long, root long")


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    seed: int = 7,
) -> DataFrame:
    """Near-duplicate vectors with equal labels: `id`, `n_links`, `component_id`, `kept`, one row per input row.

    Random hyperplanes give each vector a bucket in each of several tables. Vectors that share a bucket are compared
    by exact cosine in double precision and link from the threshold on. Bits and tables follow from the size of the
    largest label (`table_plan`): a pair at the threshold is missed with a chance of at most 1 - RECALL, closer
    pairs with far less.

    Ids are whole numbers. `n_links` counts the other ids linked directly, `component_id` is the least id reachable, and `kept` marks it.
    Vectors that are null, empty, zero or hold null or non-finite components, rows without a label and rows without
    an id link with nothing and stand alone; without an id, `component_id` is null and `kept` false. Vectors of
    different lengths do not link. Repeated rows (same id, label and vector) count as one vector. An empty table gives
    no rows.

    Equal vectors are one class, linked from the start. Buckets are cut into tiles of bounded size, and a tile pair
    returns counts and a forest of links only, never its pairs.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    able = usable() & F.col("id").isNotNull() & F.col("label").isNotNull()
    hashes = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit("second"), "vector").alias("h2")]
    keyed = rows.select("*", able.alias("able"), *hashes)
    classes = stage(class_rows(keyed.where("able")), "vector_classes")
    sizes = classes.groupBy(F.size("vector").alias("size"), "label").count()
    sizes = sizes.groupBy("size").agg(F.max("count").alias("most")).orderBy("size").collect()  # a row per dimension
    links = None
    for size, most in sizes:
        bits, tables = table_plan(most, threshold)
        buckets = bucket_rows(classes, size, bits, tables, seed)
        found = verified(tile_rows(buckets), size, bits, tables, seed, threshold)
        links = found if links is None else links.unionByName(found)
    if links is None:
        links = rows.sparkSession.createDataFrame([], "rep long, links long, root long")
    links = stage(links, "vector_links")
    roots = connected_components(links.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    linked = links.groupBy("rep").agg(F.sum("links").alias("links"))
    judged = (
        classes.select("label", "h1", "h2", "rep", "members")
        .join(linked, "rep", "left")
        .join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
        .select(
            "label",
            "h1",
            "h2",
            F.lit(True).alias("able"),
            (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    named = keyed.select("id", "label", "h1", "h2", "able").join(judged, ["label", "h1", "h2", "able"], "left")
    component = F.coalesce("component_id", "id").alias("component_id")
    alone = F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    kept = F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept")
    return named.select("id", alone, component, kept)
