"""LM scoring: difference of cross-entropies under a target and a background bigram model with one vocabulary."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import Unsqueezed, arrow_map, mix, runs, safe_pieces, squeezed, stage, text_bytes

UNKNOWN, BOUNDARY = 0, 1  # in place of a word's hash
WORDS_AT_ONCE = 400_000
TOKENS_AT_ONCE = 1 << 20
BUCKET_TOKENS = 1 << 21
CONTEXT_PRIOR = 20.0
WORD_PRIOR = 0.1
CLASSES = 4  # counts of target documents in either half, then of all documents in either half


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, piece by piece."""
    for piece in safe_pieces(text.lower()):
        yield piece.split()


def word_counts(texts: DataFrame) -> DataFrame:
    """Occurrences of each word by its hash: `word`, `n`."""

    def counted(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: Counter = Counter()
        for batch in stream:
            for text in batch.column("text").to_pylist():
                for words in words_of(text):
                    held.update(words)
                    if len(held) > WORDS_AT_ONCE:
                        yield columns(held)
                        held = Counter()
        yield columns(held)

    def columns(held: Counter) -> dict:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, held), np.uint64, len(held))
        return {"word": hashes.view(np.int64), "n": np.fromiter(held.values(), np.int64, len(held))}

    return arrow_map(texts, counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, size: int) -> np.ndarray:
    """Hashes of the most frequent words, at most `size`, sorted: all words from the least count that keeps the bound."""
    level = F.floor(F.log2("n") * 64).alias("level")
    counts = stage(counts.select("word", level), "word_counts")
    levels = counts.groupBy("level").count().orderBy(F.desc("level")).collect()  # at most 64 * 64 rows
    total, least = 0, None
    for found in levels:
        total += found["count"]
        if total > size:
            break
        least = found["level"]
    if least is None:
        return np.zeros(0, np.uint64)
    picked = counts.where(F.col("level") >= least).select("word").toPandas()["word"]
    return np.sort(picked.to_numpy(np.int64).view(np.uint64))


class Keys(NamedTuple):
    """The different words or bigrams of a block."""

    values: np.ndarray  # their 64-bit keys, sorted
    place: np.ndarray  # where in `values` each transition's is

    def counts(self, chosen: np.ndarray, half: np.ndarray) -> np.ndarray:
        """Chosen transitions with each key in either half."""
        n = len(self.values)
        return np.bincount(self.place[chosen] * 2 + half[chosen], minlength=2 * n).reshape(n, 2)


class Block:
    """Consecutive documents of a task, until they are sent. Words have numbers of the block's own."""

    def __init__(self) -> None:
        self.ids: list = []
        self.tokens: list[np.ndarray] = []
        self.half: list[int] = []
        self.hashes = np.zeros(0, np.uint64)  # of each word number
        self.size = 0

    def lengths(self) -> np.ndarray:
        """Transitions per document."""
        return np.array([len(t) + 1 for t in self.tokens], np.int64)

    def keys(self) -> tuple[Keys, Keys, np.ndarray]:
        """The word each transition leads to, its bigram, and the word it starts from; boundaries at both ends."""
        edge = np.array([len(self.hashes)], np.int64)
        line = np.concatenate([p for t in self.tokens for p in (edge, t)] + [edge])
        words, place = np.unique(np.append(self.hashes, np.uint64(BOUNDARY)), return_inverse=True)
        line = place[line]
        hashes = words[line]
        bigrams, at = np.unique(mix(hashes[:-1], hashes[1:], 2), return_inverse=True)
        return Keys(words, line[1:]), Keys(bigrams, at), line[:-1]


class Numbers(dict):
    """Numbers of a block's words, in the order they come."""

    def __init__(self, vocabulary: np.ndarray | None) -> None:
        self.vocabulary = vocabulary
        self.hashes: list[int] = []

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if self.vocabulary is not None:
            at = int(np.searchsorted(self.vocabulary, np.uint64(value)))
            if at == len(self.vocabulary) or int(self.vocabulary[at]) != value:
                value = UNKNOWN
        self.hashes.append(value)
        self[word] = found = len(self)
        return found


def buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each key; buckets are equal parts of all 64-bit numbers, so sorted keys lie in order of buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def block_rows(documents: DataFrame, words: np.ndarray | None) -> DataFrame:
    """Blocks of documents, made where they are read: `block`, `size` (transitions), `data` and `ids`, in order.

    Words beyond a vocabulary, if one is given, are UNKNOWN.
    """
    ids = documents.schema["id"].dataType.simpleString()
    shared = documents.sparkSession.sparkContext.broadcast(words)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        held, numbers = Block(), Numbers(shared.value)
        kind = None
        for batch in stream:
            kind = batch.schema.field("id").type
            columns = [batch.column(c).to_pylist() for c in ("id", "text", "half")]
            for ident, text, half in zip(*columns):
                parts = [np.fromiter(map(numbers.__getitem__, own), np.uint32, len(own)) for own in words_of(text)]
                held.ids.append(ident)
                held.tokens.append(np.concatenate(parts))
                held.half.append(half)
                held.size += len(held.tokens[-1]) + 1
                if held.size >= TOKENS_AT_ONCE:
                    yield sent(held, numbers, number, kind)
                    held, numbers, number = Block(), Numbers(shared.value), number + 1
        if held.ids:
            yield sent(held, numbers, number, kind)

    def sent(held: Block, numbers: Numbers, number: int, kind: pa.DataType) -> dict:
        lengths = np.array([len(t) for t in held.tokens], np.uint32)
        sizes = np.array([len(lengths), len(numbers.hashes), lengths.sum(dtype=np.int64)], np.int64)
        half = np.array(held.half, np.uint8)
        blob = squeezed(sizes, lengths, half, np.array(numbers.hashes, np.uint64), np.concatenate(held.tokens))
        return {
            "block": pa.array([number], pa.int64()),
            "size": pa.array([held.size], pa.int64()),
            "data": pa.array([blob], pa.binary()),
            "ids": pa.array([held.ids], pa.list_(kind)),
        }

    return arrow_map(documents, rows, f"block long, size long, data binary, ids array<{ids}>")


def target_places(blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """`block` and `places` of the target documents in it. Ids alone meet the targets; texts and blocks stay."""
    placed = blocks.select("block", F.posexplode("ids").alias("place", "id")).where("id is not null")
    return placed.join(targets, "id", "left_semi").groupBy("block").agg(F.collect_list("place").alias("places"))


def unsqueezed_block(data: bytes, ids: list) -> Block:
    found = Unsqueezed(data)
    n, n_words, n_tokens = found.take(3, np.int64).tolist()
    held = Block()
    held.ids = ids
    lengths = found.take(n, np.uint32).astype(np.int64)
    held.half = found.take(n, np.uint8).tolist()
    held.hashes = found.take(n_words, np.uint64)
    held.tokens = np.split(found.take(n_tokens, np.uint32).astype(np.int64), np.cumsum(lengths)[:-1])
    return held


def sent_counts(blocks: DataFrame, places: DataFrame, buckets: int) -> DataFrame:
    """Counts of the words and bigrams of each block, a row per bucket that any is in: `block`, `bucket`, `data`.

    A word or bigram is sent once per block, however frequent it is.
    """

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in stream:
            columns = [batch.column(c) for c in ("block", "data", "places")]
            for number, data, own in zip(*columns):
                yield sent(number.as_py(), unsqueezed_block(data.as_py(), []), own.as_py() or [])

    def sent(number: int, held: Block, places: list[int]) -> dict:
        words, bigrams, _ = held.keys()
        lengths = held.lengths()
        half = np.repeat(np.array(held.half, np.int64), lengths)
        target = np.zeros(len(lengths), bool)
        target[places] = True
        own = np.repeat(target, lengths)
        every = slice(None)
        parts = []
        for keys in (words, bigrams):
            counts = np.concatenate([keys.counts(own, half), keys.counts(every, half)], axis=1).astype(np.uint32)
            parts.append((keys.values, counts, buckets_of(keys.values, buckets)))
        used = np.unique(np.concatenate([at for _, _, at in parts]))
        edges = [(np.searchsorted(at, used), np.searchsorted(at, used, "right")) for _, _, at in parts]
        blobs = []
        for k in range(len(used)):
            found = [(values[b[k] : e[k]], counts[b[k] : e[k]]) for (values, counts, _), (b, e) in zip(parts, edges)]
            sizes = np.array([len(values) for values, _ in found], np.int64)
            steps = [np.diff(values, prepend=np.uint64(0)) for values, _ in found]
            blobs.append(squeezed(sizes, *steps, *[counts.T for _, counts in found]))
        return {
            "block": pa.array([number] * len(used), pa.int64()),
            "bucket": pa.array(used, pa.int64()),
            "data": pa.array(blobs, pa.binary()),
        }

    known = blocks.select("block", "data").join(places, "block", "left")
    return arrow_map(known, rows, "block long, bucket long, data binary")


def answered(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """What each sender of keys gets back, and the different keys with their counts in all.

    Of each half that the sender has a key in, it gets the counts in the other half: target documents, all documents.
    """
    values, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros((len(values), CLASSES), np.int64)
    for c in range(CLASSES):
        every = np.concatenate([own[c] for own in counts])
        total[:, c] = np.bincount(place, every, len(values))
    edges = np.cumsum([0, *map(len, keys)])
    answers = []
    for own, begin, end in zip(counts, edges, edges[1:]):
        mine = total[place[begin:end]][:, [[1, 3], [0, 2]]]
        answers.append(mine[own[2:].T > 0])
    return answers, values, total


def counted_answers(counted: DataFrame) -> DataFrame:
    """An answer to each block from each bucket: counts of the words and bigrams that it sent, in order.

    The first row of a bucket also has its number of different words, and of transitions in each class (`totals`).
    """

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for run in runs(stream, ["bucket"]):
            keys: tuple[list, list] = ([], [])
            counts: tuple[list, list] = ([], [])
            for data in run.column("data"):
                found = Unsqueezed(data.as_py())
                sizes = found.take(2, np.int64).tolist()
                for held, n in zip(keys, sizes):
                    held.append(np.cumsum(found.take(n, np.uint64), dtype=np.uint64))
                for held, n in zip(counts, sizes):
                    held.append(found.take(CLASSES * n, np.uint32).reshape(CLASSES, n))
            own, values, total = answered(keys[0], counts[0])
            pairs, _, _ = answered(keys[1], counts[1])
            blobs = [squeezed(np.array([len(w), len(p)], np.int64), w.T, p.T) for w, p in zip(own, pairs)]
            words = int((values > BOUNDARY).sum())
            yield {
                "block": run.column("block").combine_chunks(),
                "bucket": run.column("bucket").combine_chunks(),
                "data": pa.array(blobs, pa.binary()),
                "totals": pa.array([[words, *total.sum(axis=0).tolist()], *([None] * (len(blobs) - 1))], pa.list_(pa.int64())),
            }

    met = counted.repartition("bucket").sortWithinPartitions("bucket", "block")
    return arrow_map(met, rows, "block long, bucket long, data binary, totals array<long>")


class Received:
    """Answers to a block, in the order of its keys."""

    def __init__(self, data: list[bytes]) -> None:
        self.parts: tuple[list, list] = ([], [])
        for answer in data:
            found = Unsqueezed(answer)
            for held, n in zip(self.parts, found.take(2, np.int64).tolist()):
                held.append(found.take(2 * n, np.int64).reshape(2, n))

    def counts(self, kind: int, keys: Keys, half: np.ndarray) -> np.ndarray:
        """For the words (0) or bigrams (1): counts in the other half, by key, half and model (target, all)."""
        found = np.zeros((len(keys.values), 2, 2))
        found[keys.counts(slice(None), half) > 0] = np.concatenate(self.parts[kind], axis=1).T
        return found


def document_scores(blocks: DataFrame, answers: DataFrame, totals: list[int]) -> DataFrame:
    """`id`, `n_words` and `score` of every document, from its block and the block's answers.

    Both models are Dirichlet-smoothed bigrams over a smoothed unigram of the same vocabulary, and both leave out the
    half that the document itself is in.
    """
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    both = blocks.select("block", F.lit(-1).cast("long").alias("bucket"), "data", "ids")
    both = both.unionByName(answers.select("block", "bucket", "data", F.lit(None).cast(f"array<{kind}>").alias("ids")))
    n_words, *classes = totals
    size = n_words + 2  # UNKNOWN and BOUNDARY

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for run in runs(stream, ["block"]):
            data = run.column("data").to_pylist()
            held = unsqueezed_block(data[0], run.column("ids")[0].as_py())
            words, bigrams, before = held.keys()
            lengths = held.lengths()
            half = np.repeat(np.array(held.half, np.int64), lengths)
            received = Received(data[1:])
            single, pairs = received.counts(0, words, half), received.counts(1, bigrams, half)
            loss = np.zeros(len(half))
            for model, sign in ((0, -1), (1, 1)):
                every = np.array([classes[2 * model + 1], classes[2 * model]])[half]
                alone = (single[words.place, half, model] + WORD_PRIOR) / (every + WORD_PRIOR * size)
                together = pairs[bigrams.place, half, model] + CONTEXT_PRIOR * alone
                loss += sign * np.log(together / (single[before, half, model] + CONTEXT_PRIOR))
            doc = np.repeat(np.arange(len(lengths)), lengths)
            yield {
                "id": pa.array(held.ids, run.schema.field("ids").type.value_type),
                "n_words": lengths - 1,
                "score": np.bincount(doc, loss, len(lengths)) / lengths,
            }

    met = both.repartition("block").sortWithinPartitions("block", "bucket")
    return arrow_map(met, rows, f"id {kind}, n_words long, score double")


def cross_entropy_difference(
    docs: DataFrame,
    targets: DataFrame,
    vocabulary_size: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Mean loss per token under a model of the target documents less that under a model of all documents.

    `targets` holds the ids of the target documents; repeats and nulls in it do not count. Returns the id, `n_words`
    and `score` (negative: more like the targets), one row per row of `docs`.

    Both models are bigram models with one smoothing and one vocabulary: every word of all documents (lower case, split
    at white space), and a boundary token at either end. With a `vocabulary_size`, only that many of the most frequent
    words are told apart, and the others are one unknown word.
    Documents fall into two halves by a hash of the id, and each is scored by the models of the other half, so that
    no document is scored by a model that has seen it.

    Null and empty texts consist of the two boundaries. A null id is no target. Repeated rows are counted and scored
    each. Without targets the target model is uniform. An empty table gives no rows.

    All words and bigrams of all documents are counted, by hashes of 64 bits. Texts are not shuffled. They become blocks
    of word numbers where they are read, each with the hashes of its own words; only ids meet the targets. A block sends
    each of its words and bigrams once and gets the counts back, so a frequent one is no burden to the task that adds
    it up, and no task holds the vocabulary. Buckets grow in number with the corpus, not in size. A block holds
    TOKENS_AT_ONCE words or one document, if that is longer.
    """
    words = None
    if vocabulary_size is not None:
        words = vocabulary(word_counts(docs.select(text_bytes(text_col).alias("text"))), vocabulary_size)
    half = F.pmod(F.xxhash64(id_col), F.lit(2)).cast("int").alias("half")
    documents = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), half)
    blocks = stage(block_rows(documents, words), "token_blocks")
    places = stage(target_places(blocks, targets.select(F.col(id_col).alias("id"))), "target_places")
    size = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, size // BUCKET_TOKENS)
    answers = stage(counted_answers(sent_counts(blocks, places, buckets)), "token_answers")
    sums = [F.coalesce(F.sum(F.col("totals")[k]), F.lit(0)) for k in range(1 + CLASSES)]
    totals = list(answers.agg(*sums).first())
    return document_scores(blocks, answers, totals).withColumnRenamed("id", id_col)
