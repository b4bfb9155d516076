"""Substring dedup where very many documents share a line shorter than the window."""

import random
from collections import Counter

import numpy as np
import pytest
from test_dedup import slow_substrings

from fieldheat.llm import substring_dedup
from fieldheat.llm.common import WordHashes, text_bytes


def lines_between(n):
    rng = random.Random(9)
    line = " ".join(f"c2363x{k}" for k in range(12))  # with low hashes, so that it is the anchor of most windows
    return [(i, " ".join([*(f"a{rng.random()}" for _ in range(25)), line, *(f"b{rng.random()}" for _ in range(25))])) for i in range(n)]


def test_a_common_short_line_is_spread_over_buckets(documents, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FREQUENT", 50)
    frame = substring_dedup.with_order(documents(lines_between(400)), "doc_id", "text")
    source = frame.select(text_bytes("text").alias("text"), "d", "r1")
    for length in substring_dedup.levels_of(20):
        sketch = substring_dedup.repeated_sketch(source, 20, length, 16)
    sizes = np.zeros(16, int)
    for row in substring_dedup.candidate_blocks(source, sketch, 20, 16).where("bucket is not null").collect():
        sizes[row.bucket] += len(substring_dedup.unblock(row.packed)[0])
    assert sizes.sum() >= 2000 and sizes.max() < 2 * sizes.sum() / 16


@pytest.mark.parametrize("frequent", [0, 3])
def test_substrings_with_frequent_anchors(documents, corpus, monkeypatch, frequent):
    monkeypatch.setattr(substring_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 1 << 14)
    rows = [(n, t) for n, (_, t) in enumerate([*corpus, *lines_between(40)])]
    found = substring_dedup.dedup_substrings(documents(rows), 20).collect()
    assert {r.doc.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == slow_substrings(rows, 20)


def test_levels_hand_on_surviving_windows_only(spark, documents, corpus):
    rows = [(n, t) for n, (_, t) in enumerate([*corpus, *lines_between(40)])]
    frame = substring_dedup.with_order(documents(rows), "doc_id", "text")
    source = frame.select(text_bytes("text").alias("text"), "d", "r1")
    sketch = substring_dedup.repeated_sketch(source, 20, 5, 16)
    known, wanted, found = WordHashes(), {}, {}
    for n, t in rows:
        for group in substring_dedup.segments([(t or "").encode()], known, 20):
            own = substring_dedup.windows(group, 20, 5)
            for k in sketch.surviving(own).tolist():
                wanted[n, int(own.start[k])] = group.hashes[own.place[k] : own.place[k] + 20].tolist()
    total = sum(max(0, len((t or "").split()) - 19) for _, t in rows)
    assert 500 < len(wanted) < total / 2
    stretches = substring_dedup.surviving_stretches(source, sketch, 20).toArrow()
    for batch in stretches.to_batches():
        for group, docs in substring_dedup.segments_of(batch, known, 20):
            own = substring_dedup.windows(group, 20, 10)
            for at, segment, start in zip(own.place, own.segment, own.start):
                key = int(docs[group.doc[segment], 0]), int(start)
                assert key not in found
                found[key] = group.hashes[at : at + 20].tolist()
    assert found == wanted


def test_slices_are_even(documents):
    rng = random.Random(1)
    texts = [(n, " ".join(f"w{rng.randrange(10**9)}" for _ in range(3000))) for n in range(12)]
    frame = substring_dedup.with_order(documents(texts), "doc_id", "text").select(text_bytes("text").alias("text"), "d", "r1")
    sizes = Counter()
    for row in substring_dedup.anchor_blocks(frame, 20, 5, 8).collect():
        sizes[row["slice"]] += len(row.once)
    assert len(sizes) == 8 and max(sizes.values()) < 1.5 * min(sizes.values())
