"""Near-duplicates, repeated lines, repeated substrings and components against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldheat.llm import line_dedup, simhash, substring_dedup
from fieldheat.llm.components import connected_components
from fieldheat.llm.embedding_dedup import near_vectors


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def groups(nodes, linked):
    """Smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def slow_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[n : n + size]) for n in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(documents, corpus):
    found = simhash.near_duplicates(documents(corpus)).collect()
    prints = [slow_fingerprint(t) for _, t in corpus]
    linked = [
        (a, b) for a in range(len(prints)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3
    ]
    root = groups(range(len(prints)), linked)
    least = defaultdict(list)
    for n, (i, _) in enumerate(corpus):
        least[root[n]].append(i)
    expected = []
    for n, (i, _) in enumerate(corpus):
        ids = [x for x in least[root[n]] if x is not None]
        expected.append((str(i), prints[n], str(min(ids) if ids else None)))
    assert sorted((str(r.id), r.fp % 2**64, str(r.component_id)) for r in found) == sorted(expected)
    assert simhash.near_duplicates(documents([])).count() == 0


def test_every_tile_pair_within_the_radius_is_met(spark, monkeypatch):
    """Dense fingerprints, tiles of a few rows."""
    monkeypatch.setattr(simhash, "TILE", 4)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 12, dtype=np.int64)
    prints = {0, -1}
    for b in base.tolist():
        for _ in range(40):
            flipped = b
            for bit in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                flipped ^= 1 << bit
            prints.add(flipped - 2**64 if flipped >= 2**63 else flipped)
    prints = sorted(prints)
    classes = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.link_pairs(simhash.tile_pairs(simhash.tiles_of(classes), 3), 3)
    roots = {r.node: r.root for r in connected_components(links).collect()}
    linked = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) % 2**64).bit_count() <= 3]
    expected = groups(prints, linked)
    assert {p: roots.get(p, p) for p in prints} == expected


def test_components_of_paths_hubs_and_nothing(spark):
    edges = [(n, n + 1) for n in range(1, 60)] + [(1000, n) for n in range(1001, 1200)] + [(5, 5), (3, 2), (2, 3)]
    random.Random(1).shuffle(edges)
    frame = spark.createDataFrame([*edges, (None, 4), (9000, None)], "src long, dst long")
    found = {r.node: r.root for r in connected_components(frame).collect()}
    assert found == {**{n: 1 for n in range(1, 61)}, **{n: 1000 for n in range(1000, 1200)}}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def slow_lines(rows, least):
    def key(line):
        return re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", lowered(line))

    where = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            where[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or len(where[key(x)]) < least]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("partitions", ["2", "40"])
def test_lines(spark, documents, corpus, partitions):
    rows = [*corpus, *((700 + n, "  Shared line\nown %d" % n) for n in range(200)), *((i, "nine") for i in range(900, 909))]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = line_dedup.dedup_lines(documents(rows), 10, 1).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((str(r.doc.doc_id), r.n_lines, r.n_dropped, r.kept or "") for r in found) == slow_lines(rows, 10)
    assert found[0].doc.keep == "y"
    assert line_dedup.dedup_lines(documents([])).count() == 0


def test_runs_split_over_many_partitions_add_up(spark):
    """One line in every document, more partitions than it would take to see ten documents in any."""
    rows = [(5, 6, n, n, n, 0) for n in range(12)] + [(n, 1, n, n, n, 1) for n in range(100, 130)]
    lines = spark.createDataFrame(rows, "h1 long, h2 long, d long, r1 long, r2 long, position int")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = line_dedup.frequent_lines(lines, 10).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r.r1, r.position) for r in found) == [(n, 0) for n in range(12)]


def test_bitmaps():
    for dropped in ([0], [3, 17], list(range(30)), [7], [8]):
        assert line_dedup.dropped_lines(line_dedup.keep_bitmap(dropped), 40) == dropped


def slow_substrings(rows, size):
    seen, out = set(), {}
    for i, t in rows:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for n in range(len(words) - size + 1):
            window = tuple(words[n : n + size])
            if window in seen:
                gone[n : n + size] = [True] * size
            seen.add(window)
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
    return out


@pytest.mark.parametrize("size", [20, 7])
def test_substrings(documents, corpus, size):
    rows = [(n, t) for n, (_, t) in enumerate(corpus)]
    found = substring_dedup.dedup_substrings(documents(rows), size).collect()
    expected = slow_substrings(rows, size)
    assert {r.doc.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == expected
    assert all(sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) == r.n_removed for r in found)


def test_levels():
    assert substring_dedup.levels_of(20) == [5, 10] and substring_dedup.levels_of(50) == [6, 12, 25]
    assert substring_dedup.levels_of(7) == [3] and substring_dedup.levels_of(2) == [1]


def test_substrings_with_null_and_repeated_ids(documents):
    text = " ".join(f"a{n}" for n in range(30))
    found = substring_dedup.dedup_substrings(documents([(None, text), (4, text), (4, text), (4, None), (9, "a b")])).collect()
    assert sorted((str(r.doc.doc_id), r.n_words, r.n_removed) for r in found) == [
        ("4", 0, 0), ("4", 30, 30), ("4", 30, 30), ("9", 2, 0), ("None", 30, 0),
    ]
    assert substring_dedup.dedup_substrings(documents([])).count() == 0


def vectors_of(n=600, dims=16):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((n, dims))
    near = base[rng.integers(0, 40, n)] + rng.standard_normal((n, dims)) * rng.choice([0.02, 0.1, 0.2, 0.3], (n, 1))
    return np.concatenate([base, near, base[:50]]).astype(np.float32)


def slow_vectors(rows, threshold):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    linked = set()
    usable = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        a = np.array(v, float)
        if a.any():
            usable[i] = (label, a / np.sqrt(a @ a))
    for label in {u[0] for u in usable.values()}:
        own = [i for i in usable if usable[i][0] == label]
        for size in {len(usable[i][1]) for i in own}:
            same = [i for i in own if len(usable[i][1]) == size]
            x = np.stack([usable[i][1] for i in same])
            linked |= {(same[a], same[b]) for a, b in zip(*np.nonzero(x @ x.T >= threshold)) if a != b}
    root = groups(ids, linked)
    return {i: (sum(a == i for a, _ in linked), root[i], root[i] == i) for i in ids}


def test_vectors(spark, monkeypatch):
    from fieldheat.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "TILE", 32)  # buckets are split
    rows = [(n, v.tolist(), n % 3) for n, v in enumerate(vectors_of())]
    nan, inf = float("nan"), float("inf")
    rows += [(5000, None, 1), (5001, [0.0] * 16, 1), (5002, [nan] * 16, 1), (5003, [inf] * 16, 1), (5004, [], 1)]
    rows += [(5005, [None] * 16, 1), (5006, rows[0][1], None), (5007, rows[0][1][:8], 0), (5008, rows[0][1][:8], 0)]
    rows += [rows[3], rows[3]]
    schema = "vec_id long, embedding array<float>, label int"
    found = near_vectors(spark.createDataFrame([*rows, (None, rows[0][1], 0)], schema).repartition(5)).collect()
    expected = slow_vectors(rows, 0.93)
    assert len(found) == len(rows) + 1
    got = {r.id: (r.n_links, r.component_id, r.kept) for r in found if r.id is not None}
    assert [(r.n_links, r.component_id, r.kept) for r in found if r.id is None] == [(0, None, False)]
    links, missed = sum(e[0] for e in expected.values()), sum(abs(got[i][0] - expected[i][0]) for i in expected)
    assert links > 3000 and missed <= 0.001 * links
    assert all(got[i][0] <= expected[i][0] for i in expected)
    if not missed:
        assert got == expected
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0


TEXTS = ["", " ", "a", "a b", "A  b\tc d", " ".join(f"W{n % 17}é" for n in range(300)), "x" * 500, "x" * 90 + " y " * 90]


@pytest.mark.parametrize("text", TEXTS)
def test_long_texts_are_taken_in_pieces(small_pieces, text):
    assert simhash.fingerprint(text.encode(), 3) == slow_fingerprint(text)
    words = text.encode().split()
    plain = substring_dedup.cleaned(text.encode(), None, None, 20)
    assert plain == (b" ".join(words), [], len(words), 0)
    if len(words) > 60:
        kept, spans, n, gone = substring_dedup.cleaned(text.encode(), [2, 50, 5], [1, 3, 2], 10)
        assert spans == [2, 16, 50, 62] and n == len(words) and gone == 26
        assert kept == b" ".join(words[:2] + words[16:50] + words[62:])


def test_windows_of_cut_texts(small_pieces, monkeypatch):
    """Every window once, with the anchors that the uncut text gives."""
    from fieldheat.llm.common import WordHashes

    texts = [t.encode() for t in TEXTS]
    whole = [substring_dedup.windows(g, 20, 10) for g in substring_dedup.segments(texts, WordHashes(), 20)]
    monkeypatch.setattr(substring_dedup, "WORDS_AT_ONCE", 25)
    groups_of = list(substring_dedup.segments(texts, WordHashes(), 20))
    cut = [substring_dedup.windows(g, 20, 10) for g in groups_of]
    assert len(cut) > 5 and len(whole) == 1

    def listed(found, docs):
        return sorted(
            (int(d), int(s), int(w.runs[a]), int(w.runs[p]))
            for w, doc in zip(found, docs)
            for d, s, a, p in zip(doc[w.segment], w.start, w.anchor, w.place)
        )

    first = list(substring_dedup.segments(texts, WordHashes(), 20))
    monkeypatch.undo()
    assert listed(cut, [g.doc for g in first]) == listed(
        whole, [g.doc for g in substring_dedup.segments(texts, WordHashes(), 20)]
    )
