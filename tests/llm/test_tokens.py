"""Token counts and packing against the library, document by document."""

import struct
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldheat.llm.common import safe_pieces
from fieldheat.llm.packing import best_fit_decreasing, pack
from fieldheat.llm.token_counts import token_counts
from fieldheat.llm.word_encoder import encoder, letters_are_whole, white_space_is_border

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


def test_borders_are_read_from_the_file():
    assert white_space_is_border(WORDS) and letters_are_whole(WORDS)
    assert not white_space_is_border(BYTES) and not letters_are_whole(BYTES)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB é́ÉİßΣ1²'s.,!?<|endoftxART>\n\t\x0b\x1c\x85  日😀‍[`~"), max_size=40), max_size=5))
def test_word_by_word_equals_whole_texts(texts):
    texts = [*texts, "a<|endoftext|>b <|EndOfText|> it's,", "x" * 100]
    found = defaultdict(bytes)
    for number, ids in encoder(WORDS).pieces([t.encode() for t in texts]):
        found[number] += ids
    for number, text in enumerate(texts):
        expected = ids_of(WORDS, text)
        assert found[number] == struct.pack(f"<{len(expected)}I", *expected)


def test_safe_pieces_join_to_the_text():
    text = b"aa bb\tcc " * 100 + b"d" * 50
    pieces = list(safe_pieces(text, 20))
    assert b"".join(pieces) == text and len(pieces) > 10
    assert [w for p in pieces for w in p.split()] == text.split()


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_counts(documents, corpus, path):
    found = token_counts(documents(corpus), path).collect()
    expected = sorted((i is None, i or 0, len((t or "").encode()), len(ids_of(path, t))) for i, t in corpus)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in found) == expected


def test_counts_of_nothing(documents):
    assert token_counts(documents([]), WORDS).count() == 0


def test_packing_is_a_round_trip(documents, corpus):
    distinct = [(n, t) for n, (_, t) in enumerate(corpus)]
    found = pack(documents(distinct), WORDS, end_id=1, window=256).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r.doc_id].append((r.start, r.length, bytes(r.ids), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for number, text in distinct:
        expected = [*ids_of(WORDS, text), 1]
        own = sorted(pieces[number])
        assert b"".join(p[2] for p in own) == struct.pack(f"<{len(expected)}I", *expected)
        assert [p[0] for p in own] == [sum(q[1] for q in own[:k]) for k in range(len(own))]
        assert {p[3] for p in own} == {len(expected)} and all(len(p[2]) == 4 * p[1] for p in own)
    for own in map(sorted, sequences.values()):
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 256
    used = sum(n for own in sequences.values() for _, n in own)
    assert used / (256 * len(sequences)) > 0.95


def test_packing_null_ids_repeats_and_nothing(documents):
    found = pack(documents([(None, None), (None, None), (3, "a b"), (3, "a b")]), WORDS, end_id=1).collect()
    assert sorted((r.doc_id or 0, r.length, zlib.crc32(r.ids)) for r in found)[:2] == [
        (0, 1, zlib.crc32(struct.pack("<I", 1)))
    ] * 2
    assert len(found) == 4
    assert pack(documents([]), WORDS, end_id=1).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_takes_the_tightest_window(lengths):
    found = best_fit_decreasing(np.bincount(lengths, minlength=65), 64)
    free = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else 64) - n)
    used = [(sum(n * times for n, times in members), windows) for members, windows in found]
    assert sorted(64 - total for total, windows in used for _ in range(windows)) == sorted(free)
    packed = [n for members, windows in found for n, times in members for _ in range(times * windows)]
    assert sorted(packed) == sorted(lengths)


def test_many_tasks_fill_sequences_as_well_as_one(spark):
    """At 211 partitions of the benchmark documents nearly nothing is padding."""
    folder = Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("benchmark tables not present")
    docs = spark.read.parquet(str(folder / "documents.parquet")).repartition(211)
    total, sequences = pack(docs, WORDS, end_id=1).selectExpr("sum(length)", "count(DISTINCT sequence_id)").first()
    assert total / (2048 * sequences) >= 0.97
