"""Exact complements and best fit against brute force; packing as a round trip."""

import itertools
import struct
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldheat.llm import pieces as cutting
from fieldheat.llm.exact_fit import best_fit, exact_patterns, pack_exactly, plan
from fieldheat.llm.pieces import Slots

WORDS = public_tokenizers.path("word_bpe_49k.json")
WINDOW = 24
LENGTHS = st.lists(st.integers(1, WINDOW), max_size=60)


def counts_of(lengths):
    return np.bincount(lengths, minlength=WINDOW + 1).astype(np.int64)


@settings(max_examples=150, deadline=None)
@given(LENGTHS)
def test_no_exact_complement_is_left(lengths):
    patterns, rest = exact_patterns(counts_of(lengths), WINDOW)
    used = counts_of([])
    for members, windows in patterns:
        assert sum(length * times for length, times in members) == WINDOW
        assert sum(times for _, times in members) <= 4
        for length, times in members:
            used[length] += times * windows
    assert (used + rest == counts_of(lengths)).all() and (rest >= 0).all()
    left = np.repeat(np.arange(WINDOW + 1), np.minimum(rest, 4)).tolist()
    assert not any(sum(c) == WINDOW for n in range(1, 5) for c in itertools.combinations(left, n))


@settings(max_examples=150, deadline=None)
@given(LENGTHS)
def test_best_fit_over_counts_is_best_fit_piece_by_piece(lengths):
    free = []
    for n in sorted(lengths, reverse=True):
        room = min((f for f in free if f >= n), default=None)
        if room is not None:
            free.remove(room)
        free.append((WINDOW if room is None else room) - n)
    found = [
        WINDOW - sum(length * times for length, times in members)
        for members, windows in best_fit(counts_of(lengths), WINDOW)
        for _ in range(windows)
    ]
    assert sorted(found) == sorted(free)


@settings(max_examples=100, deadline=None)
@given(LENGTHS)
def test_every_piece_has_a_place_of_its_own(lengths):
    counts = counts_of(lengths)
    patterns = plan(counts, WINDOW)
    length = np.repeat(np.arange(WINDOW + 1), counts)
    rank = np.concatenate([np.arange(n) for n in counts])
    taken = defaultdict(list)
    if len(length):
        for n, sequence, offset in zip(length, *Slots(patterns).of(length, rank)):
            taken[sequence].append((offset, n))
    assert sorted(taken) == list(range(sum(windows for _, windows in patterns)))
    for own in map(sorted, taken.values()):
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= WINDOW


def ids_of(text):
    return [*Tokenizer.from_file(WORDS).encode(text or "", add_special_tokens=False).ids, 0]


def test_packing_is_a_round_trip(documents, corpus, monkeypatch):
    monkeypatch.setattr(cutting, "OUT_BYTES", 1 << 12)
    distinct = [(n, t) for n, (_, t) in enumerate(corpus)]
    found = pack_exactly(documents(distinct).repartition(7), WORDS, end_id=0, window=256).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert len(r.ids) == 4 * r.length and r.start == 256 * r.piece
        pieces[r.doc_id].append((r.piece, bytes(r.ids)))
        sequences[r.sequence_id].append((r.offset, r.length))
    total = 0
    for number, text in distinct:
        expected = ids_of(text)
        total += len(expected)
        own = sorted(pieces[number])
        assert [p for p, _ in own] == list(range(-(-len(expected) // 256)))
        assert all(len(ids) == 4 * 256 for _, ids in own[:-1])
        assert b"".join(ids for _, ids in own) == struct.pack(f"<{len(expected)}I", *expected)
    for own in map(sorted, sequences.values()):
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 256
    assert len(sequences) <= 1.03 * -(-total // 256)


def test_many_tasks_fill_windows_as_well_as_one(documents, corpus):
    rows = [(n, t) for n, (_, t) in enumerate(corpus)]
    used = {
        tasks: pack_exactly(documents(rows).repartition(tasks), WORDS, 0, 256).select("sequence_id").distinct().count()
        for tasks in (1, 40)
    }
    assert used[1] == used[40]


def test_null_ids_repeats_and_nothing(documents):
    rows = [(None, None), (None, ""), (3, "a b"), (3, "a b"), (4, " \n")]
    found = pack_exactly(documents(rows), WORDS, end_id=0).collect()
    expected = Counter((i, tuple(ids_of(t))) for i, t in rows)
    assert Counter((r.doc_id, struct.unpack(f"<{r.length}I", r.ids)) for r in found) == expected
    assert {r.sequence_id for r in found} == {0} and len({r.offset for r in found}) == 5
    assert pack_exactly(documents([]), WORDS, end_id=0).count() == 0


def test_a_document_as_long_as_a_window_is_not_cut(documents):
    word = "a "
    rows = [(n, word * n) for n in (7, 8, 15, 16)]  # with the end id 8, 9, 16 and 17 ids
    found = sorted((r.doc_id, r.piece, r.length) for r in pack_exactly(documents(rows), WORDS, 0, window=8).collect())
    assert found == [
        (7, 0, 8), (8, 0, 8), (8, 1, 1), (15, 0, 8), (15, 1, 8), (16, 0, 8), (16, 1, 8), (16, 2, 1)
    ]
