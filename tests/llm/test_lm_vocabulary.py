"""LM scores over more words than any fixed table holds."""

import random

import pytest
from test_search_and_scores import slow_scores

from fieldheat.llm.lm_scoring import cross_entropy_difference


def test_lm_scores_tell_all_words_apart(spark, documents):
    rng = random.Random(6)
    rows = [(n, " ".join(f"d{n // 4}w{k}" for k in rng.sample(range(9000), 2600))) for n in range(40)]
    assert len({w for _, t in rows for w in t.split()}) > 65_000
    targets = set(range(0, 40, 2))
    frame = spark.createDataFrame([(n,) for n in targets], "doc_id long")
    found = {r.doc_id: r.score for r in cross_entropy_difference(documents(rows), frame).collect()}
    for i, _, score in slow_scores(rows, targets, 10**9):
        assert found[i] == pytest.approx(score, abs=1e-9)
