"""Decontamination, URL filters, LM scores and toxicity against brute force and held-out rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from fieldheat.llm import decontamination, toxicity
from fieldheat.llm.decontamination import benchmark_hits
from fieldheat.llm.lm_scoring import CONTEXT_PRIOR, WORD_PRIOR, cross_entropy_difference
from fieldheat.llm.url_filters import filter_urls


def slow_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_hits(text, items, size):
    words = slow_words(text)
    hit, found = set(), set()
    for item, own in items:
        own = slow_words(own)
        length = min(size, len(own))
        windows = {tuple(own[n : n + length]) for n in range(len(own) - length + 1)} if length else set()
        for n in range(len(words) - length + 1):
            if length and tuple(words[n : n + length]) in windows:
                hit.update(range(n, n + length))
                found.add(item)
    return len(words), hit, found - {None}


@pytest.mark.parametrize("pattern_bytes, kind", [(1 << 20, "long"), (200, "string")])
def test_benchmark_hits(spark, documents, corpus, pattern_bytes, kind):
    texts = [t for _, t in corpus if t and 30 < len(t.split()) < 200]
    items = [(n, " ".join(texts[n].split()[3 : 3 + size])) for n, size in enumerate((10, 11, 25, 9, 4, 1, 30))]
    items += [(7, None), (8, " . "), (2, items[2][1]), (None, items[6][1]), (9, "nothing of this occurs " * 4)]
    items += [(10, "la " * 12), (11, "la " * 12)]
    rows = [*corpus, (900, items[1][1].upper().replace(" ", "--")), (901, "Ärger é日本 w1")]
    if kind == "string":
        items = [(i if i is None else f"q-{i}", t) for i, t in items]
    bench = spark.createDataFrame(items, f"item_id {kind}, text string")
    found = benchmark_hits(documents(rows), bench, 10, pattern_bytes=pattern_bytes).collect()
    assert len(found) == len(rows)
    expected = []
    for i, t in rows:
        n, hit, own = slow_hits(t, items, 10)
        expected.append((str(i), n, sorted(hit), sorted(map(str, own))))
    got = [
        (str(r.doc.doc_id), r.n_words, [w for a, b in zip(r.spans[::2], r.spans[1::2]) for w in range(a, b)], r["items"])
        for r in found
    ]
    assert sorted(got) == sorted(expected) and any(e[3] for e in expected)
    assert found[0].doc.spans == 1  # a column of that name in the input


def test_benchmark_hits_of_nothing(spark, documents):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert benchmark_hits(documents([]), empty).count() == 0
    assert [r.spans for r in benchmark_hits(documents([(1, "a b")]), empty).collect()] == [[]]


def test_long_texts_are_searched_in_pieces(small_pieces):
    rng = random.Random(3)
    words = [f"w{n}" for n in range(8)]
    items = [(n, " ".join(rng.choices(words, k=k))) for n, k in enumerate((1, 2, 4, 5, 5, 7, 9))]
    engines = decontamination.searchers([(i, t.encode()) for i, t in items], 5)
    for n in (0, 1, 30, 400):
        text = " ".join(rng.choices([*words, "é", "W1,w2"], k=n))
        count, hits, found = decontamination.search(engines, text.encode())
        expected = slow_hits(text, items, 5)
        assert (count, {w for a, b in hits for w in range(a, b)}, found) == expected


def test_shift_tables_skip():
    pattern = tuple(b"a b c d e f g h i j".split())
    engine = decontamination.WuManber(10, {pattern: {1}})
    looked = []

    class Shift(dict):
        def get(self, key, default):
            looked.append(key)
            return dict.get(self, key, default)

    engine.shift = Shift(engine.shift)
    assert list(engine.search([b"x"] * 900 + list(pattern))) == [(900, {1})]
    assert len(looked) < 120


PAGE = "page_id long, url string, html string"


def test_url_rules(spark):
    rules = spark.sql(
        "SELECT * FROM VALUES ('org','/','allow'),('example.org','/es/','block'),('example.org','/en/1','block'),"
        "('com','/fr/','allow'),('com','/de/','block') AS r(host, path, verdict)"
    )
    cases = [
        ("http://A.Example.ORG/es/x?q=/de/", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/en/2#/es/", "example.org", "/en/2", "org/", "allow"),
        ("https://example.org", "example.org", "", None, "block"),  # its host: more of all distrust than of all trust
        ("https://other.org?x", "other.org", "", None, "allow"),
        ("https://myexample.org/es/", "myexample.org", "/es/", "org/", "allow"),
        ("ftp://x.com/de/?a://b", "x.com", "/de/", "com/de/", "block"),
        ("http://com/fr/1", "com", "/fr/1", "com/fr/", "allow"),
        ("http://x.com.net/fr/", "x.com.net", "/fr/", None, "allow"),
        ("example.org/es/", "", "", None, "allow"),
        ("http://ÄX.org?x", "Äx.org", "", None, "allow"),
        ("http:///es/", "", "/es/", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("a://b\n.org/x\ny", "b\n.org", "/x\ny", "org/", "allow"),
    ]
    pages = spark.createDataFrame([(n, c[0], None) for n, c in enumerate(cases)], PAGE)
    found = filter_urls(pages.withColumn("host", F.lit(1)).withColumn("rule", F.lit(2)), rules).orderBy("id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [c[1:] for c in cases]
    assert filter_urls(spark.createDataFrame([], PAGE), rules).count() == 0


def test_trust_and_distrust_follow_links(spark):
    rules = spark.sql("SELECT * FROM VALUES ('good.org','/','allow'),('bad.org','/','block') AS r(host, path, verdict)")

    def link(*hosts):
        return "".join(f"<p><a class=x HREF='http://{h}/p'>t</a>" for h in hosts)

    graph = {
        "good.org": ["fine.net", "both.net"],
        "bad.org": ["innocent.net"],
        "farm.net": ["bad.org", "farm.net"],
        "far.net": ["farm.net"],
        "both.net": ["bad.org"],
        "fine.net": ["far.net", "fine.net"],
        "alone.net": [],
        "innocent.net": [],
    }
    pages = [(n, f"http://{h}/p", link(*out) + '<a href="/own">') for n, (h, out) in enumerate(graph.items())]
    found = filter_urls(spark.createDataFrame(pages, PAGE), rules, rounds=12).collect()
    expected = slow_spread(graph, "good.org", 12), slow_spread(reverse(graph), "bad.org", 12)
    for r in found:
        assert r.trust == pytest.approx(expected[0].get(r.host, 0)) and r.distrust == pytest.approx(expected[1].get(r.host, 0))
    verdicts = {r.host: r.verdict for r in found}
    assert verdicts["farm.net"] == "block" and verdicts["alone.net"] == verdicts["innocent.net"] == "allow"
    assert verdicts["good.org"] == "allow" and verdicts["bad.org"] == "block"


def reverse(graph):
    back = defaultdict(list)
    for host, out in graph.items():
        for other in out:
            back[other].append(host)
    return back


def slow_spread(graph, seed, rounds):
    score = {seed: 1.0}
    for _ in range(rounds):
        new = Counter({seed: 0.15})
        for host, value in score.items():
            out = [o for o in graph.get(host, []) if o != host]
            for other in out:
                new[other] += 0.85 * value / len(out)
        score = new
    return score


def slow_scores(rows, targets, size):
    """Cross-entropy differences from nested counters."""
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split() for _, t in rows]
    counts = Counter(w for own in words for w in own)
    level = {w: math.floor(math.log2(n) * 64) for w, n in counts.items()}
    kept, total = set(), 0
    for at in sorted(set(level.values()), reverse=True):
        total += sum(v == at for v in level.values())
        if total > size:
            break
        kept |= {w for w in level if level[w] == at}
    lines = [["<>", *(w if w in kept else "?" for w in own), "<>"] for own in words]
    halves = [half_of(i) for i, _ in rows]
    vocabulary = len(kept) + 2
    out = []
    for (i, _), line, half in zip(rows, lines, halves):
        others = [n for n in range(len(rows)) if halves[n] != half]
        losses = []
        for chosen in ([n for n in others if rows[n][0] in targets], others):
            pairs = Counter(p for n in chosen for p in zip(lines[n], lines[n][1:]))
            single = Counter(w for n in chosen for w in lines[n][1:])
            every = sum(single.values())
            loss = 0.0
            for v, w in zip(line, line[1:]):
                alone = (single[w] + WORD_PRIOR) / (every + WORD_PRIOR * vocabulary)
                loss -= math.log((pairs[v, w] + CONTEXT_PRIOR * alone) / (single[v] + CONTEXT_PRIOR))
            losses.append(loss / (len(line) - 1))
        out.append((i, len(line) - 2, losses[0] - losses[1]))
    return out


def half_of(ident):
    if ident is None:
        return 42 % 2
    return (xxhash.xxh64_intdigest(ident.to_bytes(8, "little", signed=True), 42) - 0) % 2


@pytest.mark.parametrize("size", [50, 65_000])
def test_lm_scores(spark, documents, corpus, size, monkeypatch):
    from fieldheat.llm import lm_scoring

    monkeypatch.setattr(lm_scoring, "TOKENS_AT_ONCE", 3000)
    monkeypatch.setattr(lm_scoring, "BUCKET_TOKENS", 4000)
    targets = {n for n in range(0, 60, 3)} | {600}
    frame = spark.createDataFrame([(n,) for n in [*targets, *targets, None]], "doc_id long")
    found = cross_entropy_difference(documents(corpus), frame, size).collect()
    expected = slow_scores(corpus, targets, size)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for got, wanted in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert got[:2] == wanted[:2] and got[2] == pytest.approx(wanted[2], abs=1e-5)


def test_lm_scores_of_nothing(spark, documents):
    none = spark.createDataFrame([], "doc_id long")
    assert cross_entropy_difference(documents([]), none).count() == 0
    assert cross_entropy_difference(documents([(1, "a b"), (2, None)]), none).count() == 2


def test_lm_scores_tell_targets_from_others(spark, documents):
    rng = random.Random(4)
    vocabularies = [[f"t{n}" for n in range(60)], [f"o{n}" for n in range(60)]]
    rows = [(n, " ".join(rng.choices(vocabularies[n % 2] + ["the", "of"], k=60))) for n in range(300)]
    targets = spark.createDataFrame([(n,) for n in range(0, 150, 2)], "doc_id long")
    found = {r.doc_id: r.score for r in cross_entropy_difference(documents(rows), targets).collect()}
    assert max(found[n] for n in range(150, 300, 2)) < min(found[n] for n in range(151, 300, 2))


LABELS = "doc_id long, quality int, toxic int"


def toxic_corpus(n=1500):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(n):
        text = rng.choices(words, k=rng.randint(5, 150))
        bad = rng.random() < 0.15
        if bad:
            for _ in range(rng.randint(1, 4)):
                text.insert(rng.randrange(len(text)), rng.choice(["Idiot,", "moron", f"grumsk{rng.randrange(9)}a", "blargh!"]))
        rows.append((k, " ".join(text)))
        labels.append((k, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, documents):
    rows, labels = toxic_corpus()
    noisy = [(i, q, 1 - t if i % 41 == 0 and zlib.crc32(str(i).encode()) % 5 else t) for i, q, t in labels]
    noisy += [(None, 1, 1), (3, 1, None), (4, 1, 7), (10**6, 1, 1), (5, 1, noisy[5][2])]
    extra = [(None, None), (None, "you moron"), (7000, ""), (7, rows[7][1])]
    found = toxicity.toxicity(documents([*rows, *extra]), spark.createDataFrame(noisy, LABELS)).collect()
    assert len(found) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in found)
    truth = {i: t for i, _, t in labels}
    held = [r for r in found if r.doc.doc_id in truth and zlib.crc32(str(r.doc.doc_id).encode()) % 5 == 0]
    assert len(held) > 200
    wrong = [r for r in held if (r.score >= 0.5) != truth[r.doc.doc_id]]
    assert len(wrong) <= 0.02 * len(held)


def test_held_out_labels_are_not_learned(spark, documents):
    rows, labels = toxic_corpus(600)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    scores = [
        {r.doc.doc_id: r.score for r in toxicity.toxicity(documents(rows), spark.createDataFrame(given, LABELS)).collect()}
        for given in (labels, flipped)
    ]
    assert scores[0] == scores[1]


def test_toxicity_bounds_are_parameters(spark, documents):
    rows, labels = toxic_corpus(600)
    frames = documents(rows), spark.createDataFrame(labels, LABELS)
    sizes = [len(toxicity.fit(*frames, features=n).units) for n in (2, 5)]
    lexicon = len(set(toxicity.LEXICON))
    assert sizes[0] <= 2 + lexicon and sizes[0] < sizes[1] <= 5 + lexicon
    found = toxicity.toxicity(*frames, features=50, mined_voters=3).collect()
    truth = {i: t for i, _, t in labels}
    assert sum((r.score >= 0.5) != truth[r.doc.doc_id] for r in found) <= 0.05 * len(found)


def test_a_very_long_text_is_scored_whole(spark, documents):
    rows, labels = toxic_corpus(600)
    filler = " ".join(f"filler{n}" for n in range(200_000))
    found = toxicity.toxicity(documents([*rows, (9000, f"{filler} {rows[0][1]}"), (9001, rows[0][1])]), spark.createDataFrame(labels, LABELS))
    scores = {r.doc.doc_id: r.score for r in found.where("doc.doc_id >= 9000").collect()}
    assert scores[9000] == pytest.approx(scores[9001], abs=1e-9)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(1, 1, 1), (2, 0, 1)]])
def test_toxicity_without_both_labels(spark, documents, labels):
    found = toxicity.toxicity(documents([(1, "a"), (2, None)]), spark.createDataFrame(labels, LABELS)).collect()
    assert {r.score >= 0.5 for r in found} == {bool(labels) and labels[0][2] == 1}
    assert toxicity.toxicity(documents([]), spark.createDataFrame(labels, LABELS)).count() == 0


def test_correlated_voters_count_as_one():
    """Five copies of one noisy voter against two independent ones; labels say little."""
    import numpy as np

    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    vote = lambda hit, false: np.where(truth, rng.random(4000) < hit, rng.random(4000) < false)
    same = vote(0.6, 0.3)
    votes = np.stack([*[same] * 5, vote(0.9, 0.05), vote(0.9, 0.05)], axis=1)
    found = toxicity.label_model(votes.astype(np.float32), truth.astype(int))
    assert ((found >= 0.5) == truth).mean() > 0.97


def planted_votes(size, seed):
    """Votes of six voters: 1 copies 0 mostly, 3 avoids 2, 4 and 5 stand alone; rates by label, and the true labels."""
    import numpy as np

    parent = np.array([-1, 0, -1, 2, -1, -1])
    given_vote = np.array([[0.1, 0.7, 0.2, 0.02, 0.05, 0.3], [0.7, 0.95, 0.6, 0.2, 0.6, 0.4]])
    given_none = np.array([[0.1, 0.03, 0.2, 0.3, 0.05, 0.3], [0.7, 0.2, 0.6, 0.9, 0.6, 0.4]])
    rng = np.random.default_rng(seed)
    truth = (rng.random(size) < 0.3).astype(int)
    votes = np.zeros((size, 6), np.float32)
    for n in range(6):
        theirs = votes[:, parent[n]] > 0 if parent[n] >= 0 else np.zeros(size, bool)
        votes[:, n] = rng.random(size) < np.where(theirs, given_vote[truth, n], given_none[truth, n])
    return toxicity.Voters(parent, given_vote, given_none), votes, truth


def chances_by_hand(voters):
    """Chance of each of the patterns of votes under label 0 and 1, voter by voter."""
    from itertools import product

    found = {}
    for pattern in product((0, 1), repeat=len(voters.parent)):
        for label in (0, 1):
            chance = 1.0
            for n, vote in enumerate(pattern):
                theirs = voters.parent[n] >= 0 and pattern[voters.parent[n]]
                rate = (voters.given_vote if theirs else voters.given_none)[label][n]
                chance *= rate if vote else 1 - rate
            found.setdefault(pattern, []).append(chance)
    return found


def test_evidence_of_votes_equals_that_of_all_patterns():
    import numpy as np

    _, votes, truth = planted_votes(3000, 1)
    voters = toxicity.voters_of(votes, truth.astype(float))
    chances = chances_by_hand(voters)
    assert np.allclose(np.sum(list(chances.values()), axis=0), 1)
    patterns = np.array(list(chances))
    assert np.allclose(voters.evidence(patterns), [math.log(c[1] / c[0]) for c in chances.values()])


def test_planted_rates_and_correlations_are_recovered():
    """With every tenth label wrong: rates, links of either sign, and as likely a model as the planted one."""
    import numpy as np

    planted, votes, truth = planted_votes(20_000, 2)
    labels = np.where(np.arange(len(truth)) % 10 == 0, 1 - truth, truth)
    posterior = toxicity.label_model(votes, labels, rounds=40)
    # No worse than deciding with the planted rates themselves known, and better than the labels.
    best = math.log(0.3 / 0.7) + np.where(labels, 1, -1) * math.log(9) + planted.evidence(votes)
    right = ((posterior >= 0.5) == truth).mean()
    assert right > ((best >= 0) == truth).mean() - 0.005 and right > (labels == truth).mean() + 0.03
    found = toxicity.voters_of(votes, posterior)
    links = {frozenset((n, int(p))) for n, p in enumerate(found.parent) if p >= 0}
    assert {frozenset((0, 1)), frozenset((2, 3))} <= links
    for label in (0, 1):
        own = np.array([votes[truth == label, n].mean() for n in range(6)])
        weight = posterior if label else 1 - posterior
        assert np.abs(votes.T @ weight / weight.sum() - own).max() < 0.04
        apart = toxicity.voted_together(votes, weight) / weight.sum()
        assert apart[2, 3] < apart[2, 2] * apart[3, 3] and apart[0, 1] > apart[0, 0] * apart[1, 1]

    def likelihood(voters, share):
        chances = chances_by_hand(voters)
        return np.mean([math.log((1 - share) * c[0] + share * c[1]) for c in (chances[tuple(v)] for v in votes.astype(int))])

    assert likelihood(found, posterior.mean()) > likelihood(planted, 0.3) - 0.005


def test_labels_only_anchor():
    """Votes that agree overrule wrong labels; without a vote that tells, labels stand."""
    import numpy as np

    _, votes, truth = planted_votes(5000, 3)
    strong = np.concatenate([votes, votes[:, [4]], np.where(truth, 0.9, 0.05)[:, None] > np.random.default_rng(4).random((5000, 8))], axis=1)
    labels = np.where(np.arange(5000) % 20 == 0, 1 - truth, truth)
    found = toxicity.label_model(strong.astype(np.float32), labels) >= 0.5
    assert (found == truth).mean() > 0.99 > (labels == truth).mean()
    assert ((toxicity.label_model(np.zeros((50, 2), np.float32), truth[:50]) >= 0.5) == truth[:50]).all()


def test_border_lies_in_the_widest_gap():
    import numpy as np

    assert toxicity.border(np.array([0.0, 1.0, 5.0, 6.0]), np.array([False, False, True, True])) == 3.0
    assert toxicity.border(np.array([1.0, 1.0]), np.array([True, True])) < 1
