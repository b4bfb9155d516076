"""Toxicity: lexicon and pattern voters, a generative label model, and a linear classifier on its posterior labels."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, stage, text_bytes

SAMPLE = 20_000
MINED_VOTERS = 300
FEATURES = 20_000
MIN_DOCS = 4
LABEL_ACCURACY = 0.9
ANCHOR = 0.25
PREFIXES = (3, 4, 5, 6)
# Marks that part words, ASCII ones and others.
MARKS = bytes.maketrans(b".,;:!?\"'`()[]{}<>*_~-|/\\", b" " * 24)
OTHER_MARKS = "…´«»„“”‚‘’–—¡¿"

# Common insults, each a voter of its own.
LEXICON = """
arse asshole awful bastard bitch brainless clown coward cretin damn despicable dimwit disgusting dumb dumbass filth
filthy fool fraud freak fuck garbage hate hideous horrible hypocrite idiot idiotic idiots ignorant imbecile jerk kill
lame liar loser losers lunatic moron moronic nasty nobody parasite pathetic pig psycho pussy rat repulsive retard
revolting scum shit shut sick slut stupid suck sucks trash ugly useless vermin vile weak whore worm worthless wretch
arschloch bastard blöd depp dreck dumm dummkopf fotze hässlich hurensohn idioten lügner mist müll penner sau
scheisse scheiße schlampe schwein trottel verlierer versager vollidiot wertlos widerlich
abruti connard connasse con crétin débile dégueulasse imbécile merde minable nul ordure pathétique perdant pute
raclure salaud salope stupide
basura cabrón cerdo escoria estúpido estúpida gilipollas idiota imbécil inútil maldito mierda pendejo perdedor
perra puta puto tonto
""".split()

# Patterns in the text as it stands, each a voter of its own. Each comes with strings one of which the
# lower-cased text must hold for the pattern to occur, since looking for those is much faster.
PATTERNS = {
    "shouting": (r"[A-Z]{4,}\W+[A-Z]{4,}", []),
    "exclamations": (r"!{2,}", ["!!"]),
    "mixed marks": (r"!\?|\?!", ["!?", "?!"]),
    "masked letters": (r"\b\w[*#@$%]{2,}\w*", list("*#@$%")),
    "swearing signs": (r"[#@$%&*!]{4,}", [*"#@$%&*", "!!!!"]),
    "stretched letters": (r"([A-Za-z])\1{3,}", [chr(c) * 4 for c in range(97, 123)]),
    "digits in words": (r"(?<=[a-z])[013457]+(?=[a-z])", list("013457")),
    "address": (r"(?i)\byou(?:'re| are| r) (?:an? )?\w+", ["you're ", "you are ", "you r "]),
    "command": (r"(?i)\b(?:shut up|get lost|go away|drop dead)\b", ["shut up", "get lost", "go away", "drop dead"]),
}


def words_of(lower: str) -> set[str]:
    """Distinct words of a lower-cased text, without marks."""
    if any(m in lower for m in OTHER_MARKS):
        lower = lower.translate(dict.fromkeys(map(ord, OTHER_MARKS), " "))
    return set(lower.encode("utf-8", "replace").translate(MARKS).decode().split())


def units_of(word: str) -> list[str]:
    """What a word stands for: itself, and its beginnings."""
    return [f"={word}", *(f"^{word[:n]}" for n in PREFIXES if len(word) > n)]


class Units:
    """Chosen units and their places; finds those of a text by few look-ups."""

    def __init__(self, units: list[str]):
        self.places = {u: n for n, u in enumerate(units)}
        self.words = {u[1:] for u in units if u[0] == "="}
        self.starts = {u[1 : 1 + PREFIXES[0]] for u in units if u[0] == "^"}

    def of(self, lower: str) -> list[int]:
        words, size = words_of(lower), PREFIXES[0]
        found = {self.places[f"={w}"] for w in words & self.words}
        starts = {w[:size] for w in words} & self.starts
        if starts:
            own = (u for w in words if w[:size] in starts for u in units_of(w))
            found.update(self.places[u] for u in own if u in self.places)
        return sorted(found)


def patterns_in(text: str, lower: str) -> list[int]:
    return [
        n
        for n, (pattern, hints) in enumerate(_COMPILED)
        if (not hints or any(h in lower for h in hints)) and pattern.search(text)
    ]


_COMPILED = [(re.compile(p), hints) for p, hints in PATTERNS.values()]


class Model(NamedTuple):
    """A linear classifier over units and patterns."""

    units: list[str]
    unit_weights: np.ndarray
    pattern_weights: np.ndarray
    bias: float


def training_rows(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str) -> DataFrame:
    """`text` and `toxic` of at most `sample` labelled documents outside the held-out fifth, picked by a hash of the id.

    Rows of `labels` without an id or with another label than 0 and 1 do not count; of differing labels the more
    frequent one does, 1 on a tie. A repeated document counts once.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    present = docs.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = stage(known.join(present.distinct(), "id", "left_semi"), "known_labels")
    # Thinned first, so that few rows beyond the sample meet to be ordered.
    place = F.pmod(F.xxhash64("id"), F.lit(max(1, known.count())))
    picked = F.broadcast(known.where(place < 2 * sample).orderBy(place, "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = texts.join(picked, "id").groupBy("id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic"))
    return found.select(text_bytes("text").alias("text"), "toxic")


def held_out(ident: F.Column) -> F.Column:
    """Whether crc32 of the id as text leaves no rest by 5; not for null."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def unit_counts(rows: DataFrame) -> DataFrame:
    """Documents with each unit, by label: `unit`, `n1`, `n0`."""

    def counted(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        ones, zeros = Counter(), Counter()
        for batch in stream:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = words_of(text.decode("utf-8", "replace").lower())
                (ones if toxic else zeros).update({u for w in words for u in units_of(w)})
            if len(ones) + len(zeros) > 1_000_000:
                yield columns(ones, zeros)
                ones, zeros = Counter(), Counter()
        yield columns(ones, zeros)

    def columns(ones: Counter, zeros: Counter) -> dict:
        units = list(ones.keys() | zeros.keys())
        n1, n0 = ([c[u] for u in units] for c in (ones, zeros))
        return {"unit": pa.array(units, pa.string()), "n1": pa.array(n1, pa.int64()), "n0": pa.array(n0, pa.int64())}

    blocks = arrow_map(rows, counted, "unit string, n1 long, n0 long")
    return blocks.groupBy("unit").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def chosen_units(counts: DataFrame, ones: int, zeros: int, features: int, voters: int) -> tuple[list[str], list[str]]:
    """The units that tell about the label beyond chance, and those among them that vote: the ones that speak for 1.

    Measured by the likelihood ratio G. Among as many unrelated units as there are, about one would reach twice the
    logarithm of their number; a quarter more is asked for.
    """
    n1, n0 = F.col("n1"), F.col("n0")
    share = ones / (ones + zeros)

    def term(n: F.Column, expected: F.Column) -> F.Column:
        return F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)

    gain = 2 * (term(n1, (n1 + n0) * share) + term(n0, (n1 + n0) * (1 - share)))
    frequent = counts.where(n1 + n0 >= MIN_DOCS)
    least = 2.5 * np.log(max(2, frequent.count()))
    best = frequent.select("unit", "n1", "n0", gain.alias("gain")).where(F.col("gain") >= float(least))
    rows = best.orderBy(F.desc("gain"), "unit").limit(features).collect()
    speaking = [r.unit for r in rows if r.n1 / (r.n1 + r.n0) > max(0.5, share)]
    return [r.unit for r in rows], speaking[:voters]


class Voters(NamedTuple):
    """How voters vote under label 0 and label 1: each given the vote of the one voter it depends on most.

    `parent` is that voter's place, -1 for none. `given_vote` and `given_none` are the rates of voting, one row per
    label, where the parent voted and where it did not (or there is none). Since a parent never depends on its
    dependants, the rates multiply to the chance of all votes under a label.
    """

    parent: np.ndarray
    given_vote: np.ndarray
    given_none: np.ndarray

    def evidence(self, votes: np.ndarray) -> np.ndarray:
        """Logarithm of how much likelier the votes (0 or 1) of each row are under label 1 than under label 0."""
        depends, place = self.parent >= 0, np.maximum(self.parent, 0)
        yes_vote, yes_none = (np.log(r[1] / r[0]) for r in (self.given_vote, self.given_none))
        no_vote, no_none = (np.log((1 - r[1]) / (1 - r[0])) for r in (self.given_vote, self.given_none))
        own = yes_none - no_none
        others = np.where(depends, no_vote - no_none, 0)
        both = np.where(depends, yes_vote - yes_none - others, 0)
        total = np.empty(len(votes))
        for at in range(0, len(votes), 2048):
            block = votes[at : at + 2048].astype(np.float64)
            theirs = block[:, place]
            total[at : at + 2048] = no_none.sum() + block @ own + theirs @ others + (block * theirs) @ both
        return total


def voted_together(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weight of the rows in which each two voters vote, added up in blocks of rows."""
    met = np.zeros((votes.shape[1],) * 2)
    for at in range(0, len(votes), 2048):
        block = votes[at : at + 2048].astype(np.float64)
        met += (block * weight[at : at + 2048, None]).T @ block
    return met


def information(met: np.ndarray, size: float) -> np.ndarray:
    """What the vote of one voter tells about another's, summed over rows: more, the stronger they go together or apart."""
    one = np.diag(met)[:, None] + np.zeros_like(met)
    other = one.T
    told = np.zeros_like(met)
    for cell, first, second in (
        (met, one, other),
        (one - met, one, size - other),
        (other - met, size - one, other),
        (size - one - other + met, size - one, size - other),
    ):
        there = (cell > 1e-9) & (first > 0) & (second > 0)
        told[there] += cell[there] * np.log(cell[there] * size / (first[there] * second[there]))
    return told


def dependences(told: np.ndarray, least: float) -> np.ndarray:
    """Each voter's parent: the forest of links that tell most, without those that tell less than `least`."""
    parent = np.full(len(told), -1)
    best, near = np.full(len(told), -1.0), np.full(len(told), -1)
    left = np.ones(len(told), bool)
    for _ in range(len(told)):
        place = int(np.argmax(np.where(left, best, -2.0)))
        left[place] = False
        if best[place] >= least:
            parent[place] = near[place]
        closer = told[place] > best
        best, near = np.where(closer, told[place], best), np.where(closer, place, near)
    return parent


def voters_of(votes: np.ndarray, weight: np.ndarray) -> Voters:
    """Rates and dependences of voters, from rows that have label 1 with the chance `weight`.

    A link must tell more than chance would: among as many unrelated pairs as there are, about one would reach the
    logarithm of their number; a quarter more is asked for.
    """
    size = np.array([len(weight) - weight.sum(), weight.sum()])
    met = [voted_together(votes, 1 - weight), voted_together(votes, weight)]
    pairs = len(met[0]) * (len(met[0]) - 1) / 2
    parent = dependences(sum(information(m, n) for m, n in zip(met, size)), 1.25 * np.log(max(2.0, pairs)))
    depends, place = parent >= 0, np.maximum(parent, 0)
    given_vote, given_none = [], []
    for m, n in zip(met, size):
        alone = (np.diag(m) + 0.05) / (n + 1)
        both = m[np.arange(len(m)), place]
        theirs = np.diag(m)[place]
        given_vote.append(np.where(depends, (both + alone) / (theirs + 1), alone))
        given_none.append(np.where(depends, (np.diag(m) - both + alone) / (n - theirs + 1), alone))
    return Voters(parent, *(np.clip(r, 1e-6, 1 - 1e-6) for r in (given_vote, given_none)))


def label_model(
    votes: np.ndarray,
    labels: np.ndarray,
    rounds: int = 15,
    label_accuracy: float = LABEL_ACCURACY,
    anchor: float = ANCHOR,
) -> np.ndarray:
    """Posterior of label 1 for each row, from votes (0 or 1) and given labels.

    The true label is hidden. Expectation maximisation estimates, under either value of it, each voter's rate of voting
    and its correlation, of either sign, with the voter it depends on most, so voters that go together are no independent
    witnesses. The given label fixes which value is which: it counts for `anchor` of a row where rates are estimated, the
    posterior for the rest, and is one more witness, of a fixed accuracy.
    """
    sure = np.log(label_accuracy / (1 - label_accuracy))
    given = np.where(labels > 0, 0.98, 0.02)
    posterior = given
    for _ in range(rounds):
        weight = anchor * given + (1 - anchor) * posterior
        share = (weight.sum() + 1) / (len(weight) + 2)
        score = np.log(share / (1 - share)) + np.where(labels > 0, sure, -sure) + voters_of(votes, weight).evidence(votes)
        before, posterior = posterior, 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(posterior - before).max() < 1e-4:
            break
    return posterior


def logistic(rows: np.ndarray, places: np.ndarray, n: int, m: int, target: np.ndarray, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on 0-1 features, given as (row, place) pairs, by Adam."""
    weights = np.zeros(m + 1)
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    weights[m] = np.log(share / (1 - share))
    for t in range(1, rounds + 1):
        score = np.bincount(rows, weights[places], n) + weights[m]
        miss = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - target
        slope = np.append(np.bincount(places, miss[rows], m) / n, miss.mean())
        slope[:m] += 1e-5 * weights[:m]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        weights -= 0.3 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    linear = np.bincount(rows, weights[places], n)
    return weights[:m], -border(linear, target >= 0.5)


def border(linear: np.ndarray, positive: np.ndarray) -> float:
    """The value that parts positive from other rows with the fewest errors; the middle of the widest such gap."""
    order = np.argsort(linear, kind="stable")
    values, hits = linear[order], positive[order]
    errors = np.concatenate([[0], np.cumsum(hits)]) + np.concatenate([np.cumsum(~hits[::-1])[::-1], [0]])
    edges = np.concatenate([[values[0] - 1], values, [values[-1] + 1]])
    gap = np.diff(edges)
    best = np.flatnonzero((errors == errors[gap > 0].min()) & (gap > 0))
    at = best[np.argmax(gap[best])]
    return float(edges[at] + edges[at + 1]) / 2


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    features: int = FEATURES,
    mined_voters: int = MINED_VOTERS,
) -> Model:
    """The classifier, from a bounded sample of labelled documents outside the held-out fifth.

    Voters are the words of LEXICON, the PATTERNS, and units mined from the sample that occur mostly under label 1.
    `sample` bounds the labelled rows, `features` the units of the classifier and `mined_voters` the mined voters, the
    most telling first; the driver holds a table of `sample` by voters votes (4 bytes each).
    Without a training row of either label the model knows only the share of label 1 (0 without rows).
    """
    rows = stage(training_rows(docs, labels, sample, id_col, text_col), "labelled")
    seen = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    ones, zeros = seen.get(1, 0), seen.get(0, 0)
    nothing = np.zeros(0), np.zeros(len(PATTERNS))
    if not ones or not zeros:
        return Model([], *nothing, 30.0 if ones else -30.0)
    units, mined = chosen_units(unit_counts(rows), ones, zeros, features, mined_voters)
    units = list(dict.fromkeys([*units, *(f"={w}" for w in LEXICON)]))
    places = {u: n for n, u in enumerate(units)}
    voters = list(dict.fromkeys([places[u] for u in [*mined, *(f"={w}" for w in LEXICON)]]))

    def present(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = Units(units)
        for batch in stream:
            texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            lowered = [t.lower() for t in texts]
            found = [known.of(o) + [len(units) + p for p in patterns_in(t, o)] for t, o in zip(texts, lowered)]
            yield {"toxic": batch.column("toxic"), "places": pa.array(found, pa.list_(pa.int32()))}

    # At most `sample` rows, each with some of `features` places, as flat arrays.
    table = arrow_map(rows, present, "toxic int, places array<int>").toArrow().combine_chunks()
    toxic, lists = table.column("toxic").to_numpy(), table.column("places").combine_chunks()
    place = lists.flatten().to_numpy().astype(np.int32)
    row = np.repeat(np.arange(len(toxic), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    voting = np.full(len(units) + len(PATTERNS), -1)
    everyone = np.array([*voters, *range(len(units), len(units) + len(PATTERNS))])
    voting[everyone] = np.arange(len(everyone))
    votes = np.zeros((len(toxic), len(everyone)), np.float32)
    spoken = voting[place] >= 0
    votes[row[spoken], voting[place[spoken]]] = 1
    target = label_model(votes, toxic)
    weights, bias = logistic(row, place, len(toxic), len(voting), target)
    return Model(units, weights[: len(units)], weights[len(units) :], bias)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`doc` (a struct of all columns) and `score`, the chance of label 1, for every row.

    Null and empty texts have no units and get the score of the bias. Whole texts are read; no row is shuffled.
    The model is bounded by its number of features.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = shared.value
        known = Units(own.units)
        for batch in stream:
            scores = []
            for text in batch.column("text").to_pylist():
                text = text.decode("utf-8", "replace")
                lower = text.lower()
                total = own.bias + sum(own.unit_weights[n] for n in known.of(lower))
                total += sum(own.pattern_weights[n] for n in patterns_in(text, lower))
                scores.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
            yield {"doc": batch.column("doc"), "score": pa.array(scores, pa.float64())}

    picked = docs.select(F.struct("*").alias("doc"), text_bytes(text_col).alias("text"))
    return arrow_map(picked, rows, f"doc {picked.schema['doc'].dataType.simpleString()}, score double")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    features: int = FEATURES,
    mined_voters: int = MINED_VOTERS,
) -> DataFrame:
    """`scored` with the model of `fit` on the same documents, with the same bounds.

    Repeated rows are scored each, null ids too (they are never trained on or held out); an empty table gives no
    rows. Language, source, ids and labels are no features.
    """
    return scored(docs, fit(docs, labels, sample, id_col, text_col, features, mined_voters), text_col)
