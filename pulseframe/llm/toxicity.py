"""Toxicity scores by weak supervision.

1. Voters. Terms (words and word beginnings) are proposed by how much more often they occur in toxic rows of a bounded
   labelled sample; each gives two voters, one on occurrence and one on a rate of ``RATE`` of the words. The commonest
   terms come first; toxic rows that have few of them, as those of a small language or topic, add terms of their own.
   Fixed voters are a short lexicon, an address pattern, and voters on the number and the rate of all terms, which alone
   vote for clean, and only on texts most of whose words they know from labelled rows.
2. Label model. A generative model without labels: a hidden class, and per voter the chance of each vote given the class,
   fitted by expectation maximisation on the sample with more, unlabelled documents. Correlations of the voters given the class
   are estimated from the residuals, and a voter's evidence is divided by how much of it others repeat.
3. Classifier. Logistic regression on hashed words and word beginnings, trained on the label model's posterior labels. Its
   margin is a sum over the distinct words, each by its rate up to one per cent, whatever the length of the document.

Labels are read from rows only whose crc32(doc_id as text) modulo 3 is not 1, at most ``PER_LABEL`` of each label, and
at most ``UNLABELLED`` more documents of those rows, both the first by a hash of the id; nothing else reaches the driver.
Only texts enter a score. Scoring has no shuffle.

Defined cases: NULL and empty texts have no words and get the score of the bias; a NULL id is not held out and not
sampled; labels other than 0 and 1 are ignored; of several labels of an id the largest counts. Without a label of either class every score is 0.
Repeated rows give repeated rows with equal scores; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import sys
from array import array
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pulseframe.llm.common import CACHE_WORDS, WORD, map_texts

PER_LABEL = 1500
UNLABELLED = 2000
THRESHOLD = 0.7
# Voters: lengths of word beginnings, most terms, least toxic documents and least precision of a term, the rate.
BEGINNINGS = (4, 5, 6)
TERMS = 60
LEAST_DOCUMENTS, LEAST_SHARE = 6, 0.03
LEAST_PRECISION = 0.85
# Terms for small groups: voters that a toxic row should have, chance that a term without a meaning is so one-sided.
COVER = 8
CHANCE = 1e-4
# Least share of known words of a text that gets a vote for clean.
KNOWN_SHARE = 0.5
RATE = 0.006
# A short general lexicon and a pattern of address.
LEXICON = frozenset("""
    idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown fool
    fools imbecile jerk creep filthy vermin
""".split())
ADDRESS = re.compile(r"\b(?:you|your|they)(?:'re| are)? (?:a |an |all |so |such )*(?:" + "|".join(sorted(LEXICON)) + r")\b")
# Label model and classifier.
ROUNDS, PASSES = 40, 3
CLEAR_MAJORITY = 3
LEAST_CORRELATION = 0.1
FEATURES = 1 << 18
KEPT_FEATURES = 6000
STEPS, LEARNING, DECAY = 250, 0.05, 1e-3
SCALE = 100.0


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def terms_of(word: str) -> list[str]:
    """The word, marked at its end, and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) > n)]


@dataclass
class Sample:
    """Words of the sampled documents as counts, and their labels (NaN: none)."""

    words: list[Counter] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    addressed: list[bool] = field(default_factory=list)
    labels: list[float] = field(default_factory=list)
    toxic_share: float = 0.1

    def add(self, text: str | None, label: float) -> None:
        lower = (text or "").lower()
        found = WORD.findall(lower)
        self.words.append(Counter(map(sys.intern, found)))  # one string per distinct word of the sample
        self.sizes.append(max(1, len(found)))
        self.addressed.append(bool(ADDRESS.search(lower)))
        self.labels.append(label)


def word_value(count: int, size: int) -> float:
    """What a word counts for the classifier: its rate in per cent, 1 at most, so that no word repeated fills a text."""
    return min(SCALE * count / size, 1.0)


def term_counts(words: Counter) -> Counter:
    out: Counter = Counter()
    for word, n in words.items():
        for term in terms_of(word):
            out[term] += n
    return out


def proposed_terms(sample: Sample) -> list[tuple[str, bool]]:
    """(term, whether by rate) of the voters, those that occur in most toxic documents first.

    A term is left out if it begins, or begins with, a better one and adds few documents to it. The terms after the first
    ``TERMS`` need no share of all toxic rows: they are taken for the rows that have fewer than ``COVER`` voters so far.
    """
    positive, negative = float(sample.labels.count(1.0)), float(sample.labels.count(0.0))
    seen = {1.0: Counter(), 0.0: Counter()}
    for words, size, label in zip(sample.words, sample.sizes, sample.labels, strict=True):
        if label == label:
            count = term_counts(words)
            seen[label].update((term, False) for term in count)
            seen[label].update((term, True) for term, n in count.items() if n >= RATE * size)
    ranked, rare = [], []
    toxic_part = positive / (positive + negative)
    for key, hits in seen[1.0].items():
        if hits >= LEAST_DOCUMENTS:
            share, other = hits / positive, (seen[0.0][key] + 0.5) / negative
            precision = share / (share + other)
            if precision >= LEAST_PRECISION:
                if hits >= LEAST_SHARE * positive:
                    ranked.append((hits, precision, key))
                elif one_sided(hits, seen[0.0][key], toxic_part):
                    rare.append((hits, precision, key))
    ranked.sort(key=lambda r: (-r[0] * r[1], r[2]))
    chosen: list[tuple[str, bool]] = []

    def repeats(term: str, by_rate: bool) -> bool:
        bare = term.rstrip("$")
        return any(by_rate == rate and (bare.startswith(t.rstrip("$")) or t.rstrip("$").startswith(bare)) for t, rate in chosen)

    for _, _, key in ranked:
        if len(chosen) < TERMS and not repeats(*key):
            chosen.append(key)
    rest = sorted({r[2]: r for r in [*ranked, *rare]}.values(), key=lambda r: (-r[0] * r[1], r[2]))
    wanted = {key for _, _, key in rest} - set(chosen)
    rows_of: dict[tuple[str, bool], list[int]] = {key: [] for key in wanted}
    voters = Counter()
    first = set(chosen)
    toxic = [n for n, label in enumerate(sample.labels) if label == 1.0]
    for n in toxic:
        count, size = term_counts(sample.words[n]), sample.sizes[n]
        for term, times in count.items():
            for key in ((term, False), *([(term, True)] if times >= RATE * size else [])):
                if key in first:
                    voters[n] += 1
                elif key in wanted:
                    rows_of[key].append(n)
    for _, _, key in rest:
        if key in wanted:
            lacking = [n for n in rows_of[key] if voters[n] < COVER]
            if len(lacking) >= LEAST_DOCUMENTS and not repeats(*key):
                chosen.append(key)
                voters.update(rows_of[key])
    return chosen


def one_sided(toxic: int, clean: int, toxic_part: float) -> bool:
    """Whether so few clean rows among those with a term are beyond chance, by the binomial tail."""
    n, tail = toxic + clean, 0.0
    for k in range(clean + 1):
        tail += math.comb(n, k) * toxic_part ** (n - k) * (1 - toxic_part) ** k
    return tail <= CHANCE


def known_words(sample: Sample) -> set[str]:
    """The words that labelled rows have."""
    return {w for words, label in zip(sample.words, sample.labels, strict=True) if label == label for w in words}


def votes(sample: Sample, terms: Sequence[tuple[str, bool]]) -> np.ndarray:
    """One row per document, one column per voter: 1 toxic, -1 clean, 0 no vote."""
    out = np.zeros((len(sample.words), len(terms) + 4), "i1")
    names = {term for term, _ in terms}
    seen = known_words(sample)
    for row, (words, size) in enumerate(zip(sample.words, sample.sizes, strict=True)):
        count = term_counts(words)
        for column, (term, by_rate) in enumerate(terms):
            out[row, column] = count.get(term, 0) >= (RATE * size if by_rate else 1)
        hits = [count[t] for t in names if t in count]
        fired = int(out[row, :len(terms)].sum())
        lexicon = sum(words.get(w, 0) for w in LEXICON)
        known = sum(n for w, n in words.items() if w in seen) >= KNOWN_SHARE * sum(words.values())
        out[row, len(terms):] = [
            1 if lexicon >= 2 or lexicon >= RATE * size else 0,
            int(sample.addressed[row]),
            1 if fired >= 3 else -1 if fired == 0 and known else 0,
            1 if sum(hits) >= RATE * size else -1 if sum(hits) < RATE / 2 * size and known else 0,
        ]
    return out


@dataclass
class LabelModel:
    """Chances of every vote given the class, and the share of each voter's evidence that is its own."""

    prior: float
    log_odds: np.ndarray  # voter x vote (-1, 0, 1)
    own: np.ndarray

    def posterior(self, ballot: np.ndarray) -> np.ndarray:
        evidence = np.take_along_axis(self.log_odds.T, ballot.astype("i8") + 1, axis=0) * self.own
        return sigmoid(np.log(self.prior / (1 - self.prior)) + evidence.sum(axis=1))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def label_model(ballot: np.ndarray, prior: float) -> LabelModel:
    """Fit the model to votes and the share of toxic documents, from a clear majority of votes: at first as if voters
    were independent given the class, then with every voter's evidence divided by what the estimated correlations say
    others repeat of it. Voters are taken to be better than chance."""
    belief = np.where(ballot.sum(axis=1) >= CLEAR_MAJORITY, 0.95, 0.02)
    one_hot = np.stack([ballot == v for v in (-1, 0, 1)]).astype("f8")  # vote x document x voter
    own = np.ones(ballot.shape[1])
    for _ in range(PASSES):
        for _ in range(ROUNDS):
            toxic = (np.einsum("vdj,d->jv", one_hot, belief) + 0.1) / (belief.sum() + 0.3)
            clean = (np.einsum("vdj,d->jv", one_hot, 1 - belief) + 0.1) / ((1 - belief).sum() + 0.3)
            log_odds = np.log(toxic) - np.log(clean)
            log_odds[:, 1] = 0.0  # no vote is no evidence: most voters know one language
            log_odds[:, 0], log_odds[:, 2] = np.minimum(log_odds[:, 0], 0.0), np.maximum(log_odds[:, 2], 0.0)
            model = LabelModel(prior, log_odds, own)
            onward = model.posterior(ballot)
            moved, belief = np.abs(onward - belief).max(), onward
            if moved < 1e-4:
                break
        # What a voter says beyond what the class explains, and how much of that others say, too.
        expected = np.outer(belief, toxic[:, 2] - toxic[:, 0]) + np.outer(1 - belief, clean[:, 2] - clean[:, 0])
        residual = ballot - expected
        spread = np.sqrt((residual ** 2).mean(axis=0)) + 1e-9
        correlation = (residual.T @ residual) / len(ballot) / np.outer(spread, spread)
        own = 1.0 / np.where(correlation > LEAST_CORRELATION, correlation, 0.0).sum(axis=1).clip(1.0)
    return model


def feature(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term) % FEATURES


class Hashed(dict):
    def __missing__(self, term: str) -> int:
        value = self[term] = feature(term)
        return value


@dataclass
class Classifier:
    """margin = bias + sum over the distinct words of their value times the weights of their terms."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -35.0

    def scorer(self) -> Callable[[str | None], float]:
        weights, bias = self.weights, self.bias

        class Weights(dict):
            def __missing__(self, word: str) -> float:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                value = self[word] = sum(weights.get(feature(t), 0.0) for t in terms_of(word))
                return value

        of = Weights()

        def score(text: str | None) -> float:
            words = WORD.findall(text.lower()) if text else []
            margin = bias + sum(of[w] * word_value(n, len(words)) for w, n in Counter(words).items())
            return float(sigmoid(np.float64(margin)))

        return score


def train(documents: Sequence[Counter], sizes: Sequence[int], belief: np.ndarray) -> Classifier:
    """Logistic regression on posterior labels; the two classes weigh the same."""
    rows, columns, values = array("i"), array("i"), array("d")
    hashed = Hashed()
    for row, (words, size) in enumerate(zip(documents, sizes, strict=True)):
        for word, n in words.items():
            for term in terms_of(word):
                rows.append(row)
                columns.append(hashed[term])
                values.append(word_value(n, size))
    row, column, value = np.array(rows), np.array(columns), np.array(values)
    # Keep the features whose mean rates differ most between the classes, measured in their spread.
    share = belief / belief.sum(), (1 - belief) / (1 - belief).sum()
    means = [np.bincount(column, value * s[row], FEATURES) for s in share]
    squares = np.bincount(column, value ** 2 * (share[0] + share[1])[row] / 2, FEATURES)
    contrast = np.abs(means[0] - means[1]) / np.sqrt(squares + 1e-4)
    kept = np.sort(np.argsort(-contrast, kind="stable")[:KEPT_FEATURES])
    place = np.full(FEATURES, -1)
    place[kept] = np.arange(len(kept))
    inside = place[column] >= 0
    row, column, value = row[inside], place[column[inside]], value[inside]
    weights, bias, n = np.zeros(len(kept)), 0.0, len(documents)
    weight = 0.5 * share[0] + 0.5 * share[1]
    target = 0.5 * share[0] / weight
    momentum, square = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, STEPS + 1):
        margin = bias + np.bincount(row, weights[column] * value, n)
        slope = (sigmoid(margin) - target) * weight
        gradient = np.append(np.bincount(column, slope[row] * value, len(kept)) + DECAY * weights, slope.sum())
        momentum = 0.9 * momentum + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        move = LEARNING * (momentum / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        weights -= move[:-1]
        bias -= move[-1]
    return Classifier({int(f): float(w) for f, w in zip(kept, weights, strict=True) if abs(w) > 1e-6}, float(bias))


def fitted(sample: Sample) -> Classifier:
    """Voters from the labelled part, the label model from all, the classifier from the posterior labels."""
    labels = np.array(sample.labels, "f8")
    if not (labels == 1).any() or not (labels == 0).any():
        return Classifier()
    ballot = votes(sample, proposed_terms(sample))
    # The share of toxic documents in the sample, that of the unlabelled part taken from all open labels.
    known = np.isfinite(labels)
    prior = (float((labels == 1).sum()) + sample.toxic_share * float((~known).sum())) / len(labels)
    return train(sample.words, sample.sizes, label_model(ballot, float(np.clip(prior, 0.01, 0.5))).posterior(ballot))


def sampled(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, unlabelled: int = UNLABELLED) -> Sample:
    """The bounded training sample; ids are chosen before any text moves."""
    open_labels = (
        labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sample = Sample()
    share = open_labels.agg(F.avg("toxic")).collect()[0][0]
    sample.toxic_share = sample.toxic_share if share is None else float(share)
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    parts = [
        open_labels.where(F.col("toxic") == label).orderBy(*by_hash).limit(per_label)
        .select("doc_id", F.col("toxic").cast("double").alias("label")) for label in (0, 1)
    ]
    others = (
        docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).orderBy(*by_hash)
        .limit(unlabelled).select("doc_id", F.lit(None).cast("double").alias("label"))
    )
    chosen = (
        parts[0].unionByName(parts[1]).unionByName(others)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    # At most 2 * per_label + unlabelled rows of two numbers, so the broadcast is bounded.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    for row in rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).orderBy("doc_id").toLocalIterator():
        sample.add(row["text"], np.nan if row["label"] is None else row["label"])
    return sample


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(sampled(docs, labels)))

    def work(rows: dict[str, list]) -> dict[str, list]:
        score = model.value.scorer()
        return {"key": rows["key"], "held_out": rows["held_out"], "score": [score(t) for t in rows["text"]]}

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("key"), held_out(F.col("doc_id")).alias("held_out"), "text"
    )
    scored = map_texts(narrow, "text", work, "key long, held_out boolean, score double")
    return scored.select(
        F.col("key").alias("doc_id"), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic."""
    import pyarrow as pa

    from pulseframe.llm.common import slices

    model = docs.sparkSession.sparkContext.broadcast(fitted(sampled(docs, labels)))
    at = docs.columns.index("text")

    def keep(batches):
        score = model.value.scorer()
        for batch in batches:
            for part in slices(batch, "text"):
                clean = pa.array([score(t) < THRESHOLD for t in part.column(at).to_pylist()], pa.bool_())
                yield part.filter(clean)

    return docs.mapInArrow(keep, docs.schema)
