"""Toxicity: a linear classifier of words and word pieces, regularised by counterfactuals.

Terms that name groups of people are swapped in labelled texts, and every labelled text is also taken
with a neutral mention of a group, in each version of it. The model is punished for every change of
score, so that it learns from what is said and not from who is mentioned.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaybook.llm.common import map_arrow, quoted, without

#: Labelled rows that the model is fitted on at most, taken by a hash of the id.
FIT_ROWS = 6_000
FEATURES = 1 << 20
#: Beginnings of a word that are features beside the word itself, in characters.
BEGINNINGS = (4, 5)
#: A feature counts if this many fitted rows have it.
LEAST_ROWS = 3
#: Standard errors that its log odds must be away from 0.
LEAST_ERRORS = 2.0
#: Word scores that a task remembers.
REMEMBERED = 300_000
FOLDS = 5

#: Terms of one group stand in for each other.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslim", "christian", "jewish"),
    ("muslims", "christians", "jews"), ("gay", "straight"), ("black", "white", "asian"),
    ("immigrants", "natives"), ("disabled", "healthy"), ("old", "young"),
    ("femmes", "hommes"), ("frauen", "männer"), ("mujeres", "hombres"),
)
_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """True for the fold that nothing is learnt from; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def features(word: str) -> list[int]:
    """Hashed features of a word: itself, and its beginnings."""
    found = {zlib.crc32(f"{word}$".encode())}
    found.update(zlib.crc32(word[:n].encode()) for n in BEGINNINGS if len(word) >= n)
    return [f % FEATURES for f in found]


def words_of(text: str) -> Counter[str]:
    return Counter(_WORD.findall(text.lower()))


def swaps(words: Counter[str], identity=IDENTITY) -> list[Counter[str]]:
    """The words with every identity term replaced by the next of its group, and so on round."""
    if not any(term in words for group in identity for term in group):
        return []
    out: list[Counter[str]] = []
    for turn in range(1, max(len(group) for group in identity)):
        other = {t: g[(i + turn) % len(g)] for g in identity for i, t in enumerate(g)}
        changed: Counter[str] = Counter()
        for word, count in words.items():
            changed[other.get(word, word)] += count
        if changed != words and changed not in out:
            out.append(changed)
    return out


class Mentions:
    """Each text with one more word: a term of one group, for every term of the group that is its turn.

    A text's score is a mean over its words, so that of the longer text follows from the text's own mean
    and the weight of the term; no second text is laid out.
    """

    def __init__(self, texts: list[Counter[str]], identity=IDENTITY):
        self.terms = [term for group in identity for term in group]
        first = np.cumsum([0, *(len(group) for group in identity)])
        turns = [(i, n) for i in range(len(texts)) for n in range(*first[i % len(identity):][:2])] if self.terms else []
        self.origin = np.array([i for i, _ in turns], np.int64)
        self.term = np.array([n for _, n in turns], np.int64)
        words = np.array([max(1, text.total()) for text in texts], float)[self.origin]
        self.kept, self.added = words / (words + 1), 1 / (words + 1)
        found = [features(term) for term in self.terms]
        self.feature = np.array([f for each in found for f in each], np.int64)
        self.owner = np.repeat(np.arange(len(found)), [len(each) for each in found])

    def product(self, means: np.ndarray, weights: np.ndarray) -> np.ndarray:
        terms = np.bincount(self.owner, weights[self.feature], max(1, len(self.terms)))
        return means[self.origin] * self.kept + terms[self.term] * self.added

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        terms = np.bincount(self.term, slope * self.added, max(1, len(self.terms)))
        return np.bincount(self.feature, terms[self.owner], FEATURES)


class Rows:
    """Sparse rows: of each feature, its share of the text's words."""

    def __init__(self, texts: list[Counter[str]], known: dict[str, list[int]]):
        ids, counts, sizes = [], [], []
        for words in texts:
            row: Counter[int] = Counter()
            for word, count in words.items():
                for feature in known.setdefault(word, features(word)):
                    row[feature] += count
            ids.append(np.fromiter(row.keys(), np.int32, len(row)))
            counts.append(np.fromiter(row.values(), float, len(row)) / max(1, words.total()))
            sizes.append(len(row))
        self.ids = np.concatenate([*ids, np.zeros(0, np.int32)])
        self.share = np.concatenate([*counts, np.zeros(0)])
        self.row, self.size = np.repeat(np.arange(len(texts)), sizes), len(texts)

    def only(self, which: np.ndarray) -> Rows:
        """The same rows with features that are marked in ``which``."""
        kept = which[self.ids]
        self.ids, self.row, self.share = self.ids[kept], self.row[kept], self.share[kept]
        return self

    def product(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.ids] * self.share, self.size)

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        return np.bincount(self.ids, slope[self.row] * self.share, FEATURES)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _log_odds(rows: Rows, y: np.ndarray) -> np.ndarray:
    """Per feature, how much more often label 1 has it, as a log; 0 for features of few rows."""
    total = np.bincount(rows.ids, minlength=FEATURES)
    ones = np.bincount(rows.ids, y[rows.row], FEATURES)
    share = y.mean()
    odds = np.log((ones + share) / (y.sum() + 1)) - np.log((total - ones + 1 - share) / (len(y) - y.sum() + 1))
    error = np.sqrt(1 / (ones + share) + 1 / (total - ones + 1 - share))
    return np.where((total >= LEAST_ROWS) & (np.abs(odds) >= LEAST_ERRORS * error), odds, 0.0)


def fit(
    texts: list[str], labels: list[int], penalty: float = 4.0, decay: float = 1e-3, steps: int = 200,
    rate: float = 0.5, identity=IDENTITY,
) -> tuple[dict[int, float], float]:
    """Weights (those that are not 0) and bias of a logistic model. Without both labels it knows only their rate.

    Each feature's weight is its log odds times a factor; the factors are fitted by Adam, over all
    rows in each step, with both labels weighing alike. Added to the log loss are ``penalty`` times
    the mean square of the change of score under swaps, the same for neutral mentions, and ``decay`` times
    the factors' squares. Words of groups have no weight of their own where no fitted text holds them; the
    pieces of words that they share with others have, and are what mentions bring to light.
    """
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return {}, float(np.log(share / (1 - share)))
    sets = [words_of(t) for t in texts]
    known: dict[str, list[int]] = {}
    pairs = [(i, changed) for i, words in enumerate(sets) for changed in swaps(words, identity)]
    rows, other = Rows(sets, known), Rows([changed for _, changed in pairs], known)
    origin, mentions = np.array([i for i, _ in pairs], np.int64), Mentions(sets, identity)
    odds = _log_odds(rows, y)
    rows, other = rows.only(odds != 0), other.only(odds != 0)
    weigh = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    # At first, one strong word in a hundred decides.
    factors = np.full(FEATURES, 25.0)
    bias = -float(np.median(rows.product(odds * factors))) - 2.0
    mean, square = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for step in range(1, steps + 1):
        means = rows.product(odds * factors)
        score = _sigmoid(means + bias)
        slope = weigh * (score - y)
        change = np.zeros(0)
        told, at = np.zeros(0), mentions.origin
        if len(at):
            named = _sigmoid(mentions.product(means, odds * factors) + bias)
            both = 2 * penalty * (score[at] - named) / len(at)
            told = -both * named * (1 - named)
            slope = slope + np.bincount(at, both * score[at] * (1 - score[at]), len(y))
        if len(origin):
            swapped = _sigmoid(other.product(odds * factors) + bias)
            both = 2 * penalty * (score[origin] - swapped) / len(origin)
            slope = slope + np.bincount(origin, both * score[origin] * (1 - score[origin]), len(y))
            change = -both * swapped * (1 - swapped)
        # A mention's score moves with the mean of its text as well as with its term.
        through = slope + np.bincount(at, told * mentions.kept, len(y)) if len(at) else slope
        gradient = rows.gradient(through) + (other.gradient(change) if len(origin) else 0.0)
        gradient = gradient + (mentions.gradient(told) if len(at) else 0.0)
        full = np.append(gradient * odds + 2 * decay * factors / FEATURES, slope.sum() + change.sum() + told.sum())
        mean, square = 0.9 * mean + 0.1 * full, 0.99 * square + 0.01 * full * full
        moved = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
        factors, bias = factors - moved[:-1], bias - float(moved[-1])
    weights = odds * factors
    used = np.flatnonzero(weights)
    return dict(zip(used.tolist(), weights[used].tolist(), strict=True)), bias


class WordWeights(dict):
    """The weight of a word: the sum over its features, computed once and remembered."""

    def __init__(self, weights: dict[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = sum(self.weights.get(f, 0.0) for f in features(word))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


class Scorer:
    """Scores texts by the mean weight of their words."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.words, self.bias = WordWeights(weights), bias

    def score(self, text: str) -> float:
        words = _WORD.findall(text.lower())
        total = sum(map(self.words.__getitem__, words))
        return float(_sigmoid(total / max(1, len(words)) + self.bias))


def mention_gap(texts: list[str], model: tuple[dict[int, float], float], identity=IDENTITY) -> float:
    """How much a neutral mention moves the score, on average over texts, groups and their terms.

    For each text and group, this is the difference between the highest and the lowest score among the
    text with each of the group's terms added.
    """
    scorer = Scorer(*model)
    gaps = []
    for text in texts:
        for group in identity:
            scores = [scorer.score(f"{text} {term}") for term in group]
            gaps.append(max(scores) - min(scores))
    return float(np.mean(gaps)) if gaps else 0.0


def mention_change(texts: list[str], model: tuple[dict[int, float], float], identity=IDENTITY) -> float:
    """The mean absolute change of score when a group's term is added to a text."""
    scorer = Scorer(*model)
    changes = [abs(scorer.score(f"{text} {term}") - scorer.score(text)) for text in texts for group in identity for term in group]
    return float(np.mean(changes)) if changes else 0.0


#: Characters of all fitted texts together, at most: the driver holds them while it fits.
FIT_CHARS = 64_000_000


def fitted_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", most: int = FIT_ROWS, chars: int = FIT_CHARS,
) -> list[tuple[object, int, str]]:
    """(id, label, text) of the labelled documents to fit on, as ``train`` takes them.

    They are taken in the order of a hash of the id, as many as ``most`` and as ``chars`` allow, and are
    looked at by their lengths before any text comes to the driver.
    """
    ids = labels.select(F.col(doc_id).alias("fit_id"), F.col(label).cast("int").alias("y")).filter(
        F.col("y").isNotNull() & F.col("fit_id").isNotNull() & ~held_out(F.col("fit_id"))
    ).groupBy("fit_id").agg(F.max("y").alias("y"))
    chosen = ids.orderBy(F.xxhash64("fit_id"), "fit_id").limit(most)
    named = docs.select(F.col(doc_id).alias("own_id"), F.col(text).alias("t"))
    sizes = named.select("own_id", F.length("t").alias("n")).join(
        F.broadcast(chosen), F.col("own_id") == F.col("fit_id")
    ).groupBy("fit_id").agg(F.max("y").alias("y"), F.max(F.coalesce("n", F.lit(0))).alias("n"))
    # ``most`` rows of three numbers.
    taken, held = [], 0
    for row in sorted(sizes.withColumn("h", F.xxhash64("fit_id")).collect(), key=lambda r: (r.h, r.fit_id)):
        if held + row.n <= chars:
            held += row.n
            taken.append((row.fit_id, row.y))
    if not taken:
        return []
    able = docs.sparkSession.createDataFrame(taken, ids.schema)
    found = named.join(F.broadcast(able), F.col("own_id") == F.col("fit_id")).groupBy("fit_id").agg(
        F.max("y").alias("y"), F.max("t").alias("t")
    )
    return sorted((r.fit_id, r.y, r.t or "") for r in found.collect())


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", most: int = FIT_ROWS, chars: int = FIT_CHARS, **options,
) -> tuple[dict[int, float], float]:
    """Fit on at most ``most`` labelled documents, outside the held-out fold, taken by hash of id.

    Their texts have ``chars`` characters together at most; one that would pass that is left out of the
    fit. The ids (``most`` rows) go to all tasks and one text for each comes back. Of several labels of an
    id the highest counts; null labels do not. Without rows to fit on, the model knows no words.
    """
    rows = fitted_rows(docs, labels, doc_id, text, label, most, chars)
    return fit([r[2] for r in rows], [r[1] for r in rows], **options)


def score_toxicity(
    docs: DataFrame, model: tuple[dict[int, float], float], text: str = "text"
) -> DataFrame:
    """Documents with ``score`` (0 to 1) and ``predicted`` in place of their text.

    Every text is scored whole and by itself, from its text alone; null counts as empty and gets the
    score of no words. Rows that repeat are scored alike; an empty table gives an empty one. Columns with
    the names of result columns are replaced.
    """
    names = [n for n in without(docs, "score", "predicted").columns if n != text]
    rows = docs.select(*[quoted(n) for n in names], quoted(text).alias("scored_text"))
    schema = T.StructType([*[rows.schema[n] for n in names], T.StructField("score", T.DoubleType())])
    # FEATURES weights at most, and far fewer as a rule.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shared.value)
        for batch in batches:
            scores = [scorer.score(t.as_py() or "") for t in batch.column("scored_text")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(scores, pa.float64())],
                names=[f.name for f in schema],
            )

    scored = map_arrow(rows, run, schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
