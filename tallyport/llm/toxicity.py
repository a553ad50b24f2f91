"""Toxicity by class-conditional Kneser-Ney models.

Two character models (toxic, ordinary) predict each letter of a word from the ORDER - 1 symbols before it. Each class
has its own highest-order counts; below them both share one hierarchy of continuation counts, so a rare expression is
smoothed alike by either and only what a class has really seen tells them apart. Where neither has seen a letter after
a context, the shared part cancels and only the two backoff weights remain. A word's log-likelihood ratio therefore
comes from two tables, and is remembered by word.

A document's evidence is the difference of the two length-normalised log-likelihoods (a symbol's mean), over the whole
text and over the runs of one, three and eight words where it is largest; a logistic calibration, fitted on labelled rows that the models have
not seen, turns it into a score.

The models are fitted on a bounded sample of the labelled training rows (SAMPLE rows of each class, those with the least
hash of doc_id); everything else covers all rows and whole texts. doc_id, labels, lang and source are never inputs.

Defined results: null, empty and blank texts have no evidence and get the calibrated score of none; rows that repeat
are scored alike; labels that are null are ignored, and with several labels for a doc_id any toxic one counts; without
labels of both classes every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.llm.common import table
from tallyport.session import ship

ORDER = 5
DISCOUNT = 0.75
#: Most labelled rows of each class (ordinary, toxic) that the models are fitted on.
SAMPLE = (4000, 2000)
#: Of the sample, every so many-th row calibrates the score instead of training the models.
CALIBRATE_EVERY = 3
THRESHOLD = 0.3
#: Words of the runs whose best is looked at.
RUNS = (1, 3, 8)
#: Words that a worker remembers; when full it forgets all.
CACHE_WORDS = 500_000
START, END = "\x02", "\x03"
_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    """Letter runs, in lower case."""
    return _WORD.findall(text.lower()) if text else []


class Levels:
    """Kneser-Ney counts: own of a class at the highest order, shared continuation counts below it."""

    def __init__(self, by_class: tuple[Counter, Counter]) -> None:
        self.own = tuple(self._grams(words) for words in by_class)
        grams = set().union(*self.own)
        self.shared: dict[str, tuple[int, int]] = {}  # context: total, types
        self.counts: dict[str, int] = {}
        symbols = {g[-1] for g in grams}
        self.uniform = 1 / (len(symbols) + 1)
        while grams:
            lower = Counter(g[1:] for g in grams if len(g) > 1)
            self.counts.update(lower)
            total: defaultdict[str, list[int]] = defaultdict(lambda: [0, 0])
            for g, n in lower.items():
                total[g[:-1]][0] += n
                total[g[:-1]][1] += 1
            for h, (n, types) in total.items():
                was = self.shared.get(h, (0, 0))
                self.shared[h] = (was[0] + n, was[1] + types)
            grams = set(lower)

    @staticmethod
    def _grams(words: Counter) -> Counter:
        out: Counter = Counter()
        for word, n in words.items():
            w = START + word + END
            for i in range(1, len(w)):
                out[w[max(0, i + 1 - ORDER) : i + 1]] += n
        return out

    def lower(self, h: str, x: str) -> float:
        """Shared probability of x after h."""
        below = self.lower(h[1:], x) if h else self.uniform
        if h not in self.shared:
            return below
        n, types = self.shared[h]
        return (max(self.counts.get(h + x, 0) - DISCOUNT, 0) + DISCOUNT * types * below) / n


def fit(by_class: tuple[Counter, Counter]) -> tuple[dict[str, float], dict[str, float]]:
    """Log-likelihood ratios (toxic to ordinary): of n-grams that a class has seen, and of others by context."""
    levels = Levels(by_class)
    weight: list[dict[str, float]] = []
    totals: list[dict[str, int]] = []
    for own in levels.own:
        n: Counter = Counter()
        types: Counter = Counter()
        for g, c in own.items():
            n[g[:-1]] += c
            types[g[:-1]] += 1
        totals.append(n)
        weight.append({h: DISCOUNT * types[h] / n[h] for h in n})
    unseen = {h: math.log(weight[1].get(h, 1.0) / weight[0].get(h, 1.0)) for h in weight[0].keys() | weight[1].keys()}
    seen = {}
    for g in levels.own[0].keys() | levels.own[1].keys():
        h = g[:-1]
        shared = levels.lower(h[1:], g[-1])
        p = [(max(own.get(g, 0) - DISCOUNT, 0) / totals[c][h] if h in totals[c] else 0) + weight[c].get(h, 1.0) * shared for c, own in enumerate(levels.own)]
        seen[g] = math.log(p[1] / p[0])
    return seen, unseen


def word_ratio(word: str, seen: dict[str, float], unseen: dict[str, float]) -> float:
    w, total = START + word + END, 0.0
    for i in range(1, len(w)):
        g = w[max(0, i + 1 - ORDER) : i + 1]
        r = seen.get(g)
        total += unseen.get(g[:-1], 0.0) if r is None else r
    return total


def evidence(found: list[str], ratios: dict[str, float]) -> tuple[float, ...]:
    """Length-normalised ratio of the text, and of its best runs of RUNS words (of the whole text if it has fewer)."""
    if not found:
        return (0.0,) * (1 + len(RUNS))
    ratio = np.fromiter((ratios[w] for w in found), np.float64, len(found))
    length = np.fromiter(map(len, found), np.float64, len(found)) + 1
    sums, sizes = np.concatenate(([0], np.cumsum(ratio))), np.concatenate(([0], np.cumsum(length)))
    of_run = lambda n: float(((sums[n:] - sums[:-n]) / (sizes[n:] - sizes[:-n])).max())
    return (of_run(len(found)), *(of_run(min(n, len(found))) for n in RUNS))


def calibrate(features: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray | float]:
    """Logistic regression by Newton steps, on standardised features."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(len(features)), (features - mean) / scale])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - labels) + 0.5 * np.r_[0, w[1:]]
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, *[0.5] * (len(w) - 1)])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return {"mean": mean, "scale": scale, "w": w}


def probability(features: np.ndarray, fitted: dict[str, np.ndarray | float]) -> np.ndarray:
    z = fitted["w"][0] + ((features - fitted["mean"]) / fitted["scale"]) @ fitted["w"][1:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Model:
    """Both models' ratios and the calibration. Its size is bounded by the sample's."""

    def __init__(self, rows: Iterable[tuple[str | None, int]]) -> None:
        by_class: tuple[Counter, Counter] = (Counter(), Counter())
        held: list[tuple[list[str], int]] = []
        seen_of = [0, 0]
        for text, label in rows:
            found = tokens(text)
            seen_of[label] += 1
            if seen_of[label] % CALIBRATE_EVERY == 0:
                held.append((found, label))
            else:
                by_class[label].update(found)
        self.fitted = None
        self.seen, self.unseen = {}, {}
        self.known: dict[str, float] = {}
        if not (by_class[0] and by_class[1] and len({label for _, label in held}) == 2):
            return
        self.seen, self.unseen = fit(by_class)
        features = np.array([self.features(found) for found, _ in held])
        self.fitted = calibrate(features, np.array([label for _, label in held], dtype=np.float64))
        self.known.clear()

    def features(self, found: list[str]) -> tuple[float, ...]:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        for word in set(found).difference(self.known):
            self.known[word] = word_ratio(word, self.seen, self.unseen)
        return evidence(found, self.known)

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        features = np.array([self.features(tokens(t)) for t in texts]).reshape(-1, 1 + len(RUNS))
        return np.zeros(len(features)) if self.fitted is None else probability(features, self.fitted)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = SAMPLE) -> DataFrame:
    """(text, toxic) of at most most[0] ordinary and most[1] toxic labelled rows that are not held out."""
    label = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    label = label.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    place = F.xxhash64(F.lit("toxicity"), "doc_id")
    chosen = [label.where(F.col("toxic") == c).orderBy(place, "doc_id").limit(n) for c, n in enumerate(most)]
    ids = chosen[0].union(chosen[1])  # at most sum(most) rows
    # A doc_id that repeats in the documents gives one row.
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).orderBy(place, "doc_id").select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return Model((row.text, row.toxic) for row in sample(docs, labels).toLocalIterator())


def scorer(spark: SparkSession, model: Model):  # noqa: ANN201
    """Pandas UDF: text to score."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(texts))

    return of


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document."""
    of = scorer(docs.sparkSession, train(docs, labels))
    scored = docs.select("doc_id", of(F.col("text")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose score stays below the threshold."""
    of = scorer(spark, train(docs, table(spark, sf_dir, "labels")))
    return docs.where(of(F.col("text")) < THRESHOLD)
