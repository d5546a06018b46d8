"""Toxicity by a logistic classifier that is indifferent to which group a text names.

Features are the distinct words of a text and the first three to six letters of each; a
word adds the weights of its own features. Besides the loss on the labels, fitting
looks at every labelled text that names a group: its counterfactuals name another group of the same
kind, and the squared change of the log-odds is penalised. So a neutral mention of a group that
happens to occur in toxic texts does not raise the score.

Fitting uses a bounded sample, ``SAMPLE_DOCS`` labelled documents a class at most, and keeps ``FEATURES`` features at most. Scores of whole texts, null
counting as empty, lie in 0 to 1. Without labelled rows of both classes every score is the share of
toxic labels, or 0. Rows with a null id are scored, not learned from; of an id that several rows share one
text is learned, the one with the least hash; the first label in (toxic) order counts where a document has
several. Extra columns change nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, chunks, least, store, texts

#: Labelled documents of either class in the fit.
SAMPLE_DOCS = 3000
FEATURES = 8000
#: Least documents of the sample that have a feature, and its least chi-square.
LEAST_DOCS, LEAST_CHI2 = 3, 6.0
THRESHOLD = 0.7
PREFIXES = (3, 4, 5, 6)
#: Weights of the two penalties and the steps of the fit.
RIDGE, FAIRNESS, STEPS = 5e-4, 1.0, 300

#: Terms that name groups, by kind; any may stand for another of its line.
IDENTITY = (
    ("woman", "man", "girl", "boy", "lady", "gentleman"),
    ("women", "men", "girls", "boys", "ladies", "gentlemen"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("frau", "mann", "mädchen", "junge"),
    ("frauen", "männer", "christen", "muslime", "juden"),
    ("femme", "homme", "fille", "garçon"),
    ("femmes", "hommes", "chrétiens", "musulmans", "juifs"),
    ("mujer", "hombre", "niña", "niño"),
    ("mujeres", "hombres", "cristianos", "musulmanes", "judíos"),
)
_GROUP = {term: line for line in IDENTITY for term in line}
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features(word: str) -> list[str]:
    """The word, and its beginnings where it goes on behind them."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_DOCS) -> DataFrame:
    """The ``per_class`` documents (doc_id, text, toxic) of either class with the least hash of the id, one row each."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    chosen = store(least(known.withColumn("_draw", F.xxhash64("doc_id")), "toxic", "_draw", per_class).drop("_draw"), "toxicity-draws")
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # two classes of per_class rows at most
    return found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def bags(rows: DataFrame) -> DataFrame:
    """(toxic, words): the distinct words of each row, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            own = [sorted(words(t)) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([pc.cast(batch.column("toxic"), pa.int32()), pa.array(own, pa.list_(pa.string()))], names=["toxic", "words"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, words array<string>")


class Model:
    """Weights of features and the constant; ``word`` adds up those of a word."""

    def __init__(self, weights: dict[str, float], constant: float) -> None:
        self.weights, self.constant, self.cache = weights, constant, {}

    def word(self, word: str) -> float:
        value = self.cache.get(word)
        if value is None:
            if len(self.cache) > 500_000:
                self.cache.clear()
            get = self.weights.get
            value = self.cache[word] = math.fsum(get(f, 0.0) for f in features(word))
        return value

    def score(self, text: str | None) -> float:
        logit = math.fsum([self.constant, *map(self.word, words(text))])
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, logit))))

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "constant": self.constant, "cache": {}}


def counterfactuals(own: list[str]) -> list[tuple[str, str]]:
    """(named, other) for every group word of a text and every other term of its line."""
    return [(w, other) for w in own if w in _GROUP for other in _GROUP[w] if other != w]


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, a, b): toxic and other rows of ``bags`` that have each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for label, own in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist()):
                seen[label].update({f for w in own for f in features(w)})
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([seen[i][n] for n in names], pa.int64()) for i in (1, 0))], names=["feature", "a", "b"])

    counted = rows.mapInArrow(run, "feature string, a bigint, b bigint")
    return counted.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def vectors(rows: DataFrame, names: list[str]) -> DataFrame:
    """(toxic, cols, times, named): counts of the kept features, and the group words, of each row."""
    place = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, times, named = [], [], []
            for own in batch.column("words").to_pylist():
                found = Counter(place[f] for w in own for f in features(w) if f in place)
                cols.append(sorted(found))
                times.append([found[c] for c in cols[-1]])
                named.append(sorted(w for w in own if w in _GROUP))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(cols, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32())), pa.array(named, pa.list_(pa.string()))],
                names=["toxic", "cols", "times", "named"],
            )

    return rows.mapInArrow(run, "toxic int, cols array<int>, times array<int>, named array<string>")


def fit_bags(rows: DataFrame) -> Model:
    """Fit on ``bags``, each once, since copies would make chance words look telling.

    Features are counted and chosen on the cluster; the driver gets ``FEATURES`` names at
    most and, of each row of the sample, the counts of those.
    """
    rows = store(rows.distinct(), "toxicity-bags")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    if not n1 or not n0:
        share = 1.0 if n1 else 0.0
        return Model({}, math.log((share + 1e-9) / (1 - share + 1e-9)))
    have = F.col("a") + F.col("b")
    apart = F.col("a") * (F.lit(n0) - F.col("b")) - F.col("b") * (F.lit(n1) - F.col("a"))
    spread = have * (F.lit(n0 + n1) - have) * n1 * n0
    chi2 = F.when(spread > 0, apart * apart * (n0 + n1) / spread).otherwise(0.0)
    kept = feature_counts(rows).filter(have >= LEAST_DOCS).select("feature", chi2.alias("chi2")).filter(F.col("chi2") >= LEAST_CHI2)
    names = [r["feature"] for r in kept.orderBy(F.desc("chi2"), "feature").limit(FEATURES).collect()]
    found = sorted((r["toxic"], r["cols"], r["times"], r["named"]) for r in vectors(rows, names).collect())
    y = np.array([f[0] for f in found], float)
    row = np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
    col = np.array([c for f in found for c in f[1]], int)
    val = np.log1p(np.array([t for f in found for t in f[2]], float))
    return solve(y, row, col, val, names, Counter(s for f in found for s in counterfactuals(f[3])))


def solve(y: np.ndarray, row: np.ndarray, col: np.ndarray, val: np.ndarray, names: list[str], swaps: Counter) -> Model:
    """Gradient steps on the mean loss of balanced classes and both penalties."""
    place = {f: i for i, f in enumerate(names)}
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    # Each swap is a row of differences: what the other term brings less what the named one takes away.
    differences = []
    for (named, other), times in sorted(swaps.items()):
        d = np.zeros(len(names))
        for term, sign in ((named, -1), (other, 1)):
            for f in features(term):
                if f in place:
                    d[place[f]] += sign
        if d.any():
            differences.append(d * math.sqrt(times / len(y)))
    d = np.array(differences) if differences else np.zeros((0, len(names)))
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    w, constant = np.zeros(len(names)), 0.0
    m, v, m0, v0 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, STEPS + 1):
        logit = np.bincount(row, val * w[col], len(y)) + constant
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y) * weight
        g = np.bincount(col, val * error[row], len(names)) + RIDGE * w + FAIRNESS * (d.T @ (d @ w))
        g0 = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        m0, v0 = 0.9 * m0 + 0.1 * g0, 0.99 * v0 + 0.01 * g0 * g0
        a, b = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.1 * (m / a) / (np.sqrt(v / b) + 1e-8)
        constant -= 0.1 * (m0 / a) / (math.sqrt(v0 / b) + 1e-8)
    # A feature that one word of a text has counts log1p(1); scores add weights of words as they are.
    return Model({f: float(x) * math.log(2) for f, x in zip(names, w) if abs(x) > 1e-6}, float(constant))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_DOCS) -> Model:
    """Learn from the labelled rows given."""
    return fit_bags(bags(sample(docs, labels, per_class)))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            scores = [model.score(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bounded(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score stays below the threshold, all columns kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            yield batch.filter(pa.array([model.score(t) < threshold for t in texts(batch)], pa.bool_()))

    return bounded(docs).mapInArrow(run, docs.schema)
