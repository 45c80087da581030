"""Quality classifier learned from preferences: Bradley-Terry ranking of documents.

A document's strength is a weighted sum of its features, and one document is preferred
to another with the logistic of the difference of their strengths. Pairs of a good and
a bad labelled document are the preferences; their logistic loss on the difference of
the two feature vectors gives the weights. There is no bias: ranking tells which of two
documents is better, and not yet which are good enough.

The threshold is a quantile of the strengths of all documents. Its level is the one that
tells the labelled documents apart best, of a grid that is finer towards both ends, so a
corpus with little junk has levels below it. Scores are the logistic of the distance
from the threshold, shifted so that a document at the threshold gets ``THRESHOLD``.

Features are shares of character classes (each ASCII sign is its own), word lengths and
repetition in words, word triples and lines, all over the whole text. They do not depend
on the length of a text as such. They are computed once and kept in a checkpoint of some
``50`` floats a row; training, quantiles and scores read that.

Learning takes at most ``TRAIN_DOCS`` documents of each label, those with the smallest
hash of id and features, and ``ROUNDS`` pairs for each document of the more frequent label.

Defined results: a text without words (or null) has all features zero and is scored like any other;
rows repeat as often as in the input; a document with several label rows has the label that
most of them give, good in a tie; rows without id are scored and never learned; with labels
of one kind only, every score is that label, and without labels 0.5; an empty table gives
an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saldo.llm.textarrays import Words, chunks, code_points, mix
from saldo.session import ensure_checkpoint_dir

TRAIN_DOCS, ROUNDS, RIDGE, THRESHOLD = 4000, 8, 1e-3, 0.7
#: Words of a block in which different words are counted.
BLOCK = 64
CHUNK = 1_000_000
#: Quantile levels that are tried; their log-odds are equally spaced.
LEVELS, END = 1000, 12.0
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
LOWER, UPPER, DIGIT, SPACE, OTHER_PUNCTUATION, SYMBOL, OTHER = range(len(SIGNS), len(SIGNS) + 7)
CLASSES = len(SIGNS) + 7
N_FEATURES = CLASSES + 8


def class_table() -> np.ndarray:
    """The class of each code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    of = {"Lu": UPPER, "Lt": UPPER, "Nd": DIGIT, "Zs": SPACE, "Zl": SPACE, "Zp": SPACE}
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))
        if kind in of:
            table[point] = of[kind]
        elif kind[0] in "LM":
            table[point] = LOWER
        elif kind[0] in "PS":
            table[point] = OTHER_PUNCTUATION if kind[0] == "P" else SYMBOL
    table[9:14] = SPACE
    for k, sign in enumerate(SIGNS):
        table[ord(sign)] = k
    return table


def _distinct(group: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each group has."""
    _, first = np.unique(mix(mix(key) + group.astype(np.uint64)), return_index=True)
    return np.bincount(group[first], minlength=n)


def features(texts: list[str], table: np.ndarray) -> np.ndarray:
    """One row of ``N_FEATURES`` for each text."""
    n = len(texts)
    out = np.zeros((n, N_FEATURES))
    points, offsets = code_points(texts)
    kind = table[points].astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(doc * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    solid = np.maximum(counts.sum(axis=1) - counts[:, SPACE], 1)[:, None]
    out[:, :CLASSES] = np.sqrt(counts / solid)
    letters = np.maximum(counts[:, LOWER] + counts[:, UPPER], 1)
    out[:, UPPER] = np.sqrt(counts[:, UPPER] / letters)

    words = Words(texts)
    sizes = np.diff(words.first)
    many = np.maximum(sizes, 1)
    owner = np.repeat(np.arange(n), sizes)
    lengths = (words.ends - words.starts).astype(float)
    mean = np.bincount(owner, weights=lengths, minlength=n) / many
    spread = np.sqrt(np.maximum(np.bincount(owner, weights=lengths**2, minlength=n) / many - mean**2, 0))
    # words without a letter: no letter byte between their ends
    raw = np.frombuffer(words.data, dtype=np.uint8)
    lettered = np.concatenate(([0], np.cumsum((raw >= 128) | ((raw | 32) >= 97) & ((raw | 32) <= 122))))
    bare = lettered[words.ends] == lettered[words.starts]
    rest = out[:, CLASSES:]
    rest[:, 0], rest[:, 1] = np.log1p(mean), np.log1p(spread)
    rest[:, 2] = np.sqrt(np.bincount(owner, weights=bare, minlength=n) / many)
    again = np.zeros(len(owner), dtype=bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    rest[:, 3] = np.sqrt(np.bincount(owner, weights=again, minlength=n) / many)

    place = np.arange(len(owner)) - words.first[:-1][owner]
    blocks = -(-sizes // BLOCK)
    block = (np.cumsum(blocks) - blocks)[owner] + place // BLOCK
    different = np.bincount(
        np.repeat(np.arange(n), blocks), weights=_distinct(block, words.hashes, int(blocks.sum())), minlength=n
    )
    rest[:, 4] = 1 - different / many
    triple = np.flatnonzero(place < sizes[owner] - 2)
    if len(triple):
        three = mix(words.hashes[triple] + mix(words.hashes[triple + 1] + mix(words.hashes[triple + 2])))
        kinds = _distinct(owner[triple], three, n)
        rest[:, 5] = np.where(sizes > 2, 1 - kinds / np.maximum(sizes - 2, 1), 0.0)
    for k, text in enumerate(texts):
        lines = [line for line in text.split("\n") if line]
        rest[k, 6] = 1 - len(set(lines)) / len(lines) if lines else 0.0
    rest[:, 7] = np.sqrt((counts[:, DIGIT] + counts[:, SYMBOL] + counts[:, : len(SIGNS)].sum(axis=1)) / solid[:, 0])
    out[sizes == 0] = 0
    return out


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x) of every row, x an array of ``N_FEATURES`` floats."""
    table = docs.sparkSession.sparkContext.broadcast(class_table())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for a, b in chunks(texts, CHUNK):
                found = features(texts[a:b], table.value).astype(np.float32)
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b], "x": list(found)})

    kind = dict(docs.dtypes)[doc_id]
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInPandas(run, f"doc_id {kind}, x array<float>")


def preferences(good: np.ndarray, bad: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Feature differences of ``rounds`` pairs for each document of the larger side, each time with another partner."""
    n = max(len(good), len(bad))
    at = np.arange(n)
    order = np.random.default_rng(0)
    better, worse = order.permutation(len(good)), order.permutation(len(bad))
    return np.concatenate([good[better[at % len(good)]] - bad[worse[(at + at // len(bad) + k) % len(bad)]] for k in range(rounds)])


def bradley_terry(differences: np.ndarray, ridge: float = RIDGE, steps: int = 50) -> np.ndarray:
    """Weights that make each difference's strength positive, by Newton steps on the mean logistic loss."""
    n, size = differences.shape
    w = np.zeros(size)
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(differences @ w, -40, 40)))  # chance of the other order
        gradient = ridge * w - differences.T @ p / n
        hessian = (differences * (p * (1 - p))[:, None]).T @ differences / n + ridge * np.eye(size)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Ranking:
    """The learned strength (weights on raw features) and the learned documents' strengths by label."""

    weights: np.ndarray
    good: np.ndarray
    bad: np.ndarray

    def strength(self, x: str = "x") -> Column:
        """A document's strength from its features."""
        parts = [F.element_at(x, k + 1).cast("double") * float(w) for k, w in enumerate(self.weights)]
        total = F.lit(0.0)
        for part in parts:
            total = total + part
        return total


def fit(known: DataFrame, labels: DataFrame, label: str = "quality", train_docs: int = TRAIN_DOCS) -> Ranking | float:
    """The ranking learned from features (doc_id, x) and labels (doc_id, label); with fewer than two labels their value."""
    said = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    said = said.groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).alias("good"))
    sides = {}
    for good in (True, False):
        # both cuts are top lists by a hash: no more than train_docs rows of a side reach the driver
        drawn = said.filter(F.col("good") == good).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
        rows = known.join(F.broadcast(drawn), "doc_id").select("doc_id", "x")
        kept = rows.orderBy(F.xxhash64("doc_id", "x"), "doc_id").limit(train_docs).select("x").collect()
        sides[good] = np.array([r["x"] for r in kept], dtype=float).reshape(-1, N_FEATURES)
    good, bad = sides[True], sides[False]
    if not len(good) or not len(bad):
        return 1.0 if len(good) else 0.0 if len(bad) else 0.5
    every = np.concatenate((good, bad))
    scale = every.std(axis=0)
    scale = np.where(scale > 1e-9, scale, np.inf)  # a feature that never varies gets no weight
    weights = bradley_terry(preferences(good / scale, bad / scale)) / scale
    return Ranking(weights, np.sort(good @ weights), np.sort(bad @ weights))


def threshold(ranking: Ranking, strengths: DataFrame) -> tuple[float, float]:
    """(level, threshold): the quantile of all documents' strengths that tells the labels apart best.

    A threshold lies halfway between two neighbouring quantiles. Of equally good ones the
    one with the widest gap is taken, then the lowest.
    """
    levels = (1 / (1 + np.exp(-np.linspace(-END, END, LEVELS)))).tolist()
    at = strengths.agg(F.percentile_approx("strength", levels, 100_000).alias("q")).first()["q"]
    grid = np.array(at)
    # beyond the outermost quantiles everything is good, or nothing is
    grid = np.concatenate(([grid[0] - 1], grid, [grid[-1] + 1]))
    middle, gap = (grid[1:] + grid[:-1]) / 2, np.diff(grid)
    missed = np.searchsorted(ranking.good, middle, side="left") / len(ranking.good)
    passed = 1 - np.searchsorted(ranking.bad, middle, side="left") / len(ranking.bad)
    cost = missed + passed
    best = np.flatnonzero(cost <= cost.min() + 1e-12)
    chosen = best[np.argmax(gap[best])]
    return float([0.0, *levels, 1.0][chosen]), float(middle[chosen])


def steepness(ranking: Ranking, cut: float, ridge: float = 1e-2, steps: int = 50) -> float:
    """The slope of the logistic through (cut, THRESHOLD) that fits the labels best, each label with half of the weight."""
    x = np.concatenate((ranking.good, ranking.bad)) - cut
    y = np.append(np.ones(len(ranking.good)), np.zeros(len(ranking.bad)))
    weight = np.append(np.full(len(ranking.good), 0.5 / len(ranking.good)), np.full(len(ranking.bad), 0.5 / len(ranking.bad)))
    offset, a = np.log(THRESHOLD / (1 - THRESHOLD)), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * x + offset, -40, 40)))
        slope = (weight * x * (p - y)).sum() + ridge * a
        curve = (weight * x * x * p * (1 - p)).sum() + ridge
        a -= np.clip(slope / curve, -1, 1)
    return max(float(a), 1e-3)


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, strength, score, predicted) of every row of ``docs``, learned from ``labels`` (doc_id, label)."""
    ensure_checkpoint_dir(docs.sparkSession)
    known = measured(docs, doc_id, text).checkpoint()
    ranking = fit(known, labels, label)
    if not isinstance(ranking, Ranking):
        found = known.select("doc_id", F.lit(None).cast("double").alias("strength"), F.lit(ranking).alias("score"))
        return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    strengths = known.select("doc_id", ranking.strength().alias("strength"))
    if known.isEmpty():
        return strengths.select("doc_id", "strength", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    _, cut = threshold(ranking, strengths)
    odds = steepness(ranking, cut) * (F.col("strength") - cut) + float(np.log(THRESHOLD / (1 - THRESHOLD)))
    found = strengths.withColumn("score", 1 / (1 + F.exp(-odds)))
    above = F.col("strength") >= cut
    # at the threshold itself rounding must not decide against what the quantile says
    found = found.withColumn("score", F.when(above, F.greatest("score", F.lit(THRESHOLD))).otherwise(F.least("score", F.lit(0.6999999))))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
