"""Toxicity by a counterfactual-regularised linear classifier.

A document's features are its words and the beginnings of its longer words. Spark counts, in
a bounded sample of labelled documents, how many documents of either label hold a feature,
and the features that tell the labels apart best go on. The weights are fitted in the driver
on that sample. Each sampled document that names a group of people is also read with every
identity term swapped for another of its kind, and the squared change of its margin is
penalised, so that naming a group neither raises nor lowers a score.

Null and empty texts score as documents without features. Without labels of both kinds each
score is the share of label 1 (a half without any label). Repeated rows are scored each; a
repeated id counts once in the sample.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from trailmart.llm.common import held_out, labelled_sample, ready, stored

#: Most labelled documents that are learnt from, and features that are kept.
MAX_LABELLED, MAX_FEATURES = 20_000, 4_096
LEAST_DOCUMENTS = 3
STEPS, STEP, RIDGE, COUNTERFACTUAL = 500, 0.05, 2e-4, 1.0
THRESHOLD = 0.5
#: Words that a worker remembers.
KEPT_WORDS = 300_000
BEGINNINGS, MARK = (4, 5), "~"
WORD = re.compile(r"[^\W\d_]+")

# Identity terms; within a line each stands for the next when swapped.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual"),
    ("transgender", "cisgender"),
    ("immigrants", "natives"),
    ("disabled", "blind", "deaf"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)
SWAPS = {term: line[n - len(line) + 1] for line in IDENTITY_TERMS for n, term in enumerate(line)}


def features(word: str) -> tuple[str, ...]:
    """The features that a lower-case word gives."""
    return (word, *(word[:size] + MARK for size in BEGINNINGS if len(word) > size))


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def swapped(found: set[str]) -> set[str]:
    """The words with each identity term exchanged."""
    return {SWAPS.get(word, word) for word in found}


@dataclass
class Model:
    """Weights of named features; a document holds a feature or not."""

    base: float
    weights: dict[str, float]

    def scorer(self) -> Callable[[Column], Column]:
        """A column function: the score of a text, 0 to 1, higher for label 1."""
        number = {name: n for n, name in enumerate(self.weights)}
        weights, base = np.array([*self.weights.values(), 0.0]), self.base

        @F.pandas_udf(DoubleType())
        def score(texts: pd.Series) -> pd.Series:
            known: dict[str, tuple[int, ...]] = {}
            margins = np.full(len(texts), base)
            for row, text in enumerate(texts):
                held: set[int] = set()
                for word in words(text):
                    numbers = known.get(word)
                    if numbers is None:
                        if len(known) > KEPT_WORDS:
                            known.clear()
                        numbers = tuple(number[f] for f in features(word) if f in number)
                        known[word] = numbers
                    held.update(numbers)
                margins[row] += weights[sorted(held)].sum()
            return pd.Series(1 / (1 + np.exp(-margins)))

        return score


@F.pandas_udf(ArrayType(StringType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([sorted({f for w in words(text) for f in features(w)}) for text in texts])


def _kept(names: list[str], swap: bool) -> Callable[[Column], Column]:
    """A column function: the chosen features that a text holds, maybe after swapping."""
    chosen = set(names)

    @F.pandas_udf(ArrayType(StringType()))
    def kept(texts: pd.Series) -> pd.Series:
        rows = []
        for text in texts:
            found = swapped(words(text)) if swap else words(text)
            rows.append(sorted(chosen.intersection(f for w in found for f in features(w))))
        return pd.Series(rows)

    return kept


def choose_features(sample: DataFrame, max_features: int) -> list[str]:
    """The features with the largest chi-square against the label, and the identity terms'.

    None where the sample has no two labels to tell apart.
    """
    of_each = sample.agg(F.sum("label").alias("toxic"), F.count("*").alias("all")).head()
    toxic, everything = of_each["toxic"] or 0, of_each["all"]
    if toxic in (0, everything):
        return []
    held = sample.select("label", F.explode(_features("text")).alias("feature"))
    counts = held.groupBy("feature").agg(F.sum("label").alias("t"), F.count("*").alias("n"))
    expected = F.col("n") * (toxic / everything)
    chi = (F.col("t") - expected) ** 2 / (expected * (1 - F.col("n") / (everything + 1)))
    best = (
        counts.filter(F.col("n") >= LEAST_DOCUMENTS)
        .orderBy(chi.desc(), "feature")
        .limit(max_features)
    )
    of_terms = {f for term in SWAPS for f in features(term)}
    return sorted({row["feature"] for row in best.collect()} | of_terms)


def fit(rows: list, pairs: list, labels: np.ndarray, names: list[str]) -> Model:
    """Weights that fit the labels and change little between the sides of each pair."""
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6) if len(labels) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        return Model(base, {})
    number = {name: n for n, name in enumerate(names)}
    width, documents = len(names), _Sparse(rows, number)
    one, other = (_Sparse([pair[side] for pair in pairs], number) for side in (0, 1))
    weights, first, second = np.zeros(width), np.zeros(width), np.zeros(width)
    for step in range(1, STEPS + 1):
        score = 1 / (1 + np.exp(-(documents.times(weights) + base)))
        error = score - labels
        gradient = documents.back(error, width) / len(rows) + RIDGE * weights
        if pairs:
            change = one.times(weights) - other.times(weights)
            pull = 2 * COUNTERFACTUAL / len(pairs) * change
            gradient += one.back(pull, width) - other.back(pull, width)
        base -= STEP * error.mean()
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        ahead = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights -= STEP * ahead
    return Model(base, dict(zip(names, weights.tolist())))


class _Sparse:
    """Rows of features that are held or not."""

    def __init__(self, rows: list, number: dict[str, int]) -> None:
        self.rows = len(rows)
        self.row = np.repeat(np.arange(len(rows)), [len(row) for row in rows]).astype(np.int64)
        flat = [number[name] for row in rows for name in row]
        self.column = np.array(flat, dtype=np.int64)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.rows)

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, values[self.row], width)


def learn(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """A model of at most ``max_labelled`` documents that the labels name."""
    ready(documents.sparkSession)
    sample = labelled_sample(documents, labels, "toxic", max_labelled)
    sample = stored(sample.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "toxic")
    names = choose_features(sample, MAX_FEATURES)
    held = sample.select(
        "doc_id",
        "label",
        _kept(names, swap=False)("text").alias("held"),
        _kept(names, swap=True)("text").alias("other"),
    )
    found = sorted(held.collect(), key=lambda row: row["doc_id"])
    pairs = [(row["held"], row["other"]) for row in found if row["held"] != row["other"]]
    targets = np.array([row["label"] for row in found], dtype=float)
    return fit([row["held"] for row in found], pairs, targets, names)


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document."""
    score = learn(documents, labels).scorer()
    rows = documents.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
