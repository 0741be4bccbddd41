"""Document quality by histogram gradient-boosted trees over document statistics.

The trees are fitted in the driver on a bounded sample of labelled documents outside the
held-out fold: statistics fall into quantile bins, each level of a tree takes its splits
from histograms of gradients over the bins, and all trees lie in flat arrays. Scoring walks
all trees at once in numpy, one level at a time, inside Arrow batches of any document table.

Null and empty texts have all statistics zero and are scored like any other. Without labels
of both kinds each score is the share of label 1 (a half without any label). Repeated rows
are scored each; a repeated id counts once in the sample.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from trailmart.llm.common import held_out, labelled_sample, ready

#: Most labelled documents that the trees are fitted on.
MAX_LABELLED = 20_000
TREES, DEPTH, BINS = 80, 4, 64
LEARNING_RATE, PENALTY, LEAST_WEIGHT = 0.15, 1.0, 3.0
#: A document is predicted to be good from this score.
THRESHOLD = 0.3
SYMBOLS = "#*$%&|<>"
ENDS = (".", "!", "?", ":", ";", ",")


def statistics(text: str | None) -> list[float]:
    """The statistics of one document; shares are of its words, lines or characters."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, chars = len(words), len(text)
    lines = [line for line in text.split("\n") if line.strip()]
    counts = Counter(words)
    pairs = set(zip(words, words[1:]))
    triples = set(zip(words, words[1:], words[2:]))
    letters = sum(map(len, words))
    line_words = [line.count(" ") + 1 for line in lines]
    return [
        np.log1p(n),
        letters / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        1 - len(pairs) / max(1, n - 1),
        1 - len(triples) / max(1, n - 2),
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, counts)) / len(counts),
        sum(map(text.count, SYMBOLS)) / n,
        text.count("|") / n,
        text.count("!") / n,
        text.count(",") / n,
        text.count(".") / n,
        sum(map(text.count, "0123456789")) / chars,
        sum(map(text.count, "()[]{}\"';:/\\=_-+@")) / chars,
        len(text.encode()) / chars - 1,
        np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines),
        sum(line.endswith(ENDS) for line in lines) / len(lines),
        np.log1p(max(line_words)),
        np.log1p(n / len(lines)),
        np.log1p(max(map(len, counts))),
        sum(len(word) <= 2 for word in counts) / len(counts),
    ]


STATISTICS = (
    "log words", "word length", "distinct words", "commonest word", "words repeated at once",
    "repeated pairs", "repeated triples", "upper-case words", "title-case words", "symbols",
    "bars", "exclamation marks", "commas", "full stops", "digits", "other signs",
    "bytes beyond one", "log lines", "repeated lines", "ended lines", "log longest line",
    "log words a line", "log longest word", "short words",
)


@dataclass
class Forest:
    """Complete trees in flat arrays: the children of node n are 2n + 1 and 2n + 2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    leaf: np.ndarray  # trees x leaves

    def margins(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros((len(rows), len(self.feature)), dtype=np.int64)
        tree, row = np.arange(len(self.feature)), np.arange(len(rows))[:, None]
        for _ in range(DEPTH):
            right = rows[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[tree, node - (2**DEPTH - 1)].sum(axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(rows)))


def fit(rows: np.ndarray, labels: np.ndarray) -> Forest:
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6) if len(labels) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        none = np.zeros((0, inner), dtype=np.int64)
        return Forest(base, none, none.astype(float), np.zeros((0, leaves)))
    edges = [_edges(column) for column in rows.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, rows.T)], axis=1)
    feature = np.zeros((TREES, inner), dtype=np.int64)
    threshold = np.full((TREES, inner), np.inf)
    leaf = np.zeros((TREES, leaves))
    margin = np.full(len(rows), base)
    for tree in range(TREES):
        score = 1 / (1 + np.exp(-margin))
        gradient, weight = score - labels, score * (1 - score)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(DEPTH):
            first = 2**level - 1
            best = _best_splits(binned, node - first, 2**level, gradient, weight)
            for at, (column, cut) in enumerate(best):
                if column >= 0:
                    feature[tree, first + at] = column
                    threshold[tree, first + at] = edges[column][cut]
            right = rows[np.arange(len(rows)), feature[tree, node]] > threshold[tree, node]
            node = 2 * node + 1 + right
        at = node - inner
        sums = np.bincount(at, gradient, leaves), np.bincount(at, weight, leaves)
        leaf[tree] = -LEARNING_RATE * sums[0] / (sums[1] + PENALTY)
        margin += leaf[tree, at]
    return Forest(base, feature, threshold, leaf)


def _edges(column: np.ndarray) -> np.ndarray:
    """Upper bounds of the bins but the last."""
    return np.unique(np.quantile(column, np.arange(1, BINS) / BINS, method="lower"))


def _best_splits(binned, node, nodes, gradient, weight):
    """For each node the column and bin of the best split, column -1 where none gains."""
    best, gains = [(-1, 0)] * nodes, np.full(nodes, 1e-9)
    for column in range(binned.shape[1]):
        key = node * BINS + binned[:, column]
        g, h = (
            np.bincount(key, values, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
            for values in (gradient, weight)
        )
        g_all, h_all = g[:, -1:], h[:, -1:]
        gain = g**2 / (h + PENALTY) + (g_all - g) ** 2 / (h_all - h + PENALTY)
        gain -= g_all**2 / (h_all + PENALTY)
        gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = -1
        cut = gain[:, :-1].argmax(axis=1)
        for at in np.flatnonzero(gain[np.arange(nodes), cut] > gains):
            best[at], gains[at] = (column, int(cut[at])), gain[at, cut[at]]
    return best


@F.pandas_udf(ArrayType(DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(text) for text in texts])


def learn(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Forest:
    """Trees fitted on at most ``max_labelled`` documents that the labels name."""
    ready(documents.sparkSession)
    sample = labelled_sample(documents, labels, "quality", max_labelled)
    rows = sample.select("doc_id", "label", _statistics("text").alias("row"))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("row").alias("row"))
    found = rows.toPandas().sort_values("doc_id")
    matrix = np.array(found["row"].tolist(), dtype=float).reshape(len(found), len(STATISTICS))
    return fit(matrix, found["label"].to_numpy(dtype=float))


def scorer(forest: Forest) -> Callable[[Column], Column]:
    """A column function: the score of a text, 0 to 1, higher for label 1."""

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        rows = np.array([statistics(text) for text in texts], dtype=float)
        return pd.Series(forest.scores(rows.reshape(len(texts), len(STATISTICS))))

    return score


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each document."""
    score = scorer(learn(documents, labels))
    rows = documents.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(documents: DataFrame, forest: Forest) -> DataFrame:
    """The documents that are predicted to be good, with their own columns."""
    ready(documents.sparkSession)
    return documents.filter(scorer(forest)("text") >= THRESHOLD)
