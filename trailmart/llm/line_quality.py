"""Quality rules: counts of a text, and a conditional random field over its lines.

The counts are plain rules. For the rest, each line with a word is described by a few shares
and decoded by Viterbi as content or boilerplate under a linear chain: a weight per feature,
one for each pair of neighbouring labels and one for each first label. The weights are
fitted by gradient ascent on the conditional likelihood, in the driver, on a bounded sample
of labelled documents outside the held-out fold, whose lines carry their document's label.
A document is kept if it fails no rule and at least half of its letters lie in content.

Null texts have no words, and a text without words fails the rules. Without labels of both
kinds every line is content. Repeated rows are judged each; a repeated id counts once in the
sample. Only the text is sent to Python; other columns come back unchanged.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from trailmart.llm.common import labelled_sample, ready

#: Most labelled documents that are learnt from, and most lines of each.
MAX_LABELLED, MAX_LINES = 2_000, 64
STEPS, STEP, RIDGE = 150, 0.1, 1e-3
#: The share of a document's letters in content lines from which it is kept.
CONTENT_SHARE = 0.5
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
BOILERPLATE, CONTENT = 0, 1
FEATURES = 13
RULES = StructType(
    [
        *(
            StructField(name, LongType())
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ),
        StructField("base_failed", BooleanType()),
        StructField("content_share", DoubleType()),
        StructField("kept", BooleanType()),
    ]
)


def repeated_words(words: list[str]) -> int:
    """Words in windows of three that the text has twice or more, the first included."""
    if len(words) < WINDOW:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for word in words], dtype=np.int64)
    _, pairs = np.unique(ids[:-2] * len(number) + ids[1:-1], return_inverse=True)
    _, which, times = np.unique(
        pairs * len(number) + ids[2:], return_inverse=True, return_counts=True
    )
    opens = np.flatnonzero(times[which] > 1)
    covered = np.zeros(len(words), dtype=bool)
    for place in range(WINDOW):
        covered[opens + place] = True
    return int(covered.sum())


def line_features(words: list[str], line: str, seen: bool) -> tuple[float, ...]:
    """The description of a line with at least one word."""
    n, letters = len(words), sum(map(len, words))
    symbols = sum(map(line.count, SYMBOLS))
    return (
        1.0,
        min(n, 40) / 40,
        float(n < 5),
        min(1.0, symbols / n),
        min(1.0, line.count("|") / n),
        min(1.0, line.count("!") / n),
        sum(map(str.isupper, words)) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        len(set(words)) / n,
        float(seen),
        float(line.rstrip().endswith((".", "!", "?"))),
        min(1.0, letters / n / 20),
        min(1.0, sum(map(line.count, "0123456789")) / letters),
    )


@dataclass
class Chain:
    """Weights of content over boilerplate, of label pairs and of first labels."""

    emission: np.ndarray  # features
    transition: np.ndarray  # from x to
    first: np.ndarray  # labels

    def decode(self, lines: np.ndarray) -> np.ndarray:
        """The likeliest labels of the lines of one document, by Viterbi."""
        gains = (lines @ self.emission).tolist()
        (stay_b, to_c), (to_b, stay_c) = self.transition.tolist()
        boiler, content = self.first.tolist()
        content += gains[0]
        back = []
        for gain in gains[1:]:
            from_b = boiler + stay_b >= content + to_b
            from_c = content + stay_c >= boiler + to_c
            back.append((BOILERPLATE if from_b else CONTENT, CONTENT if from_c else BOILERPLATE))
            boiler, content = (
                max(boiler + stay_b, content + to_b),
                max(boiler + to_c, content + stay_c) + gain,
            )
        label = CONTENT if content >= boiler else BOILERPLATE
        labels = [label]
        for before in reversed(back):
            label = before[label]
            labels.append(label)
        return np.array(labels[::-1])


def fit(documents: list[np.ndarray], labels: np.ndarray) -> Chain:
    """The chain of highest penalised likelihood; ``labels`` has one label per document."""
    chain = Chain(np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(2))
    if len(np.unique(labels)) < 2:
        chain.emission[0] = 1.0
        return chain
    longest = max(map(len, documents))
    lines = np.zeros((len(documents), longest, FEATURES))
    there = np.zeros((len(documents), longest), dtype=bool)
    for row, document in enumerate(documents):
        lines[row, : len(document)], there[row, : len(document)] = document, True
    target = np.where(there, labels[:, None].astype(int), 0)
    moments = {name: [np.zeros_like(getattr(chain, name)) for _ in range(2)]
               for name in ("emission", "transition", "first")}
    for step in range(1, STEPS + 1):
        for name, gradient in _gradients(chain, lines, there, target).items():
            value, (mean, square) = getattr(chain, name), moments[name]
            gradient = gradient / len(documents) - RIDGE * value
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            ahead = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            value += STEP * ahead
    return chain


def _gradients(chain, lines, there, target) -> dict[str, np.ndarray]:
    """Observed less expected counts, by the forward and backward sums of all documents."""
    documents, longest = there.shape
    scores = np.zeros((documents, longest, 2))
    scores[:, :, CONTENT] = lines @ chain.emission
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = chain.first + scores[:, 0]
    for at in range(1, longest):
        reached = np.logaddexp.reduce(ahead[:, at - 1, :, None] + chain.transition, axis=1)
        ahead[:, at] = np.where(there[:, at, None], reached + scores[:, at], ahead[:, at - 1])
    for at in range(longest - 1, 0, -1):
        onward = (scores[:, at] + behind[:, at])[:, None, :] + chain.transition
        reached = np.logaddexp.reduce(onward, axis=2)
        behind[:, at - 1] = np.where(there[:, at, None], reached, behind[:, at])
    whole = np.logaddexp.reduce(ahead[:, -1], axis=1)[:, None, None]
    share = np.exp(ahead + behind - whole) * there[:, :, None]
    pairs = there[:, 1:]
    joint = ahead[:, :-1, :, None] + chain.transition
    joint = joint + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[..., None]
    expected = (np.exp(np.where(pairs[..., None, None], joint, -np.inf))).sum(axis=(0, 1))
    observed = np.zeros((2, 2))
    np.add.at(observed, (target[:, :-1][pairs], target[:, 1:][pairs]), 1)
    surplus = (target - share[:, :, CONTENT]) * there
    return {
        "emission": np.einsum("dlf,dl->f", lines, surplus),
        "transition": observed - expected,
        "first": np.bincount(target[:, 0], minlength=2) - share[:, 0].sum(axis=0),
    }


def described(text: str | None) -> tuple[list[tuple[float, ...]], list[int], int, list[str]]:
    """Features and letters of each line with a word, repeated lines, and all words."""
    lines, letters, repeats, everything = [], [], 0, []
    met: set[str] = set()
    for line in (text or "").split("\n"):
        words = WORD.findall(line)
        if words:
            seen = line in met
            repeats += seen
            met.add(line)
            lines.append(line_features(words, line, seen))
            letters.append(sum(map(len, words)))
            everything += words
    return lines, letters, repeats, everything


def judge(text: str | None, chain: Chain) -> tuple:
    """The columns of ``RULES`` for one text."""
    lines, letters, repeats, words = described(text)
    n, repeated = len(words), repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * n
    share = 0.0
    if lines:
        content = chain.decode(np.array(lines)) == CONTENT
        share = float(np.array(letters)[content].sum() / sum(letters))
    symbols = sum(map((text or "").count, SYMBOLS))
    kept = not failed and share >= CONTENT_SHARE
    return n, sum(letters), symbols, repeats, repeated, failed, share, kept


@F.pandas_udf(ArrayType(ArrayType(DoubleType())))
def _sampled_lines(texts: pd.Series) -> pd.Series:
    """A stretch of each document's lines, from a place that its length picks."""
    rows = []
    for text in texts:
        lines = described(text)[0]
        at = len(text or "") % max(1, len(lines) - MAX_LINES + 1)
        rows.append([list(line) for line in lines[at : at + MAX_LINES]])
    return pd.Series(rows)


def learn(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Chain:
    """A chain fitted on at most ``max_labelled`` documents that the labels name."""
    ready(documents.sparkSession)
    sample = labelled_sample(documents, labels, "quality", max_labelled)
    rows = sample.select("doc_id", "label", _sampled_lines("text").alias("lines"))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("lines").alias("lines"))
    found = sorted(rows.filter(F.size("lines") > 0).collect(), key=lambda row: row["doc_id"])
    return fit(
        [np.array(row["lines"]) for row in found],
        np.array([row["label"] for row in found], dtype=int),
    )


def judged_by(chain: Chain) -> Callable[[Column], Column]:
    """A column function: the struct of ``RULES`` of a text."""

    @F.pandas_udf(RULES)
    def rules(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(text, chain) for text in texts], columns=RULES.names)

    return rules


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, the columns of ``RULES``) of each document."""
    rules = judged_by(learn(documents, labels))
    return documents.select("doc_id", rules("text").alias("rules")).select("doc_id", "rules.*")


def accepted(documents: DataFrame, chain: Chain) -> DataFrame:
    """The documents that are kept, with their own columns."""
    ready(documents.sparkSession)
    return documents.filter(judged_by(chain)("text")["kept"])
