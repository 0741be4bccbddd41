"""Classifiers and the line model: held-out accuracy, regularisation, messy tables."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from trailmart.llm import line_quality, quality_classifier, toxicity
from trailmart.llm.common import table

TABLES = "/root/testdata/sf0.01"


def held_out_accuracy(found, labels, label):
    rows = found.filter("held_out").join(labels, "doc_id").collect()
    return np.mean([r["predicted"] == r[label] for r in rows]), len(rows)


@pytest.mark.parametrize(
    ("operator", "label", "least"),
    [(quality_classifier, "quality", 0.95), (toxicity, "toxic", 0.9)],
)
def test_held_out_accuracy(spark, operator, label, least):
    labels = table(spark, TABLES, "labels")
    found = operator.scored(table(spark, TABLES, "documents"), labels)
    accuracy, rows = held_out_accuracy(found, labels, label)
    assert rows > 50 and accuracy >= least
    assert found.filter("score < 0 OR score > 1 OR isnan(score) OR score IS NULL").count() == 0


@pytest.mark.parametrize("operator", [quality_classifier, toxicity])
def test_messy_and_empty_tables(messy, labels, operator):
    for given in (labels((0, 1, 1), (3, 0, 0), (None, 1, 1), (4, None, None)), labels()):
        found = operator.scored(messy, given)
        assert found.count() == messy.count()
        assert found.filter("score IS NULL OR held_out IS NULL").count() == 0
        assert operator.scored(messy.limit(0), given).collect() == []
    assert {r["score"] for r in operator.scored(messy, labels()).collect()} == {0.5}


def test_the_held_out_fold_is_not_learnt_from(documents, labels):
    import zlib

    texts = [f"word{n} common" for n in range(60)]
    out = [n for n in range(60) if zlib.crc32(str(n).encode()) % 5 == 0]
    rows = [(n, int(n in out), int(n in out)) for n in range(60)]
    assert out and toxicity.learn(documents(*texts), labels(*rows)).weights == {}
    assert len(quality_classifier.learn(documents(*texts), labels(*rows)).feature) == 0


def test_a_single_tree_finds_the_best_split(monkeypatch):
    rows = np.array([[float(n), float(n % 2)] for n in range(40)])
    forest = quality_classifier.fit(rows, (rows[:, 0] > 17).astype(float))
    assert forest.feature[0, 0] == 0 and 17 <= forest.threshold[0, 0] < 18
    scores = forest.scores(rows)
    assert (scores[18:] > 0.75).all() and (scores[:18] < 0.25).all()


def test_flat_traversal_equals_a_walk_of_each_tree():
    chance = np.random.default_rng(1)
    rows = chance.normal(size=(200, 5))
    forest = quality_classifier.fit(rows, (rows[:, 0] * rows[:, 1] > 0).astype(float))
    for row, margin in zip(rows, forest.margins(rows)):
        total = forest.base
        for tree in range(len(forest.feature)):
            node = 0
            while node < forest.feature.shape[1]:
                right = row[forest.feature[tree, node]] > forest.threshold[tree, node]
                node = 2 * node + 1 + int(right)
            total += forest.leaf[tree, node - forest.feature.shape[1]]
        assert margin == pytest.approx(total)


def test_swapping_identity_terms_changes_scores_less_with_the_penalty(monkeypatch):
    rows = [["muslim", "vile"]] * 30 + [["muslim"]] * 10 + [["christian"]] * 40 + [["tree"]] * 20
    marks = np.array([1] * 30 + [0] * 70, dtype=float)
    pairs = [(r, sorted(toxicity.swapped(set(r)))) for r in rows if r != ["tree"]]
    names = sorted({name for pair in pairs for side in pair for name in side} | {"tree"})

    def gap():
        weights = toxicity.fit(rows, pairs, marks, names).weights
        return abs(weights["muslim"] - weights[toxicity.SWAPS["muslim"]])

    with_penalty = gap()
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    assert with_penalty < 0.2 * gap()


def test_swaps_stay_within_their_kind_and_return():
    for line in toxicity.IDENTITY_TERMS:
        word = line[0]
        for _ in line:
            word = toxicity.SWAPS[word]
            assert word in line
        assert word == line[0]


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {
        n + k
        for n in range(len(words) - 2)
        if triples[tuple(words[n : n + 3])] > 1
        for k in range(3)
    }
    seen, repeats = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            repeats += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeats, len(covered), failed


def test_rules_on_a_messy_table(messy, labels):
    for given in (labels((0, 1, 1), (3, 0, 0)), labels()):
        rows = line_quality.judged(messy, given).collect()
        texts = messy.select("doc_id", "text").collect()
        want = [(doc_id, *brute_counts(text)) for doc_id, text in texts]
        assert sorted(repr(tuple(r)[:7]) for r in rows) == sorted(map(repr, want))
        assert not any(r["kept"] and r["base_failed"] for r in rows)
        assert line_quality.judged(messy.limit(0), given).collect() == []


def test_rules_equal_brute_force_on_odd_texts():
    chain = line_quality.fit([], np.array([]))
    for text in ("a b c a b c", "a a a a", "x\nx\n\nx \ny", "a b\na b\n", "# | <é>", "a\x0bb\x1cc", "a b c d b c d"):
        found = line_quality.judge(text, chain)
        assert found[:6] == brute_counts(text)


def test_viterbi_finds_the_best_path():
    chance = np.random.default_rng(3)
    for length in (1, 2, 6):
        chain = line_quality.Chain(
            chance.normal(size=line_quality.FEATURES), chance.normal(size=(2, 2)), chance.normal(size=2)
        )
        lines = chance.normal(size=(length, line_quality.FEATURES))

        def score(path):
            total = chain.first[path[0]] + sum(chain.transition[a, b] for a, b in zip(path, path[1:]))
            return total + sum(lines[n] @ chain.emission for n, label in enumerate(path) if label)

        best = max(itertools.product((0, 1), repeat=length), key=score)
        assert tuple(chain.decode(lines)) == best


def test_gradient_of_the_likelihood():
    chance = np.random.default_rng(4)
    lines = chance.normal(size=(3, 4, line_quality.FEATURES))
    there = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 0, 0, 0]], dtype=bool)
    lines[~there] = 0
    target = np.where(there, np.array([1, 0, 1])[:, None], 0)
    chain = line_quality.Chain(chance.normal(size=line_quality.FEATURES), chance.normal(size=(2, 2)), chance.normal(size=2))

    def likelihood():
        total = 0.0
        for n, length in enumerate(there.sum(axis=1)):
            def score(path, n=n):
                value = chain.first[path[0]] + sum(chain.transition[a, b] for a, b in zip(path, path[1:]))
                return value + sum(lines[n, k] @ chain.emission for k, label in enumerate(path) if label)

            every = [score(path) for path in itertools.product((0, 1), repeat=int(length))]
            total += score(tuple(target[n, :length])) - np.logaddexp.reduce(every)
        return total

    found = line_quality._gradients(chain, lines, there, target)
    for name in ("emission", "transition", "first"):
        values = getattr(chain, name)
        for place in np.ndindex(values.shape):
            before = values[place]
            values[place] = before + 1e-5
            up = likelihood()
            values[place] = before - 1e-5
            down = likelihood()
            values[place] = before
            assert found[name][place] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_good_documents_are_kept_by_the_line_model(spark):
    labels = table(spark, TABLES, "labels")
    rows = line_quality.judged(table(spark, TABLES, "documents"), labels).join(labels, "doc_id")
    kept = rows.filter("NOT base_failed").groupBy("quality").agg({"kept": "count"}).collect()
    by = {r["quality"]: r[1] for r in kept}
    good = rows.filter("NOT base_failed AND quality = 1 AND kept").count()
    bad = rows.filter("NOT base_failed AND quality = 0 AND NOT kept").count()
    assert good >= 0.98 * by[1] and bad >= 0.7 * by[0]
