"""Phrase mining by branch and bound, against brute force over all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from trailmart.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def brute(rows, top, least):
    counts, words = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered(text)):
            own = [word for word in re.split("[ \t]+", piece) if word]
            words[lang] += len(own)
            for size in range(1, 5):
                counts[lang].update(tuple(own[n : n + size]) for n in range(len(own) - size + 1))
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for phrase, a in candidates.items():
            for size in range(2, len(phrase)):
                for n in range(len(phrase) - size + 1):
                    part = phrase[n : n + size]
                    longest[part] = max(longest[part], a)
        ranked = []
        for phrase, a in candidates.items():
            if longest[phrase] and 100 * longest[phrase] >= 80 * a:
                continue
            cuts = [(f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase))]
            score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
            ranked.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return sorted(found)


def texts(seed, many=150):
    """Prose with frequent words, set phrases, and phrases that go on after frequent words."""
    chance = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(60)] + ["é", "ß", "Ω", "中"]
    weights = [1 / (n + 1) for n in range(len(vocabulary))]
    fixed = [" ".join(chance.choices(vocabulary, k=chance.randint(2, 6))) for _ in range(12)]
    rows = []
    for n in range(many):
        parts = []
        for _ in range(chance.randint(1, 12)):
            parts.append(chance.choice(fixed))
            parts.append(" ".join(chance.choices(vocabulary, weights, k=chance.randint(0, 9))))
        mark = chance.choice([" ", ". ", "\n", "\t", " , ", "!?", "\r\n", "\x0b"])
        rows.append((n, mark.join(parts), chance.choice(["en", "EN", "de", None])))
    return rows


@pytest.mark.parametrize("top, least", [(3, 3), (10, 5), (2_000, 3), (25, 1)])
def test_equals_brute_force(spark, monkeypatch, top, least):
    monkeypatch.setattr(collocations, "GROWTH", 2)
    rows = texts(top + least)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = collocations.collocations(df, top, least).collect()
    assert sorted(map(tuple, found)) == brute(rows, top, least)


def test_too_many_hashes_to_send_change_nothing(spark, monkeypatch):
    rows = texts(5, 60)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(collocations, "SENT", 3)
    assert sorted(map(tuple, collocations.collocations(df, 5, 3).collect())) == brute(rows, 5, 3)


def test_not_all_nodes_are_expanded(spark, monkeypatch):
    counted, count = [], collocations.frequent

    def watched(documents, size, least, either):
        counted.append((size, count(documents, size, least, either)))
        return counted[-1][1]

    monkeypatch.setattr(collocations, "frequent", watched)
    rows = texts(9)
    found = collocations.collocations(spark.createDataFrame(rows, SCHEMA), 3, 3).collect()
    assert sorted(map(tuple, found)) == brute(rows, 3, 3)
    every = count(spark.createDataFrame(rows, SCHEMA).fillna("und", "lang"), 3, 3, None).count()
    assert [size for size, _ in counted].count(2) == 1
    assert 0 < counted[1][1].count() < every


def test_stretches_and_merged_counts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 50)
    monkeypatch.setattr(collocations, "HELD", 20)
    rows = texts(11, 40)
    stretches = list(collocations.words_of([text.encode() for _, text, _ in rows]))
    assert len(stretches) > 20
    assert list(collocations.words_of([])) == list(collocations.words_of([b""])) == []


def test_hashes_in_tasks_equal_those_of_phrases(spark):
    df = spark.createDataFrame([("en", "of the 中"), ("", "a b")], "lang string, phrase string")
    held = collocations.sent(df).value
    spelled = [("en", [b"of", b"the", "中".encode()]), ("", [b"a", b"b"])]
    own = []
    for lang, words in spelled:
        hashes = np.array([collocations.xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
        own.append(collocations.hashed(collocations.seed(lang), hashes, len(words))[0])
    assert sorted(own) == held.tolist()
    members = collocations.Members(held)
    assert members.has(np.array([own[0], 5, own[1]], dtype=np.uint64)).tolist() == [True, False, True]


def test_counts_beyond_64_bits_are_exact(spark):
    big = 9_000_000_000_000_000_000
    words = spark.createDataFrame([("en", "a", big), ("en", "b", 7)], "lang string, phrase string, f bigint")
    pair = spark.createDataFrame([("en", "a b", big - 5)], "lang string, phrase string, f bigint")
    row = collocations.scored(pair, 2, {1: words}).head()
    assert row["score"] == 2_000_000 * (big - 5) // (big + 7)
    assert collocations.bounded(pair, words).head()["bound"] == 2_000_000 * (big - 5) // (2 * big - 5)


def test_messy_tables(spark, messy):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in messy.collect()]
    found = collocations.collocations(messy, 50, 2).collect()
    assert sorted(map(tuple, found)) == brute(rows, 50, 2)
    assert {r["lang"] for r in found} == {"en"}
    assert collocations.collocations(messy.limit(0)).collect() == []
    assert collocations.collocations(messy.filter("text = ''")).collect() == []
