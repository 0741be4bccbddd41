"""SimHash: fingerprints, the trie join and the classes, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmart.llm import simhash


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(words[n : n + 3]) for n in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(shingle, seed=42) for shingle in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(values):
    root = list(range(len(values)))
    for n, one in enumerate(values):
        for m in range(n):
            if bin(one ^ values[m]).count("1") <= 2 and root[n] != root[m]:
                low, high = sorted((root[n], root[m]))
                root = [low if r == high else r for r in root]
    return root


@settings(max_examples=100, deadline=None)
@given(text=st.text(max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_of_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(simhash, "COUNTED", 3)
    text = "one two three four five six seven eight nine TEN one two three"
    assert simhash.fingerprint(text) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def near_values(seed, clusters, each, flips):
    chance = random.Random(seed)
    values = set()
    for _ in range(clusters):
        centre = chance.getrandbits(64)
        for _ in range(each):
            value = centre
            for _ in range(chance.randint(0, flips)):
                value ^= 1 << chance.randrange(64)
            values.add(value)
    return sorted(values)


def linked(values, order):
    """Roots by the trie of one order alone, by value."""
    own = np.array(values, dtype=np.uint64)
    turned = simhash.reordered(own, order)
    ranked = np.argsort(turned)
    forest = simhash.Forest(len(own))
    simhash.join_tries(turned[ranked], forest)
    return {frozenset((int(own[ranked][n]), int(own[ranked][r]))) for n, r in enumerate(forest.root)}


def test_all_orders_together_lose_no_link(monkeypatch):
    for seed, frontier in ((1, 1_000_000), (2, 7)):
        monkeypatch.setattr(simhash, "FRONTIER", frontier)
        values = near_values(seed, clusters=12, each=25, flips=4)
        pairs = set().union(*(linked(values, order) for order in range(len(simhash.ORDERS))))
        place, root = {v: n for n, v in enumerate(values)}, list(range(len(values)))
        for pair in pairs:
            low, high = sorted(root[place[v]] for v in (min(pair), max(pair)))
            root = [low if r == high else r for r in root]
        assert root == brute_roots(values)


def test_links_and_stars_over_tasks(spark):
    values = near_values(3, clusters=20, each=30, flips=5) + [0, 1, 3, 7, 15]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    marked = spark.createDataFrame([(n, fp) for n, fp in enumerate(signed)], "doc_id long, fp long")
    found = {r["fp"]: r["component_id"] for r in simhash.classes(marked.repartition(5)).collect()}
    assert [found[fp] for fp in signed] == brute_roots(values)


def test_a_chain_of_links_is_one_class(spark):
    edges = spark.createDataFrame([(n + 1, n) for n in range(60)], "a long, b long")
    assert {tuple(r) for r in simhash.stars(edges).collect()} == {(n, 0) for n in range(1, 61)}
    assert simhash.stars(edges.limit(0)).collect() == []


def test_near_duplicates_on_a_messy_table(messy):
    rows = simhash.near_duplicates(messy).collect()
    texts = messy.select("doc_id", "text").collect()
    values = [simhash.fingerprint(r["text"]) for r in texts]
    roots = brute_roots(values)
    want = []
    for (doc_id, _), fp, root in zip(texts, values, roots):
        ids = [t[0] for t, r in zip(texts, roots) if r == root and t[0] is not None]
        want.append((doc_id, fp - (1 << 64) if fp >> 63 else fp, min(ids, default=None)))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert simhash.near_duplicates(messy.limit(0)).collect() == []


def test_one_of_each_class_stays(messy, documents):
    kept = simhash.one_of_each(messy)
    assert kept.columns == messy.columns
    fps = [simhash.fingerprint(r["text"]) for r in kept.collect()]
    everything = {simhash.fingerprint(r["text"]) for r in messy.collect()}
    assert sorted(fps) == sorted(everything)
    twice = documents("one two three four", "one two three four", "five six", None, "")
    assert sorted(r["doc_id"] for r in simhash.one_of_each(twice.union(twice)).collect()) == [0, 2, 3]
