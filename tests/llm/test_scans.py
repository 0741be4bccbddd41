"""Contamination and licence scans."""

from __future__ import annotations

import math
import re
import textwrap
from collections import defaultdict
from urllib.parse import urlparse
from urllib.request import url2pathname

import pyarrow.parquet as pq
import pytest

from tests.oracle_check import compare
from trailmart.llm import contamination, license_scan

PASSAGE = "One two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ITEMS = (PASSAGE, "short item", "", "élan VITAL 2024", f"again {PASSAGE}", "the the the the", None)


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items):
    windows = defaultdict(set)
    for item_id, text in items:
        words = brute_words(text)
        for at in range(max(1, len(words) - 12)):
            if words:
                windows[tuple(words[at : at + 13])].add(item_id)
    rows = []
    for doc_id, text in documents:
        words, hit, found = brute_words(text), set(), set()
        for at in range(len(words)):
            for size in range(1, 14):
                if tuple(words[at : at + size]) in windows and at + size <= len(words):
                    hit |= set(range(at, at + size))
                    found |= windows[tuple(words[at : at + size])]
        bad = len(hit) > 0 and 20 * len(hit) >= len(words)
        rows.append((doc_id, len(words), len(hit), sorted(found), bad))
    return rows


TEXTS = (
    PASSAGE, f"before {PASSAGE.upper()}, after; a short item.", PASSAGE.replace(" ", "--"),
    " ".join(PASSAGE.split()[:12]), "the the the the the the", "élan vital 2024", "nothing here",
    f"{PASSAGE} {PASSAGE} " + "filler word " * 400,
)


def as_rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.mark.parametrize("block_words", [1, 500_000])
@pytest.mark.parametrize("shard_postings", [10, 1_000_000])
def test_contamination(documents, items, monkeypatch, block_words, shard_postings):
    monkeypatch.setattr(contamination.phrase_blocks, "__defaults__", (block_words,))
    monkeypatch.setattr(contamination, "SHARD_POSTINGS", shard_postings)
    found = contamination.contamination(documents(*TEXTS).repartition(2), items(*ITEMS))
    want = brute(list(enumerate(TEXTS)), list(enumerate(ITEMS)))
    assert as_rows(found) == sorted(map(repr, want))


def test_contamination_of_messy_tables(messy, items, monkeypatch):
    given = items("a plain text", "x" * 50_000, "of the tionble of")
    rows = [tuple(r) for r in messy.select("doc_id", "text").collect()]
    found = contamination.contamination(messy, given)
    want = brute(rows, [tuple(r) for r in given.collect()])
    assert as_rows(found) == sorted(map(repr, want))
    assert contamination.contamination(messy.limit(0), given).collect() == []
    assert not contamination.contamination(messy, given.limit(0)).filter("n_hit > 0").collect()
    for broadcast_rows in (0, 1_000_000):
        monkeypatch.setattr(contamination, "BROADCAST_ROWS", broadcast_rows)
        kept = contamination.clean(messy, given)
        assert kept.columns == messy.columns
        assert kept.count() == sum(not bad for *_, bad in want)


def test_an_item_without_id_marks_words_only(spark, documents):
    items = spark.createDataFrame([(None, "two three"), (7, "two three")], "item_id long, text string")
    row = contamination.contamination(documents("one two three"), items).head()
    assert (row["n_hit"], row["items"]) == (2, [7])


def test_proximity(documents, items):
    index = contamination.build_index(documents("b x a", "a x x x b", "a b", "b", "a").coalesce(1))
    block = next(contamination.phrase_blocks(items("a b")))
    exact = contamination.matches(index, block).collect()
    assert [(r["document"], r["first"], r["after"]) for r in exact] == [(2, 0, 2)]
    near = contamination.matches(index, block, slack=2).collect()
    assert sorted({r["document"] for r in near}) == [0, 2]


def test_a_scan_of_the_index_holds_few_shards(documents):
    """Row groups are small, as readers hold one at once, and places are bytes to the JVM."""
    words = " ".join(f"w{n % 997}" for n in range(150_000))
    index = contamination.build_index(documents(*[words] * 8).coalesce(1))
    files = [pq.ParquetFile(url2pathname(urlparse(f).path)).metadata for f in index.inputFiles()]
    groups = [f.row_group(n) for f in files for n in range(f.num_row_groups)]
    assert len(groups) >= 4
    assert max(group.total_byte_size for group in groups) < 3 << 20
    assert {dict(index.dtypes)[name] for name in ("documents", "positions")} == {"binary"}


def test_places_beyond_two_bytes(documents, items):
    texts = (f"{'filler ' * 70_000}{PASSAGE}", "", PASSAGE)
    index = contamination.build_index(documents(*texts).coalesce(1))
    found = contamination.matches(index, next(contamination.phrase_blocks(items(PASSAGE)))).collect()
    assert sorted((r["document"], r["first"], r["after"]) for r in found) == [
        (0, 70_000, 70_015), (2, 0, 15)
    ]


def pairs(words):
    return list(zip(words, words[1:]))


def brute_dice(text, template, threshold=license_scan.THRESHOLD):
    """The best stretch of the template's length that lies around one of its longest bigrams."""
    words, own = (re.findall("[a-z0-9]+", t.lower()) for t in (text, template))
    wanted = set(pairs(own))
    low = len(wanted) * threshold / (2 - threshold)
    anchors = sorted(wanted, key=lambda b: (-len(" ".join(b)), " ".join(b)))
    anchors = anchors[: len(wanted) - math.ceil(low) + 1]
    best = 0
    for at, pair in enumerate(pairs(words)):
        if pair in anchors:
            first = max(0, at - pairs(own).index(pair))
            found = words[first : first + len(own)]
            if len(found) - 1 >= low:
                shared = set(pairs(found))
                best = max(best, 2 * len(shared & wanted) / (len(shared) + len(wanted)))
    return best


def wrapped(text, prefix="", width=80):
    return "\n".join(prefix + line for line in textwrap.wrap(text, width - len(prefix)))


KNOWN = dict(license_scan.TEMPLATES)
SCANNED = (
    "Some words.\nReleased under the MIT License.\nMore.", "RELEASED   under: the mit licence",
    KNOWN["MIT-text"].replace(", ", ",\n"), KNOWN["MIT-text"], "x", "", None,
    "Released under the MIT License. " * 9, "Licensed under CC BY NC 4.0!",
    f"intro words\n{KNOWN['MIT-text']} and a few words more\nend", "license " * 50,
    f"Copyright (c) 2020 Foo\n\n{wrapped(KNOWN['MIT-text'])}\n\nThe above copyright notice",
    f"#!/bin/sh\n{wrapped(KNOWN['Apache-2.0-header'], '# ')}\nexit 0",
    "Copyright 2020 Foo. Licensed under the Apache License, Version 2.0. All rights reserved.",
    f"/*\n{wrapped(KNOWN['GPL-2.0-header'], ' * ', 60)}\n */\nint main",
    wrapped(KNOWN["BSD-3-Clause-text"].replace("copyright holder", "Foo Corporation"), "// "),
    "Permission is hereby granted, free of charge, to any person obtaining",
)


def test_licence_scan(documents):
    rows = license_scan.scanned(documents(*SCANNED)).collect()
    for row in rows:
        want = {
            name: dice
            for name, template in license_scan.TEMPLATES
            if (dice := brute_dice(SCANNED[row["doc_id"]] or "", template)) >= license_scan.THRESHOLD
        }
        assert {m["name"]: m["dice"] for m in row["matches"]} == pytest.approx(want)


def test_notices_are_found_wherever_they_stand(documents):
    rows = license_scan.scanned(documents(*SCANNED)).orderBy("doc_id").collect()
    names = [{m["name"] for m in row["matches"]} for row in rows]
    assert [n for n, found in enumerate(names) if not found] == [1, 4, 5, 6, 10, 16]
    for number, name in (
        (0, "MIT"), (2, "MIT-text"), (7, "MIT"), (8, "CC-BY-NC-4.0"), (9, "MIT-text"),
        (11, "MIT-text"), (12, "Apache-2.0-header"), (13, "Apache-2.0"), (14, "GPL-2.0-header"),
        (15, "BSD-3-Clause-text"),
    ):
        assert name in names[number]


def test_each_template_is_found_in_itself(documents):
    rows = license_scan.scanned(documents(*KNOWN.values())).orderBy("doc_id").collect()
    for name, row in zip(KNOWN, rows):
        assert {m["name"]: m["dice"] for m in row["matches"]}[name] == 1


def test_enough_anchors_for_any_stretch_of_the_similarity():
    for name, text in license_scan.TEMPLATES:
        one = license_scan.template(name, text, 0.8)
        least = license_scan.size_bounds(len(one.bigrams), 0.8)[0]
        assert len(one.bigrams) - len(one.anchors) < least
        assert all(one.anchors[n] in one.bigrams for n in range(len(one.anchors)))


def test_licence_scan_of_a_messy_table_equals_its_sql(messy, documents):
    import duckdb

    given = messy.select("doc_id", "text").union(documents(*SCANNED).select("doc_id", "text"))
    for rows in (given, messy, messy.limit(0)):
        found = license_scan.summary(license_scan.scanned(rows))
        connection = duckdb.connect()
        connection.register("given", rows.select("doc_id", "text").toArrow())
        connection.execute("CREATE TABLE documents AS SELECT * FROM given")
        sql = connection.sql(license_scan.oracle())
        assert compare(found.collect(), found.columns, sql) is None
