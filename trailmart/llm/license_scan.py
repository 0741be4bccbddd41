"""Licence scans: Dice similarity of word bigrams with licence templates.

A document is normalised to lower-case ASCII words over all its lines. With a template of m
distinct bigrams, a stretch of n reaches a similarity t only if m t / (2 - t) <= n <=
m (2 - t) / t, and then it has at least m t / (2 - t) bigrams in common. So it has one of any
m - m t / (2 - t) + 1 of the template's, of which the longest, hence rarest, are the anchors:
wherever an anchor occurs, the stretch of the template's length that lies around it as around
the anchor in the template is compared. A document without any anchor, which most are, is done
after one intersection; stretches cut short by the text's end below the bounds are left out.
The similarity of a document with a template is the highest of these stretches.

All is one projection over the table, without a shuffle, by DataFrame functions only. Null and
empty texts hold no licence. Repeated rows are scanned each.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Licence names and the notices they are known by.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-header",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0-text",
        "Grant of Copyright License. Subject to the terms and conditions of this License, each "
        "Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, "
        "royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such "
        "Derivative Works in Source or Object form.",
    ),
    (
        "AGPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU Affero General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    (
        "BSD-2-Clause-text",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: 1. Redistributions of source "
        "code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause-text",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. 3. Neither the name of the copyright holder nor the "
        "names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license (the "
        '"Software") to use, reproduce, display, distribute, execute, and transmit the Software, '
        "and to prepare derivative works of the Software, and to permit third-parties to whom "
        "the Software is furnished to do so, all subject to the following:",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the person who associated CC0 with this work has "
        "waived all copyright and related or neighboring rights to this work.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    (
        "GPL-3.0-header",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-header",
        "This program is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-text",
        "The licenses for most software are designed to take away your freedom to share and "
        "change it. By contrast, the GNU General Public License is intended to guarantee your "
        "freedom to share and change free software--to make sure the software is free for all "
        "its users.",
    ),
    (
        "GPL-3.0-text",
        "The GNU General Public License is a free, copyleft license for software and other "
        "kinds of works. The licenses for most software and other practical works are designed "
        "to take away your freedom to share and change the works.",
    ),
    (
        "LGPL-2.1-header",
        "This library is free software; you can redistribute it and/or modify it under the "
        "terms of the GNU Lesser General Public License as published by the Free Software "
        "Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0-text",
        "This version of the GNU Lesser General Public License incorporates the terms and "
        "conditions of version 3 of the GNU General Public License, supplemented by the "
        "additional permissions listed below.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "MPL-2.0-header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    (
        "MPL-2.0-text",
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license: "
        "under intellectual property rights (other than patent or trademark) Licensable by such "
        "Contributor to use, reproduce, make available, modify, display, perform, distribute, "
        "and otherwise exploit its Contributions, either on an unmodified basis, with "
        "Modifications, or as part of a Larger Work;",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense-text",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no "
        "event will the authors be held liable for any damages arising from the use of this "
        "software.",
    ),
)


class Template(NamedTuple):
    """A template's length in words, its distinct bigrams, and its anchors with their offsets."""

    name: str
    words: int
    bigrams: list[str]
    anchors: list[str]
    offsets: list[int]


def template(name: str, text: str, threshold: float) -> Template:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
    bigrams = list(dict.fromkeys(pairs))
    spared = len(bigrams) - math.ceil(size_bounds(len(bigrams), threshold)[0])
    anchors = sorted(bigrams, key=lambda bigram: (-len(bigram), bigram))[: spared + 1]
    return Template(name, len(words), bigrams, anchors, [pairs.index(b) for b in anchors])


def size_bounds(size: int, threshold: float) -> tuple[float, float]:
    return size * threshold / (2 - threshold), size * (2 - threshold) / threshold


def scanned(
    documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, matches): an array of (name, dice) of the templates that a document reaches."""
    known = [template(name, text, threshold) for name, text in templates]
    anchors = list(dict.fromkeys(anchor for one in known for anchor in one.anchors))
    plain = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = documents.select("doc_id", F.regexp_replace(plain, "[^a-z0-9]+", " ").alias("text"))
    rows = rows.select("doc_id", F.split(F.trim("text"), " ").alias("words"))
    rows = rows.select("doc_id", "words", _bigrams(F.col("words")).alias("bigrams"))
    met = F.array_intersect("bigrams", F.array(*map(F.lit, anchors)))
    rows = rows.select("doc_id", "words", "bigrams", met.alias("met"))
    placed = F.transform("bigrams", lambda b, i: F.struct(i.alias("at"), b.alias("bigram")))
    hits = F.filter(placed, lambda hit: F.array_contains(F.col("met"), hit["bigram"]))
    hits = F.when(F.size("met") > 0, hits)
    rows = rows.select("doc_id", "words", hits.alias("hits"))
    best = [
        F.struct(F.lit(one.name).alias("name"), _best(one, threshold).alias("dice")) for one in known
    ]
    reached = F.filter(F.array(*best), lambda match: match["dice"] >= threshold)
    kind = "array<struct<name:string,dice:double>>"
    found = F.when(F.col("hits").isNotNull(), reached).otherwise(F.array().cast(kind))
    return rows.select("doc_id", found.alias("matches"))


def _bigrams(words: Column) -> Column:
    count = F.greatest(F.size(words) - 1, F.lit(0))
    firsts, seconds = F.slice(words, 1, count), F.slice(words, 2, count)
    return F.zip_with(firsts, seconds, lambda a, b: F.concat(a, F.lit(" "), b))


def _best(one: Template, threshold: float) -> Column:
    """The highest similarity of a template with a stretch around one of its anchors, else 0."""
    low, _ = size_bounds(len(one.bigrams), threshold)
    anchors, offsets = F.array(*map(F.lit, one.anchors)), F.array(*map(F.lit, one.offsets))
    wanted = F.array(*map(F.lit, one.bigrams))
    own = F.filter("hits", lambda hit: F.array_contains(anchors, hit["bigram"]))
    starts = F.transform(
        own,
        lambda hit: F.greatest(
            hit["at"] - F.element_at(offsets, F.array_position(anchors, hit["bigram"]).cast("int")),
            F.lit(0),
        ),
    )
    long_enough = F.filter(
        F.array_distinct(starts),
        lambda start: F.least(F.size("words") - start, F.lit(one.words)) - 1 >= low,
    )
    stretches = F.transform(
        long_enough,
        lambda start: F.array_distinct(_bigrams(F.slice("words", start + 1, one.words))),
    )
    dice = F.transform(
        stretches,
        lambda u: 2.0 * F.size(F.array_intersect(u, wanted)) / (F.size(u) + F.lit(len(one.bigrams))),
    )
    return F.coalesce(F.array_max(dice), F.lit(0.0))


def summary(matches: DataFrame) -> DataFrame:
    """(doc_id, licenses, best_dice): names joined by commas, and the best similarity."""
    return matches.select(
        "doc_id",
        F.array_join(F.col("matches.name"), ",").alias("licenses"),
        F.coalesce(F.array_max("matches.dice"), F.lit(0.0)).alias("best_dice"),
    )


def oracle(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The summary as one DuckDB statement over ``documents``."""
    known = [template(name, text, threshold) for name, text in templates]
    anchors = ", ".join(
        f"({n}, '{anchor}', {offset})"
        for n, one in enumerate(known)
        for anchor, offset in zip(one.anchors, one.offsets)
    )
    bigrams = ", ".join(f"({n}, '{b}')" for n, one in enumerate(known) for b in one.bigrams)
    sizes = ", ".join(
        f"({n}, '{one.name}', {one.words}, {len(one.bigrams)},"
        f" {size_bounds(len(one.bigrams), threshold)[0]!r}::DOUBLE)"
        for n, one in enumerate(known)
    )
    return f"""
    WITH anchors(t, bigram, place) AS (VALUES {anchors}
    ), wanted(t, bigram) AS (VALUES {bigrams}
    ), sizes(t, name, m, size, low) AS (VALUES {sizes}
    ), cut AS (
        SELECT row_number() OVER () AS r, doc_id, string_split(trim(regexp_replace(translate(
            coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS words
        FROM documents
    ), spelled AS (
        SELECT r, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM cut
    ), paired AS (
        SELECT r, n, i, word || ' ' || lead(word) OVER (PARTITION BY r ORDER BY i) AS bigram
        FROM spelled
    ), starts AS (
        SELECT DISTINCT r, n, t, greatest(i - place, 1) AS first FROM paired JOIN anchors USING (bigram)
    ), bounded AS (
        SELECT r, t, first, least(first + m - 1, n) AS last FROM starts JOIN sizes USING (t)
        WHERE least(n - first + 1, m) - 1 >= low
    ), inside AS (
        SELECT DISTINCT bounded.r, t, first, bigram
        FROM bounded JOIN paired ON paired.r = bounded.r AND i >= first AND i < last
    ), compared AS (
        SELECT r, inside.t, first, 2.0::DOUBLE * count(wanted.bigram) / (count(*) + any_value(size))
            AS dice
        FROM inside JOIN sizes ON sizes.t = inside.t
        LEFT JOIN wanted ON wanted.t = inside.t AND wanted.bigram = inside.bigram
        GROUP BY r, inside.t, first
    ), best AS (
        SELECT r, t, max(dice) AS dice FROM compared GROUP BY r, t HAVING max(dice) >= {threshold}
    ), named AS (
        SELECT r, string_agg(name, ',' ORDER BY t) AS licenses, max(dice) AS best_dice
        FROM best JOIN sizes USING (t) GROUP BY r
    )
    SELECT doc_id, coalesce(licenses, '') AS licenses, coalesce(best_dice, 0.0)::DOUBLE AS best_dice
    FROM cut LEFT JOIN named USING (r)
    """
