"""Hard negatives by residue arithmetic, against brute force in Python's integers."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle_check import check
from trailmart.llm import hard_negatives, queries

SCHEMA = "vec_id bigint, label int, q array<bigint>"


def brute(rows, counts=(5, 10), window=(30, 90), step=4):
    rows = [r for r in rows if None not in r and None not in r[2]]

    def score(one, other):
        return sum(x * y for x, y in zip(one, other))

    found = []
    for anchor, label, q in rows:
        if anchor % step:
            continue
        same = [(-score(q, v), n) for n, other, v in rows if other == label and n != anchor]
        for worth, positive in sorted(same)[: counts[0]]:
            apart = sorted(
                (-score(q, v), n)
                for n, other, v in rows
                if other != label
                and window[0] * -worth <= 100 * score(q, v) <= window[1] * -worth
            )
            for rank, (far, negative) in enumerate(apart[: counts[1]], 1):
                found.append((anchor, positive, rank, negative, -worth, -far))
    return sorted(found)


def vectors(seed, count, width, most, labels=3):
    chance = random.Random(seed)
    return [
        (n, chance.randrange(labels), [chance.randint(-most, most) for _ in range(width)])
        for n in range(count)
    ]


def mined(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = hard_negatives.mined(df, F.col("vec_id") % 4 == 0, **options)
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize(
    "count, width, most, labels", [(120, 8, 200, 3), (90, 3, 2, 2), (60, 5, 300_000_000, 2), (8, 4, 9, 9)]
)
def test_equals_brute_force(spark, count, width, most, labels):
    rows = vectors(count, count, width, most, labels)
    assert mined(spark, rows) == brute(rows)


def test_blocks_of_anchors_and_slices_of_scores(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "SCORED", 64)
    rows = vectors(1, 150, 6, 40)
    assert mined(spark, rows, counts=(2, 4), window=(-50, 120)) == brute(rows, (2, 4), (-50, 120))


def test_ties_go_to_the_smaller_id(spark):
    rows = [(n, n % 2, [1 + (n % 2 == 0), 1]) for n in range(80)]
    assert mined(spark, rows) == brute(rows)
    rows = [(n, n % 2, [0, 0]) for n in range(40)]
    assert mined(spark, rows) == brute(rows)


@pytest.mark.parametrize("width, most", [(3, 5), (64, 256), (2_500, 255), (7, 100_000_000)])
def test_products_are_exact(width, most):
    chance = np.random.default_rng(width)
    one, other = (chance.integers(-most, most + 1, size=(n, width)) for n in (9, 13))
    one[0], other[0], other[1] = most, most, -most
    primes = hard_negatives.primes_for(width * most * most)
    given = [[hard_negatives.residues(m, prime) for prime in primes] for m in (one, other)]
    exact = [[sum(map(int.__mul__, a.tolist(), b.tolist())) for b in other] for a in one]
    assert hard_negatives.products(*given, primes).tolist() == exact


def test_primes_are_as_many_as_needed():
    assert hard_negatives.primes_for(100) == [251]
    assert hard_negatives.primes_for(65_536) == [251, 241, 239]
    with pytest.raises(ValueError):
        hard_negatives.primes_for(1 << 62)


def test_messy_rows(spark):
    rows = vectors(3, 40, 4, 50, 2)
    rows += [rows[8], rows[9], (None, 1, [1, 2, 3, 4]), (100, None, [1, 2, 3, 4]), (101, 1, None)]
    rows += [(104, 1, []), (105, 0, [7, 8])]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows[:0] + [(1, 1, [1])]) == []
    assert mined(spark, [(0, 1, [5]), (1, 1, [4])]) == []
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mined(empty, F.col("vec_id") % 4 == 0).collect() == []


def test_incomplete_vectors_take_no_part(spark):
    odd = [[1.0, None], [1.0, float("nan")], [float("inf")], [-float("inf"), 0.0], None]
    rows = [(n, v) for n, v in enumerate([*odd, [0.5, -0.001], []])]
    df = spark.createDataFrame(rows, "n int, v array<float>").filter(hard_negatives.complete("v"))
    found = df.select("n", hard_negatives.integers("v", 256).alias("q")).orderBy("n").collect()
    assert [tuple(r) for r in found] == [(5, [128, -1]), (6, [])]


def test_query(spark, tmp_path):
    assert check(spark, "/root/testdata/sf0.01", ["op13_hard_negatives"]) == {"op13_hard_negatives": None}
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    given.limit(0).selectExpr("*", "1 AS q", "2 AS rank").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op13_hard_negatives(spark, str(tmp_path)).collect() == []
