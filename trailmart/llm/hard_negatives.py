"""Hard negatives by exact integer scores from a residue number system.

Scores are inner products of integer vectors. The components are reduced modulo several small
primes; for each prime one float32 matrix product multiplies a block of anchors with a batch of
rows, exactly, as residues are at most half a prime and sums stay below 2^24. Chinese
remaindering puts the residues of a score together again. The primes are as many as the longest
vector needs, so no score can be ambiguous; scores beyond 62 bits raise a ``ValueError``.

All rows are read for each block of anchors, which is sent to the tasks and bounded in values.
A task keeps the best few of each anchor over all its batches, and a window ranks what the
tasks kept: first the positives, rows of the anchor's label; then, for each positive, the rows
of other labels whose scores lie within the given percentages of the positive's.

Higher scores come first, ties by the smaller id. Repeated rows count each; no row is a positive
of an anchor of the same id. Rows without an id, label or vector, or with a null or non-finite
component, take no part. Shorter vectors end in zeros, and empty ones score zero with all.
Anchors without positives have no rows, nor have positives without negatives.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmart.llm.common import ready, stored
from trailmart.session import fresh_path

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Residues of 125 and sums of 1,024 products of them stay exact in float32.
LARGEST_PRIME, SUMMED = 251, 1_024
#: Values in a block of anchors, anchors in it, and scores made at once.
BLOCK_VALUES, BLOCK_ANCHORS, SCORED = 1 << 20, 4_096, 1 << 21
MOST_BITS = 62
NONE = np.iinfo(np.int64).min


def primes_for(largest: int) -> list[int]:
    """Primes whose product exceeds twice the largest absolute score."""
    if 2 * largest + 1 >= 1 << MOST_BITS:
        raise ValueError(f"Scores of up to {largest} do not fit {MOST_BITS} bits")
    chosen, product, number = [], 1, LARGEST_PRIME
    while product <= 2 * largest:
        if all(number % divisor for divisor in range(2, int(number**0.5) + 1)):
            chosen.append(number)
            product *= number
        number -= 1
    return chosen


def residues(values: np.ndarray, prime: int) -> np.ndarray:
    """The components between minus and plus half the prime, as float32."""
    reduced = values % prime
    return np.where(reduced > prime // 2, reduced - prime, reduced).astype(np.float32)


def products(one: list[np.ndarray], other: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed inner products of all rows of ``one`` with all of ``other``, both given as
    their residues for each prime."""
    total, modulus = np.zeros((len(one[0]), len(other[0])), dtype=np.int64), 1
    for a, b, prime in zip(one, other, primes):
        part = np.zeros(total.shape, dtype=np.int32)
        for at in range(0, a.shape[1], SUMMED):
            part += (a[:, at : at + SUMMED] @ b[:, at : at + SUMMED].T).astype(np.int32) % prime
        digit = (part - total % prime) * pow(modulus, -1, prime) % prime
        total += modulus * digit
        modulus *= prime
    return np.where(total > modulus // 2, total - modulus, total)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of ``width`` integers, shorter ones ending in zeros."""
    held = np.zeros((len(lists), width), dtype=np.int64)
    lengths = np.diff(lists.offsets.to_numpy())
    held[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return held


class Best:
    """The first ``count`` of each group by score, descending, then id."""

    def __init__(self, groups: int, count: int) -> None:
        self.count, self.worst = count, np.full(groups, NONE)
        self.group, self.score, self.id = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def offer(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """A row of scores for each of ``groups``, a column for each id; ``NONE`` is no offer."""
        if scores.shape[1] > self.count:
            least = np.partition(scores, -self.count, axis=1)[:, -self.count]
        else:
            least = np.full(len(scores), NONE)
        least = np.maximum(least, self.worst[groups])
        row, column = np.nonzero((scores >= least[:, None]) & (scores != NONE))
        if not len(row):
            return
        group = np.concatenate([self.group, groups[row]])
        score = np.concatenate([self.score, scores[row, column]])
        number = np.concatenate([self.id, ids[column]])
        order = np.lexsort((number, -score, group))
        group, score, number = group[order], score[order], number[order]
        opens = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.arange(len(group)) - np.repeat(opens, np.diff(np.append(opens, len(group))))
        kept = place < self.count
        self.group, self.score, self.id = group[kept], score[kept], number[kept]
        last = place[kept] == self.count - 1
        self.worst[self.group[last]] = self.score[last]


def _batches(batches, width, primes):
    """(ids, labels, residues) of the rows of each batch."""
    for batch in batches:
        values = matrix(batch["q"], width)
        own = [residues(values, prime) for prime in primes]
        yield batch["vec_id"].to_numpy(), batch["label"].to_numpy(), own


def _slices(count: int, other: int):
    step = max(1, SCORED // max(1, other))
    return [slice(at, min(at + step, count)) for at in range(0, count, step)]


def _ranked(found: DataFrame, group: list[str], number: str, count: int) -> DataFrame:
    best = Window.partitionBy(*group).orderBy(F.desc("score"), number)
    ranked = found.withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= count)


def positives(
    rows: DataFrame, block: Broadcast, width: int, primes: list[int], count: int
) -> DataFrame:
    """(anchor, vec_id, score, rank): the first rows of each anchor's label but its own id.

    ``anchor`` is the anchor's place in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        best = Best(len(anchors["ids"]), count)
        own = [residues(anchors["q"], prime) for prime in primes]
        for ids, labels, parts in _batches(batches, width, primes):
            for label in np.intersect1d(labels, anchors["labels"]):
                held = np.flatnonzero(anchors["labels"] == label)
                met = np.flatnonzero(labels == label)
                for part in _slices(len(held), len(met)):
                    at = held[part]
                    scores = products([a[at] for a in own], [b[met] for b in parts], primes)
                    scores[anchors["ids"][at][:, None] == ids[met]] = NONE
                    best.offer(at, scores, ids[met])
        yield pa.RecordBatch.from_pydict(
            {"anchor": best.group, "vec_id": best.id, "score": best.score}
        )

    found = rows.mapInArrow(run, "anchor bigint, vec_id bigint, score bigint")
    return _ranked(found, ["anchor"], "vec_id", count)


def negatives(
    rows: DataFrame, block: Broadcast, width: int, primes: list[int], count: int
) -> DataFrame:
    """(pair, vec_id, score, rank): the first rows of another label than the anchor's within
    the window of each pair of the block.

    A pair is an anchor's place in the block and the least and the most score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        place, slots = anchors["anchor"], anchors["slot"]
        least, most = anchors["least"], anchors["most"]
        best = Best(len(place), count)
        own = [residues(anchors["q"], prime) for prime in primes]
        for ids, labels, parts in _batches(batches, width, primes):
            for part in _slices(len(anchors["ids"]), len(ids)):
                scores = products([a[part] for a in own], parts, primes)
                other = anchors["labels"][part][:, None] != labels
                for slot in range(slots.max(initial=-1) + 1):
                    pairs = np.flatnonzero(
                        (slots == slot) & (place >= part.start) & (place < part.stop)
                    )
                    mine = place[pairs] - part.start
                    met = scores[mine]
                    fits = (met >= least[pairs][:, None]) & (met <= most[pairs][:, None])
                    best.offer(pairs, np.where(fits & other[mine], met, NONE), ids)
        yield pa.RecordBatch.from_pydict(
            {"pair": best.group, "vec_id": best.id, "score": best.score}
        )

    found = rows.mapInArrow(run, "pair bigint, vec_id bigint, score bigint")
    return _ranked(found, ["pair"], "vec_id", count)


def integers(vector: str, factor: int) -> Column:
    """floor(factor * x) of each component x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def complete(vector: str) -> Column:
    """Whether there is a vector, and all its components are finite numbers."""
    infinite = F.lit(float("inf"))
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == infinite)
    )
    return F.col(vector).isNotNull() & ~odd


def _whole(values: Iterable[int]) -> np.ndarray:
    """Python's integers within the 64 bits that scores have."""
    most = np.iinfo(np.int64).max
    return np.array([max(-most, min(value, most)) for value in values], dtype=np.int64)


def _mined_block(rows, anchors, width, primes, counts, window):
    """One block's result as a DataFrame that needs no further broadcast, stored."""
    spark, context = rows.sparkSession, rows.sparkSession.sparkContext
    held = anchors.toArrow().combine_chunks()
    ids, labels = held["vec_id"].to_numpy(), held["label"].to_numpy()
    q = matrix(held["q"].combine_chunks(), width)
    block = context.broadcast({"ids": ids, "labels": labels, "q": q})
    near = positives(rows, block, width, primes, counts[0])
    near = near.orderBy("anchor", "rank").toArrow()
    scores = near["score"].to_pylist()
    pairs = {
        "anchor": near["anchor"].to_numpy(),
        "slot": near["rank"].to_numpy().astype(np.int64) - 1,
        "least": _whole(-(-window[0] * score // 100) for score in scores),
        "most": _whole(window[1] * score // 100 for score in scores),
    }
    sent = context.broadcast({"ids": ids, "labels": labels, "q": q, **pairs})
    of_pair = spark.createDataFrame(
        pa.table(
            {
                "pair": np.arange(len(near)),
                "anchor_id": ids[pairs["anchor"]],
                "positive_id": near["vec_id"].to_numpy(),
                "positive_score": near["score"].to_numpy(),
            }
        )
    )
    far = negatives(rows, sent, width, primes, counts[1])
    found = far.join(of_pair, "pair").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    return found, [block, sent]


def mined(
    vectors: DataFrame,
    is_anchor: Column,
    counts: tuple[int, int] = (POSITIVES, NEGATIVES),
    window: tuple[int, int] = (LOW, HIGH),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has (vec_id, label, q) with integer components; ``counts`` are the positives
    of an anchor and the negatives of a positive; a negative's score lies between the
    percentages ``window`` of its positive's.
    """
    ready(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), F.col("q").cast("array<bigint>")
    )
    rows = stored(rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL"), "vectors")
    squares = "aggregate(q, 0D, (sum, x) -> sum + CAST(x AS DOUBLE) * x)"
    found = rows.selectExpr(f"max({squares}) AS longest", "max(size(q)) AS width").head()
    width, longest = found["width"] or 0, found["longest"] or 0.0
    primes = primes_for(int(longest * 1.000001) + 1)
    anchors = stored(rows.filter(is_anchor), "anchors")
    size = max(1, min(BLOCK_ANCHORS, BLOCK_VALUES // max(1, width)))
    blocks = max(1, -(-anchors.count() // size))
    folder = fresh_path(rows.sparkSession, "hard_negatives")
    for number in range(blocks):
        own = anchors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number)
        result, sent = _mined_block(rows, own, width, primes, counts, window)
        result.write.parquet(f"{folder}/block={number}")
        for block in sent:
            block.unpersist()
    schema = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
        "positive_score bigint, negative_score bigint, block int"
    )
    return rows.sparkSession.read.schema(schema).parquet(folder).drop("block")


def oracle(anchor_step: int, factor: int, counts: tuple[int, int], window: tuple[int, int]) -> str:
    """The registered query as DuckDB SQL: scores of all pairs, then windows."""
    return f"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({factor} * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
           list_inner_product(a.q, r.q)::BIGINT AS score
    FROM vectors a, vectors r WHERE a.vec_id % {anchor_step} = 0
), positives AS (
    SELECT anchor_id, row_id AS positive_id, score AS positive_score
    FROM scores WHERE same AND row_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= {counts[0]}
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id
                          ORDER BY score DESC, row_id)::INTEGER AS rank,
       row_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
 AND 100 * score BETWEEN {window[0]} * positive_score AND {window[1]} * positive_score
QUALIFY rank <= {counts[1]}
"""
