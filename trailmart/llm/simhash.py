"""Near duplicates by SimHash, linked through a binary trie joined with itself.

Fingerprints are made per document and kept in a narrow stored table. Only distinct ones go
on. Of four 16-bit blocks, two fingerprints at two or fewer differing bits agree in at least
two blocks, so the trie is built in six bit orders, each led by another pair of blocks where
no bit may differ. Spark deals each order's tries out by their leading 32 bits; a task walks
all its tries at once, level by level: a frontier of node pairs, each with the bits that
differ so far, is replaced by the pairs of their children, and a pair beyond the error
budget is dropped with everything under it. Distinct values have few others within two bits
(at most n log(n)^2 / 4 pairs), and a task returns a spanning forest of its links only.
Stars of links are then joined over all tasks, in rounds written to the shared folder.

Null texts are empty; texts without words have fingerprint zero and link like any other.
Repeated rows keep their row each. A class of which no document has an id has a null id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from trailmart.llm.common import ready, stored

SHINGLE_WORDS, HASH_SEED, MAX_DIFFERING = 3, 42, 2
#: Shingles counted at once, and node pairs of a frontier that are walked together.
COUNTED, FRONTIER = 65_536, 1_000_000
#: Pairs of the four blocks that lead a bit order.
ORDERS = [(a, b) for a in range(4) for b in range(a + 1, 4)]
BLOCK_BITS, REST_BITS = 16, 32


def fingerprint(text: str | None) -> int:
    """The SimHash of a text's word shingles, repeats included, as an unsigned integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, size = ends - lengths, min(SHINGLE_WORDS, len(words))
    total, ones = len(words) - size + 1, np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, COUNTED):
        upto = min(at + COUNTED, total)
        cuts = zip(starts[at:upto].tolist(), ends[at + size - 1 : upto + size - 1].tolist())
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in cuts], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    values = np.array([fingerprint(text) for text in texts], dtype=np.uint64)
    return pd.Series(values.view(np.int64))


def with_fingerprints(df: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, fp): fp holds the 64 bits as a signed long."""
    ready(df.sparkSession)
    return df.select(*keys, _fingerprints("text").alias("fp"))


def reordered(values: np.ndarray, order: int) -> np.ndarray:
    """Fingerprints with the blocks of an order in front."""
    lead = ORDERS[order]
    blocks = [*lead, *(b for b in range(4) if b not in lead)]
    mask, out = np.uint64(0xFFFF), np.zeros_like(values)
    for block in blocks:
        shifted = values >> np.uint64(BLOCK_BITS * (3 - block))
        out = (out << np.uint64(BLOCK_BITS)) | (shifted & mask)
    return out


class Forest:
    """Classes of numbers that were linked, each pointing at its smallest member."""

    def __init__(self, size: int) -> None:
        self.root = np.arange(size)

    def link(self, one: np.ndarray, other: np.ndarray) -> None:
        while True:
            a, b = self.root[one], self.root[other]
            apart = a != b
            if not apart.any():
                return
            one, other, a, b = one[apart], other[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(above := self.root[self.root], self.root):
                self.root = above


def join_tries(values: np.ndarray, forest: Forest, budget: int = MAX_DIFFERING) -> None:
    """Link all pairs of sorted distinct values that share their leading 32 bits and differ
    in at most ``budget`` of the rest."""
    lead = values >> np.uint64(REST_BITS)
    opens = np.flatnonzero(np.diff(lead, prepend=lead[:1] + np.uint64(1)))
    closes = np.append(opens[1:], len(values))
    several = closes - opens > 1
    lo, hi = opens[several], closes[several]
    waiting = [(REST_BITS - 1, (lo, hi, lo, hi, np.zeros(len(lo), dtype=np.int8)))]
    while waiting:
        bit, frontier = waiting.pop()
        if len(frontier[0]) > FRONTIER:
            half = len(frontier[0]) // 2
            waiting.append((bit, tuple(part[half:] for part in frontier)))
            waiting.append((bit, tuple(part[:half] for part in frontier)))
            continue
        frontier = _finish_leaves(values, frontier, forest, budget)
        if len(frontier[0]):
            waiting.append((bit - 1, _children(values, frontier, bit, budget)))


def _finish_leaves(values, frontier, forest, budget):
    """Compare the pairs of single values at once; the other node pairs."""
    a_lo, a_hi, b_lo, b_hi, _ = frontier
    leaves = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
    one, other = a_lo[leaves], b_lo[leaves]
    near = np.bitwise_count(values[one] ^ values[other]) <= budget
    forest.link(one[near], other[near])
    return tuple(part[~leaves] for part in frontier)


def _children(values, frontier, bit, budget):
    """The pairs of children of each node pair, without those beyond the budget."""
    a_lo, a_hi, b_lo, b_hi, differing = frontier
    a_mid, b_mid = (_split(values, lo, hi, bit) for lo, hi in ((a_lo, a_hi), (b_lo, b_hi)))
    itself = a_lo == b_lo
    pairs = (
        (a_lo, a_mid, b_lo, b_mid, differing, None),
        (a_mid, a_hi, b_mid, b_hi, differing, None),
        (a_lo, a_mid, b_mid, b_hi, differing + 1, None),
        (a_mid, a_hi, b_lo, b_mid, differing + 1, ~itself),
    )
    made = []
    for al, ah, bl, bh, d, allowed in pairs:
        keep = (al < ah) & (bl < bh) & (d <= budget)
        keep &= ~((al == bl) & (ah - al == 1))
        if allowed is not None:
            keep &= allowed
        made.append([part[keep] for part in (al, ah, bl, bh, d)])
    return tuple(np.concatenate(parts) for parts in zip(*made))


def _split(values, lo, hi, bit):
    """Where, in sorted values that agree above a bit, those with the bit set begin."""
    above = values[lo] >> np.uint64(bit + 1) << np.uint64(bit + 1)
    return np.clip(np.searchsorted(values, above | np.uint64(1 << bit)), lo, hi)


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) signed fingerprints, a > b, whose classes are those of all links."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        order = np.concatenate([np.zeros(0, np.int8), *(t["trie"].to_numpy() for t in tables)])
        signed = np.concatenate([np.zeros(0, np.int64), *(t["fp"].to_numpy() for t in tables)])
        values = np.unique(signed.view(np.uint64))
        forest = Forest(len(values))
        for number in np.unique(order):
            own = np.unique(signed[order == number].view(np.uint64))
            turned = reordered(own, int(number))
            ranked = np.argsort(turned)
            part = Forest(len(own))
            join_tries(turned[ranked], part)
            moved = np.flatnonzero(part.root != np.arange(len(own)))
            at = np.searchsorted(values, own[ranked])
            forest.link(at[moved], at[part.root[moved]])
        moved = np.flatnonzero(forest.root != np.arange(len(values)))
        one, other = (values[n].view(np.int64) for n in (moved, forest.root[moved]))
        yield pa.RecordBatch.from_pydict(
            {"a": np.maximum(one, other), "b": np.minimum(one, other)}
        )

    block = "shiftrightunsigned(fp, {}) & 65535"
    leads = [
        f"struct({n}Y AS trie, ({block.format(48 - 16 * a)}) * 65536"
        f" + ({block.format(48 - 16 * b)}) AS lead)"
        for n, (a, b) in enumerate(ORDERS)
    ]
    dealt = distinct.selectExpr("fp", f"inline(array({', '.join(leads)}))")
    dealt = dealt.repartition("trie", "lead").select("trie", "fp")
    return dealt.mapInArrow(walk, "a bigint, b bigint")


def stars(edges: DataFrame) -> DataFrame:
    """(a, b): each vertex of the links with the smallest of its class, b < a.

    Large and small star steps in turn, each round written to the shared folder, until a
    round changes nothing.
    """
    edges, before = stored(edges.distinct(), "links"), None
    while (now := _checksum(edges)) != before:
        before = now
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), "m")
        large = large.distinct().toDF("a", "b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b > m").select("b", "m")
        edges = stored(small.union(least.select("a", "m")).distinct().toDF("a", "b"), "stars")
    return edges


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).head())


def classes(
    marked: DataFrame, linked_by: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(fp, root, component_id) for each distinct fingerprint of (doc_id, fp) rows.

    ``root`` names a class by a fingerprint, ``component_id`` by its smallest document id.
    ``linked_by`` makes other links than those of SimHash from the rows.
    """
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    edges = linked_by(marked) if linked_by else links(distinct.select("fp"))
    linked = stars(edges).toDF("fp", "root")
    rooted = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of each document."""
    marked = stored(with_fingerprints(documents, ["doc_id"]), "fingerprints")
    return marked.join(classes(marked), "fp").select("doc_id", "fp", "component_id")


def fingerprint_text(fp: str) -> Column:
    """The 64 bits as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def one_of_each(
    documents: DataFrame,
    marked_by: Callable[[DataFrame, list[str]], DataFrame] = with_fingerprints,
    linked_by: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The documents with one row kept of each class of near duplicates.

    The row of the smallest id (a null id comes last), then of the smallest hash of its
    text, then of all its columns; of rows that are equal in every column, one.
    """
    taken, name = set(documents.columns), []
    for part in ("row_id", "row_text", "row_all"):
        while part in taken:
            part = f"_{part}"
        name.append(part)
        taken.add(part)
    named = documents.withColumns(
        {
            name[0]: F.xxhash64("doc_id"),
            name[1]: F.xxhash64(F.coalesce("text", F.lit(""))),
            name[2]: F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in documents.columns]),
        }
    )
    marked = stored(marked_by(named, ["doc_id", *name]), "fingerprints")
    rooted = classes(marked, linked_by).select("fp", "root")
    grouped = marked.select("doc_id", *name, "fp").join(rooted, "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *name))
    kept = grouped.groupBy("root").agg(first.alias("first"))
    kept = kept.select(*[F.col(f"first.{part}").alias(part) for part in name])
    return named.dropDuplicates(name).join(kept, name, "left_semi").drop(*name)
