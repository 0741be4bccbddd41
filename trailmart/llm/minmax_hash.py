"""Near duplicates by min-max hashing: sets of word shingles linked by Jaccard similarity.

Each permutation of the shingle hashes gives two values of a signature, the least and the
greatest hash of the set, so that a signature takes half the permutations that plain MinHash
needs. Either value agrees between two sets with the probability of their similarity. A group
of permutations makes one band of the least and one of the greatest values; so many bands are
taken that a link is missed with a probability of at most ``MISSED``.

Equal sets are one vertex from the start. A bucket holds the vertices that agree in a band:

1. every vertex is compared with one centre, the least vertex of all its buckets, which joins
   groups of near copies at one comparison a vertex;
2. where a bucket holds many vertices beside its largest class, its vertices are dealt at random
   into cells of a bounded number of vertices and shingles and compared there, each vertex in
   one bucket a round, in rounds for as long as that halves the classes of such buckets;
3. of each bucket, all vertices that are still not of one class are compared, in cells again.
   Members of a bucket's largest class meet the others, never one another, and buckets of the
   same vertices are compared once.

All links are confirmed on the full sets, made again from the texts and held as 64-bit hashes.
No bucket is cut; a large one becomes more cells.

Null texts are empty; texts without words have an empty set and are linked with nothing. Texts
of fewer words than a shingle are one shingle. Repeated rows keep their row each. A class of
which no document has an id has a null id. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmart.llm.common import ready, stored, stored_side
from trailmart.llm.simhash import Forest, stars

#: The rule for near-duplicate stages on word shingles.
SHINGLE_WORDS, PERCENT = 5, 80
#: Signature values in a band, and the probability that all bands of a link differ.
BAND_VALUES, MISSED = 5, 1e-9
#: Shingles whose permutations are made at once.
PERMUTED = 1 << 15
#: Vertices and shingles of one side of a cell, and ids that a join broadcasts.
CELL_VERTICES, CELL_SHINGLES, BROADCAST_IDS = 512, 400_000, 1_000_000
SEED = 20_130


def shingles(text: str | None, size: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of ``size`` words."""
    words = (text or "").encode().lower().split()
    size = min(size, len(words))
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist() if words else []
    cuts = zip(starts, ends[max(size, 1) - 1 :].tolist())
    return np.unique(np.fromiter((digest(joined[a:b]) for a, b in cuts), np.uint64, len(starts)))


def band_pairs(percent: int) -> int:
    """Groups of permutations: each gives a band of least and a band of greatest values."""
    differs = math.log1p(-((percent / 100) ** BAND_VALUES))
    return math.ceil(math.log(MISSED) / differs / 2)


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and odd factors of ``count`` permutations of the 64-bit integers."""
    chance = np.random.default_rng(SEED)
    offsets, factors = chance.integers(0, 1 << 64, size=(2, count), dtype=np.uint64)
    return offsets, factors | np.uint64(1)


def signatures(sets: list[np.ndarray], count: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest): a row for each set, none of them empty, a column a permutation."""
    offsets, factors = permutations(count)
    least = np.empty((len(sets), count), dtype=np.uint64)
    greatest = np.empty_like(least)
    upto = np.cumsum([len(own) for own in sets], dtype=np.int64)
    cuts = np.flatnonzero(np.diff(upto // PERMUTED, prepend=0, append=-1)).tolist()
    for at, end in zip([0, *cuts], cuts):
        if at == end:
            continue
        values = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *(len(own) for own in sets[at : end - 1])], dtype=np.int64)
        for n in range(count):
            permuted = (values ^ offsets[n]) * factors[n]
            least[at:end, n] = np.minimum.reduceat(permuted, starts)
            greatest[at:end, n] = np.maximum.reduceat(permuted, starts)
    return least, greatest


def estimated(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """The similarity of two sets by their (least, greatest) rows: the share that agrees."""
    return float(np.mean([np.mean(a == b) for a, b in zip(one, other)]))


def band_keys(least: np.ndarray, greatest: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set and band, different between bands."""
    rows, count = least.shape
    keys = []
    for kind, values in enumerate((least, greatest)):
        grouped = values.reshape(rows, count // BAND_VALUES, BAND_VALUES)
        number = np.arange(grouped.shape[1], dtype=np.uint64) * np.uint64(2) + np.uint64(kind)
        key = np.broadcast_to(number, grouped.shape[:2]).copy()
        for n in range(BAND_VALUES):
            key = (key ^ grouped[:, :, n]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        keys.append(key)
    return np.concatenate(keys, axis=1).view(np.int64)


def with_bands(documents: DataFrame, size: int, percent: int) -> DataFrame:
    """(row, doc_id, text, n_shingles, fp, bands), stored: ``row`` numbers the rows, equal
    sets have equal ``fp``, and empty sets have no bands."""
    ready(documents.sparkSession)
    count = band_pairs(percent) * BAND_VALUES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, size) for text in batch["text"].to_pylist()]
            some = np.array([n for n, own in enumerate(sets) if len(own)], dtype=np.int64)
            keys = np.zeros((0, 0), dtype=np.int64)
            if len(some):
                keys = band_keys(*signatures([sets[n] for n in some], count))
            held = np.zeros(len(sets), dtype=np.int32)
            held[some] = keys.shape[1]
            bands = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *held], dtype=np.int32)), pa.array(keys.ravel())
            )
            fp = pa.array([xxhash.xxh3_128_digest(own.tobytes()) for own in sets], pa.binary())
            lengths = pa.array([len(own) for own in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lengths, fp, bands],
                names=[*batch.schema.names, "n_shingles", "fp", "bands"],
            )

    given = documents.select("doc_id", "text")
    kinds = ", ".join(f"{name} {kind}" for name, kind in given.dtypes)
    marked = given.mapInArrow(run, f"{kinds}, n_shingles bigint, fp binary, bands array<bigint>")
    return stored(marked.withColumn("row", F.monotonically_increasing_id()), "signatures")


def buckets(marked: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, node, n, centre) of each vertex and bucket of two vertices or more, stored."""
    nodes = stored_side(sets.select("node"), "nodes", BROADCAST_IDS)
    heads = marked.join(nodes, F.col("row") == F.col("node"), "left_semi")
    keys = heads.select(F.col("row").alias("node"), "n_shingles", F.explode("bands").alias("key"))
    keys = stored(keys, "bands")
    shared = keys.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("nodes"))
    shared = shared.filter("nodes > 1").select("key", "centre")
    shared = stored_side(shared, "shared", BROADCAST_IDS)
    return stored(keys.join(shared, "key"), "buckets")


def _alike(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    few, many = sorted((len(one), len(other)))
    if 100 * few < percent * many:
        return False
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * shared >= percent * (few + many - shared)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of vertices whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: dict[int, np.ndarray] = {}
            columns = [batch[name].to_pylist() for name in ("a", "b", "one", "other")]
            kept = []
            for a, b, one, other in zip(*columns):
                for vertex, text in ((a, one), (b, other)):
                    if vertex not in met:
                        met[vertex] = shingles(text, size)
                kept.append(_alike(met[a], met[b], percent))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    one = texts.select(F.col("row").alias("a"), F.col("text").alias("one"))
    other = texts.select(F.col("row").alias("b"), F.col("text").alias("other"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    return both.mapInArrow(run, "a bigint, b bigint")


def _blocks(nodes: str, weight: str) -> str:
    """SQL for the number of blocks that so many vertices and shingles are dealt into."""
    most = f"greatest(({nodes}) / {CELL_VERTICES}, ({weight}) / {CELL_SHINGLES})"
    return f"CAST(greatest(1, ceil({most})) AS INT)"


def by_bucket(members: DataFrame) -> DataFrame:
    """(key, main, main_nodes, main_weight, nodes, weight, classes) of (key, node, class,
    n_shingles) rows: a bucket's vertices, their shingles, and those of its largest class."""
    weight, count = F.sum("n_shingles").alias("weight"), F.count("*").alias("nodes")
    return members.groupBy("key", "class").agg(count, weight).groupBy("key").agg(
        F.max_by("class", "nodes").alias("main"),
        F.max("nodes").alias("main_nodes"),
        F.max_by("weight", "nodes").alias("main_weight"),
        F.sum("nodes").alias("nodes"),
        F.sum("weight").alias("weight"),
        F.count("*").alias("classes"),
    )


def mixed(members: DataFrame, crowded: DataFrame, turn: int) -> DataFrame:
    """(cell, node, class): the vertices of crowded buckets, each in one of its buckets and
    there in a random cell, another one every turn."""
    placed = members.join(crowded.select("key", "nodes", "weight"), "key")
    chosen = F.min_by("key", F.xxhash64("key", F.lit(turn))).alias("key")
    one = placed.groupBy("node").agg(chosen)
    return placed.join(one, ["node", "key"]).selectExpr(
        "key",
        "node",
        "class",
        "false AS with_main",
        f"pmod(xxhash64(node, {turn}), {_blocks('nodes', 'weight')}) AS x",
        "0L AS y",
    )


def cells(members: DataFrame) -> DataFrame:
    """(cell, node, class) so that any two vertices of a bucket that are of different classes
    meet in a cell, from (key, node, class, n_shingles).

    Both sides of a bucket, its largest class and the rest, are dealt into blocks by a hash.
    A cell holds a block of the largest class and one of the rest, or two of the rest.
    """
    own = by_bucket(members)
    same = members.groupBy("key").agg(
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("other"),
    )
    once = own.filter("classes > 1").join(same, "key")
    once = once.groupBy("nodes", "one", "other").agg(F.min("key").alias("key")).select("key")

    planned = own.join(once, "key", "left_semi").selectExpr(
        "key",
        "main",
        f"{_blocks('main_nodes', 'main_weight')} AS main_blocks",
        f"{_blocks('nodes - main_nodes', 'weight - main_weight')} AS rest_blocks",
    )
    met = members.join(planned, "key").withColumns(
        {
            "is_main": F.expr("class = main"),
            "place": F.expr("pmod(xxhash64(node), IF(class = main, main_blocks, rest_blocks))"),
        }
    )
    mixed = "transform(sequence(0, {} - 1), i -> struct(true AS with_main, {} AS x, {} AS y))"
    rest = (
        "transform(filter(sequence(0, rest_blocks - 1), i -> i <> place), i -> "
        "struct(false AS with_main, least(i, place) AS x, greatest(i, place) AS y))"
    )
    of_main = mixed.format("rest_blocks", "CAST(place AS BIGINT)", "CAST(i AS BIGINT)")
    of_rest = mixed.format("main_blocks", "CAST(i AS BIGINT)", "CAST(place AS BIGINT)")
    return met.selectExpr(
        "key", "node", "class", f"inline(IF(is_main, {of_main}, concat({of_rest}, {rest})))"
    )


def linked_in_cells(met: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b): links whose classes are those of all links between classes in a cell."""

    def run(group: pa.Table) -> pa.Table:
        nodes = group["node"].to_numpy()
        _, of_class = np.unique(group["class"].to_numpy(), return_inverse=True)
        sets = [shingles(text, size) for text in group["text"].to_pylist()]
        lengths = np.array([len(own) for own in sets], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        known, ids = np.unique(np.concatenate(sets), return_inverse=True)
        forest, held = Forest(len(sets)), np.zeros(len(known), dtype=np.int64)
        for n in range(len(sets)):
            mine = slice(starts[n], starts[n] + lengths[n])
            held[ids[mine]] = 1
            shared = np.add.reduceat(held[ids], starts)
            held[ids[mine]] = 0
            near = 100 * shared >= percent * (lengths + lengths[n] - shared)
            found = np.flatnonzero(near & (of_class != of_class[n]))
            forest.link(np.full(len(found), n), found)
        moved = np.flatnonzero(forest.root != np.arange(len(nodes)))
        return pa.table({"a": nodes[moved], "b": nodes[forest.root[moved]]})

    own = texts.select(F.col("row").alias("node"), "text")
    grouped = met.join(own, "node").groupBy("key", "with_main", "x", "y")
    return grouped.applyInArrow(run, "a bigint, b bigint")


def links(marked: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, class) of the vertices that are linked with others."""
    members = buckets(marked, sets)
    met = stored_side(members.select("node").distinct(), "compared", BROADCAST_IDS)
    texts = marked.select("row", "text").join(met, F.col("row") == F.col("node"), "left_semi")
    texts = stored(texts, "texts")
    near = members.filter("node <> centre").groupBy("node").agg(F.min("centre").alias("b"))
    near = near.select(F.col("node").alias("a"), "b")
    known = stars(confirmed(near, texts, size, percent))
    before, turn = None, 0
    while True:
        classed = _classed(members, known)
        crowded = stored(by_bucket(classed).filter(f"nodes - main_nodes > {CELL_VERTICES}"), "crowded")
        left = crowded.agg(F.sum(F.col("classes") - 1)).head()[0] or 0
        if left == 0 or (before is not None and 2 * left > before):
            break
        found = linked_in_cells(mixed(classed, crowded, turn), texts, size, percent)
        known, before, turn = stars(known.unionByName(found)), left, turn + 1
    rest = linked_in_cells(cells(classed), texts, size, percent)
    return stars(known.unionByName(rest)).toDF("node", "class")


def _classed(members: DataFrame, known: DataFrame) -> DataFrame:
    classes = members.join(known.toDF("node", "class"), "node", "left")
    own = F.coalesce("class", "node").alias("class")
    return stored(classes.select("key", "node", own, "n_shingles"), "classed")


def near_duplicates(
    documents: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each document.

    Documents are linked where 100 * intersection >= ``percent`` * union of their sets of
    ``size``-word shingles. A row is kept if its id is that of its class, nulls included.
    """
    marked = with_bands(documents, size, percent)
    some = marked.filter("n_shingles > 0").groupBy("fp")
    sets = some.agg(F.min("row").alias("node"), F.min("doc_id").alias("first_id"))
    sets = stored(sets, "sets")
    linked = links(marked, sets, size, percent)
    rooted = sets.join(linked, "node", "left").withColumn("class", F.coalesce("class", "node"))
    least = rooted.groupBy("class").agg(F.min("first_id").alias("component_id"))
    of_set = rooted.join(least, "class").select("fp", "component_id")
    shown = ["doc_id", "n_shingles", "component_id"]
    full = marked.filter("n_shingles > 0").join(of_set, "fp").select(shown)
    empty = marked.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    both = full.unionByName(empty.select(shown))
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def oracle(size: int, percent: int) -> str:
    """The same as DuckDB SQL, by counting the shared shingles of all pairs that share one."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT r, s FROM (
        SELECT r, unnest(list_transform(range(1, greatest(2, len(w) - {size - 2})),
            lambda i: array_to_string(w[i:i + {size - 1}], ' '))) AS s
        FROM texts WHERE len(w) > 0)
), sized AS (SELECT r, count(*) AS n FROM shingles GROUP BY r
), shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r GROUP BY ALL
), linked AS (
    SELECT shared.a, shared.b FROM shared JOIN sized x ON x.r = a JOIN sized y ON y.r = b
    WHERE 100 * shared.n >= {percent} * (x.n + y.n - shared.n)
), reached(r, other) AS (
    SELECT r, r FROM texts UNION SELECT reached.r, b FROM reached JOIN linked ON a = other
), least AS (
    SELECT reached.r, min(doc_id) AS component_id
    FROM reached JOIN texts ON texts.r = other GROUP BY reached.r
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM texts JOIN least USING (r) LEFT JOIN sized USING (r)
"""
